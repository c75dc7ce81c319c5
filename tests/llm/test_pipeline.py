import inspect
import random

import duckdb
import pandas as pd
import pytest

import corpus_pipeline as P
from cohortlift.llm.queries import ORACLES, QUERIES


def test_registered():
    import __spark_entry__ as entry

    known = entry.queries()
    assert known["pipeline"] is P.run and set(QUERIES) <= set(known) and set(ORACLES) <= set(entry.oracle_sql())
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in known)] == []
    assert 4 <= len(P.STAGES) <= 5 and all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in P.STAGES)


@pytest.fixture(scope="module")
def folder(spark, prose, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(8)
    boiler = "Subscribe to our letter and never miss a thing"
    bench = [(i, prose(900 + i, 25)) for i in range(4)]
    rows, labels = [], []
    for i in range(240):
        text = prose(i, 80)
        if i % 10 == 3:  # toxic
            words = text.split()
            words[10], words[40] = "nastyword!", "nastyword"
            text = " ".join(words)
        if i % 5 == 4:
            text = f"{boiler}\n{text}"
        if i % 40 == 5:
            text += " " + bench[i // 40 % 4][1]
        rows.append((i, text, "en", f"s{i % 8}", len(text)))
        if i % 2:
            labels.append((i, 1, int(i % 10 == 3)))
    base = rows[0][1].split()
    for k in range(20):  # near copies of document 0
        words = list(base)
        words[rng.randrange(len(words))] = "edited"
        rows.append((1000 + k, " ".join(words), "en", f"s{k % 3}", 1))
    rows += [(2000, None, None, None, None), (2001, "", "en", "s0", 0), (None, prose(5000, 30), "en", "s1", 9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_decide_what_was_planted(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    columns, kept = docs.columns, set(rows)
    expected_gone = {
        "toxicity": {i for i in kept if i is not None and i < 1000 and i % 10 == 3},
        "line_dedup": set(),
        "near_duplicates": {1000 + k for k in range(20)},
        "decontamination": {i for i in kept if i is not None and i < 240 and i % 40 == 5},
    }
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == columns
        path = f"{folder}/out-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        now = {r["doc_id"] for r in docs.collect()}
        assert kept - now == expected_gone[name] and now <= kept, name
        kept = now
    texts = {r["doc_id"]: r for r in docs.collect()}
    holds = [i for i, r in texts.items() if r["text"] and r["text"].startswith("Subscribe")]
    assert holds == [4] and texts[14]["n_chars"] == len(texts[14]["text"])
    mixed = P.STAGES[-1][1](spark, docs, folder).collect()
    size = {i: len((r["text"] or "").split()) for i, r in texts.items()}
    assert {i for r in mixed for i in r["doc_ids"]} <= set(texts)
    assert abs(sum(r["n_words"] for r in mixed) - 1.5 * sum(size.values())) <= 128 * 9


def test_run_equals_its_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    want = sorted(map(str, P.STAGES[-1][1](spark, docs, folder).collect()))
    assert sorted(map(str, P.run(spark, folder).collect())) == want


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    got, want = QUERIES[name](spark, small).toPandas(), con.execute(ORACLES[name]).fetch_df()
    columns = sorted(want.columns)
    one = lambda v: "null" if pd.isna(v) else str(int(v)) if isinstance(v, float) else str(v)
    rows = lambda frame: sorted(tuple(map(one, r)) for r in frame[columns].itertuples(index=False))
    assert sorted(got.columns) == columns and rows(got) == rows(want)
