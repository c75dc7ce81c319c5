import pytest

from cohortlift.llm import lines as L


def test_first_occurrence_stays(spark):
    boiler, local = "All rights  reserved here", "Only on two sites here"
    rows = [(i, f"own line number {i}\n {boiler} \nshort one\n{boiler}" + (f"\n{local}" if i < 2 else ""), f"s{i}") for i in range(8)]
    rows += [(20, boiler.upper(), "s0"), (21, "", "s1"), (22, None, "s2"), (23, "a b c d", None), (None, boiler, "s9"), (7, rows[7][1], "s7")]
    docs = spark.createDataFrame([(i, t, s, 5, "x") for i, t, s in rows], "doc_id long, text string, source string, n_lines int, pos string").repartition(3)
    out = L.remove_boilerplate(docs, min_sites=5)
    assert out.columns == ["doc_id", "text", "source", "pos", "n_lines", "n_removed"]
    got = {(r["doc_id"], r["text"]): (r["n_lines"], r["n_removed"]) for r in out.collect()}
    assert out.count() == len(rows)
    assert got[(0, f"own line number 0\n {boiler} \nshort one\n{local}")] == (5, 1)  # the second copy in one text goes
    assert got[(1, f"own line number 1\nshort one\n{local}")] == (5, 2)
    assert got[(7, "own line number 7\nshort one")] == (4, 2)
    assert got[(20, "")] == (1, 1) and got[(21, "")] == (1, 0) and got[(22, None)] == (0, 0) and got[(None, boiler)] == (1, 0)


@pytest.mark.parametrize("sites", [4, 5, 6, 300])
def test_near_the_threshold_counts_are_exact(spark, sites):
    rows = [(i * 1000 + s, f"line of {i} words with sites", f"site{s}") for i in range(max(1, sites - 3), sites + 4) for s in range(i)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = L.remove_boilerplate(docs, min_sites=sites).where("n_removed > 0").select(L.F.floor(L.F.col("doc_id") / 1000).alias("i")).distinct()
    assert sorted(r["i"] for r in got.collect()) == list(range(sites, sites + 4))


def test_long_texts_and_no_rows(spark):
    long = "\n".join(f"line of one text {i}" for i in range(20_000))
    docs = spark.createDataFrame([(i, long if i < 3 else f"line of one text {i}", f"s{i}") for i in range(6)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["n_removed"] for r in L.remove_boilerplate(docs, min_sites=3).collect()}
    assert got == {0: 0, 1: 20_000, 2: 20_000, 3: 1, 4: 1, 5: 1}
    assert L.remove_boilerplate(docs.limit(0)).count() == 0


def test_clashing_columns(spark):
    rows = [(i, f"own line number {i}\nthe same old line", f"s{i}", i, "x", "y") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _doc int, _gone string, _LEFT string")
    out = L.remove_boilerplate(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"] and out.where("_gone = 'x' and _LEFT = 'y' and _doc = doc_id").count() == 6
    assert out.agg({"n_removed": "sum"}).first()[0] == 5
