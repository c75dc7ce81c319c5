import itertools
import math

import numpy as np
import pytest

from cohortlift.llm import toxicity as T


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    e, t, start = rng.normal(size=(6, 1)), rng.normal(size=3), 0.7
    forward, backward = T.messages(e, np.ones((6, 1), bool), t, start)
    got = 1 / (1 + np.exp(-(forward + backward)))[:, 0]
    move = {(0, 0): 0, (0, 1): t[0], (1, 0): t[1], (1, 1): t[2]}
    total, on = 0.0, np.zeros(6)
    for tags in itertools.product((0, 1), repeat=6):
        s = start * tags[0] + sum(e[k, 0] * tags[k] for k in range(6)) + sum(move[p] for p in zip(tags, tags[1:]))
        total += math.exp(s)
        on += np.array(tags) * math.exp(s)
    assert got == pytest.approx(on / total)


def test_segments_agree_with_one_long_chain():
    rng = np.random.default_rng(2)
    model = T.Model(bias=-3.0, transitions=(-1.0, -0.5, 1.0), start=-0.5)
    sizes = np.array([0, 1, 255, 256, 257, 1500])
    at = np.concatenate(([0], np.cumsum(sizes)))
    e = rng.normal(-2, 3, at[-1]).astype(np.float32)
    model.emissions = lambda found: e
    got = model.marginals(np.zeros((at[-1], 1), np.uint64), at)
    for lo, hi in zip(at, at[1:]):
        if hi > lo:
            f, b = T.messages(e[lo:hi, None].astype(float), np.ones((hi - lo, 1), bool), np.array(model.transitions), model.start)
            assert got[lo:hi] == pytest.approx(1 / (1 + np.exp(-(f + b)))[:, 0], abs=1e-4)


@pytest.fixture(scope="module")
def corpus(prose):
    rows, labels = [], []
    for i in range(400):
        words = prose(i, 40).split()
        toxic = i % 4 == 0
        if toxic:
            for k in range(3):
                words[5 + 9 * k] = ("Badword!!", "nastyish", "nastything")[k]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_documents(spark, corpus, prose):
    rows, labels = corpus
    rows = rows + [(1000, None), (1001, ""), (1002, "12 !!"), (None, "Badword nastyish nastything"), (7, rows[7][1]), (1003, prose(5, 20_000) + " badword nastyish")]
    docs = spark.createDataFrame([(i, t, 1.0, "x") for i, t in rows], "doc_id long, text string, score double, y string").repartition(4)
    known = spark.createDataFrame(labels + [(None, 1), (5, None), (9999, 1)], "doc_id long, toxic int")
    got = T.toxicity(docs, known, train=T.F.col("i") % 3 != 0).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    held = [i for i, _ in labels if i % 3 == 0]
    assert sum((by[i]["score"] >= 0.3) == (i % 4 == 0) for i in held) >= 0.97 * len(held)
    text = dict(rows)[0]
    assert [text[s["begin"] : s["end"]] for s in by[0]["spans"]] == ["Badword", "nastyish", "nastything"]
    assert by[1000]["score"] == by[1001]["score"] < 0.3 and not by[1000]["spans"]
    assert by[None]["score"] > 0.3 and len(by[1003]["spans"]) == 2
    whole = T.with_toxicity(docs, known)
    assert whole.columns == [*docs.columns, "_toxicity"] and whole.count() == len(rows)


@pytest.mark.parametrize("label", [0, 1, None])
def test_one_label_only(spark, label):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, label)], "doc_id long, toxic int")
    got = T.toxicity(docs, labels).collect()
    assert len(got) == 2 and all((r["score"] > 0.5) == (label == 1) for r in got)
    assert T.toxicity(docs.limit(0), labels).count() == 0 and T.toxicity(docs, labels.limit(0)).count() == 2


def test_labels_without_documents_take_no_place_in_the_sample(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels + [(i, i % 2) for i in range(10_000, 14_000)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in T.toxicity(docs, known, max_toxic=60, max_clean=120).collect()}
    assert sum((got[i] >= 0.3) == bool(y) for i, y in labels) >= 0.97 * len(labels)
    with pytest.raises(ValueError, match="_toxicity"):
        T.with_toxicity(docs.withColumn("_Toxicity", T.F.lit(1)), known)
