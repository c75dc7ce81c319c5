import itertools
import math

import numpy as np
import pyarrow as pa
import pytest

from cohortlift.llm import quality as Q
from cohortlift.llm import words as W


def test_marginals_and_pairs_equal_enumeration():
    rng = np.random.default_rng(1)
    e, t, at = rng.normal(size=9) * 2, rng.normal(size=5), np.array([0, 1, 1, 6, 9])
    p, pairs = Q.forward_backward(e, at, t)
    for lo, hi in zip(at, at[1:]):
        total, on, moves = 0.0, np.zeros(hi - lo), np.zeros((4, hi - lo))
        for tags in itertools.product((0, 1), repeat=hi - lo):
            if not tags:
                continue
            s = t[4] * tags[0] + sum(e[lo + k] * tags[k] for k in range(hi - lo)) + sum(t[2 * a + b] for a, b in zip(tags, tags[1:]))
            total += math.exp(s)
            on += np.array(tags) * math.exp(s)
            for k, (a, b) in enumerate(zip(tags, tags[1:]), 1):
                moves[2 * a + b, k] += math.exp(s)
        if hi > lo:
            assert p[lo:hi] == pytest.approx(on / total) and pairs[:, lo:hi] == pytest.approx(moves / total)


def test_long_chain_equals_recursion():
    rng = np.random.default_rng(2)
    n, t = 5000, np.array([1.5, -2.0, -1.0, 1.0, 0.3])
    e = rng.normal(0, 20, n)
    got, _ = Q.forward_backward(e, np.array([0, n]), t)
    m = t[:4].reshape(2, 2)
    f, b = np.zeros((n, 2)), np.zeros((n, 2))
    f[0] = [0, t[4] + np.clip(e[0], -50, 50)]
    for k in range(1, n):
        f[k] = np.logaddexp(f[k - 1, 0] + m[0], f[k - 1, 1] + m[1]) + [0, np.clip(e[k], -50, 50)]
    for k in range(n - 2, -1, -1):
        x = b[k + 1] + [0, np.clip(e[k + 1], -50, 50)]
        b[k] = np.logaddexp(m[:, 0] + x[0], m[:, 1] + x[1])
    want = 1 / (1 + np.exp(np.clip((f + b)[:, 0] - (f + b)[:, 1], -700, 700)))
    assert got == pytest.approx(want, abs=1e-9)


def test_gradient_equals_differences():
    rng = np.random.default_rng(3)
    at, y, t = np.array([0, 4, 6, 7]), np.array([1, 1, 0, 0, 1, 0, 1]), rng.normal(size=5)
    e = rng.normal(size=7)

    def loglik(e, t):
        out = 0.0
        for lo, hi in zip(at, at[1:]):
            def score(tags):
                return t[4] * tags[0] + sum(e[lo + k] * tags[k] for k in range(hi - lo)) + sum(t[2 * a + b] for a, b in zip(tags, tags[1:]))
            out += score(y[lo:hi]) - math.log(sum(math.exp(score(g)) for g in itertools.product((0, 1), repeat=hi - lo)))
        return out

    p, pairs = Q.forward_backward(e, at, t)
    h = 1e-5
    for k in range(7):
        d = np.eye(7)[k] * h
        assert (loglik(e + d, t) - loglik(e - d, t)) / (2 * h) == pytest.approx(y[k] - p[k], abs=1e-6)
    moves = np.zeros(4)
    for lo, hi in zip(at, at[1:]):
        for a, b in zip(y[lo:hi], y[lo + 1 : hi]):
            moves[2 * a + b] += 1
    for k in range(4):
        d = np.eye(5)[k] * h
        assert (loglik(e, t + d) - loglik(e, t - d)) / (2 * h) == pytest.approx(moves[k] - pairs[k].sum(), abs=1e-6)


def test_line_features_by_hand():
    texts = ["One two TWO two\n\n a, b!! 12 ##\r\nOne two TWO two", "", "   \n\t", "été", None]
    x, points, at, ranges = Q.lines(*W.text_buffer(pa.array(texts, pa.string())))
    got = [dict(zip(Q.FEATURES, map(float, row))) for row in x]
    assert at.tolist() == [0, 3, 3, 3, 4, 4] and points.tolist() == [16, 15, 15, 3] and ranges[0].tolist() == [0, 16]
    a, b = got[0], got[1]
    assert a["letters"] == 1 and a["upper"] == pytest.approx(4 / 12) and a["adjacent_repeats"] == pytest.approx(2 / 4)
    assert a["distinct_words"] == pytest.approx(2 / 4) and a["seen_in_document"] == 1 and b["seen_in_document"] == 0
    assert b["digits"] == pytest.approx(2 / 9) and b["symbols"] == pytest.approx(2 / 9) and b["stops"] == pytest.approx(3 / 9)
    assert b["doubled_marks"] == pytest.approx(2 / 9) and b["lone_marks"] == 0 and b["ends_with_stop"] == 0
    assert got[3]["letters"] == 1 and got[3]["word_length"] == 3
    x, *_ = Q.lines(*W.text_buffer(pa.array(["a | b! "])))
    assert x[0, Q.FEATURES.index("lone_marks")] == pytest.approx(1 / 3) and x[0, Q.FEATURES.index("ends_with_stop")] == 1


def test_slices_do_not_matter(monkeypatch, prose):
    texts = [prose(i, 50).replace(" th", "\n") + ("!!\n" * (i % 3)) for i in range(20)] + ["x" * 256, "y"]
    buffers = W.text_buffer(pa.array(texts))
    whole = Q.lines(*buffers)
    monkeypatch.setattr(Q, "_SLICE", 300)
    for a, b in zip(whole, Q.lines(*buffers)):
        assert np.array_equal(a, b)


@pytest.fixture(scope="module")
def corpus(prose):
    rows, labels = [], []
    for i in range(400):
        lines = [prose(100 * i + k, 12).capitalize() + "." for k in range(4)]
        bad = i % 4 == 0
        if bad:
            lines[1:] = [("$$ ".join(line.split()).upper() if i % 8 else " ".join([line.split()[0]] * 12)) for line in lines[1:]]
        rows.append((i, "\n".join(lines)))
        labels.append((i, int(not bad)))
    return rows, labels


def test_held_out_documents(spark, corpus, prose):
    rows, labels = corpus
    rows = rows + [(1000, None), (1001, ""), (1002, " \n\n"), (None, "A$$ B$$ C$$ D$$"), (7, rows[7][1]), (1003, (prose(5, 9) + ".\n") * 9000)]
    docs = spark.createDataFrame([(i, t, 1.0, "x", 3) for i, t in rows], "doc_id long, text string, score double, lines string, i int").repartition(4)
    known = spark.createDataFrame(labels + labels[:9] + [(None, 1), (5, None), (9999, 1), (6, 2)], "doc_id long, quality int")
    got = Q.quality(docs, known, train=Q.F.col("i") % 3 != 0, max_rows=90).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    held = [i for i, _ in labels if i % 3 == 0]
    assert sum((by[i]["score"] >= 0.3) == (i % 4 != 0) for i in held) >= 0.97 * len(held)
    text = dict(rows)[12]
    assert [text[s["begin"] : s["end"]] for s in by[12]["lines"]] == text.splitlines(True)
    assert by[12]["lines"][0]["good"] > 0.5 > by[12]["lines"][1]["good"]
    assert by[1000]["score"] == by[1001]["score"] == by[1002]["score"] and not by[1000]["lines"]
    assert len(by[1003]["lines"]) == 9000
    bare = Q.quality(docs, known, train=Q.F.col("i") % 3 != 0, max_rows=90, spans=False).collect()
    assert all(r["lines"] is None for r in bare) and sorted(r["score"] for r in bare) == sorted(r["score"] for r in got)


@pytest.mark.parametrize("label", [0, 1, None])
def test_one_label_only(spark, label):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, label)], "doc_id long, quality int")
    got = [r["score"] for r in Q.quality(docs, labels).collect()]
    assert got == pytest.approx([{0: 1e-3, 1: 1 - 1e-3, None: 0.5}[label]] * 2)
    assert Q.quality(docs.limit(0), labels).count() == 0 and Q.quality(docs, labels.limit(0)).count() == 2


def test_both_labels_of_an_id_teach_nothing(spark):
    docs = spark.createDataFrame([(i, "word " * i) for i in range(1, 9)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i in range(1, 9) for y in (0, 1)], "doc_id long, quality int")
    assert {r["score"] for r in Q.quality(docs, labels).collect()} == {0.5}
