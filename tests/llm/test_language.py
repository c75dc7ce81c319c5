import random

import numpy as np
import pytest

from cohortlift.llm import language as G

WORDS = {"aa": "the and thing over water house".split(), "bb": "der und haus über wasser straße".split(), "cc": "дом вода и над улица".split()}


def sentence(lang, seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def test_gradients():
    rng = np.random.default_rng(0)
    d = G.Direction(rng.normal(0, 0.4, (256, 6)), rng.normal(0, 0.4, (6, 2)), rng.normal(0, 0.1, (2, 1)))
    codes = rng.integers(0, 256, (5, 3))
    target = rng.normal(size=(5, 2, 3))
    states, tape = d.run(codes, keep=True)
    gx, gu, gb = d.back(codes, tape, target.astype(np.float32))
    for array, grad in ((d.u, gu), (d.b, gb), (d.x, gx)):
        for _ in range(4):
            at = (codes[0, 0], rng.integers(6)) if array is d.x else tuple(rng.integers(s) for s in array.shape)
            step, kept = 1e-2, array[at]
            array[at] = kept + step
            high = (d.run(codes)[0] * target).sum()
            array[at] = kept - step
            low = (d.run(codes)[0] * target).sum()
            array[at] = kept
            assert (high - low) / (2 * step) == pytest.approx(grad[at], rel=0.05, abs=5e-3)


def by_hand(net, text):
    """Mean probabilities of the bytes of letters of a text, one byte after the other."""
    raw, h = text.encode(), net.out.shape[1] // 2
    total, letters = np.zeros(len(net.langs)), 0

    def states(d, codes):
        state, out = np.zeros(h), []
        for c in codes:
            x, a = d.x[c].astype(float), d.u @ state
            z, r = (np.clip(0.5 + 0.25 * (a[k * h : (k + 1) * h] + x[k * h : (k + 1) * h]), 0, 1) for k in (0, 1))
            cand = np.clip(r * (a[2 * h :] + d.b[:, 0]) + x[2 * h :], -1, 1)
            state = z * state + (1 - z) * cand
            out.append(state)
        return out

    for lo in range(0, len(raw), G.WINDOW):
        codes = list(raw[lo : lo + G.WINDOW])
        codes += [32] * (G.WINDOW - len(codes))
        ahead, behind = states(net.forward, codes), states(net.backward, codes[::-1])[::-1]
        for k, c in enumerate(raw[lo : lo + G.WINDOW]):
            if G.LETTERS[c]:
                e = net.out @ np.concatenate((ahead[k], behind[k])) + net.bias[:, 0]
                total += np.exp(e - e.max()) / np.exp(e - e.max()).sum()
                letters += 1
    return total / max(1, letters)


def test_pooled_labels_equal_single_bytes():
    net = G.fit([sentence(lang, i, 20) for lang in WORDS for i in range(6)], [lang for lang in WORDS for _ in range(6)], steps=20)
    texts = ["the water", "", "12 ?!", "дом вода и над " * 9, sentence("bb", 3, 40), "x" * G.WINDOW, "x" * (G.WINDOW + 1)]
    raw, offsets = G.W.text_buffer(G.pa.array(texts))
    got = G.pooled(net, raw, offsets)
    assert got == pytest.approx(np.array([by_hand(net, t) for t in texts]), abs=1e-4)


def test_held_out_accuracy(spark):
    rows = [(i, sentence(lang, i, 3 + i % 30), lang, "x") for i, lang in enumerate(list(WORDS) * 60)]
    extra = [(1000, None, "aa", ""), (1001, "", None, ""), (1002, "12 ?! 3", "bb", ""), (1003, sentence("cc", 1, 8000), None, ""), (None, "water house", None, ""), (0, rows[0][1], "aa", "")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, score string").repartition(3)
    got = G.identify(docs, train=G.F.col("id") % 5 != 0).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    held = [(i, lang) for i, _, lang, _ in rows if i % 5 == 0]
    assert sum(by[i] == lang for i, lang in held) >= 0.95 * len(held)
    assert (by[1000], by[1001], by[1002], by[1003], by[None]) == ("und", "und", "und", "cc", "aa")


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "word", None), (2, None, "aa")], "doc_id long, text string, lang string")
    assert [tuple(r) for r in G.identify(docs).sort("doc_id").collect()] == [(1, "und", 0.0), (2, "und", 0.0)]
    assert G.identify(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "word", "aa"), (2, "x", None)], docs.schema)
    assert {r["lang_pred"] for r in G.identify(one).collect()} == {"aa"}
