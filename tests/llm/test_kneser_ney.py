import collections
import math
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlift.llm import kneser_ney as K

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)) + ["end"]


def brute(train, order):
    """Probability function of an interpolated model with modified discounts, by the definition."""
    counts = [None] * (order + 1)
    counts[order] = collections.Counter()
    raw = collections.Counter()
    for t in train:
        words = ["begin"] * (order - 1) + tokens(t)
        raw.update(words[order - 1 :])
        counts[order].update(tuple(words[i : i + order]) for i in range(len(words) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
    discounts = [None] + [K._discounts(*(sum(c == n for c in counts[k].values()) for n in (1, 2, 3, 4))) for k in range(1, order + 1)]
    follow = [None] + [collections.defaultdict(collections.Counter) for _ in range(order)]
    for k in range(1, order + 1):
        for g, c in counts[k].items():
            follow[k][g[:-1]][g[-1]] = c

    def p(history, word, k=order):
        if k == 0:
            return 1 / (len(raw) + 1)
        seen = follow[k].get(tuple(history[len(history) - k + 1 :]))
        lower = p(history, word, k - 1)
        if not seen:
            return lower
        d = (0, *discounts[k])
        rest = sum(d[min(c, 3)] for c in seen.values())
        c = seen[word]
        return (max(c - d[min(c, 3)], 0) + rest * lower) / sum(seen.values())

    return raw, p


@pytest.mark.parametrize("order", [2, 3])
def test_equals_the_definition(spark, prose, order):
    texts = [prose(i % 7, 5 + i) for i in range(40)] + [None, "", "a b A B a b c", prose(3, 4000)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string").repartition(4)
    model = K.train(docs.where("doc_id % 5 <> 0").select("text"), order)
    got = {r["doc_id"]: r for r in K.score(docs, model).collect()}
    raw, p = brute([t for i, t in enumerate(texts) if i % 5], order)
    total = sum(raw.values())
    for i, t in enumerate(texts):
        words = tokens(t)
        padded = ["begin"] * (order - 1) + words
        score = sum(math.log10(p(padded[j : j + order - 1], w)) for j, w in enumerate(words))
        base = sum(math.log10((raw[w] + 1) / (total + len(raw) + 1)) for w in words)
        row = got[i]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(words), sum(raw[w] > 0 for w in words), total)
        assert row["score"] == pytest.approx(score, rel=1e-9) and row["base_score"] == pytest.approx(base, rel=1e-9)


def test_probabilities_add_up(spark, prose):
    texts = [prose(i % 4, 30) for i in range(20)]
    raw, p = brute(texts, 3)
    for history in (["begin", "begin"], tokens(texts[0])[:2], ["no", "such"]):
        # over the vocabulary and one unknown word
        assert sum(p(history, w) for w in raw) + p(history, "unknown word") == pytest.approx(1)


def test_counts_beyond_a_byte(spark):
    docs = spark.createDataFrame([(1, "a b " * 5000)], "doc_id long, text string")
    model = K.train(docs.select("text"))
    raw, p = brute(["a b " * 5000], 2)
    row = K.score(docs, model).first()
    words = tokens("a b " * 5000)
    assert row["score"] == pytest.approx(sum(math.log10(p(["begin", *words][i : i + 1], w)) for i, w in enumerate(words)), rel=1e-9)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "c")], "doc_id long, text string")
    model = K.train(docs.limit(0).select("text"))
    got = K.score(docs, model).withColumn("zero", F.col("score") == 0).collect()
    assert len(got) == 3 and all(r["zero"] and r["n_known"] == 0 for r in got)
    assert K.score(docs.limit(0), model).count() == 0


def test_remote_folder_is_refused():
    with pytest.raises(ValueError):
        K.local_path("hdfs://name/folder")


def test_the_query_sees_more_than_one_word_back(spark, tmp_path):
    from cohortlift.llm.queries import op5_kneser_ney

    # Both texts have the same pairs of words; only triples tell them apart.
    rows = list(enumerate(["a b c", "d b e"] * 20 + ["a b e"]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["score"] for r in op5_kneser_ney(spark, str(tmp_path)).collect()}
    assert got[0] > got[40] + 0.5


def test_an_n_gram_takes_little_room(spark):
    rng = random.Random(3)
    texts = [(" ".join(f"w{rng.randrange(40)}" for _ in range(4000)),) for _ in range(20)]
    model = K.train(spark.createDataFrame(texts, "text string"), 3)
    folder = model.words.arrays.folder
    grams = sum(s["n"] for x in model.grams for s in x.stats().values())
    took = sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f[:6] in ("grams2", "grams3", "contex") and not f.endswith("json"))
    # a word's number and a byte, besides what the few contexts take; a hash and a byte before
    assert took < 7 * grams, (took, grams)


def test_followers_of_a_word_that_much_follows(spark):
    # Contexts of more than 255 followers between others: places, counts and totals beyond a byte.
    rng = random.Random(4)
    texts = [" ".join(f"a x{rng.randrange(900)} b{rng.randrange(5)} c" for _ in range(300)) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate([*texts, "a x3 nowhere", "b1 c a"])), "doc_id long, text string").repartition(3)
    model = K.train(docs.where("doc_id < 12").select("text"), 3)
    _, p = brute(texts, 3)
    for row in K.score(docs, model).collect():
        words = tokens((texts + ["a x3 nowhere", "b1 c a"])[row["doc_id"]])
        padded = ["begin"] * 2 + words
        assert row["score"] == pytest.approx(sum(math.log10(p(padded[j : j + 2], w)) for j, w in enumerate(words)), rel=1e-9)


def test_blocks_are_packed_without_loss():
    rng = np.random.default_rng(1)
    for types in (["u4", "u4", "u4"], ["u8", "u4"]):
        columns = [rng.integers(0, 1 << 32, 1000).astype(t) for t in types]
        columns[0].sort()
        packed = K._pack(columns)
        got = K._unpack(pa.scalar(packed, pa.binary()), types)
        assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(columns, got))
    small = [np.sort(rng.integers(0, 1 << 20, 20_000)).astype("u4"), rng.integers(0, 1 << 20, 20_000).astype("u4"), np.ones(20_000, "u4")]
    assert len(K._pack(small)) < 5 * 20_000  # 12 bytes a row before
