import numpy as np
import pytest

from cohortlift.llm import mixing as M


def water_fill(sizes, weights, share=1.5, passes=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        rest = share * total - sum(passes * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: passes * sizes[s] if s in full else rest * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in full and target[s] > passes * sizes[s]}
        if not over:
            return target
        full |= over


def test_permutations():
    for n in (1, 2, 3, 17, 1000):
        for key in (0, -5, 1 << 60):
            got = M._permuted(np.arange(n), np.full(n, n), np.full(n, key))
            assert sorted(got) == list(range(n))


@pytest.fixture(scope="module")
def docs(spark, prose):
    rows = [(i, prose(i, 1 + i * 7 % 90), ("a", "b", "c", "d", None)[min(i % 7, 4)]) for i in range(300)]
    rows += [(900, None, "a"), (901, "", "b"), (902, " \n ", "empty"), (903, "one", "tiny"), (None, "x y z", "a"), (5, "x y", "b"), (5, "x y", "b"), (904, prose(1, 20_000), "c")]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, size int, block string").repartition(4)


def test_targets_and_words_taken(spark, docs):
    got = M.taken_words(docs, block_words=16, shard_slots=100)
    rows = got.collect()
    assert len(rows) == docs.count() and sorted(map(str, rows)) == sorted(map(str, M.taken_words(docs.repartition(2), block_words=16, shard_slots=100).collect()))
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert {r["source_size"] for r in rows} == set(sizes.values())
    want = water_fill(sizes, M.WEIGHTS)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 16


def test_the_mix_holds_the_words(spark, docs):
    slots = M.mix(docs, block_words=16, shard_slots=100).collect()
    assert all(len(s["text"].split()) == s["n_words"] <= 16 for s in slots)
    by_shard = {}
    for s in slots:
        by_shard.setdefault(s["shard"], []).append(s["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert all(len(v) == 100 for k, v in by_shard.items() if k != max(by_shard))
    assert sum(s["n_words"] for s in slots) == M.taken_words(docs, block_words=16, shard_slots=100).agg(M.F.sum("taken")).first()[0]
    # the blocks of one full pass are the source's words
    whole = {}
    for s in slots:
        if s["source"] == "a" and s["pass_no"] == 0:
            whole[s["block"]] = s["text"]
    if len(whole) == max(whole) + 1:
        words = " ".join(whole[b] for b in sorted(whole)).split()
        texts = [r["text"] for r in docs.where("source = 'a' and text is not null").collect()]
        assert sorted(words) == sorted(w for t in texts for w in t.split())


def test_words_taken_of_each_document_are_those_in_the_slots(spark):
    from collections import Counter

    rows = [(i, " ".join(f"d{i}w{k}" for k in range(1 + i * 5 % 37)), "abcd"[i % 4] if i % 9 else None) for i in range(120)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = {r["doc_id"]: r["taken"] for r in M.taken_words(table, block_words=16, shard_slots=50).collect()}
    slots = M.mix(table, block_words=16, shard_slots=50).collect()
    found = Counter(int(w[1:].split("w")[0]) for s in slots for w in s["text"].split())
    assert got == {i: found[i] for i, *_ in rows}
    assert all({int(w[1:].split("w")[0]) for w in s["text"].split()} == set(s["doc_ids"]) for s in slots)


def test_no_rows_and_no_words(spark, docs):
    assert M.taken_words(docs.limit(0)).count() == 0 and M.mix(docs.limit(0)).count() == 0
    empty = docs.where("doc_id in (900, 901, 902)")
    assert [r["taken"] for r in M.taken_words(empty).collect()] == [0, 0, 0] and M.mix(empty).count() == 0
