import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from cohortlift.llm import jaccard as J
from cohortlift.llm.components import components

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(rows, n, num, den):
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                o = len(sets[a] & sets[b])
                if den * o >= num * (len(sets[a]) + len(sets[b]) - o):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(prose):
    rng = random.Random(5)
    base, rows = prose(1, 150).split(), []
    for i in range(70):  # near copies at all distances, so that links form chains
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(40)}"
        rows.append((i * 3 + 1, " ".join(words)))
    rows += [(1000 + i, prose(100 + i, rng.randint(0, 30)) + " shared tail of many texts " * rng.randint(0, 2)) for i in range(60)]
    rows += [(2000 + i, prose(100 + i % 9, 14 + i % 3)) for i in range(30)]
    rows += [(3000, None), (3001, ""), (3002, " \n\t"), (3003, "One"), (3004, "ONE"), (3005, "one two"), (3006, prose(9, 30_000)), (3007, prose(9, 30_000).upper())]
    return rows


@pytest.mark.parametrize("n,num,den,small", [(4, 85, 100, False), (5, 4, 5, True)])
def test_equals_brute_force(spark, prose, n, num, den, small):
    rows = corpus(prose)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, rep string").repartition(5)
    blocks = dict(block_grams=2500, block_rows=20) if small else {}
    got = {r[0]: (r[1], r[2]) for r in J.jaccard_join(docs, n=n, num=num, den=den, **blocks).collect()}
    assert got == brute(rows, n, num, den)


def test_null_ids_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (None, "a b c d e f"), (4, None)], "doc_id long, text string")
    got = sorted(map(tuple, J.jaccard_join(docs, n=4).collect()), key=str)
    assert got == sorted([(1, 3, 1), (1, 3, 1), (2, 3, 1), (None, None, None), (4, 0, 4)], key=str)
    assert J.jaccard_join(docs.limit(0), n=4).count() == 0


@pytest.mark.parametrize("n,num,den", [(5, 4, 5), (4, 85, 100)])
def test_texts_that_share_passages_do_not_become_one_cluster(spark, prose, monkeypatch, n, num, den):
    passages = [prose(500 + i, 40) for i in range(6)]
    rows = [(i, f"{prose(i, 25)} {passages[i % 6]} {prose(1000 + i, 15)} {passages[i % 5]}") for i in range(240)]
    rows += [(300 + i, rows[i][1] + " end") for i in range(0, 240, 40)]
    members, deal = [], J._blocks
    monkeypatch.setattr(J, "_blocks", lambda member, *a: members.append(member.groupBy("cluster").count().collect()) or deal(member, *a))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r[0]: (r[1], r[2]) for r in J.jaccard_join(docs, n=n, num=num, den=den).collect()}
    assert got == brute(rows, n, num, den)
    assert sum(v[1] != i for i, v in got.items()) == 6
    assert max(r["count"] for r in members[0]) < 10  # all of them would meet by their passages


def sets_with_links(rng, count):
    """Sets around a few centres, at all distances up to and beyond the threshold."""
    centres = [rng.integers(1, 1 << 63, int(rng.integers(6, 400))).astype(np.uint64) for _ in range(4)]
    out = []
    for i in range(count):
        c = centres[i % 4]
        gone = int(rng.integers(0, len(c) // 5 + 2))
        out.append(np.unique(np.concatenate((rng.permutation(c)[gone:], rng.integers(1, 1 << 63, int(rng.integers(0, len(c) // 5 + 2))).astype(np.uint64)))))
    return out


def rooted(ids, links):
    label = {i: i for i in ids}
    for _ in range(len(label)):
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    return label


@pytest.mark.parametrize("slots", [64, 1 << 15])
def test_sketches_lose_no_link(monkeypatch, slots):
    monkeypatch.setattr(J, "MOST_SLOTS", slots)
    sets = sets_with_links(np.random.default_rng(11), 160)
    linked = [
        (i, j) for i, x in enumerate(sets) for j, y in enumerate(sets)
        if i < j and 5 * len(np.intersect1d(x, y)) >= 4 * len(np.union1d(x, y))
    ]
    assert len(linked) > 100
    columns = [[7] * len(sets), list(range(len(sets))), [len(u) for u in sets], [J.sketch(u) for u in sets]]
    whole = pa.record_batch([pa.array(c) for c in columns], ["group", "doc", "n", "sketch"])
    for size in (1, 13, 160):
        batches = (whole.slice(lo, size) for lo in range(0, 160, size))
        links = [x for b in J._plausible(batches, 4, 5) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        label = rooted(range(len(sets)), links)
        assert all(label[i] == label[j] for i, j in linked)
        if slots > 64:
            assert len(set(label.values())) >= 4


def test_rows_of_equal_keys_are_grouped_over_batches(monkeypatch):
    keys, ids = [1, 1, 2, 2, 3, 4, 4, 4, 4, 4, 4, 4, 5, 5, 5], [8, 9, 9, 8, 8, 1, 2, 3, 4, 5, 6, 7, 7, 8, 7]
    for held in (4, 1 << 19):
        monkeypatch.setattr(J, "STRUNG_AT_ONCE", held)
        for most in (3, 100):
            monkeypatch.setattr(J, "GROUP_ROWS", most)
            for size in (1, 4, 15):
                batches = (pa.record_batch([pa.array(keys[lo : lo + size]), pa.array(ids[lo : lo + size])], ["key", "doc"]) for lo in range(0, 15, size))
                rows = [tuple(r.values()) for b in J._group(batches) for r in b.to_pylist()]
                groups = {}
                for g, a, b in rows:
                    if b is None:
                        groups.setdefault(g, []).append(a)
                small = [[7, 8], [8, 9]]
                assert sorted(groups.values()) == (small if most == 3 else [[1, 2, 3, 4, 5, 6, 7], *small])
                links = [(a, b) for _, a, b in rows if b is not None]
                assert bool(links) == (most == 3)
                if links:
                    assert rooted(range(1, 8), links) == dict.fromkeys(range(1, 8), 1)
    assert not list(J._group(iter(())))


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(2)
    for _ in range(400):
        size = int(rng.integers(6, 90))
        x = rng.integers(1, 1 << 63, size).astype(np.uint64)
        change = int(rng.integers(0, size // 6 + 2))
        y = np.concatenate((x[change:], rng.integers(1, 1 << 63, int(rng.integers(0, size // 6 + 2))).astype(np.uint64)))
        x, y = np.unique(x), np.unique(y)
        o = len(np.intersect1d(x, y))
        if 100 * o >= 85 * (len(x) + len(y) - o) and o < max(len(x), len(y)):
            assert set(J.candidate_keys(x, 85, 100).tolist()) & set(J.candidate_keys(y, 85, 100).tolist())


def test_product_of_frequent_and_rare_columns():
    rng = np.random.default_rng(3)
    for rows, columns, size in ((40, 60, 30), (90, 3000, 40), (3, 8, 6)):
        sets = [np.unique(rng.integers(0, columns, size)).astype(np.uint64) for _ in range(rows)]
        sets += [np.unique(np.concatenate((s[1:], [columns + 1]))).astype(np.uint64) for s in sets[: rows // 2]]
        want = {
            (i, j)
            for i, a in enumerate(sets) for j, b in enumerate(sets)
            if i < j and 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b))
        }
        label = np.arange(len(sets))
        for i, j in sorted(want) * 3:
            label[[i, j]] = min(label[i], label[j])
        for _ in range(len(sets)):
            for i, j in want:
                label[[i, j]] = min(label[i], label[j])
        got = np.arange(len(sets))
        for found in J._product(sets, 4, 5):
            got[found[0]] = found[1]
        assert (got == label).all()


def peak(run):
    """What ``run`` returns, and the most bytes that it holds of Python's and numpy's memory."""
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_keys_are_strung_in_little_memory():
    rng = np.random.default_rng(4)
    keys, ids = rng.integers(1, 1 << 21, 3 << 20), rng.integers(1, 1 << 40, 3 << 20)
    keys[: 1 << 20] = 7  # one key has more rows than are held at once
    keys.sort()
    batches = (pa.RecordBatch.from_arrays([pa.array(x[lo : lo + 10_000]) for x in (keys, ids)], ["key", "doc"]) for lo in range(0, len(keys), 10_000))
    count, most = peak(lambda: sum(b.num_rows for b in J._string(batches)))
    assert most < 20 * len(keys)  # of 16 bytes a row
    assert len(keys) - len(np.unique(keys)) <= count <= len(keys)


def test_a_task_returns_a_link_once():
    rng = np.random.default_rng(7)
    keys, ids = np.sort(rng.integers(1, 1 << 19, 3 << 19)), rng.integers(1, 50, 3 << 19)
    got = list(J._string(iter([pa.record_batch([pa.array(keys), pa.array(ids)], ["key", "doc"])])))
    links = [link for b in got for link in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    assert 48 <= len(links) == len(set(links)) <= 49 * 48 // 2


def test_rows_of_a_key_are_strung_over_batches(monkeypatch):
    monkeypatch.setattr(J, "STRUNG_AT_ONCE", 4)
    keys, ids = [1, 1, 1, 1, 1, 1, 1, 2, 3, 3, 3, 3], [9, 8, 7, 6, 5, 6, 4, 9, 20, 23, 21, 22]
    for size in (1, 3, 5, 12):
        batches = (pa.record_batch([pa.array(keys[lo : lo + size]), pa.array(ids[lo : lo + size])], ["key", "doc"]) for lo in range(0, 12, size))
        label = {i: i for i in ids}
        links = [link for b in J._string(batches) for link in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        for _ in ids:
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        assert label == {i: 4 if i < 10 else 20 for i in ids}
    assert not list(J._string(iter(())))


def test_incidence_leaves_in_small_batches():
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(5000)])
    texts = [" ".join(words[rng.integers(0, 5000, 350)]) for _ in range(1500)]
    batch = pa.record_batch([pa.array(range(1500)), pa.array(texts)], ["doc", "text"])
    made = list(J._incidence(iter([batch]), 4, 85, 100))
    assert max(b.num_rows for b in made) <= 1 << 16
    got = {int(b.column(0)[0].as_py()): 0 for b in made}
    for b in made:
        got[int(b.column(0)[0].as_py())] += b.num_rows
    assert got[0] == 1500 and got[1] > 1 << 16


def test_a_product_takes_little_memory_besides_its_ngrams():
    rng = np.random.default_rng(6)
    base = rng.integers(1, 1 << 63, 1600).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[rng.random(1600) < 0.97], rng.integers(1, 1 << 63, 20).astype(np.uint64)))) for _ in range(600)]
    grams = sum(map(len, sets))
    found, most = peak(lambda: list(J._product(list(sets), 85, 100)))
    assert [x.shape for x in found] == [(2, 599)]
    assert most < 48 * grams


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(200, 100), (5, 5), (None, 3)], "a long, b long")
    got = dict(components(edges, "a", "b").collect())
    assert got == {**{i: 0 for i in range(1, 61)}, 200: 100}
