import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlift.llm import negatives as N
from cohortlift.llm import vectors as V


def by_hand(rows, anchors, k=5, floor=80, scale=256):
    """Rows (id, label, vector), each taken once."""
    good = {}
    for i, label, v in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(scale * x) for x in v):
            continue
        q = tuple(math.floor(scale * x) for x in v)
        if len(q) * max(map(abs, q)) ** 2 < 2**63:
            good[i, label, q] = None
    want = []
    for a, own, v in [r for r in good if r[0] % anchors == 0]:
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, label) for i, label, w in good if i != a and len(w) == len(v))
        for s, p, _ in [r for r in scored if r[2] == own][:k]:
            near = [r for r in scored if r[2] != own and floor * -s <= 100 * -r[0] <= 100 * -s][:k]
            want += [(a, p, rank, i, -s, -t) for rank, (t, i, _) in enumerate(near, 1)]
    return sorted(want)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (4, 6))
    made = [(i, i % 4, (centres[(i + (i % 5 == 0)) % 4] + rng.normal(0, 0.4, 6)).round(1).tolist()) for i in range(300)]
    made += [(i, i % 3, [1.0, 0.5, 0.0, -0.25, 2.0, 1.0]) for i in range(300, 380)]  # ties
    made += [
        (400, 1, None), (401, 1, []), (402, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, 2, [math.inf] * 6), (404, 2, [math.nan] * 6),
        (405, None, [1.0] * 6), (None, 1, [1.0] * 6), (410, 1, [1.0, 2.0]), (420, 1, [0.5, 1.0]), (421, 0, [0.5, 0.9]), (430, 2, [0.0] * 6),
        (440, 1, [1e30] * 6), (450, 1, [1e308] + [0.0] * 5), (451, 3, [-1.0] * 6), made[0], (20, 3, [9.0] * 6), (460, 9, [2.0] * 6),
    ]
    return made


@pytest.mark.parametrize("settings", [{}, {"blocks": 1}, {"blocks": 7, "at_once": 2}, {"blocks": 1, "block_rows": 40}])
def test_equals_brute_force(spark, rows, settings):
    table = spark.createDataFrame([(i, v, y, 1, 2, 3) for i, y, v in rows], "vec_id long, embedding array<double>, label int, rank int, key int, c int")
    found = N.hard_negatives(table.repartition(3), F.col("vec_id") % 10 == 0, **settings)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = by_hand(rows, 10)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 100


def test_other_sizes_and_labels(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = N.hard_negatives(table, F.col("vec_id") % 20 == 0, label=F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 4).otherwise(F.col("label")), k_positive=3, k_negative=3, floor=50, scale=10)
    moved = [(i, None if y is None else (y + 1) % 4 if i is not None and i % 7 == 0 else y, v) for i, y, v in rows]
    assert sorted(map(tuple, found.collect())) == by_hand(moved, 20, 3, 50, 10)
    for empty in (table.limit(0), table.where("vec_id = 1"), table.where("label = 0")):
        assert N.hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0


def test_large_components_stay_exact(spark):
    big = 1 << 28
    rows = [(i, i % 2, [float(big + i * j) for j in range(1, 5)]) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = N.hard_negatives(table, F.col("vec_id") % 10 == 0, scale=1)
    assert sorted(map(tuple, got.collect())) == by_hand(rows, 10, scale=1) != []


def test_packed_integers():
    for top in (5, 300, 70_000, 1 << 30):
        v = np.array([top, -top, 0.5, -0.5])
        assert V.unpack(V.quantise(v, 1)).tolist() == [top, -top, 0, -1]
    assert V.unpack(V.quantise(np.array([1 << 31]), 1)).tolist() == [1 << 31]
    assert V.quantise(np.array([1e10]), 1) is None and V.quantise(np.array([]), 1) is None and V.quantise(np.array([np.nan]), 1) is None
    a, b = np.array([[1 << 30, 3]]), np.array([[1 << 30, 5], [7, 1]])
    assert V.products(a, b).tolist() == [[(1 << 60) + 15, (7 << 30) + 3]]


def test_slots_answer_each_window():
    rng = np.random.default_rng(6)
    ids = np.arange(500)
    rows = [(int(i), int(i % 2), V.quantise(rng.integers(0, 20, 4).astype(float), 1)) for i in ids]
    block = N.Block(rows)
    key, limits = 7, [900, 700, 700, 650, 300]
    found = list(N.negatives(block, [(key, 0, 0, rows[0][2], limits)], 5, 80, 100))
    (_, got_ids, labels, scores), = block.scores([(key, 0, 0, rows[0][2], limits)])
    merged = sorted(((-s, i) for _, _, i, s in found))
    for p in limits:
        low, high = N.window(p, 80, 100)
        want = sorted((-int(s), int(i)) for i, y, s in zip(got_ids, labels, scores) if y != 0 and low <= s <= high)[:5]
        assert [m for m in merged if -m[0] <= high][:5][: len(want)] == want
    assert max(sum(1 for f in found if f[1] == slot) for slot in range(4)) <= 5
