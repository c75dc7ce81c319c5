import math

import numpy as np
import pytest

from cohortlift.llm import topk as K


@pytest.mark.parametrize("scale", [1, 1 << 25])
def test_block_equals_brute_force(scale):
    rng = np.random.default_rng(1)
    for n, width in ((3, 4), (200, 8), (500, 3)):
        vectors = rng.integers(-9, 10, (n, width)) * scale
        lists = K.Lists(np.arange(n)[::-1].copy(), vectors)
        queries = np.stack((vectors[0], -vectors[1], np.zeros(width, np.int64), vectors[2] * np.array([1] + [0] * (width - 1))))
        found, _ = lists.best(np.full(4, n - 1), queries, 5)
        for q, (ids, scores) in zip(queries, found):
            want = sorted(((-int(s), int(i)) for i, s in zip(lists.ids, vectors @ q) if i != n - 1))[:5]
            assert [(-int(s), int(i)) for i, s in zip(ids, scores)] == want


def test_bounds_hold_and_close_with_depth():
    rng = np.random.default_rng(9)
    vectors, queries = rng.integers(-50, 51, (200, 5)), rng.integers(-50, 51, (7, 5))
    lists, exact, width = K.Lists(np.arange(200), vectors), queries @ vectors.T, None
    for depth in (1, 40, 120, 200):
        lower, upper = lists.bounds(queries, depth, np.float64)
        assert (lower <= exact).all() and (exact <= upper).all()
        assert width is None or ((upper - lower) <= width).all()
        width = upper - lower
    assert not width.any()


def test_reading_stops_early():
    rng = np.random.default_rng(2)
    centre = rng.normal(0, 100, 16)
    vectors = np.concatenate((rng.normal(0, 3, (3000, 16)), centre + rng.normal(0, 1, (8, 16)))).round().astype(np.int64)
    _, read = K.Lists(np.arange(len(vectors)), vectors).best(np.array([3000]), vectors[3000:3001], 5)
    assert read <= 0.5 * vectors.size


def test_query_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 6).round(1).tolist()) for i in range(260)]
    rows += [(i, [1.0, 0.5, 0.0, -0.25, 2.0, 1.0]) for i in range(300, 380)]  # ties
    rows += [(400, None), (401, []), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, [math.inf] * 6), (404, [math.nan] * 6), (None, [1.0] * 6), (410, [1.0, 2.0]), (420, [0.5, 1.0]), (0, rows[0][1])]
    table = spark.createDataFrame([(i, v, 1, 7) for i, v in rows], "vec_id long, embedding array<double>, score int, rank int").repartition(3)
    good = {i: [math.floor(256 * x) for x in v] for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in [i for i in good if i % 10 == 0]:
        scored = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:5], 1)]
    for sizes in ({}, {"candidates": 50, "tasks": 1}, {"candidates": 20, "tasks": 2, "task_rows": 70}):
        got = K.top_k(table, K.F.col("vec_id") % 10 == 0, **sizes).collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert K.top_k(table.limit(0), K.F.col("vec_id") % 10 == 0).count() == 0


def test_extreme_components(spark):
    rows = [(i, [float(1 << 28), float(i), -3.5]) for i in range(12)]
    rows += [(20, [1e30, 0.0, 0.0]), (21, [1e308, 1.0, 1.0]), (22, [float(1 << 31), 0.0, 0.0]), (23, [-1.0, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = K.top_k(table, K.F.col("vec_id") % 5 == 0, scale=1, tasks=2).collect()
    good = {i: [math.floor(x) for x in v] for i, v in rows if i not in (20, 21, 22)}
    want = []
    for q in (0, 5, 10):
        scored = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:5], 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_a_bar_keeps_ties():
    rng = np.random.default_rng(8)
    vectors = rng.integers(-20, 21, (300, 6))
    lists = K.Lists(np.arange(300), vectors)
    ((ids, scores),), _ = lists.best(np.array([3]), vectors[3:4], 5)
    ((again, same),), _ = lists.best(np.array([3]), vectors[3:4], 5, scores[-1:])
    assert again.tolist() == ids.tolist() and same.tolist() == scores.tolist()
