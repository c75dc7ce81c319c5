import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlift.operators import evaluate as E
from cohortlift.operators import profile as P


def area(rows):
    pos, neg = [p for y, p in rows if y == 1], [p for y, p in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12)), min_size=1, max_size=60))
def test_auc_equals_pair_count(spark, rows):
    rows = [(y, p / 12) for y, p in rows]
    got = E.auc(spark.createDataFrame(rows, "y int, p double"), n=4).first()["auc"]
    want = area(rows)
    assert got is None if want is None else got == pytest.approx(want)


def test_auc_per_group_and_missing_values(spark):
    rng = random.Random(1)
    rows = [(g, rng.randint(0, 1), round(rng.random(), 2)) for g in "abc" for _ in range(80)]
    rows += [("one", 1, 0.5), ("one", 1, 0.7), ("a", None, 0.1), ("a", 1, None)]
    got = {r["g"]: r["auc"] for r in E.auc(spark.createDataFrame(rows, "g string, y int, p double"), by=["g"], n=8).collect()}
    for g in "abc":
        assert got[g] == pytest.approx(area([(y, p) for k, y, p in rows if k == g and y is not None and p is not None]))
    assert got["one"] is None


def test_auc_of_equal_scores(spark):
    df = spark.createDataFrame([(i % 2, 0.3) for i in range(10)], "y int, p double")
    assert E.auc(df).first()["auc"] == 0.5


def wide_rows(spark, n=600):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.4)
        rows.append((i, y, min(max(0.5 + 0.1 * y + rng.gauss(0, 0.2), 0.0), 1.0), min(max(0.5 + 0.15 * y + rng.gauss(0, 0.3), 0.0), 1.0), rng.random()))
    return rows, spark.createDataFrame(rows, "id int, y int, a double, b double, c double").persist()


def test_weight_search(spark):
    rows, wide = wide_rows(spark)
    starts = [(1, 0, 0), (0, 1, 0), (0, 0, 1)]
    weights, best = E.search_weights(wide, ["a", "b", "c"], starts, rounds=4)
    assert sum(weights) == pytest.approx(1.0, abs=1e-5) and min(weights) >= 0
    singles = [area([(r[1], r[2 + j]) for r in rows]) for j in range(3)]
    assert best >= max(singles) - 1e-12
    assert best == pytest.approx(area([(r[1], sum(w * x for w, x in zip(weights, r[2:]))) for r in rows]), abs=1e-6)
    binned = {r["candidate"]: r["auc"] for r in E.candidate_auc(wide, ["a", "b", "c"], dict(enumerate(starts)), edges=E.score_edges(wide, ["a", "b", "c"])).collect()}
    assert binned[2] == pytest.approx(singles[2], abs=2e-3)


def test_blend_weights(spark):
    df = spark.createDataFrame([(0.2, 0.6)], "a double, b double")
    assert df.select(E.blend(["a", "b"], (3, -1))).first()[0] == pytest.approx(0.2)
    assert df.select(E.mean_blend(["a", "b"])).first()[0] == pytest.approx(0.4)
    with pytest.raises(ValueError):
        E.blend(["a"], (-1.0,))


def test_rank_normalise_with_ties(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.5), (3, 0.1), (4, 0.9)], "id int, p double")
    got = {r["id"]: r["rank_p"] for r in E.rank_normalise(df, n=2).collect()}
    assert got == {1: 2.5 / 4, 2: 2.5 / 4, 3: 1 / 4, 4: 1.0}


def test_rank_normalise_keeps_missing_scores_and_groups(spark):
    df = spark.createDataFrame([(1, None, 0.5), (2, None, 0.7), (3, "a", 0.1), (4, "a", None)], "id int, g string, p double")
    got = {r["id"]: r["rank_p"] for r in E.rank_normalise(df, by=["g"], n=2).collect()}
    assert got == {1: 0.5, 2: 1.0, 3: 1.0, 4: None}


def test_long_table_means_and_choice(spark):
    rows = [(1, 0, "m", s, f, 0.1 * s + f) for s in (1, 2) for f in (0, 1)]
    preds = spark.createDataFrame(rows, "id int, y int, model string, seed int, fold int, p double")
    assert E.fold_mean(preds).count() == 2
    assert E.seed_mean(preds).first()["p"] == pytest.approx(0.65)
    assert E.pivot_members(preds, ["m", "none"]).first()["none"] is None
    scores = spark.createDataFrame([("x", 0.6), ("y", 0.7), ("z", None)], "model string, auc double")
    assert E.best_member(scores).first()["model"] == "y"
    assert E.summary(preds).first()["n"] == 4


def test_profile_edge_cases(spark):
    df = spark.createDataFrame([(1.0, 5.0, None, 1), (2.0, 5.0, None, 0), (None, 5.0, None, 0)], "a double, b double, c double, success int")
    corr = {r["column"]: r["corr"] for r in P.correlations(df, ["a", "b", "c"]).collect()}
    assert corr["a"] == pytest.approx(-1.0) and corr["b"] is None and corr["c"] is None
    constant = {r["column"]: (r["n_distinct"], r["is_constant"]) for r in P.zero_variance(df, ["a", "b", "c"]).collect()}
    assert constant == {"a": (2, 0), "b": (1, 1), "c": (0, 1)}
    approx = {r["column"]: r["is_constant"] for r in P.zero_variance(df, ["a", "b", "c"], approx=True).collect()}
    assert approx == {"a": 0, "b": 1, "c": 1}
    missing = {r["column"]: r["missing_rate"] for r in P.missing_rates(df, ["a", "c"]).collect()}
    assert missing == {"a": pytest.approx(1 / 3), "c": 1.0}
    rare = P.rare_positives(df, ["a"], k=5).first()
    assert (rare["positives"], rare["share"], rare["per_fold"]) == (1, pytest.approx(1 / 3), pytest.approx(0.2))
    top = P.top_values(df, "a", 2).collect()
    assert [r["a"] for r in top] == [None, 1.0] and top[0]["share"] == pytest.approx(1 / 3)
    zero = spark.createDataFrame([(0.0,), (-0.0,)], "a double")
    assert P.zero_variance(zero, ["a"]).first()["n_distinct"] == 1


def test_frequent_values_are_exact(spark):
    """300,000 rows of 250,000 values, six of them frequent: the sketch's values are few, their counts and the top are exact."""
    i = F.col("id")
    df = spark.range(300_000).select(
        F.when(i % 7 == 0, F.concat(F.lit("hot"), (i % 6).cast("string"))).when(i % 101 == 1, None).otherwise(F.concat(F.lit("v"), (i % 250_007).cast("string"))).alias("c")
    )
    every = df.groupBy("c").count()
    counts, bound = P.frequent_counts(df, "c", 512)
    found = counts.collect()
    assert len(found) <= 512 and spark.createDataFrame(found, counts.schema).exceptAll(every.withColumnRenamed("count", "n")).count() == 0
    assert every.join(counts, every["c"].eqNullSafe(counts["c"]), "left_anti").agg(F.max("count")).first()[0] <= bound
    for n in (3, 7, 9):  # the last one reaches the values that all have one row or two
        want = every.orderBy(F.desc("count"), F.asc_nulls_first("c")).limit(n).collect()
        assert [(r["c"], r["n"]) for r in P.top_values(df, "c", n, 512).collect()] == [(r["c"], r["count"]) for r in want]


def test_search_bins_follow_clustered_scores(spark):
    rows = spark.range(40_000).select(
        (F.rand(3) < 0.3).cast("int").alias("y"), (F.rand(1) * 0.001 + 0.5).alias("n1"), (F.rand(2) * 0.001 + 0.5).alias("n2")
    )
    wide = rows.select("y", (F.col("n1") + F.col("y") * 0.0002).alias("a"), (F.col("n2") + F.col("y") * 0.0001).alias("b")).persist()
    weights = {0: (1.0, 0.0), 1: (0.5, 0.5), 2: (0.2, 0.8)}
    edges = E.score_edges(wide, ["a", "b"])
    near, exact = ({r["candidate"]: r["auc"] for r in E.candidate_auc(wide, ["a", "b"], weights, edges=e).collect()} for e in (edges, None))
    for k in weights:
        assert near[k] == pytest.approx(exact[k], abs=1e-5)  # rows of one bin count as tied
    found, area = E.search_weights(wide, ["a", "b"], [(1, 0), (0, 1)])
    assert area >= max(exact.values()) and found[0] > found[1]
    wide.unpersist()
