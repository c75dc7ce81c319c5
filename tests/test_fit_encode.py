import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlift.functions import joins, ranking
from cohortlift.operators import encode as T
from cohortlift.operators import fit as M
from cohortlift.operators.folds import assign_folds, complement_rates, split_fold


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60), st.booleans())
def test_bracketed_median_is_exact(spark, xs, with_null):
    rows = [(x, None) for x in xs] + ([(None, None)] if with_null else [])
    df = spark.createDataFrame(rows, "a double, b double")
    got = M.as_dict(ranking.exact_medians(df, ["a", "b"]))
    assert got["a"] == pytest.approx(statistics.median(xs)) and got["b"] is None


def test_median_paths_agree(spark):
    df = spark.range(5001).select((F.col("id") * 7919 % 10007).cast("double").alias("a"))
    exact = statistics.median([r[0] for r in df.collect()])
    assert M.as_dict(M.fit_medians(df, ["a"], most=10))["a"] == exact
    assert M.as_dict(M.fit_medians(df, ["a"], most=10**6))["a"] == exact
    assert abs(M.as_dict(M.fit_medians(df, ["a"], exact=False))["a"] - exact) < 100
    assert M.fit_medians(df, ["absent"]).count() == 0


def test_order_statistics_by_narrowing(spark):
    """A million distinct values over several rounds, a value that half of the rows hold, infinite ends, and one row."""
    n = 1_000_000
    a = (F.col("id") * 7919 % n).cast("double")
    df = spark.range(n).select(
        a.alias("a"), F.exp(a / 40_000).alias("b"), F.when(F.col("id") % 2 == 0, 7.0).otherwise(a).alias("c"),
        F.when(F.col("id") < 3, float("inf")).when(F.col("id") < 5, float("-inf")).otherwise(a).alias("d"), F.when(F.col("id") == 9, a).alias("e"),
    )
    ranks = lambda size: sorted({0, size // 10, size // 2, size - 1})
    found = ranking.exact_values(df, ["a", "b", "c", "d", "e"], ranks, most=50, cuts=31)
    rows = df.toPandas()
    for c in rows.columns:
        values = rows[c].dropna().sort_values().tolist()
        assert found[c] == (len(values), {r: values[r] for r in ranks(len(values))}), c


def test_impute_defaults_a_column_without_values(spark):
    df = spark.createDataFrame([(1, None, None), (2, 4.0, None)], "id int, a double, b double")
    out = M.impute(df, M.as_dict(M.fit_medians(df, ["a", "b"])), 0.0)
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 4.0, 0.0), (2, 4.0, 0.0)]


def test_codes_follow_the_order(spark):
    words = [("a", f"w{i * 37 % 101:03d}") for i in range(101)] + [("b", f"v{i}") for i in range(7)]
    df = spark.createDataFrame(words, "column string, value string").repartition(5)
    codes = {(r["column"], r["value"]): r["code"] for r in ranking.dense_codes(df, "column", "value", "code").collect()}
    assert codes == {(c, v): sorted(w for k, w in words if k == c).index(v) for c, v in words}


def test_vocabulary_and_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,), ("nan",)], "c string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    vocab = M.fit_vocab(train, ["c"])
    assert {r["value"]: r["code"] for r in vocab.collect()} == {"a": 0, "b": 1}
    assert [r["c_code"] for r in M.apply_vocab(test, vocab, ["c"]).collect()] == [0, None, None]
    assert [r["c_code"] for r in M.apply_vocab(test, vocab, ["c"], unseen="keep").collect()] == [0, -1, -1]
    assert [(r["value"], r["n"]) for r in M.unseen_values(test, vocab, ["c"]).collect()] == [("z", 1)]
    both = M.fit_vocab(train, ["c"], also=test, placeholder="missing")
    assert sorted(r["value"] for r in both.collect()) == ["a", "b", "missing", "z"]


def test_finalize_keeps_shared_columns(spark):
    train = spark.createDataFrame([(1, "3회", "x", 1.0, 1, 9.0), (2, None, "y", None, 0, 9.0)], "id int, n string, t string, a double, success int, extra double")
    test = spark.createDataFrame([(3, "1회", "z", None)], "id int, n string, t string, a double")
    left, right, cats = M.finalize(train, test)
    assert cats == ["t"] and "extra" not in left.columns and "success" in left.columns
    assert right.collect()[0].asDict() == {"id": 3, "n": 1.0, "t": -1, "a": 1.0}
    own = M.finalize(train, test, fit_on="self")[1].collect()[0]
    assert own["t"] == 2 and own["a"] == 0.0
    kept = M.finalize(train, test, categories="string")[1].collect()[0]
    assert kept["t"] == "z"


def test_merge_rare(spark):
    train = spark.createDataFrame([("a",)] * 3 + [("b",)], "c string")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, None)], "id int, c string")
    out = M.merge_rare(df, train, "c", 2).orderBy("id").collect()
    assert [r["c"] for r in out] == ["a", "OTHER", "OTHER", None]


@pytest.mark.parametrize("hot_keys", [2, 10, 1000])
def test_hot_split_join_equals_plain_join(spark, hot_keys):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 6 + [None] * 3 + [f"k{j}" for j in range(9)])) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, k string")
    stats = df.where("k != 'k3' or k is null").groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("m"))
    small = {tuple(r) for r in joins.attach(df, stats, ["k"]).select("id", "k", "n", "m").collect()}
    large = joins.attach(df, stats, ["k"], ["id"], max_bytes=0, hot_keys=hot_keys)
    assert {tuple(r) for r in large.collect()} == small and large.count() == len(rows)


def test_fold_sizes(spark):
    df = spark.range(1003).select("id", (F.col("id") % 7 == 0).cast("int").alias("success"))
    folds = assign_folds(df, seeds=(1, 2))
    sizes = folds.groupBy("seed", "success", "fold").count().collect()
    for seed in (1, 2):
        for y in (0, 1):
            n = [r["count"] for r in sizes if (r["seed"], r["success"]) == (seed, y)]
            assert len(n) == 5 and max(n) - min(n) <= 1
    assert folds.groupBy("seed").agg(F.countDistinct("id").alias("n")).where("n != 1003").count() == 0
    other = {tuple(r) for r in assign_folds(df.repartition(64), seeds=(1, 2)).collect()}
    assert {tuple(r) for r in assign_folds(df.coalesce(1), seeds=(1, 2), digits=1).collect()} == other


def test_fewer_rows_than_folds(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "id int, success int")
    folds = {r["id"]: r["fold"] for r in assign_folds(df).collect()}
    assert folds[1] == 0 and {folds[2], folds[3]} == {0, 1}
    fit, valid = split_fold(assign_folds(df), 0)
    assert fit.count() == 1 and valid.count() == 2
    assert {r["fold"]: (r["n_train"], r["n_valid"]) for r in complement_rates(assign_folds(df)).collect()} == {0: (1, 2), 1: (2, 1)}


def test_rows_without_a_label_or_stratum_stay(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2, None if i < 5 else "x") for i in range(30)], "id int, success int, s string")
    folds = assign_folds(df, k=2, strata=["s"])
    assert folds.count() == 30 and folds.select("id").distinct().count() == 30
    labelled = df.where("success is not null").withColumn("fold", F.col("id") % 2)
    both = labelled.unionByName(df.where("success is null").withColumn("fold", F.col("id") % 2))
    one, two = (T.fit_encoder(side, {"te": T.Key("s", 5.0)}, k=2).transform(df).collect() for side in (labelled, both))
    assert sorted(one) == sorted(two)


def encoded_rows(spark, seed=5, n=400):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a"] * 8 + ["b", "c", None]), int(rng.random() < 0.3)) for i in range(n)]
    rows.append((n, "once", 1))
    return rows, assign_folds(spark.createDataFrame(rows, "id int, k string, success int"))


def by_hand(rows, folds, s):
    """Leave-fold-out loop."""
    out = {}
    for f in range(5):
        part = [(k, y) for i, k, y in rows if folds[i] != f]
        gm = sum(y for _, y in part) / len(part)
        for i, k, _ in rows:
            if folds[i] == f:
                ys = [y for kk, y in part if k is not None and kk == k]
                out[i] = (sum(ys) + gm * s) / (len(ys) + s) if ys else gm
    return out


@pytest.mark.parametrize("max_bytes", [32 << 20, 0])
def test_oof_equals_leave_fold_out_loop(spark, max_bytes):
    rows, folded = encoded_rows(spark)
    folds = {r["id"]: r["fold"] for r in folded.collect()}
    got = T.fit_encoder(folded, {"te": T.Key("k", 12.0)}).oof(folded, max_bytes=max_bytes).collect()
    want = by_hand(rows, folds, 12.0)
    assert len(got) == len(rows)
    assert all(r["te"] == pytest.approx(want[r["id"]], abs=1e-12) for r in got)


def test_own_label_does_not_reach_own_encoding(spark):
    rows, folded = encoded_rows(spark)
    folded = folded.persist()
    before = {r["id"]: r["te"] for r in T.oof_encode(folded, "k", s=5.0).collect()}
    flipped = folded.withColumn("success", F.when(F.col("id") == 7, 1 - F.col("success")).otherwise(F.col("success")))
    after = {r["id"]: r["te"] for r in T.oof_encode(flipped, "k", s=5.0).collect()}
    assert before[7] == after[7] and before != after


@pytest.mark.parametrize("max_bytes", [32 << 20, 0])
def test_test_side_variants(spark, max_bytes):
    rows, folded = encoded_rows(spark)
    folds = {r["id"]: r["fold"] for r in folded.collect()}
    test = spark.createDataFrame([(1, "a"), (2, "new"), (3, None), (4, "once")], "id int, k string")
    encoder = T.fit_encoder(folded, {"te": T.Key("k", 5.0)})
    gm = sum(y for _, _, y in rows) / len(rows)
    full = {r["id"]: r["te"] for r in encoder.transform(test, max_bytes=max_bytes).collect()}
    ys = [y for _, k, y in rows if k == "a"]
    assert full[1] == pytest.approx((sum(ys) + gm * 5) / (len(ys) + 5)) and full[2] == full[3] == pytest.approx(gm)
    mean = {r["id"]: r["te"] for r in encoder.transform(test, "fold_mean", max_bytes).collect()}
    per_fold, priors = [], []
    for f in range(5):
        part = [(k, y) for i, k, y in rows if folds[i] != f]
        prior = sum(y for _, y in part) / len(part)
        ys = [y for k, y in part if k == "once"]
        priors.append(prior)
        per_fold.append((sum(ys) + prior * 5) / (len(ys) + 5) if ys else prior)
    assert mean[4] == pytest.approx(sum(per_fold) / 5) and mean[2] == mean[3] == pytest.approx(sum(priors) / 5)
    with pytest.raises(ValueError):
        encoder.transform(test, "other")


def test_hot_key_without_statistics_is_spread(spark):
    from cohortlift.functions.joins import attach

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, "unseen").otherwise(F.concat(F.lit("k"), F.col("id") % 3000)).alias("key"))
        stats = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("v"))
        out = attach(rows, stats, ["key"], max_bytes=0).withColumn("part", F.spark_partition_id()).persist()
        hot = out.where("key = 'unseen'")
        assert hot.count() == 10_000 and hot.where("v is not null").count() == 0
        assert hot.select("part").distinct().count() > 4
        assert out.where("key <> 'unseen' and v = cast(substring(key, 2) as bigint)").count() == 10_000
        out.unpersist()
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
