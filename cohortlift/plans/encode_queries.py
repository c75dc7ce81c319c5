"""Folds and target encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.functions import scalars as X
from cohortlift.operators import encode as T
from cohortlift.operators.folds import assign_folds, complement_rates
from cohortlift.plans.base import query, raw, split, sql_folds, sql_oof, sql_raw, table, with_cycles
from cohortlift.session import materialise

TRAIN = "train AS (SELECT * FROM cycles WHERE split = 'train')"
TEST = "test AS (SELECT * FROM cycles WHERE split = 'test')"
TYPE_AGE = "coalesce(treatment_type, 'nan') || '_' || coalesce(age_band, 'nan') AS type_age"


def _train(spark, sf_dir, columns):
    return split(spark, sf_dir)[0].select("id", *columns, S.TARGET)


@query(with_cycles(f"SELECT id, success, seed, fold FROM ({sql_folds('train', 42)} UNION ALL {sql_folds('train', 2024)})", TRAIN))
def stratified_folds(spark, sf_dir):
    return assign_folds(_train(spark, sf_dir, []), seeds=(42, 2024))


@query(
    " UNION ALL ".join(
        f"SELECT {seed} AS seed, fold, quality, count(*) AS n FROM "
        f"({sql_folds('labels', seed, 'doc_id', 'quality')}) GROUP BY fold, quality"
        for seed in S.SEEDS
    )
)
def fold_sizes_of_labels(spark, sf_dir):
    """Rows per seed, fold and class: two folds differ by at most one row of a class."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return assign_folds(labels, "doc_id", "quality", seeds=S.SEEDS).groupBy("seed", "fold", "quality").agg(
        F.count("*").alias("n")
    )


@query(
    with_cycles(
        " UNION ALL ".join(
            f"SELECT {f} AS fold, count(*) FILTER (WHERE fold <> {f}) AS n_train, count(*) FILTER (WHERE fold = {f}) AS n_valid, "
            f"avg(CAST(success AS DOUBLE)) FILTER (WHERE fold <> {f}) AS rate_train FROM folds"
            for f in range(5)
        ),
        TRAIN,
        f"folds AS ({sql_folds('train')})",
    )
)
def fold_complements(spark, sf_dir):
    return complement_rates(assign_folds(_train(spark, sf_dir, [])))


@query(
    with_cycles(
        "SELECT type_age, n, total, (CAST(total AS DOUBLE) + gm * 25.0) / (CAST(n AS DOUBLE) + 25.0) AS te FROM "
        "(SELECT type_age, count(*) AS n, CAST(sum(success) AS BIGINT) AS total FROM keyed GROUP BY 1) CROSS JOIN "
        "(SELECT CAST(sum(success) AS DOUBLE) / count(*) AS gm FROM keyed)",
        TRAIN,
        f"keyed AS (SELECT *, {TYPE_AGE} FROM train)",
    )
)
def smoothed_mean_per_key(spark, sf_dir):
    rows = _train(spark, sf_dir, [X.combo_key(["treatment_type", "age_band"]).alias("type_age")])
    return T.smoothed_mean(rows, "type_age", s=25.0)


@query(
    with_cycles(
        "SELECT id, type_age, fold, success, te FROM e",
        TRAIN,
        f"folds AS ({sql_folds('train')})",
        f"keyed AS (SELECT *, {TYPE_AGE} FROM folds)",
        *sql_oof("keyed", "type_age", 25.0),
    )
)
def oof_encoding_type_age(spark, sf_dir):
    rows = _train(spark, sf_dir, [X.combo_key(["treatment_type", "age_band"]).alias("type_age")])
    out = T.oof_encode(materialise(assign_folds(rows), "folds"), "type_age", s=25.0)
    return out.select("id", "type_age", "fold", "success", "te")


@query(
    with_cycles(
        "SELECT id, specific_type, fold, te FROM e",
        "train AS (SELECT * FROM cycles WHERE split = 'train')",
        f"folds AS ({sql_folds('train')})",
        *sql_oof("folds", "specific_type", 30.0),
    )
)
def oof_encoding_missing_key(spark, sf_dir):
    """A NULL key takes the mean of the training part."""
    rows = split(spark, sf_dir)[0].select("id", "specific_type", S.TARGET)
    return T.oof_encode(materialise(assign_folds(rows), "folds"), "specific_type", s=30.0).select("id", "specific_type", "fold", "te")


def _fold_mean_sql(key: str, s: float) -> list[str]:
    return [
        f"kf AS (SELECT {key} AS k_, fold, count(*) AS n, sum(success) AS t FROM keyed GROUP BY 1, 2)",
        "f AS (SELECT fold, sum(n) AS n, sum(t) AS t FROM kf GROUP BY fold)",
        "g AS (SELECT fold, CAST((SELECT sum(t) FROM f) - t AS DOUBLE) / CAST((SELECT sum(n) FROM f) - n AS DOUBLE) AS gm FROM f)",
        "k AS (SELECT k_, sum(n) AS n, sum(t) AS t FROM kf GROUP BY k_)",
        "grid AS (SELECT k.k_, g.fold, g.gm, k.n - coalesce(kf.n, 0) AS n, k.t - coalesce(kf.t, 0) AS t FROM k CROSS JOIN g "
        "LEFT JOIN kf ON kf.k_ = k.k_ AND kf.fold = g.fold)",
        f"one AS (SELECT k_, fold, CASE WHEN n = 0 THEN gm ELSE (CAST(t AS DOUBLE) + gm * {s}) / (CAST(n AS DOUBLE) + {s}) END AS te FROM grid)",
        "maps AS (SELECT k_, ("
        + " + ".join(f"max(te) FILTER (WHERE fold = {i})" for i in range(5))
        + ") / 5 AS te FROM one GROUP BY k_)",
        "gmean AS (SELECT (" + " + ".join(f"max(gm) FILTER (WHERE fold = {i})" for i in range(5)) + ") / 5 AS gm FROM g)",
    ]


TEST_KEY = "concat_ws('_', period_code, age_band, n_cycles) AS visit"


@query(
    with_cycles(
        "SELECT t.id, t.visit, coalesce(m.te, gmean.gm) AS te FROM (SELECT *, " + TEST_KEY + " FROM test) t "
        "LEFT JOIN maps m ON m.k_ = t.visit CROSS JOIN gmean",
        TRAIN, TEST, f"folds AS ({sql_folds('train')})", f"keyed AS (SELECT *, {TEST_KEY} FROM folds)",
        *_fold_mean_sql("visit", 20.0),
    )
)
def encoding_of_test_by_fold_mean(spark, sf_dir):
    key = X.combo_key(["period_code", "age_band", "n_cycles"]).alias("visit")
    train, test = split(spark, sf_dir)
    rows = materialise(assign_folds(train.select("id", key, S.TARGET)), "folds")
    return T.encode_test(rows, test.select("id", key), "visit", s=20.0, how="fold_mean")


@query(
    with_cycles(
        "SELECT t.id, t.visit, coalesce((CAST(k.t AS DOUBLE) + g.gm * 20.0) / (CAST(k.n AS DOUBLE) + 20.0), g.gm) AS te FROM "
        "(SELECT *, " + TEST_KEY + " FROM test) t LEFT JOIN k ON k.k_ = t.visit CROSS JOIN g",
        TRAIN, TEST, f"keyed AS (SELECT *, {TEST_KEY} FROM train)",
        "k AS (SELECT visit AS k_, count(*) AS n, sum(success) AS t FROM keyed GROUP BY 1)",
        "g AS (SELECT CAST(sum(success) AS DOUBLE) / count(*) AS gm FROM keyed)",
    )
)
def encoding_of_test_by_all_rows(spark, sf_dir):
    key = X.combo_key(["period_code", "age_band", "n_cycles"]).alias("visit")
    train, test = split(spark, sf_dir)
    rows = materialise(assign_folds(train.select("id", key, S.TARGET)), "folds")
    return T.encode_test(rows, test.select("id", key), "visit", s=20.0, how="full")


COMBO_SQL = (
    "concat(" + ", ".join(f"CAST(has_{t} AS VARCHAR)" for t in S.COMBO_TOKENS) + ") AS proc_specific, "
    "concat(treatment_type, '_', age_band) AS proc_age, concat(treatment_type, '_', period_code) AS proc_timing"
)


def combo_train(spark, sf_dir):
    rows = raw(spark, sf_dir).where("split = 'train'")
    return T.combo_keys(rows).select("id", S.TARGET, "period_code", "proc_specific", "proc_age", "proc_timing")


@query(
    with_cycles(
        "SELECT a.id, a.fold, a.te AS TE__proc_specific, b.te AS TE__proc_age, c.te AS TE__proc_timing "
        "FROM a JOIN b ON a.id = b.id JOIN c ON a.id = c.id",
        *sql_raw(),
        "train AS (SELECT * FROM rawc WHERE split = 'train')",
        f"folds AS ({sql_folds('train')})",
        f"keyed AS (SELECT *, {COMBO_SQL} FROM folds)",
        *sql_oof("keyed", "proc_specific", 30.0, name="a"),
        *sql_oof("keyed", "proc_age", 25.0, name="b"),
        *sql_oof("keyed", "proc_timing", 25.0, name="c"),
    )
)
def oof_encoding_combo_keys(spark, sf_dir):
    """Three combination keys counted in one pass."""
    rows = materialise(assign_folds(combo_train(spark, sf_dir)), "folds")
    return T.fit_encoder(rows, T.COMBO_KEYS).oof(rows).select("id", "fold", *T.COMBO_KEYS)


@query(
    with_cycles(
        "SELECT id, fold, te AS period_te FROM e", TRAIN, f"folds AS ({sql_folds('train')})",
        *sql_oof("folds", "period_code", 20.0),
    )
)
def oof_encoding_period(spark, sf_dir):
    rows = materialise(assign_folds(_train(spark, sf_dir, ["period_code"])), "folds")
    out = T.fit_encoder(rows, T.PERIOD_KEY).oof(rows)
    return out.drop("period_code").select("id", "fold", "period_te")


@query(
    with_cycles(
        "SELECT id, fold, timing, te FROM e",
        TRAIN,
        f"folds AS ({sql_folds('train')})",
        "keyed AS (SELECT *, concat(treatment_type, '_', coalesce(CAST(CASE age_band "
        + " ".join(f"WHEN '{k}' THEN {v}" for k, v in S.AGE_ORDINAL.items())
        + " END AS VARCHAR), 'nan')) AS timing FROM folds)",
        *sql_oof("keyed", "timing", 25.0),
    )
)
def oof_encoding_type_age_ordinal(spark, sf_dir):
    rows = split(spark, sf_dir)[0].withColumn("age_ord", X.lookup("age_band", S.AGE_ORDINAL))
    rows = rows.select("id", S.TARGET, X.combo_key(["treatment_type", "age_ord"]).alias("timing"))
    return T.oof_encode(materialise(assign_folds(rows), "folds"), "timing", s=25.0).select("id", "fold", "timing", "te")


ORDERS = "orders_y AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders)"


@query(
    "WITH " + ",\n".join([
        ORDERS, f"folds AS ({sql_folds('orders_y', 42, 'o_orderkey', 'y')})",
        *sql_oof("folds", "o_orderpriority", 20.0, y="y"),
    ]) + " SELECT o_orderkey, fold, te FROM e"
)
def oof_encoding_order_priority(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", X.flag(F.col("o_orderstatus") == "F").alias("y")
    )
    out = T.oof_encode(materialise(assign_folds(rows, "o_orderkey", "y"), "folds"), "o_orderpriority", "y")
    return out.select("o_orderkey", "fold", "te")


@query(
    "WITH " + ",\n".join([
        "docs AS (SELECT l.doc_id, l.quality, d.source FROM labels l JOIN documents d ON l.doc_id = d.doc_id)",
        f"folds AS ({sql_folds('docs', 42, 'doc_id', 'quality')})", *sql_oof("folds", "source", 10.0, y="quality"),
    ]) + " SELECT doc_id, source, fold, te FROM e"
)
def oof_encoding_document_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    rows = table(spark, sf_dir, "labels").select("doc_id", "quality").join(docs, "doc_id")
    out = T.oof_encode(materialise(assign_folds(rows, "doc_id", "quality"), "folds"), "source", "quality", s=10.0)
    return out.select("doc_id", "source", "fold", "te")


