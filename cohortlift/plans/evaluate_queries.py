"""Evaluation and blending of a deterministic prediction table.

The members are out-of-fold encodings of three keys under two seeds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.functions import scalars as X
from cohortlift.operators import encode as T
from cohortlift.operators import evaluate as E
from cohortlift.operators.folds import assign_folds
from cohortlift.operators.models import union
from cohortlift.plans.base import query, rounded, split, sql_folds, sql_oof, table, with_cycles
from cohortlift.session import materialise

SEEDS = (42, 2024)
MEMBERS = {"type_age": 25.0, "period": 20.0, "procedure": 30.0}
NAMES = list(MEMBERS)
KEYS = {
    "type_age": T.Key("k_type_age", 25.0),
    "period": T.Key("k_period", 20.0),
    "procedure": T.Key("k_procedure", 30.0),
}


def keyed_rows(df):
    return df.select(
        "id",
        *[c for c in (S.TARGET,) if c in df.columns],
        X.combo_key(["treatment_type", "age_band"]).alias("k_type_age"),
        F.col("period_code").alias("k_period"),
        X.combo_key(["specific_type", "n_ivf_cycles"]).alias("k_procedure"),
    )


def predictions(spark, sf_dir):
    """``id, y, model, seed, fold, p`` of every train row."""
    folds = materialise(assign_folds(keyed_rows(split(spark, sf_dir)[0]), seeds=SEEDS), "folds", ["seed"])
    parts = []
    for seed in SEEDS:
        rows = folds.where(F.col("seed") == seed)
        encoded = T.fit_encoder(rows, KEYS).oof(rows)
        parts.append(encoded.unpivot(["id", S.TARGET, "seed", "fold"], NAMES, "model", "p"))
    return materialise(union(parts).withColumnRenamed(S.TARGET, "y"), "predictions")


KEYED_SQL = (
    "concat(coalesce(treatment_type, 'nan'), '_', coalesce(age_band, 'nan')) AS k_type_age, period_code AS k_period, "
    "concat(coalesce(specific_type, 'nan'), '_', coalesce(n_ivf_cycles, 'nan')) AS k_procedure"
)


def sql_predictions() -> list[str]:
    ctes = ["train AS (SELECT * FROM cycles WHERE split = 'train')"]
    selects = []
    for seed in SEEDS:
        ctes.append(f"folds{seed} AS (SELECT *, {KEYED_SQL} FROM ({sql_folds('train', seed)}))")
        for name, s in MEMBERS.items():
            cte = f"{name}{seed}"
            ctes += sql_oof(f"folds{seed}", f"k_{name}", s, out="p", name=cte)
            selects.append(f"SELECT id, success AS y, '{name}' AS model, seed, fold, p FROM {cte}")
    ctes.append(f"preds AS ({' UNION ALL '.join(selects)})")
    ctes.append(
        "wide AS (SELECT id, y, "
        + ", ".join(f"avg(p) FILTER (WHERE model = '{m}') AS {m}" for m in NAMES)
        + " FROM preds GROUP BY id, y)"
    )
    return ctes


def sql_auc(source: str, by: str = "", y: str = "y", p: str = "p", name: str = "a") -> list[str]:
    """CTEs ending in ``name``: exact area per group from pairs of a positive and a negative row."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return [
        f"{name}_g AS (SELECT {keys}{p} AS p_, sum({y}) AS pos, count(*) - sum({y}) AS neg FROM {source} GROUP BY {keys}{p})",
        f"{name}_c AS (SELECT *, sum(neg) OVER ({part}ORDER BY p_ ROWS UNBOUNDED PRECEDING) - neg AS below FROM {name}_g)",
        f"{name} AS (SELECT {keys}CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg, "
        f"CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN "
        f"CAST(sum(pos * (CAST(below AS DOUBLE) + CAST(neg AS DOUBLE) / 2)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc "
        f"FROM {name}_c{group})",
    ]


def _preds(body: str, *ctes: str) -> str:
    return with_cycles(body, *sql_predictions(), *ctes)


def wide(spark, sf_dir):
    return E.pivot_members(predictions(spark, sf_dir), NAMES)


@query(_preds("SELECT id, y, model, seed, fold, p FROM preds"))
def prediction_table(spark, sf_dir):
    return predictions(spark, sf_dir).select("id", "y", "model", "seed", "fold", "p")


@query(_preds("SELECT n_pos, n_neg, auc FROM a", *sql_auc("preds")))
def exact_auc(spark, sf_dir):
    """One area over all predictions, with tied scores."""
    return E.auc(predictions(spark, sf_dir))


@query(_preds("SELECT model, seed, fold, n_pos, n_neg, auc FROM a", *sql_auc("preds", "model, seed, fold")))
def auc_per_model_seed_fold(spark, sf_dir):
    return E.auc(predictions(spark, sf_dir), by=["model", "seed", "fold"])


@query(
    "WITH s AS (SELECT l.quality AS y, d.n_chars AS p, d.lang FROM labels l JOIN documents d ON l.doc_id = d.doc_id), "
    + ", ".join(sql_auc("s", "lang"))
    + " SELECT lang, n_pos, n_neg, auc FROM a"
)
def auc_of_document_length(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("n_chars").alias("p"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    return E.auc(labels.join(docs, "doc_id"), by=["lang"])


@query(
    "WITH s AS (SELECT o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_totalprice AS p FROM orders), "
    + ", ".join(sql_auc("s", "o_orderstatus"))
    + " SELECT o_orderstatus, n_pos, n_neg, auc FROM a"
)
def auc_of_single_class_groups(spark, sf_dir):
    """Every group has one class only, so each area is NULL."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderstatus", X.flag(F.col("o_orderstatus") == "F").alias("y"), F.col("o_totalprice").alias("p")
    )
    return E.auc(rows, by=["o_orderstatus"])


W = (0.5, 0.2, -0.1)
W_SQL = " + ".join(f"{m} * {w / 0.7!r}" for m, w in zip(NAMES, (0.5, 0.2, 0.0)))


@query(_preds(f"SELECT id, y, {W_SQL} AS p FROM wide"))
def weighted_blend(spark, sf_dir):
    return wide(spark, sf_dir).select("id", "y", E.blend(NAMES, W).alias("p"))


@query(_preds(f"SELECT id, y, ({' + '.join(NAMES)}) / 3.0E0 AS p FROM wide"))
def equal_blend(spark, sf_dir):
    return wide(spark, sf_dir).select("id", "y", E.mean_blend(NAMES).alias("p"))


CANDIDATES = {0: (1.0, 0.0, 0.0), 1: (0.0, 1.0, 0.0), 2: (0.5, 0.25, 0.25), 3: (0.25, 0.5, 0.25), 4: (0.2, 0.2, 0.6)}


def _candidate_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS candidate, y, " + " + ".join(f"{m} * {x / sum(w)!r}" for m, x in zip(NAMES, w)) + " AS p FROM wide"
        for i, w in CANDIDATES.items()
    )


@query(_preds("SELECT candidate, auc FROM a", f"s AS ({_candidate_sql()})", *sql_auc("s", "candidate", p="p")))
def auc_of_weight_candidates(spark, sf_dir):
    """Exact areas of fixed weight vectors in one job."""
    return E.candidate_auc(wide(spark, sf_dir), NAMES, CANDIDATES)


@query(
    _preds(
        "SELECT id, model, seed, p, (less + (ties + 1) / 2.0E0) / size AS rank_p FROM (SELECT *, "
        "rank() OVER (PARTITION BY model, seed ORDER BY p) - 1 AS less, count(*) OVER (PARTITION BY model, seed, p) AS ties, "
        "count(*) OVER (PARTITION BY model, seed) AS size FROM preds)"
    )
)
def rank_normalised_predictions(spark, sf_dir):
    rows = predictions(spark, sf_dir).select("id", "model", "seed", "p")
    return E.rank_normalise(rows, by=["model", "seed"])


PAIRS = [(a, b) for i, a in enumerate(NAMES) for b in NAMES[i + 1 :]]


@query(
    _preds(
        " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS corr FROM wide" for a, b in PAIRS)
    )
)
def member_correlations(spark, sf_dir):
    return E.member_correlations(wide(spark, sf_dir), NAMES).select("a", "b", rounded("corr"))


@query(_preds("SELECT model, auc FROM a ORDER BY auc DESC LIMIT 1", *sql_auc("preds", "model")))
def best_member(spark, sf_dir):
    return E.best_member(E.auc(predictions(spark, sf_dir), by=["model"]))


@query(
    _preds(
        "SELECT model, seed, count(*) AS n, round(avg(p), 9) AS mean_p, round(stddev_samp(p), 9) AS std_p "
        "FROM preds GROUP BY 1, 2"
    )
)
def prediction_summary(spark, sf_dir):
    out = E.summary(predictions(spark, sf_dir), ["model", "seed"])
    return out.select("model", "seed", "n", rounded("mean_p"), rounded("std_p"))


@query(_preds("SELECT id, model, avg(p) AS p FROM preds GROUP BY 1, 2"))
def mean_over_seeds(spark, sf_dir):
    return E.seed_mean(predictions(spark, sf_dir))


def _fold_prediction_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT t.id, {f} AS fold, coalesce((CAST(k.t AS DOUBLE) + g.gm * 25.0) / (CAST(k.n AS DOUBLE) + 25.0), g.gm) AS p "
        f"FROM test t LEFT JOIN (SELECT k_type_age, count(*) AS n, sum(success) AS t FROM folds WHERE fold <> {f} GROUP BY 1) k "
        f"ON k.k_type_age = t.k_type_age CROSS JOIN "
        f"(SELECT CAST(sum(success) AS DOUBLE) / count(*) AS gm FROM folds WHERE fold <> {f}) g"
        for f in range(5)
    )


@query(
    with_cycles(
        "SELECT id, 'type_age' AS model, 42 AS seed, round(avg(p), 9) AS p FROM one GROUP BY id",
        f"test AS (SELECT *, {KEYED_SQL} FROM cycles WHERE split = 'test')",
        "train AS (SELECT * FROM cycles WHERE split = 'train')",
        f"folds AS (SELECT *, {KEYED_SQL} FROM ({sql_folds('train')}))",
        f"one AS ({_fold_prediction_sql()})",
    )
)
def mean_over_folds(spark, sf_dir):
    """Test predictions of the five training parts, averaged."""
    train, test = (keyed_rows(side) for side in split(spark, sf_dir))
    folds = materialise(assign_folds(train), "folds")
    key = {"p": T.Key("k_type_age", 25.0)}
    parts = [
        T.fit_encoder(folds.where(F.col("fold") != f), key).transform(test)
        .select("id", F.lit("type_age").alias("model"), F.lit(42).alias("seed"), F.lit(f).alias("fold"), "p")
        for f in range(5)
    ]
    return E.fold_mean(union(parts)).select("id", "model", "seed", rounded("p"))


@query(
    _preds(
        "SELECT segment, n_pos, n_neg, auc FROM a",
        "s AS (SELECT p.y, p.p, CASE WHEN c.embryos_transferred > 0 THEN 'transfer' ELSE 'no transfer' END AS segment "
        "FROM preds p JOIN cycles c ON p.id = c.id)",
        *sql_auc("s", "segment"),
    )
)
def auc_per_segment(spark, sf_dir):
    segment = F.when(F.col("embryos_transferred") > 0, "transfer").otherwise("no transfer").alias("segment")
    rows = split(spark, sf_dir)[0].select("id", segment)
    return E.auc(predictions(spark, sf_dir).join(rows, "id"), by=["segment"])
