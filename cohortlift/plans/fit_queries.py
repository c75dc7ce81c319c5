"""Queries on fitted statistics, vocabularies and feature sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.functions import scalars as X
from cohortlift.operators import fit as M
from cohortlift.operators.encode import COMBO_KEYS
from cohortlift.operators.features import catalogue
from cohortlift.plans.base import (
    cleaned, cycles, query, split, sql_cleaned, table, with_cycles,
)

CATS = list(S.CATEGORIES)
TRAIN = "train AS (SELECT * FROM cycles WHERE split = 'train')"
TEST = "test AS (SELECT * FROM cycles WHERE split = 'test')"


@query(
    with_cycles(
        " UNION ALL ".join(f"SELECT '{c}' AS \"column\", median({c}) AS median FROM train" for c in S.NUMERIC), TRAIN
    )
)
def train_median_per_column(spark, sf_dir):
    return M.fit_medians(split(spark, sf_dir)[0])


@query(
    "SELECT 'l_extendedprice' AS \"column\", median(l_extendedprice) AS median FROM lineitem UNION ALL "
    "SELECT 'l_quantity', median(l_quantity) FROM lineitem UNION ALL SELECT 'l_tax', median(l_tax) FROM lineitem"
)
def median_of_prices(spark, sf_dir):
    """Columns with many distinct values take the bracketed median."""
    rows = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity", "l_tax")
    return M.fit_medians(rows, rows.columns, most=100)


@query(with_cycles(f"SELECT id, {', '.join(S.NUMERIC)} FROM cleaned", *sql_cleaned()))
def impute_train_medians(spark, sf_dir):
    return cleaned(spark, sf_dir).select("id", *S.NUMERIC)


OWN = ["years_trying", "embryos_total", "day_transfer", "single_transfer", "pgt_used"]


@query(
    with_cycles(
        "SELECT t.id, "
        + ", ".join(f"coalesce(t.{c}, m.m_{c}, 0) AS {c}" for c in OWN)
        + " FROM test t CROSS JOIN m",
        TEST,
        f"m AS (SELECT {', '.join(f'median({c}) AS m_{c}' for c in OWN)} FROM test)",
    )
)
def impute_own_medians(spark, sf_dir):
    test = split(spark, sf_dir)[1].select("id", *OWN)
    return M.impute(test, M.as_dict(M.fit_medians(test, OWN)), 0.0)


def _codes(placeholder: str | None, also_test: bool, columns) -> str:
    value = "CAST({c} AS VARCHAR)" if placeholder is None else f"coalesce(CAST({{c}} AS VARCHAR), '{placeholder}')"
    source = "cycles" if also_test else "train"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code FROM "
        f"(SELECT DISTINCT {value.format(c=c)} AS value FROM {source}) WHERE value IS NOT NULL"
        for c in columns
    )


@query(with_cycles(_codes(None, False, CATS), TRAIN))
def vocabulary_of_train(spark, sf_dir):
    return M.fit_vocab(split(spark, sf_dir)[0], CATS)


def _coded(columns, placeholder: str | None) -> str:
    value = "t.{c}" if placeholder is None else f"coalesce(t.{{c}}, '{placeholder}')"
    joins = " ".join(
        f"LEFT JOIN v v_{c} ON v_{c}.\"column\" = '{c}' AND v_{c}.value = {value.format(c=c)}" for c in columns
    )
    return f"SELECT t.id, {', '.join(f'CAST(v_{c}.code AS DOUBLE) AS {c}_code' for c in columns)} FROM test t {joins}"


@query(with_cycles(_coded(CATS, None), TRAIN, TEST, f"v AS ({_codes(None, False, CATS)})"))
def vocabulary_codes_of_test(spark, sf_dir):
    train, test = split(spark, sf_dir)
    out = M.apply_vocab(test, M.fit_vocab(train, CATS), CATS)
    return out.select("id", *[F.col(f"{c}_code").cast("double").alias(f"{c}_code") for c in CATS])


LABELS = ["specific_type", "embryo_reason", "age_band", "treatment_type"]


@query(with_cycles(_coded(LABELS, "missing"), TRAIN, TEST, f"v AS ({_codes('missing', True, LABELS)})"))
def label_codes_of_both_sides(spark, sf_dir):
    train, test = split(spark, sf_dir)
    vocab = M.fit_vocab(train, LABELS, test, "missing")
    out = M.apply_vocab(test, vocab, LABELS, "missing")
    return out.select("id", *[F.col(f"{c}_code").cast("double").alias(f"{c}_code") for c in LABELS])


TEXTS = [c.name for c in S.COLUMNS if c.dtype == "string"]


@query(
    with_cycles(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", coalesce(max(CASE WHEN regexp_matches({c}, '[0-9]+회') THEN 1 ELSE 0 END), 0) "
            "AS is_count FROM cycles"
            for c in TEXTS
        )
    )
)
def count_like_text_columns(spark, sf_dir):
    return M.count_like_columns(cycles(spark, sf_dir), TEXTS)


@query(
    with_cycles(
        "SELECT id, "
        + ", ".join(f"coalesce({c}, 'NaN') AS {c}" for c in ("specific_type", "embryo_reason", "age_band"))
        + ", CAST(TRY_CAST(NULLIF(regexp_extract(n_cycles, '[0-9]+'), '') AS INTEGER) AS DOUBLE) AS n_cycles FROM test",
        TEST,
    )
)
def categories_kept_as_text(spark, sf_dir):
    columns = ["id", "specific_type", "embryo_reason", "age_band", "n_cycles"]
    train, test = split(spark, sf_dir)
    return M.finalize(train.select(*columns, "success"), test.select(columns), categories="string")[1].select(columns)


FINAL = ["specific_type", "egg_source", "n_births", "years_trying", "embryos_total"]


@query(
    with_cycles(
        "SELECT t.id, CAST(coalesce(s.code, -1) AS DOUBLE) AS specific_type, CAST(coalesce(e.code, -1) AS DOUBLE) AS egg_source, "
        "CAST(NULLIF(regexp_extract(t.n_births, '[0-9]+'), '') AS DOUBLE) AS n_births, "
        "coalesce(t.years_trying, m.y) AS years_trying, coalesce(t.embryos_total, m.t) AS embryos_total FROM test t "
        "LEFT JOIN v s ON s.\"column\" = 'specific_type' AND s.value = coalesce(t.specific_type, 'missing') "
        "LEFT JOIN v e ON e.\"column\" = 'egg_source' AND e.value = coalesce(t.egg_source, 'missing') CROSS JOIN m",
        TRAIN,
        TEST,
        f"v AS ({_codes('missing', False, ['specific_type', 'egg_source'])})",
        "m AS (SELECT median(years_trying) AS y, median(embryos_total) AS t FROM train)",
    )
)
def finalized_test_rows(spark, sf_dir):
    train, test = split(spark, sf_dir)
    out = M.finalize(train.select("id", *FINAL, "success"), test.select("id", *FINAL))[1]
    return out.select("id", *[F.col(c).cast("double").alias(c) for c in FINAL])


def _set_sizes() -> dict[str, int]:
    """Sizes by counting the clean columns and the catalogue entries apart."""
    kept = len([c for c in S.COLUMNS if c.group not in ("identity", "target", "near_constant")])
    added = len(S.CENSOR_FLAGS) + 3 + len(S.MISSING_DAYS) + 2 + len(S.MISSING_FLAGS) + 1 + len(S.REASON_TOKENS_CLEAN)
    base = kept + added
    v3, full = base + len(catalogue("clean", "v3")), base + len(catalogue("clean", "full"))
    return {"v3": v3, "v3_te": v3 - 1 + 1 + len(COMBO_KEYS), "full": full, "full_cat": full}


@query(
    with_cycles(
        " UNION ALL ".join(
            f"SELECT '{n}' AS name, CAST({size} AS INTEGER) AS n_features, count(*) AS n_rows FROM cycles"
            for n, size in _set_sizes().items()
        )
    )
)
def feature_set_sizes(spark, sf_dir):
    from cohortlift.operators.features import derive

    rows = cleaned(spark, sf_dir)
    v3, full = derive(rows, "v3"), derive(rows, "full")
    sets = M.feature_sets(v3.columns, full.columns, ["period_te", *COMBO_KEYS])
    n = full.count()
    return spark.createDataFrame([(k, len(v), n) for k, v in sets.items()], "name string, n_features int, n_rows bigint")


KEY = ["period_code", "age_band", "n_cycles", "n_ivf_cycles"]


@query(
    with_cycles(
        "SELECT 'visit' AS \"column\", value, count(*) AS n FROM "
        f"(SELECT concat_ws('_', {', '.join(KEY)}) AS value FROM test) WHERE value NOT IN "
        f"(SELECT concat_ws('_', {', '.join(KEY)}) FROM train) GROUP BY 2",
        TRAIN,
        TEST,
    )
)
def values_unseen_in_train(spark, sf_dir):
    train, test = (side.withColumn("visit", X.combo_key(KEY)) for side in split(spark, sf_dir))
    return M.unseen_values(test, M.fit_vocab(train, ["visit"]), ["visit"])
