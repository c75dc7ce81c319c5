"""Cleaning queries: casting, rules, sentinels, flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.functions import scalars as X
from cohortlift.functions.sql_text import flag, z
from cohortlift.operators import clean as C
from cohortlift.operators.fit import merge_rare
from cohortlift.plans.base import (
    cleaned, cycles, query, raw, split, sql_cleaned, sql_digits, sql_map, sql_null_count, sql_raw,
    table, with_cycles,
)

IS_DI = "treatment_type = 'DI'"
ALL = [c.name for c in S.COLUMNS]


def _from_cleaned(columns) -> str:
    return with_cycles(f"SELECT {', '.join(columns)} FROM cleaned", *sql_cleaned())


def _from_raw(columns) -> str:
    return with_cycles(f"SELECT {', '.join(columns)} FROM rawc", *sql_raw())


@query(with_cycles(f"SELECT {', '.join(c for c in ALL if c not in S.DROPPED)}, split FROM cycles"))
def drop_near_constant_columns(spark, sf_dir):
    return C.drop_columns(cycles(spark, sf_dir), [*S.DROPPED, "not_there"])


@query(with_cycles(f"SELECT {', '.join(c for c in ALL if c != 'success')} FROM cycles WHERE split = 'train'"))
def columns_in_train_and_test(spark, sf_dir):
    train, test = split(spark, sf_dir)
    return train.select(C.shared_columns(train, test))


@query(_from_raw(["id", *S.COUNTS]))
def parse_count_by_dictionary(spark, sf_dir):
    return raw(spark, sf_dir).select("id", *S.COUNTS)


@query(with_cycles(f"SELECT id, {', '.join(f'{sql_digits(c)} AS {c}' for c in S.COUNTS)} FROM cycles"))
def parse_count_by_digits(spark, sf_dir):
    rows = cycles(spark, sf_dir)
    return rows.select("id", *[X.count_from_digits(c).alias(c) for c in S.COUNTS])


@query(_from_cleaned(["id", *S.CENSOR_FLAGS.values()]))
def censoring_flags(spark, sf_dir):
    return C.clean(cycles(spark, sf_dir), "clean", {}).select("id", *S.CENSOR_FLAGS.values())


@query(
    with_cycles(
        f"SELECT id, CAST({sql_map('age_band', S.AGE_MEDIAN)} AS DOUBLE) AS age_num, "
        f"CAST({sql_map('age_band', S.AGE_MEDIAN, '36.0')} AS DOUBLE) AS age_median, "
        f"CAST({sql_map('age_band', S.AGE_ORDINAL)} AS DOUBLE) AS age_ord, "
        f"CAST({sql_map('egg_donor_age', S.DONOR_AGE)} AS DOUBLE) AS egg_donor_age_num, "
        f"CAST({sql_map('sperm_donor_age', S.DONOR_AGE)} AS DOUBLE) AS sperm_donor_age_num FROM cycles"
    )
)
def band_to_number(spark, sf_dir):
    rows = cycles(spark, sf_dir)
    return rows.select(
        "id",
        X.lookup("age_band", S.AGE_MEDIAN).alias("age_num"),
        X.lookup("age_band", S.AGE_MEDIAN, S.AGE_WHEN_UNKNOWN).alias("age_median"),
        X.lookup("age_band", S.AGE_ORDINAL).cast("double").alias("age_ord"),
        X.lookup("egg_donor_age", S.DONOR_AGE).alias("egg_donor_age_num"),
        X.lookup("sperm_donor_age", S.DONOR_AGE).alias("sperm_donor_age_num"),
    )


@query(
    "SELECT o_orderkey, TRY_CAST(o_orderpriority AS DOUBLE) AS whole, "
    "TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS lead FROM orders"
)
def number_or_null(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        X.num("o_orderpriority").alias("whole"),
        X.num(F.substring("o_orderpriority", 1, 1)).alias("lead"),
    )


@query(
    with_cycles(
        "SELECT id, "
        + ", ".join(f"CASE WHEN treatment_type = 'DI' THEN coalesce({c}, 0) ELSE {c} END AS {c}" for c in S.DI_ZERO_COLUMNS)
        + " FROM cycles"
    )
)
def structural_zero_embryos(spark, sf_dir):
    zeros = [f"{C.zero_when(IS_DI, c)} AS {c}" for c in S.DI_ZERO_COLUMNS]
    return cycles(spark, sf_dir).selectExpr("id", *zeros)


@query(
    with_cycles(
        "SELECT id, CASE WHEN coalesce(embryos_transferred, 0) = 0 THEN -1.0E0 ELSE day_transfer END AS day_transfer, "
        "CASE WHEN coalesce(embryos_transferred, 0) = 0 AND day_transfer IS NULL THEN -1.0E0 ELSE day_transfer END "
        "AS day_transfer_only_null, CASE WHEN coalesce(embryos_transferred, 0) = 0 THEN 1 ELSE 0 END AS no_transfer "
        "FROM cycles"
    )
)
def transfer_day_sentinel(spark, sf_dir):
    pair = ("embryos_transferred", "day_transfer")
    return cycles(spark, sf_dir).selectExpr(
        "id",
        f"{C.sentinel_when_zero(*pair)} AS day_transfer",
        f"{C.sentinel_when_zero(*pair, only_null=True)} AS day_transfer_only_null",
        f"{flag(z('embryos_transferred') + ' = 0')} AS no_transfer",
    )


@query(_from_cleaned(["id", *S.SENTINEL_DAYS.values()]))
def paired_day_sentinels(spark, sf_dir):
    return cleaned(spark, sf_dir).select("id", *S.SENTINEL_DAYS.values())


@query(
    with_cycles(
        f"SELECT id, CASE WHEN {sql_digits('n_pregnancies')} = 0 AND years_trying IS NULL THEN -1.0E0 "
        "ELSE years_trying END AS years_trying FROM cycles"
    )
)
def years_trying_sentinel(spark, sf_dir):
    return C.clean(cycles(spark, sf_dir), "clean", {}, years_rule=True).select("id", "years_trying")


@query(
    with_cycles(
        "SELECT id, CAST(coalesce(pgd, 0) AS INTEGER) AS pgd, CAST(coalesce(pgs, 0) AS INTEGER) AS pgs FROM cycles"
    )
)
def gene_test_zero(spark, sf_dir):
    return C.clean(cycles(spark, sf_dir), "clean", {}).select("id", "pgd", "pgs")


@query(_from_cleaned(["id", *[f"{n}_raw" for n in S.MISSING_DAYS]]))
def missing_before_sentinels(spark, sf_dir):
    return C.clean(cycles(spark, sf_dir), "clean", {}).select("id", *[f"{n}_raw" for n in S.MISSING_DAYS])


@query(_from_raw(["id", *[f"{c}__isnan" for c in S.MISSING_FLAGS]]))
def missing_flags(spark, sf_dir):
    return raw(spark, sf_dir).select("id", *[f"{c}__isnan" for c in S.MISSING_FLAGS])


@query(
    with_cycles(
        f"SELECT id, {sql_null_count([c for c in ALL if c not in ('id', 'success')])} AS n_missing_row FROM cycles"
    )
)
def missing_count_per_row(spark, sf_dir):
    return C.clean(cycles(spark, sf_dir), "clean", {}).select("id", "n_missing_row")


@query(_from_raw(["id", *[f"has_{t}" for t in S.PROCEDURE_TOKENS]]))
def procedure_tokens(spark, sf_dir):
    return raw(spark, sf_dir).select("id", *[f"has_{t}" for t in S.PROCEDURE_TOKENS])


@query(_from_cleaned(["id", *S.REASON_TOKENS_CLEAN]))
def reason_tokens(spark, sf_dir):
    return C.clean(cycles(spark, sf_dir), "clean", {}).select("id", *S.REASON_TOKENS_CLEAN)


@query(
    with_cycles(
        "SELECT id, greatest(coalesce(embryos_total, 0), coalesce(embryos_transferred, 0) + coalesce(embryos_stored, 0)) "
        "AS embryos_fixed, least(coalesce(icsi_embryos, 0), coalesce(icsi_eggs, 0)) AS icsi_embryos_fixed FROM cycles"
    )
)
def repaired_counts(spark, sf_dir):
    return raw(spark, sf_dir).selectExpr(
        "id",
        f"{C.fix_embryos('embryos_total', 'embryos_transferred', 'embryos_stored')} AS embryos_fixed",
        f"{C.fix_icsi_embryos('icsi_embryos', 'icsi_eggs')} AS icsi_embryos_fixed",
    )


@query(
    "SELECT event_id, CASE WHEN t IN ('nan', 'None') THEN NULL ELSE t END AS value, "
    "coalesce(CASE WHEN t IN ('nan', 'None') THEN NULL ELSE t END, 'missing') AS filled FROM "
    "(SELECT event_id, CASE WHEN event_type = 'click' THEN 'nan' WHEN event_type = 'view' THEN 'None' ELSE event_type END AS t "
    "FROM events)"
)
def placeholder_text(spark, sf_dir):
    kind = F.col("event_type")
    text = F.when(kind == "click", "nan").when(kind == "view", "None").otherwise(kind)
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("t"))
    return rows.select("event_id", X.text_or_null("t").alias("value"), X.text_or("t", "missing").alias("filled"))


@query(
    with_cycles(
        "SELECT c.id, CASE WHEN c.age_band IS NULL OR coalesce(n.n, 0) >= 500 THEN c.age_band ELSE 'OTHER' END AS age_band "
        "FROM cycles c LEFT JOIN (SELECT age_band, count(*) AS n FROM cycles WHERE split = 'train' GROUP BY 1) n "
        "ON c.age_band = n.age_band"
    )
)
def merge_rare_bands(spark, sf_dir):
    whole = cycles(spark, sf_dir)
    train = whole.where("split = 'train'")
    return merge_rare(whole, train, "age_band", 500).select("id", "age_band")


@query(
    with_cycles(
        "SELECT id, CASE WHEN coalesce(embryos_thawed, 0) > 0 THEN -1.0E0 ELSE coalesce(fresh_eggs, 0) END AS fresh_fet_adj, "
        "CASE WHEN coalesce(embryos_thawed, 0) > 0 THEN -1.0E0 ELSE coalesce(mixed_eggs, 0) END AS mixed_fet_adj FROM cycles"
    )
)
def frozen_cycle_mask(spark, sf_dir):
    return raw(spark, sf_dir).selectExpr(
        "id",
        f"{C.mask_frozen('embryos_thawed', 'fresh_eggs')} AS fresh_fet_adj",
        f"{C.mask_frozen('embryos_thawed', 'mixed_eggs')} AS mixed_fet_adj",
    )


CLEAN_COLUMNS = [
    *[c for c in ALL if c not in S.DROPPED], *S.CENSOR_FLAGS.values(), "age_median", "is_DI",
    *[f"{n}_raw" for n in S.MISSING_DAYS], "no_transfer", "miss_gene_test", *[f"{c}__isnan" for c in S.MISSING_FLAGS],
    "n_missing_row", *S.REASON_TOKENS_CLEAN, "split",
]


@query(_from_cleaned(CLEAN_COLUMNS))
def clean_table(spark, sf_dir):
    """The whole clean profile."""
    return cleaned(spark, sf_dir).select(CLEAN_COLUMNS)


RAW_COLUMNS = [
    *[c for c in ALL if c not in ("specific_type", "embryo_reason")], "age_num", "egg_donor_age_num",
    "sperm_donor_age_num", *[f"has_{t}" for t in S.PROCEDURE_TOKENS], *S.REASON_TOKENS,
    *[f"{c}__isnan" for c in S.MISSING_FLAGS], "split",
]


@query(_from_raw(RAW_COLUMNS))
def raw_table(spark, sf_dir):
    """The whole raw profile."""
    return raw(spark, sf_dir).select(RAW_COLUMNS)
