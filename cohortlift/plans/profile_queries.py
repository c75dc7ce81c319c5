"""Profiling queries over cycles and over the other tables with a binary outcome."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.functions import scalars as X
from cohortlift.operators import fit as M
from cohortlift.operators import profile as P
from cohortlift.plans.base import cycles, query, rounded, split, table, with_cycles

RATE_COLUMNS = ("age_band", "treatment_type", "specific_type", "egg_source", "sperm_source", "day_transfer")
NUMERIC_PROFILE = tuple(S.NUMERIC) + ("cause_female_factor", "single_transfer", "fresh_embryo_used")
FLAGS = ("cause_cervical", "cause_sperm_immune", "cause_sperm_conc", "cause_sperm_motility", "cause_couple_secondary", "pgd", "pgs")
NULLABLE = ("years_trying", "pgt_used", "pgd", "pgs", *S.NUMERIC)
ICSI_RANGES = ((0, 0, "0"), (0, 50, "1-50"), (50, 70, "51-70"), (70, 90, "71-90"), (90, 100, "91-100"))
EMBRYO_RANGES = ((-1, 6, "0-6"), (6, 20, "7-20"), (20, 10_000, "21+"))


def train_rows(spark, sf_dir):
    """Rates and correlations of the target are profiled on train rows only."""
    return split(spark, sf_dir)[0]


def with_train(body: str) -> str:
    return with_cycles(body, "train AS (SELECT * FROM cycles WHERE split = 'train')")


def _union(template: str, columns) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


@query(with_train("SELECT day_transfer, count(*) AS n, avg(CAST(success AS DOUBLE)) AS rate FROM train GROUP BY 1"))
def target_rate_by_transfer_day(spark, sf_dir):
    return P.target_rate(train_rows(spark, sf_dir), ["day_transfer"])


@query(
    with_train(
        _union(
            "SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n, "
            "avg(CAST(success AS DOUBLE)) AS rate FROM train GROUP BY 2",
            RATE_COLUMNS,
        )
    )
)
def target_rate_per_column(spark, sf_dir):
    return P.target_rate_all(train_rows(spark, sf_dir), RATE_COLUMNS)


@query(
    "SELECT d.lang, d.source, count(*) AS n, avg(CAST(l.quality AS DOUBLE)) AS rate "
    "FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY 1, 2"
)
def target_rate_by_document_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return P.target_rate(table(spark, sf_dir, "labels").join(docs, "doc_id"), ["lang", "source"], "quality")


@query(
    "SELECT o_orderpriority, count(*) AS n, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0E0 ELSE 0.0E0 END) AS rate "
    "FROM orders GROUP BY 1"
)
def target_rate_by_order_priority(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("finished", X.flag(F.col("o_orderstatus") == "F"))
    return P.target_rate(orders, ["o_orderpriority"], "finished")


def _range_sql(value: str, ranges) -> str:
    whens = " ".join(
        f"WHEN v = {a} THEN '{t}'" if a == b else f"WHEN v > {a} AND v <= {b} THEN '{t}'" for a, b, t in ranges
    )
    return (
        f"SELECT CASE {whens} END AS range, count(*) AS n, avg(CAST(success AS DOUBLE)) AS rate, "
        "count(*) FILTER (WHERE embryos_transferred > 0) AS n_if, "
        "avg(CAST(success AS DOUBLE)) FILTER (WHERE embryos_transferred > 0) AS rate_if "
        f"FROM (SELECT *, {value} AS v FROM train) GROUP BY 1"
    )


@query(with_train(_range_sql("icsi_embryos * 100.0E0 / nullif(icsi_eggs, 0)", ICSI_RANGES)))
def target_rate_by_icsi_range(spark, sf_dir):
    value = F.try_divide(F.col("icsi_embryos") * 100.0, F.col("icsi_eggs"))
    return P.target_rate_by_range(
        train_rows(spark, sf_dir), value, ICSI_RANGES, condition=F.col("embryos_transferred") > 0
    )


@query(with_train(_range_sql("embryos_total", EMBRYO_RANGES)))
def target_rate_after_transfer(spark, sf_dir):
    return P.target_rate_by_range(
        train_rows(spark, sf_dir), F.col("embryos_total"), EMBRYO_RANGES, condition=F.col("embryos_transferred") > 0
    )


@query(
    with_train(
        _union(
            "SELECT '{c}' AS \"column\", CASE WHEN min({c}) < max({c}) THEN "
            "round(corr(CAST({c} AS DOUBLE), CAST(success AS DOUBLE)), 9) END AS corr FROM train",
            NUMERIC_PROFILE,
        )
    )
)
def target_correlations(spark, sf_dir):
    return P.correlations(train_rows(spark, sf_dir), NUMERIC_PROFILE).select("column", rounded("corr"))


@query(
    with_cycles(
        _union(
            "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, "
            "CASE WHEN count(DISTINCT {c}) <= 1 THEN 1 ELSE 0 END AS is_constant FROM cycles",
            [c.name for c in S.COLUMNS if c.group != "identity"],
        )
    )
)
def zero_variance_columns(spark, sf_dir):
    columns = [c.name for c in S.COLUMNS if c.group != "identity"]
    return P.zero_variance(cycles(spark, sf_dir), columns)


@query(
    with_cycles(
        _union(
            "SELECT '{c}' AS \"column\", CAST(coalesce(sum(CASE WHEN {c} = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS positives, "
            "CAST(coalesce(sum(CASE WHEN {c} = 1 THEN 1 ELSE 0 END), 0) AS DOUBLE) / count(*) AS share, "
            "CAST(coalesce(sum(CASE WHEN {c} = 1 THEN 1 ELSE 0 END), 0) AS DOUBLE) / 5 AS per_fold FROM cycles",
            FLAGS,
        )
    )
)
def rare_positive_flags(spark, sf_dir):
    return P.rare_positives(cycles(spark, sf_dir), FLAGS)


@query(
    with_cycles(
        _union(
            "SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0E0 ELSE 0.0E0 END) AS missing_rate FROM cycles",
            dict.fromkeys(NULLABLE),
        )
    )
)
def missing_rate_per_column(spark, sf_dir):
    return P.missing_rates(cycles(spark, sf_dir), list(dict.fromkeys(NULLABLE)))


@query(
    with_cycles(
        "SELECT induction_type, n, CAST(n AS DOUBLE) / (SELECT count(*) FROM cycles) AS share FROM "
        "(SELECT induction_type, count(*) AS n FROM cycles GROUP BY 1) ORDER BY n DESC, induction_type LIMIT 2"
    )
)
def top_category_shares(spark, sf_dir):
    return P.top_values(cycles(spark, sf_dir), "induction_type", 2)


@query(
    "SELECT source, n, CAST(n AS DOUBLE) / (SELECT count(*) FROM documents) AS share FROM "
    "(SELECT source, count(*) AS n FROM documents GROUP BY 1) ORDER BY n DESC, source LIMIT 3"
)
def top_document_sources(spark, sf_dir):
    return P.top_values(table(spark, sf_dir, "documents"), "source", 3)


@query(
    "WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents), c AS (SELECT line, count(*) AS n FROM lines GROUP BY 1) "
    "SELECT line, n, CAST(n AS DOUBLE) / (SELECT count(*) FROM lines) AS share FROM c ORDER BY n DESC, line LIMIT 5"
)
def top_document_lines(spark, sf_dir):
    """The most frequent lines of all texts: a column of many values, of which a sketch finds the candidates."""
    lines = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.explode(F.split("text", "\n")).alias("line"))
    return P.top_values(lines, "line", 5)


@query(
    "WITH kept AS (SELECT user_id FROM events GROUP BY 1 HAVING count(*) >= 60) SELECT e.event_id, CASE WHEN e.user_id IS NULL OR k.user_id IS NOT NULL "
    "THEN CAST(e.user_id AS VARCHAR) ELSE 'OTHER' END AS user_id FROM events e LEFT JOIN kept k ON e.user_id = k.user_id"
)
def rare_users_merged(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("user_id"))
    return M.merge_rare(rows, rows, "user_id", 60)


LIFT_TOKENS = {**{t: t for t in S.PROCEDURE_TOKENS}, "repeated": ":"}


@query(
    with_train(
        " UNION ALL ".join(
            f"SELECT '{n}' AS token, count(*) FILTER (WHERE specific_type LIKE '%{t}%') AS n, "
            f"avg(CAST(success AS DOUBLE)) FILTER (WHERE specific_type LIKE '%{t}%') AS rate, "
            f"avg(CAST(success AS DOUBLE)) FILTER (WHERE specific_type LIKE '%{t}%') - avg(CAST(success AS DOUBLE)) AS lift "
            "FROM train"
            for n, t in LIFT_TOKENS.items()
        )
    )
)
def procedure_token_lift(spark, sf_dir):
    return P.token_lift(train_rows(spark, sf_dir), "specific_type", LIFT_TOKENS)


@query(
    with_train(
        "SELECT 'all' AS segment, count(*) AS n, avg(CAST(success AS DOUBLE)) AS rate FROM train UNION ALL "
        "SELECT CASE WHEN embryos_transferred > 0 THEN 'transfer' ELSE 'no transfer' END, count(*), "
        "avg(CAST(success AS DOUBLE)) FROM train GROUP BY 1"
    )
)
def target_rate_per_segment(spark, sf_dir):
    segment = F.when(F.col("embryos_transferred") > 0, "transfer").otherwise("no transfer")
    return P.target_rate_per_segment(train_rows(spark, sf_dir).withColumn("segment", segment), "segment")


@query(
    with_train(
        "SELECT CAST(cause_male_factor AS DOUBLE) AS cause_male_factor, CAST(is_icsi AS DOUBLE) AS is_icsi, CAST(grouping(cause_male_factor, is_icsi) AS INTEGER) AS margin, count(*) AS n, "
        "avg(CAST(success AS DOUBLE)) AS rate FROM (SELECT success, cause_male_factor, "
        "CASE WHEN icsi_eggs > 0 THEN 1 ELSE 0 END AS is_icsi FROM train) GROUP BY CUBE (cause_male_factor, is_icsi)"
    )
)
def target_rate_male_factor_by_icsi(spark, sf_dir):
    rows = train_rows(spark, sf_dir).select(
        "success",
        F.col("cause_male_factor").cast("double").alias("cause_male_factor"),
        X.flag(F.col("icsi_eggs") > 0).cast("double").alias("is_icsi"),
    )
    return P.target_rate_pair(rows, "cause_male_factor", "is_icsi")
