"""Query registry and the pieces that queries and their SQL share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.operators.clean import clean
from cohortlift.operators.fit import as_dict, fit_medians
from cohortlift.session import tune
from cohortlift.sources.cycles import CYCLES_SQL, read_cycles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with equivalent SQL where there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_cycles(tune(spark), sf_dir)


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; the test rows come without the target."""
    whole = cycles(spark, sf_dir)
    train = whole.where("split = 'train'").drop("split")
    return train, whole.where("split = 'test'").drop("split", S.TARGET)


def train_medians(df: DataFrame) -> dict[str, float]:
    rows = df.where("split = 'train'") if "split" in df.columns else df
    return as_dict(fit_medians(rows))


def cleaned(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    whole = cycles(spark, sf_dir)
    return clean(whole, "clean", train_medians(whole), **options)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(cycles(spark, sf_dir), "raw")


def rounded(c: str, digits: int = 9):
    """Engines add floats in different orders; results are compared after rounding."""
    return F.round(F.col(c), digits).alias(c)


def with_cycles(body: str, *ctes: str) -> str:
    parts = [f"cycles AS ({CYCLES_SQL})", *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


# --- SQL fragments -------------------------------------------------------------------------------


def sql_map(column: str, mapping: dict, default: str = "NULL") -> str:
    def literal(x):
        return f"'{x}'" if isinstance(x, str) else repr(x)

    whens = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {default} END"


def sql_digits(column: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({column}, '[0-9]+'), '') AS INTEGER)"


def sql_token(column: str, token: str) -> str:
    return f"CASE WHEN {column} LIKE '%{token}%' THEN 1 ELSE 0 END"


def sql_folds(source: str, seed: int = 42, id: str = "id", y: str = "success", k: int = S.N_FOLDS) -> str:
    return (
        f"SELECT *, {seed} AS seed, CAST((row_number() OVER (PARTITION BY {y} ORDER BY "
        f"md5(concat(CAST({id} AS VARCHAR), ':{seed}')), {id}) - 1) % {k} AS INTEGER) AS fold FROM {source}"
    )


def sql_oof(source: str, key: str, s: float, out: str = "te", y: str = "success", name: str = "e") -> list[str]:
    """CTEs ending in ``name``: the rows of ``source`` (with ``fold``) and their out-of-fold encoding."""
    return [
        f"{name}_kf AS (SELECT {key} AS k_, fold, count(*) AS n, sum({y}) AS t FROM {source} GROUP BY 1, 2)",
        f"{name}_f AS (SELECT fold, sum(n) AS n, sum(t) AS t FROM {name}_kf GROUP BY fold)",
        f"{name}_g AS (SELECT fold, CAST((SELECT sum(t) FROM {name}_f) - t AS DOUBLE) "
        f"/ CAST((SELECT sum(n) FROM {name}_f) - n AS DOUBLE) AS gm FROM {name}_f)",
        f"{name}_k AS (SELECT k_, sum(n) AS n, sum(t) AS t FROM {name}_kf GROUP BY k_)",
        f"{name}_te AS (SELECT kf.k_, kf.fold, CASE WHEN kf.k_ IS NULL OR k.n = kf.n THEN g.gm ELSE "
        f"(CAST(k.t - kf.t AS DOUBLE) + g.gm * {s}) / (CAST(k.n - kf.n AS DOUBLE) + {s}) END AS te "
        f"FROM {name}_kf kf JOIN {name}_k k ON kf.k_ IS NOT DISTINCT FROM k.k_ JOIN {name}_g g ON kf.fold = g.fold)",
        f"{name} AS (SELECT r.*, t.te AS {out} FROM {source} r JOIN {name}_te t "
        f"ON r.{key} IS NOT DISTINCT FROM t.k_ AND r.fold = t.fold)",
    ]


MEDIAN_COLUMNS_SQL = ", ".join(f"median({c}) AS m_{c}" for c in S.NUMERIC)


def sql_cleaned() -> list[str]:
    """CTEs ending in ``cleaned``: the clean profile of every cycle."""
    c: dict[str, str] = {}
    for spec in S.COLUMNS:
        if spec.group != "near_constant":
            c[spec.name] = f"c.{spec.name}"
    for n in S.COUNTS:
        c[n] = sql_digits(f"c.{n}")
    for n in S.DI_ZERO_COLUMNS:
        c[n] = f"CASE WHEN c.treatment_type = 'DI' THEN coalesce(c.{n}, 0) ELSE c.{n} END"
    for count, day in S.SENTINEL_DAYS.items():
        c[day] = f"CASE WHEN coalesce(c.{count}, 0) = 0 THEN -1 ELSE c.{day} END"
    for n in S.NUMERIC:
        c[n] = f"CAST(coalesce({c[n]}, m.m_{n}) AS DOUBLE)"
    for n in ("pgd", "pgs"):
        c[n] = f"CAST(coalesce(c.{n}, 0) AS INTEGER)"
    for n, name in S.CENSOR_FLAGS.items():
        c[name] = f"CASE WHEN c.{n} LIKE '%이상%' OR c.{n} LIKE '%>%' THEN 1 ELSE 0 END"
    c["age_ord"] = sql_map("c.age_band", S.AGE_ORDINAL)
    c["age_median"] = f"CAST({sql_map('c.age_band', S.AGE_MEDIAN, '36.0')} AS DOUBLE)"
    c["is_DI"] = "CASE WHEN c.treatment_type = 'DI' THEN 1 ELSE 0 END"
    for name, day in S.MISSING_DAYS.items():
        c[f"{name}_raw"] = f"CASE WHEN c.{day} IS NULL THEN 1 ELSE 0 END"
    c["no_transfer"] = "CASE WHEN coalesce(c.embryos_transferred, 0) = 0 THEN 1 ELSE 0 END"
    c["miss_gene_test"] = "CASE WHEN c.pgs IS NULL OR c.pgd IS NULL OR c.pgt_used IS NULL THEN 1 ELSE 0 END"
    for n in S.MISSING_FLAGS:
        c[f"{n}__isnan"] = f"CASE WHEN c.{n} IS NULL THEN 1 ELSE 0 END"
    c["n_missing_row"] = sql_null_count([s.name for s in S.COLUMNS if s.group not in ("identity", "target")], "c.")
    for name, token in S.REASON_TOKENS_CLEAN.items():
        c[name] = sql_token("c.embryo_reason", token)
    body = ",\n  ".join(f"{e} AS {n}" for n, e in c.items())
    return [
        f"m AS (SELECT {MEDIAN_COLUMNS_SQL} FROM cycles WHERE split = 'train')",
        f"cleaned AS (SELECT c.split,\n  {body}\n  FROM cycles c CROSS JOIN m)",
    ]


def sql_null_count(columns: list[str], prefix: str = "") -> str:
    return "(" + " + ".join(f"CASE WHEN {prefix}{c} IS NULL THEN 1 ELSE 0 END" for c in columns) + ")"


def sql_raw() -> list[str]:
    """CTE ``rawc``: the raw profile of every cycle."""
    c = {s.name: s.name for s in S.COLUMNS if s.name not in ("specific_type", "embryo_reason")}
    for n in S.COUNTS:
        c[n] = f"CAST({sql_map(n, S.COUNT_TEXT)} AS DOUBLE)"
    c["age_num"] = f"CAST({sql_map('age_band', S.AGE_MEDIAN)} AS DOUBLE)"
    c["age_ord"] = sql_map("age_band", S.AGE_ORDINAL)
    for n in ("egg_donor_age", "sperm_donor_age"):
        c[f"{n}_num"] = f"CAST({sql_map(n, S.DONOR_AGE)} AS DOUBLE)"
    for t in S.PROCEDURE_TOKENS:
        c[f"has_{t}"] = sql_token("specific_type", t)
    for name, token in S.REASON_TOKENS.items():
        c[name] = sql_token("embryo_reason", token)
    for n in S.MISSING_FLAGS:
        c[f"{n}__isnan"] = f"CASE WHEN {n} IS NULL THEN 1 ELSE 0 END"
    body = ",\n  ".join(f"{e} AS {n}" for n, e in c.items())
    return [f"rawc AS (SELECT split,\n  {body}\n  FROM cycles)"]
