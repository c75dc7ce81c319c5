"""Profiling: rates, correlations, missingness and concentration, each in one pass over the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.functions import scalars as X


def _text(df: DataFrame, c: str) -> Column:
    """Text of a value; adding 0.0 folds negative zero."""
    value = F.col(c) + F.lit(0.0) if dict(df.dtypes)[c] == "double" else F.col(c)
    return value.cast("string")


def _rate(y: str | Column) -> Column:
    return F.avg(X.col(y).cast("double"))


def target_rate(df: DataFrame, by: Sequence[str] = (), y: str = S.TARGET) -> DataFrame:
    """Rows and target rate overall or per value of the columns, NULL being a group."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), _rate(y).alias("rate"))


def target_rate_per_segment(df: DataFrame, segment: str, y: str = S.TARGET) -> DataFrame:
    """Rate of each segment (not NULL) and of all rows, as ``segment`` 'all', in one pass."""
    rates = df.rollup(segment).agg(F.count("*").alias("n"), _rate(y).alias("rate"))
    return rates.select(F.coalesce(F.col(segment), F.lit("all")).alias(segment), "n", "rate")


def target_rate_all(df: DataFrame, columns: Sequence[str], y: str = S.TARGET) -> DataFrame:
    """``(column, value, n, rate)`` of several columns from one scan and one shuffle."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), _text(df, c).alias("value")) for c in columns]
    )
    long = df.select(F.col(y).alias("_y"), F.inline(pairs))
    return long.groupBy("column", "value").agg(F.count("*").alias("n"), _rate("_y").alias("rate"))


def range_label(c: Column, ranges: Sequence[tuple[float, float, str]]) -> Column:
    """Label of the right-closed range that holds the value (a range of one point holds that point); else NULL."""
    out = None
    for low, high, text in ranges:
        inside = (c == low) if low == high else (c > low) & (c <= high)
        out = F.when(inside, F.lit(text)) if out is None else out.when(inside, F.lit(text))
    return out


def target_rate_by_range(
    df: DataFrame,
    value: Column,
    ranges: Sequence[tuple[float, float, str]],
    y: str = S.TARGET,
    condition: Column | None = None,
) -> DataFrame:
    """Rows and rate per range; with ``condition`` also those of the rows that meet it, in the same pass."""
    aggs = [F.count("*").alias("n"), _rate(y).alias("rate")]
    if condition is not None:
        met = X.flag(condition) == 1
        aggs += [
            F.sum(met.cast("bigint")).alias("n_if"),
            F.avg(F.when(met, F.col(y).cast("double"))).alias("rate_if"),
        ]
    return df.withColumn("range", range_label(value, ranges)).groupBy("range").agg(*aggs)


def target_rate_pair(df: DataFrame, a: str, b: str, y: str = S.TARGET) -> DataFrame:
    """Rate of each pair of values with both margins and the total."""
    return df.cube(a, b).agg(
        F.grouping_id().cast("int").alias("margin"), F.count("*").alias("n"), _rate(y).alias("rate")
    )


def _wide(df: DataFrame, columns: Sequence[str], build, key: str, value: str) -> DataFrame:
    """One aggregate per column in one pass, turned into ``(key, value)`` rows."""
    wide = df.agg(*[build(c).alias(c) for c in columns])
    return wide.unpivot([], list(columns), key, value)


def zero_variance(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """``(column, n_distinct, is_constant)``.  Exact counts come from one shuffle of (column, value)."""
    if approx:
        counts = _wide(df, columns, lambda c: F.approx_count_distinct(c), "column", "n_distinct")
    else:
        pairs = F.array(
            *[F.struct(F.lit(c).alias("column"), _text(df, c).alias("value")) for c in columns]
        )
        values = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.lit(1).alias("_one"))
        counts = values.groupBy("column").agg(F.count("value").alias("n_distinct"))
    return counts.withColumn("is_constant", (F.col("n_distinct") <= 1).cast("int"))


def correlations(df: DataFrame, columns: Sequence[str], y: str = S.TARGET) -> DataFrame:
    """``(column, corr)`` with the target; NULL for a constant column (``corr`` itself would throw there)."""

    def build(c: str) -> Column:
        x = X.num(c)
        target = F.when(x.isNotNull(), F.col(y).cast("double"))
        return F.try_divide(F.covar_pop(x, target), F.stddev_pop(x) * F.stddev_pop(target))

    return _wide(df.where(F.col(y).isNotNull()), columns, build, "column", "corr")


def rare_positives(df: DataFrame, columns: Sequence[str], k: int = S.N_FOLDS) -> DataFrame:
    """``(column, positives, share, per_fold)`` of 0/1 columns."""
    sums = [F.sum((X.z(c) == 1).cast("bigint")).alias(c) for c in columns]
    wide = df.agg(F.count("*").alias("_n"), *sums)
    long = wide.unpivot(["_n"], list(columns), "column", "positives")
    return long.select(
        "column",
        "positives",
        (F.col("positives") / F.col("_n")).alias("share"),
        (F.col("positives") / k).alias("per_fold"),
    )


def missing_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, missing_rate)``."""
    return _wide(df, columns, lambda c: F.expr(f"avg(CAST(`{c}` IS NULL AS DOUBLE))"), "column", "missing_rate")


TRACKED = 4096


def frequent_counts(df: DataFrame, column: str, tracked: int = TRACKED) -> tuple[DataFrame, float]:
    """Exact ``(column, n)`` of the values that a sketch of frequent items returns, and a bound: no other value is held oftener.

    The sketch's state holds ``tracked`` values per task and merges; only rows of values it returns are counted and moved.  It
    returns all values that surely exceed its error of at most 3.5 / ``tracked`` of the rows, so any other one lies within twice
    that.  NULL is a value.
    """
    found = df.agg(F.count("*").alias("rows"), F.expr(f"approx_top_k(`{column}`, {tracked}, {tracked})").alias("items"))
    items = found.select(F.inline("items")).select(F.col("item").alias("_item"))
    own = df.select(column)
    counts = own.join(F.broadcast(items), own[column].eqNullSafe(items["_item"]), "left_semi").groupBy(column).agg(F.count("*").alias("n"))
    return counts, 7.0 * found.first()["rows"] / tracked


def top_values(df: DataFrame, column: str, n: int, tracked: int = TRACKED) -> DataFrame:
    """The ``n`` most frequent values with their share of all rows; ties go to the smaller value, NULL first.

    Candidates of a sketch are counted exactly.  Where the n-th of them does not exceed what any other value may have, all
    values are counted.
    """
    counts, bound = frequent_counts(df, column, tracked)
    total = df.count()
    ranked = counts.orderBy(F.desc("n"), F.asc_nulls_first(column)).limit(n).persist()
    least = ranked.agg(F.count("*").alias("have"), F.min("n").alias("least")).first()
    if least["have"] < n or least["least"] <= bound:
        ranked.unpersist()
        every = df.groupBy(column).agg(F.count("*").alias("n"))
        ranked = every.orderBy(F.desc("n"), F.asc_nulls_first(column)).limit(n)
    return ranked.withColumn("share", F.try_divide(F.col("n").cast("double"), F.lit(float(total))))


def token_lift(df: DataFrame, column: str, tokens: Mapping[str, str], y: str = S.TARGET) -> DataFrame:
    """``(token, n, rate, lift)``: rate of rows that contain the token minus the overall rate."""
    named = list(tokens)
    aggs = [_rate(y).alias("_base")]
    for name in named:
        hit = X.has_token(column, tokens[name]) == 1
        aggs.append(
            F.struct(
                F.sum(hit.cast("bigint")).alias("n"),
                F.avg(F.when(hit, F.col(y).cast("double"))).alias("rate"),
            ).alias(name)
        )
    long = df.agg(*aggs).unpivot(["_base"], named, "token", "found")
    return long.select("token", "found.n", "found.rate", (F.col("found.rate") - F.col("_base")).alias("lift"))
