"""Attach a statistics table to rows: broadcast when its measured size allows, else split hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 32 << 20
HOT_KEYS = 1000


def measured_bytes(df: DataFrame) -> int:
    """Rows times column widths plus text lengths, from one aggregate."""
    texts = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`").cast("binary"))), F.lit(0)) for c, t in df.dtypes if t == "string"]
    total = reduce(lambda a, b: a + b, texts, F.lit(0))
    row = df.agg(F.count("*").alias("n"), total.alias("text")).first()
    return row["n"] * 16 * len(df.columns) + row["text"]


def _null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> Column:
    return reduce(and_, (left[c].eqNullSafe(right[f"_k_{c}"]) for c in on))


def by_id(rows: DataFrame, other: DataFrame, on: str = "id") -> DataFrame:
    """Join two tables that both grow with the input by a shuffle, never by broadcast.

    Spark takes a table's files for its size; wide rows of flags and codes are many times larger in memory, and a broadcast
    builds them whole on the driver.
    """
    return rows.hint("merge").join(other, on)


def attach(
    df: DataFrame,
    stats: DataFrame,
    on: Sequence[str],
    spread: Sequence[str] | None = None,
    max_bytes: int = MAX_BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
    size: int | None = None,
) -> DataFrame:
    """Left join of ``stats`` (one row per key; NULL keys match) onto ``df``.

    A table beyond ``max_bytes`` is joined in two parts: keys that hold more than 1/``hot_keys`` of the
    rows, of which there are fewer than ``hot_keys``, by broadcast, and the others by a shuffle in which
    the rows of hot keys are spread by a hash of ``spread`` (default: all columns).  ``size`` is an upper bound
    of the bytes of ``stats`` that the caller has measured.
    """
    if size is None:
        stats = stats.persist()
        size = measured_bytes(stats)
    values = [c for c in stats.columns if c not in on]
    keyed = stats.select(*[F.col(c).alias(f"_k_{c}") for c in on], *values)
    drop_keys = [f"_k_{c}" for c in on]
    if size <= max_bytes:
        return df.join(F.broadcast(keyed), _null_safe(df, keyed, on), "left").drop(*drop_keys)

    total = df.count()
    heavy = (
        df.groupBy(*on)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") * hot_keys > total)
        .select(*[F.col(c).alias(f"_h_{c}") for c in on])
        .persist()
    )
    same = reduce(and_, (F.col(f"_k_{c}").eqNullSafe(F.col(f"_h_{c}")) for c in on))
    matched = keyed.join(F.broadcast(heavy), same, "left_semi")
    # Every heavy key leaves the shuffle, also one that ``stats`` lacks: its values are NULL.
    hot = heavy.join(F.broadcast(matched), same, "left").select(
        *[F.col(f"_h_{c}").alias(f"_k_{c}") for c in on],
        *[F.col(v).alias(f"_hot_{v}") for v in values],
        F.lit(True).alias("_hit"),
    )
    first = df.join(F.broadcast(hot), _null_safe(df, hot, on), "left").drop(*drop_keys)

    spread_by = F.pmod(F.xxhash64(*(spread or df.columns)), F.lit(1 << 20)) + 1
    first = first.withColumn("_salt", F.when(F.col("_hit"), spread_by).otherwise(F.lit(0)))
    # Always 0, but no literal: the optimizer would turn a comparison with one into a filter, and the salt would not
    # take part in the partitioning.
    zero = F.pmod(F.xxhash64(*drop_keys), F.lit(1).cast("bigint"))
    cold = keyed.select(*drop_keys, *[F.col(v).alias(f"_cold_{v}") for v in values], zero.alias("_zero"))
    joined = first.join(cold, _null_safe(first, cold, on) & (first["_salt"] == cold["_zero"]), "left")
    return joined.select(
        *df.columns,
        *[F.when(F.col("_hit"), F.col(f"_hot_{v}")).otherwise(F.col(f"_cold_{v}")).alias(v) for v in values],
    )
