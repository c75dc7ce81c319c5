"""Stratified folds with a fixed order, equal in every engine that has md5."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.functions.ranking import hash_bucket, running_total

BUCKET_ROWS = 16_384


def assign_folds(
    df: DataFrame,
    id: str = S.ID,
    y: str = S.TARGET,
    k: int = S.N_FOLDS,
    seeds: Sequence[int] = (42,),
    digits: int | None = None,
    strata: Sequence[str] = (),
) -> DataFrame:
    """All columns of ``df`` once per seed, with ``seed`` and ``fold``.

    Each class (within ``strata``, if given) is ordered by md5 of "id:seed" and dealt out in turn, so class
    sizes of two folds differ by at most one; rows without a label are a class.  ``id`` must be unique.  A class falls into
    16**digits buckets that are ordered independently, by default as many as leave BUCKET_ROWS rows in one at most.
    """
    if digits is None:
        digits = max(1, ceil(log(max(1, df.count() / BUCKET_ROWS), 16)))
    seeded = df.withColumn("seed", F.explode(F.array(*[F.lit(s) for s in seeds])))
    seeded = seeded.withColumn("_h", F.md5(F.concat_ws(":", F.col(id).cast("string"), F.col("seed").cast("string"))))
    seeded = seeded.withColumn("_bucket", hash_bucket(F.col("_h"), digits))
    ranked = running_total(seeded, ["seed", *strata, y], "_bucket", ["_h", id], F.lit(1), "_rank")
    return ranked.withColumn("fold", (F.col("_rank") % k).cast("int")).select(*df.columns, "seed", "fold")


def fold_columns(
    df: DataFrame, id: str = S.ID, y: str = S.TARGET, k: int = S.N_FOLDS, seeds: Sequence[int] = (42,), strata: Sequence[str] = ()
) -> DataFrame:
    """``(id, fold_<seed>...)``: the folds of ``assign_folds``, a row per id and a column per seed.

    Only id, class and hash are ordered, once for each seed; rows with features are joined with the result once.
    """
    dealt = assign_folds(df.select(id, y, *strata), id, y, k, seeds, strata=strata)
    return dealt.groupBy(id).agg(*[F.max(F.when(F.col("seed") == s, F.col("fold"))).alias(fold_column(s)) for s in seeds])


def fold_column(seed: int) -> str:
    return f"fold_{seed}"


def split_fold(df: DataFrame, fold: int, column: str = "fold") -> tuple[DataFrame, DataFrame]:
    """Train complement and validation part of one fold."""
    return df.where(F.col(column) != fold), df.where(F.col(column) == fold)


def complement_rates(df: DataFrame, y: str = S.TARGET) -> DataFrame:
    """``(fold, n_train, n_valid, rate_train)``: complement sizes as total minus fold, from one pass."""
    sizes = df.groupBy("fold").agg(F.count("*").alias("n"), F.sum(y).alias("t"))
    whole = Window.partitionBy(F.lit(0))  # over the k rows of ``sizes``
    rest_n, rest_t = F.sum("n").over(whole) - F.col("n"), F.sum("t").over(whole) - F.col("t")
    return sizes.select(
        "fold", rest_n.alias("n_train"), F.col("n").alias("n_valid"), F.try_divide(rest_t, rest_n).alias("rate_train")
    )
