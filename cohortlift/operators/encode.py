"""Smoothed target encoding: one aggregation for all keys and folds, no loop over folds."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.functions import scalars as X
from cohortlift.functions.joins import MAX_BROADCAST_BYTES, attach, measured_bytes


@dataclass(frozen=True)
class Key:
    """A grouping key and its smoothing strength."""

    column: str
    smoothing: float


def combo_keys(df: DataFrame, timing: str = "period_code") -> DataFrame:
    """Add the combination keys: token flags, type with age band, type with ``timing``."""
    new = {
        "proc_specific": X.combo_key([f"has_{t}" for t in S.COMBO_TOKENS], ""),
        "proc_age": X.combo_key(["treatment_type", "age_band"]),
        "proc_timing": X.combo_key(["treatment_type", timing]),
    }
    return df.select("*", *[e.alias(n) for n, e in new.items()])


COMBO_KEYS = {f"TE__{n}": Key(n, S.SMOOTHING[n]) for n in ("proc_specific", "proc_age", "proc_timing")}
PERIOD_KEY = {"period_te": Key("period_code", S.SMOOTHING["period"])}


def smoothed(total: Column, n: Column, prior: Column, strength: Column | float) -> Column:
    strength = F.lit(float(strength)) if isinstance(strength, (int, float)) else strength
    return (total + prior * strength) / (n + strength)


def smoothed_mean(df: DataFrame, key: str, y: str = S.TARGET, s: float = 20.0) -> DataFrame:
    """``(key, n, total, te)`` per key value, shrunk towards the overall mean."""
    stats = df.groupBy(key).agg(F.count(y).alias("n"), F.coalesce(F.sum(y), F.lit(0)).alias("total")).persist()
    whole = stats.agg(F.sum("total").alias("t"), F.sum("n").alias("n")).first()
    mean = float(whole["t"]) / whole["n"] if whole["n"] else None
    return stats.withColumn("te", smoothed(F.col("total"), F.col("n"), F.lit(mean).cast("double"), s))


@dataclass(frozen=True)
class Encoder:
    """Fitted counts of all keys: ``stats(encoding, key, fold, n, total)`` and the means of the folds."""

    keys: Mapping[str, Key]
    k: int
    stats: DataFrame
    fold_prior: dict[int, float]
    prior: float
    size: int

    def _strength(self) -> Column:
        return X.lookup("encoding", {n: float(key.smoothing) for n, key in self.keys.items()})

    def _fold_prior(self, fold: Column) -> Column:
        return X.lookup(fold, self.fold_prior)

    def oof(self, df: DataFrame, fold: str = "fold", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
        """Encode the training rows, each with the counts of the other folds."""
        per_key = Window.partitionBy("encoding", "key")
        rest_n = F.sum("n").over(per_key) - F.col("n")
        rest_total = F.sum("total").over(per_key) - F.col("total")
        prior = self._fold_prior(F.col("fold"))
        table = (
            self.stats.withColumn("_n", rest_n)
            .withColumn("_total", rest_total)
            .withColumn("_prior", prior)
            .withColumn(
                "te",
                F.when(F.col("key").isNull() | (F.col("_n") == 0), F.col("_prior")).otherwise(
                    smoothed(F.col("_total"), F.col("_n"), F.col("_prior"), self._strength())
                ),
            )
        )
        out = df
        for name, key in self.keys.items():
            side = table.where(F.col("encoding") == name).select(
                F.col("key").alias("_key"), F.col("fold").alias(fold), F.col("te").alias(name)
            )
            keyed = out.withColumn("_key", F.col(key.column).cast("string"))
            out = attach(keyed, side, ["_key", fold], max_bytes=max_bytes, size=self.size).drop("_key")
        return out

    def transform(self, df: DataFrame, how: str = "full", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
        """Encode other rows from all training rows (``full``) or by the mean of the fold maps (``fold_mean``)."""
        known = self.stats.where(F.col("key").isNotNull())
        if how == "full":
            grouped = known.groupBy("encoding", "key").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
            te = smoothed(F.col("total"), F.col("n"), F.lit(self.prior), self._strength())
            default = self.prior
        elif how == "fold_mean":
            folds = range(self.k)
            grouped = (
                known.groupBy("encoding", "key")
                .pivot("fold", list(folds))
                .agg(F.sum("n").alias("n"), F.sum("total").alias("t"))
                .na.fill(0)
            )
            all_n = reduce(add, (F.col(f"{f}_n") for f in folds))
            all_t = reduce(add, (F.col(f"{f}_t") for f in folds))

            def one(f: int) -> Column:
                n, t, gm = all_n - F.col(f"{f}_n"), all_t - F.col(f"{f}_t"), F.lit(self.fold_prior[f])
                return F.when(n == 0, gm).otherwise(smoothed(t, n, gm, self._strength()))

            te = reduce(add, (one(f) for f in folds)) / self.k
            default = sum(self.fold_prior[f] for f in folds) / self.k
        else:
            raise ValueError(f"unknown variant {how!r}")
        table = grouped.withColumn("te", te)
        out = df
        for name, key in self.keys.items():
            side = table.where(F.col("encoding") == name).select(F.col("key").alias("_key"), F.col("te").alias(name))
            keyed = out.withColumn("_key", F.col(key.column).cast("string"))
            out = attach(keyed, side, ["_key"], max_bytes=max_bytes, size=self.size).drop("_key")
            out = out.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
        return out


def fit_encoder(
    train: DataFrame, keys: Mapping[str, Key], y: str = S.TARGET, fold: str = "fold", k: int = S.N_FOLDS
) -> Encoder:
    """Count rows and positives of every key and fold in one pass over ``train``."""
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("encoding"), F.col(key.column).cast("string").alias("key"))
            for n, key in keys.items()
        ]
    )
    stats = (
        train.select(F.col(fold).alias("fold"), F.col(y).alias("_y"), F.inline(pairs))
        .groupBy("encoding", "key", "fold")
        .agg(F.count("_y").alias("n"), F.coalesce(F.sum("_y"), F.lit(0)).alias("total"))
        .persist()
    )
    first = next(iter(keys))
    rows = (
        stats.where(F.col("encoding") == first).groupBy("fold").agg(F.sum("n").alias("n"), F.sum("total").alias("t")).collect()
    )
    n, t = sum(r["n"] for r in rows), float(sum(r["t"] for r in rows))
    rest = {r["fold"]: (t - r["t"], n - r["n"]) for r in rows}
    overall = t / n
    fold_prior = {f: a / b if b else overall for f, (a, b) in rest.items()}
    fold_prior = {f: fold_prior.get(f, overall) for f in range(k)}
    return Encoder(dict(keys), k, stats, fold_prior, overall, measured_bytes(stats))


def oof_encode(df: DataFrame, key: str, y: str = S.TARGET, fold: str = "fold", s: float = 20.0, out: str = "te") -> DataFrame:
    return fit_encoder(df, {out: Key(key, s)}, y, fold).oof(df, fold)


def encode_test(
    train: DataFrame, test: DataFrame, key: str, y: str = S.TARGET, s: float = 20.0, how: str = "full", out: str = "te"
) -> DataFrame:
    return fit_encoder(train, {out: Key(key, s)}, y).transform(test, how)
