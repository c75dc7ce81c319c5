"""Fitted statistics: medians, vocabularies, column kinds and feature sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.functions import scalars as X
from cohortlift.functions.joins import attach, measured_bytes
from cohortlift.functions.ranking import MOST_VALUES, dense_codes, exact_medians
from cohortlift.functions.sql_text import finite
from cohortlift.operators.profile import frequent_counts

COUNT_LIKE = "[0-9]+회"


def fit_medians(df: DataFrame, columns: Sequence[str] = tuple(S.NUMERIC), exact: bool = True, most: int = MOST_VALUES) -> DataFrame:
    """``(column, median)`` of the columns that exist, on rows before any rule.

    Ranges of values are narrowed by counts until ``most`` rows are left of them (``ranking.exact_values``).
    ``exact=False`` takes approximate percentiles.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column string, median double")
    if exact:
        return exact_medians(df, present, most)
    wide = df.selectExpr(*[f"percentile_approx({finite(c)}, 0.5D) AS `{c}`" for c in present])
    return unpivot(wide, present, "column", "median")


def unpivot(df: DataFrame, columns: Sequence[str], key: str, value: str) -> DataFrame:
    return df.unpivot([], list(columns), key, value)


def as_dict(medians: DataFrame) -> dict[str, float]:
    """One number per column, held by the driver."""
    return {r["column"]: r["median"] for r in medians.collect()}


def impute(df: DataFrame, medians: Mapping[str, float], default: float | None = None) -> DataFrame:
    """Fill NULL with the fitted medians; a column without one takes ``default``."""
    fills = {c: default if m is None else m for c, m in medians.items()}
    return df.select(
        *[
            F.coalesce(X.num(c), F.lit(float(fills[c]))).alias(c) if fills.get(c) is not None else F.col(c)
            for c in df.columns
        ]
    )


def value_counts(df: DataFrame, columns: Sequence[str], placeholder: str | None = None) -> DataFrame:
    """``(column, value, n)`` over all listed columns in one pass; NULL counts as ``placeholder`` or is left out."""

    def text(c: str) -> Column:
        return X.text_or_null(c) if placeholder is None else X.text_or(c, placeholder)

    pairs = F.array(*[F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def fit_vocab(
    df: DataFrame,
    columns: Sequence[str],
    also: DataFrame | None = None,
    placeholder: str | None = None,
) -> DataFrame:
    """``(column, value, code)``: codes in sorted order of the values seen in ``df`` (and in ``also``)."""
    values = value_counts(df, columns, placeholder).select("column", "value")
    if also is not None:
        other = value_counts(also, columns, placeholder).select("column", "value")
        values = values.unionByName(other).distinct()
    return dense_codes(values, "column", "value", "code")


def apply_vocab(
    df: DataFrame,
    vocab: DataFrame,
    columns: Sequence[str],
    placeholder: str | None = None,
    unseen: str = "null",
    suffix: str = "_code",
) -> DataFrame:
    """Add ``<column><suffix>``; a value outside the vocabulary is NULL, or -1 with ``unseen='keep'``."""
    vocab = vocab.persist()
    size, out = measured_bytes(vocab), df
    for c in columns:
        key = f"_v_{c}"
        text = X.text_or_null(c) if placeholder is None else X.text_or(c, placeholder)
        side = vocab.where(F.col("column") == c).select(F.col("value").alias(key), F.col("code").alias(f"{c}{suffix}"))
        out = attach(out.withColumn(key, text), side, [key], size=size).drop(key)
        if unseen == "keep":
            out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(-1)))
    return out


def unseen_values(test: DataFrame, vocab: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` of test values that the vocabulary lacks."""
    return value_counts(test, columns).join(vocab, ["column", "value"], "left_anti")


def merge_rare(df: DataFrame, train: DataFrame, column: str, min_rows: int, other: str = "OTHER") -> DataFrame:
    """Replace values that the train rows hold fewer than ``min_rows`` times.

    Where ``min_rows`` exceeds what a value outside of the sketch of frequent ones may have, the sketch's values alone are counted.
    """
    counts, bound = frequent_counts(train, column)
    if min_rows <= bound:
        counts = train.groupBy(column).agg(F.count("*").alias("n"))
    counts = counts.where(F.col(column).isNotNull() & (F.col("n") >= min_rows)).withColumnRenamed("n", "_seen")
    kept = F.col(column).isNull() | (F.coalesce(F.col("_seen"), F.lit(0)) >= min_rows)
    joined = attach(df, counts, [column])
    return joined.withColumn(column, F.when(kept, F.col(column)).otherwise(F.lit(other))).drop("_seen")


def count_like_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, is_count)``: whether any value looks like a count text, over all rows."""
    wide = df.agg(*[F.coalesce(F.max(F.col(c).rlike(COUNT_LIKE)), F.lit(False)).cast("int").alias(c) for c in columns])
    return unpivot(wide, columns, "column", "is_count")


def text_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string" and c not in S.NOT_FEATURES]


def number_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t != "string" and c not in S.NOT_FEATURES]


def finalize(
    train: DataFrame,
    test: DataFrame,
    categories: str = "code",
    fit_on: str = "train",
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Training-ready sides: shared columns, count texts as numbers, categories coded or kept, numbers imputed.

    ``fit_on='train'`` takes vocabulary and medians from train; ``fit_on='self'`` codes over both sides and
    imputes each side with its own medians.
    """
    from cohortlift.operators.clean import shared_columns

    keep = shared_columns(train, test)
    carried = [c for c in S.NOT_FEATURES if c in train.columns and c not in keep]
    left, right = train.select(*keep, *carried), test.select(*keep)
    texts = text_columns(left)
    kinds = {r["column"]: r["is_count"] for r in count_like_columns(left, texts).collect()} if texts else {}
    counts = [c for c in texts if kinds[c]]
    cats = [c for c in texts if not kinds[c]]

    def numbers(df: DataFrame) -> DataFrame:
        return df.select(*[X.count_from_digits(c).cast("double").alias(c) if c in counts else F.col(c) for c in df.columns])

    left, right = numbers(left), numbers(right)
    if categories == "string":
        def fill(df: DataFrame) -> DataFrame:
            return df.select(*[X.text_or(c, "NaN").alias(c) if c in cats else F.col(c) for c in df.columns])

        left, right = fill(left), fill(right)
    elif cats:
        vocab = fit_vocab(left, cats, right if fit_on == "self" else None, "missing")

        def code(df: DataFrame) -> DataFrame:
            coded = apply_vocab(df, vocab, cats, "missing", unseen="keep")
            return coded.select(*[F.col(f"{c}_code").alias(c) if c in cats else F.col(c) for c in df.columns])

        left, right = code(left), code(right)
    fill_columns = [c for c in number_columns(left) if c not in cats]
    medians = as_dict(fit_medians(left, fill_columns))
    right_medians = medians if fit_on == "train" else as_dict(fit_medians(right, fill_columns))
    return impute(left, medians, 0.0), impute(right, right_medians, 0.0), cats


def feature_sets(v3: Sequence[str], full: Sequence[str], encoded: Sequence[str]) -> dict[str, list[str]]:
    """Named feature lists over one feature table."""

    def usable(columns: Sequence[str]) -> list[str]:
        return [c for c in columns if c not in S.NOT_FEATURES]

    return {
        "v3": usable(v3),
        "v3_te": [c for c in usable(v3) if c != "period_code"] + list(encoded),
        "full": usable(full),
        "full_cat": usable(full),
    }
