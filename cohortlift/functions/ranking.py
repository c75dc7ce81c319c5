"""Order statistics without a global sort in one task.

Rows get a bucket that is monotone in the order; bucket totals form a small table whose running sum is
the offset of each bucket, and only the rows of one bucket are ordered together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.functions.scalars import num

N_BUCKETS = 1024
BUCKET_VALUES, MOST_BUCKETS = 65_536, 65_536


def buckets_for(values: int) -> int:
    """As many buckets as leave about BUCKET_VALUES values in each; MOST_BUCKETS at most, as their edges go to the driver."""
    return max(1, min(MOST_BUCKETS, -(-values // BUCKET_VALUES)))


def quantile_buckets(
    df: DataFrame, columns: dict[str, str], n: int = N_BUCKETS, fit_on: DataFrame | None = None
) -> DataFrame:
    """Add a bucket per column (``{column: bucket name}``), cut at approximate quantiles of ``fit_on``.

    The driver receives at most ``n`` edges per column.  Equal values share a bucket.
    """
    names = list(columns)
    if n <= 1:
        return df.select("*", *[F.lit(0).alias(b) for b in columns.values()])
    probabilities = [i / n for i in range(1, n)]
    edges = (df if fit_on is None else fit_on).approxQuantile(names, probabilities, 1.0 / (2 * n))
    out = df
    for c, found in zip(names, edges):
        splits = [-float("inf"), *sorted({float(e) for e in found}), float("inf")]
        if len(splits) < 3:
            out = out.withColumn(columns[c], F.lit(0))
            continue
        raw = f"_{columns[c]}_raw"
        out = Bucketizer(splits=splits, inputCol=c, outputCol=raw, handleInvalid="keep").transform(out)
        out = out.withColumn(columns[c], F.col(raw).cast("int")).drop(raw)
    return out


def hash_bucket(key: Column, digits: int = 3) -> Column:
    """Leading hex digits of a hash text: even buckets whatever the data holds."""
    return F.substring(key, 1, digits)


def running_total(
    df: DataFrame, by: Sequence[str], bucket: str, order: Sequence[str], weight: Column, out: str
) -> DataFrame:
    """Total ``weight`` of the rows that come before each row within ``by``, where NULL is a group.

    The rows are already partitioned by (by, bucket) for the inner window, so joining the offsets
    moves only the offsets.
    """
    groups = [f"_by{i}" for i in range(len(by))]
    named = df.select(
        "*",
        *[
            # a text that is never NULL, so that plain equality finds the group of NULL
            F.when(F.col(c).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(c).cast("string"))).alias(g)
            for c, g in zip(by, groups)
        ],
    )
    inner = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        named.groupBy(*groups, bucket)
        .agg(F.sum(weight).alias("_bucket_total"))
        .select(*groups, bucket, F.coalesce(F.sum("_bucket_total").over(before), F.lit(0)).alias("_offset"))
    )
    ranked = named.withColumn("_inside", F.coalesce(F.sum(weight).over(inner), F.lit(0)))
    return (
        ranked.join(offsets, [*groups, bucket])
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .drop("_inside", "_offset", *groups)
    )


MOST_VALUES, CUTS = 4096, 255


def exact_values(
    df: DataFrame, columns: Sequence[str], ranks: Callable[[int], Sequence[int]], most: int = MOST_VALUES, cuts: int = CUTS
) -> dict[str, tuple[int, dict[int, float]]]:
    """Per column its number of values and the values at ``ranks(number)`` (0-based, in ascending order); exact.

    Each round cuts the ranges that hold wanted ranks at approximate quantiles and counts, in one pass for all of them, the
    values at every cut and between two cuts.  A rank at a cut is answered; one between two cuts has a range with about
    1/``cuts`` of the rows left.  A range of at most ``most`` rows is read as it is.  So the driver receives ``cuts`` numbers or
    ``most`` values per range and round, no task orders more than that, and repeated values end at a cut.
    """
    wide = df.select(*[num(c).alias(c) for c in columns])
    sizes = wide.agg(*[F.count(c).alias(c) for c in columns]).first()
    found: dict[str, tuple[int, dict[int, float]]] = {c: (sizes[c], {}) for c in columns}
    # wanted ranks by range (column, above, below), with the rows before the range and in it
    ranges = {(c, None, None): (0, sizes[c], sorted(set(ranks(sizes[c])))) for c in columns if sizes[c]}
    while ranges:
        keys = list(ranges)
        inside = wide.select(*[_between(*key).alias(f"r{i}") for i, key in enumerate(keys)])
        small = [i for i, key in enumerate(keys) if ranges[key][1] <= most]
        large = [i for i in range(len(keys)) if i not in small]
        following = {}
        if small:
            pairs = F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"r{i}").alias("v")) for i in small])
            counts = inside.select(F.inline(pairs)).where("v IS NOT NULL").groupBy("at", "v").agg(F.count("*").alias("n")).collect()
            for i in small:
                at, _, wanted = ranges[keys[i]]
                for v, n in sorted((r["v"], r["n"]) for r in counts if r["at"] == i):
                    found[keys[i][0]][1].update({k: v for k in wanted if at <= k < at + n})
                    at += n
        if large:
            names = [f"r{i}" for i in large]
            edges = inside.approxQuantile(names, [j / (cuts + 1) for j in range(1, cuts + 1)], 1.0 / (2 * cuts))
            edges = {i: sorted(set(e)) for i, e in zip(large, edges)}
            placed = inside
            for i in large:
                splits = [-float("inf"), *[e for e in edges[i] if e not in (-float("inf"), float("inf"))], float("inf")]
                raw = Bucketizer(splits=splits, inputCol=f"r{i}", outputCol=f"b{i}", handleInvalid="keep") if len(splits) > 2 else None
                placed = raw.transform(placed) if raw else placed.withColumn(f"b{i}", F.lit(0.0))
                edges[i] = splits
            pairs = F.array(*[
                F.struct(F.lit(i).alias("at"), F.col(f"b{i}").cast("int").alias("b"), (F.col(f"r{i}") > F.get(F.lit(edges[i]), F.col(f"b{i}").cast("int"))).alias("over"))
                for i in large
            ])
            kept = placed.select(F.inline(pairs)).where("over IS NOT NULL")
            counts = kept.groupBy("at", "b", "over").agg(F.count("*").alias("n")).collect()
            for i in large:
                column, above, below = keys[i]
                at, size, wanted = ranges[keys[i]]
                for r in sorted((r for r in counts if r["at"] == i), key=lambda r: (r["b"], r["over"])):
                    own, low = [k for k in wanted if at <= k < at + r["n"]], edges[i][r["b"]]
                    if own and not r["over"]:
                        found[column][1].update(dict.fromkeys(own, low))
                    elif own:
                        high = edges[i][r["b"] + 1]
                        key = (column, above if low == -float("inf") else low, below if high == float("inf") else high)
                        following[key] = (at, r["n"], own)
                    at += r["n"]
        ranges = following
    return found


def _between(column: str, above: float | None, below: float | None) -> Column:
    held = F.lit(True)
    if above is not None:
        held = held & (F.col(column) > above)
    if below is not None:
        held = held & (F.col(column) < below)
    return F.when(held, F.col(column))


def exact_medians(df: DataFrame, columns: Sequence[str], most: int = MOST_VALUES) -> DataFrame:
    """Exact interpolated median of each column as ``(column, median)``; NULL for a column without values."""
    found = exact_values(df, columns, lambda n: (((n - 1) // 2), n // 2), most)
    rows = [(c, (values[(n - 1) // 2] + values[n // 2]) / 2 if n else None) for c, (n, values) in found.items()]
    return df.sparkSession.createDataFrame(rows, "column string, median double")


def dense_codes(values: DataFrame, by: str, value: str, out: str) -> DataFrame:
    """0-based position of each distinct ``value`` in sorted order within ``by``.

    A distributed sort is checkpointed, and the position is taken from (partition, row in partition) plus offsets.
    """
    from cohortlift.session import shared_dir

    shared_dir(values.sparkSession)
    ordered = values.sort(by, value).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    ordered = ordered.withColumn("_part", F.shiftright("_id", 33)).withColumn(
        "_row", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = ordered.groupBy("_part", by).agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sort partition and group.
    offsets = sizes.select(
        "_part", by, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        ordered.join(F.broadcast(offsets), ["_part", by])
        .withColumn(out, (F.col("_offset") + F.col("_row") - F.col("_first")).cast("int"))
        .drop("_id", "_part", "_row", "_first", "_offset")
    )
