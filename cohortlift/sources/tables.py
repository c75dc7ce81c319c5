"""Reading cycle tables: explicit schemas, sampled inference with a conflict report, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlift import schema as S

CORRUPT = "_corrupt_record"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    header: str = "name",
    with_target: bool = True,
) -> DataFrame:
    """Whole-file read.  CSV takes an explicit schema, by default the registry's, and comes back with ASCII names.

    A path that does not exist raises.
    """
    if fmt == "parquet":
        return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}")
    schema = schema or S.spark_schema(header, with_target)
    return to_names(spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows over all cores when the input has fewer partitions than cores, as one small file has.

    An input that already fills the cluster is not moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def to_names(df: DataFrame) -> DataFrame:
    """Source headers to ASCII names; other columns stay."""
    names = {c.source: c.name for c in S.COLUMNS}
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def to_headers(df: DataFrame) -> DataFrame:
    """ASCII names to source headers; other columns stay."""
    headers = {c.name: c.source for c in S.COLUMNS}
    return df.select(*[F.col(f"`{c}`").alias(headers.get(c, c)) for c in df.columns])


def sample_schema(spark: SparkSession, path: str, rows: int = 200, keep_text: tuple[str, ...] = ("ID", S.ID)) -> T.StructType:
    """Types from the first ``rows`` lines: double where every value is a number, else string."""
    sample = spark.read.option("header", True).csv(path).limit(rows)
    numeric = sample.agg(
        *[F.coalesce(F.bool_and(F.col(f"`{c}`").try_cast("double").isNotNull() | F.col(f"`{c}`").isNull()), F.lit(True)).alias(c) for c in sample.columns]
    ).first()
    return T.StructType(
        [
            T.StructField(c, T.DoubleType() if numeric[c] and c not in keep_text else T.StringType())
            for c in sample.columns
        ]
    )


def read_reporting(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV read that keeps the text of a line that does not fit the schema in ``_corrupt_record``."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(wide)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def split_rejected(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV table that fit ``schema``, and ``(file, reason, columns, line)`` of the lines that do not.

    The reason is ``quotes`` (a quote is left open), ``width`` (too few or too many fields) or ``type``, for which ``columns``
    names the fields whose text is no value of their type.  Lines that repeat the first line of the table are headers; a field
    holds no line break.
    """
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"))
    header = lines.first()
    if header is not None:
        lines = lines.where(F.col("line") != header["line"])
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    line, count = F.col("line"), len(schema.fields)
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    width = F.size(F.split(F.regexp_replace(line, r'"[^"]*"', ""), ","))  # commas outside of quotes
    read = lines.select("file", "line", F.from_csv(line, wide.toDDL(), options).alias("row"))
    reason = F.when(quotes % 2 == 1, "quotes").when(width != count, "width").when(F.col("row")[CORRUPT].isNotNull(), "type")
    read = read.withColumn("reason", reason)
    good = read.where("reason IS NULL").select(*[F.col("row")[f.name].alias(f.name) for f in schema.fields])
    fields = F.from_csv(line, ", ".join(f"c{i} STRING" for i in range(count)))
    wrong = F.array_compact(
        F.array(*[
            F.when(fields[f"c{i}"].isNotNull() & fields[f"c{i}"].try_cast(f.dataType).isNull(), F.lit(f.name)) for i, f in enumerate(schema.fields)
        ])
    )
    bad = read.where("reason IS NOT NULL").select("file", "reason", F.when(F.col("reason") == "type", wrong).alias("columns"), "line")
    return good, bad


def conflicts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``(column, type, n_conflict)``: values of the whole file that do not fit the type."""
    text = spark.read.option("header", True).csv(path)
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    counts = text.agg(
        *[
            F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(kinds[c]).isNull()).alias(c)
            for c in text.columns
        ]
    )
    long = counts.unpivot([], text.columns, "column", "n_conflict")
    kind = F.create_map(*[F.lit(x) for item in kinds.items() for x in item])
    return long.select("column", kind[F.col("column")].alias("type"), "n_conflict")


def stream_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """File-source stream with an explicit schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
