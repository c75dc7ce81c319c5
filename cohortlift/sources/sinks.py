"""Writing submissions, feature tables and keyed predictions."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, is_dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlift import schema as S
from cohortlift.functions import scalars as X
from cohortlift.operators.evaluate import summary


def fill_template(template: DataFrame, preds: DataFrame, id: str = S.ID, p: str = "p") -> DataFrame:
    """The template with its first non-id column replaced by the clipped prediction of the id.

    One row per row of the template: an id that is predicted more than once takes the mean.  The write fails on an id
    without a prediction.
    """
    target = next(c for c in template.columns if c not in (id, *PLACE))
    scored = preds.groupBy(id).agg(X.clip01(F.avg(p)).alias("_p"))
    joined = template.join(scored, id, "left")
    lost = F.concat(F.lit("no prediction of id "), F.coalesce(F.col(id).cast("string"), F.lit("NULL")))
    joined = joined.withColumn("_p", F.coalesce("_p", F.raise_error(lost).cast("double")))
    return joined.select(*[F.col("_p").alias(c) if c == target else F.col(c) for c in template.columns])


PLACE = ("_file", "_block", "_row")


def read_template(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV template with the file and the place in it that its rows come from, which ``write_submission`` orders by."""
    rows = spark.read.schema(schema).option("header", True).csv(path)
    return rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def positioned(template: DataFrame) -> DataFrame:
    """The template with its rows' positions: file and place where they are known, and the order of the rows."""
    given = [F.lit(None).cast("long").alias(c) for c in PLACE[:2] if c not in template.columns]
    return template.select("*", *given).withColumn("_row", F.monotonically_increasing_id())


def submission_name(tag: str, auc: float, at: datetime | None = None) -> str:
    return f"submission_{tag}_AUC{auc:.5f}_{(at or datetime.now()):%m%d_%H%M}"


def write_submission(
    template: DataFrame, preds: DataFrame, folder: str, auc: float, tag: str = "ensemble", id: str = S.ID
) -> tuple[str, DataFrame]:
    """Write the filled template as CSV and return its path and its count, mean and deviation.

    The part files, in the order of their names, hold the rows in the order of the template.
    """
    path = f"{folder}/{submission_name(tag, auc)}"
    names = [c for c in template.columns if c not in PLACE]
    target = next(c for c in names if c != id)
    ordered = fill_template(positioned(template), preds, id).repartitionByRange(*PLACE).sortWithinPartitions(*PLACE).select(*names)
    ordered.write.mode("overwrite").option("header", True).csv(path)
    written = template.sparkSession.read.schema(ordered.schema).option("header", True).csv(path)
    return path, summary(written, p=target)


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Feature table with its id and target."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None, id: str = S.ID) -> dict[str, str]:
    """What each column holds, as a short text per column, whatever the order and partitioning of the rows.

    One aggregate with a row per column: the rows' number, and the exclusive or and a sum of hashes of (id, value).  Neither
    grows with the table nor overflows; a changed cell changes the text of its column alone.
    """
    names = list(columns) if columns is not None else [c for c in df.columns if c != id]
    key = F.xxhash64(F.col(id).cast("string"))
    hashes = df.select(key.alias("_key"), *[F.col(f"`{c}`") for c in names]).select(
        F.posexplode(F.array(*[F.xxhash64("_key", F.col(f"`{c}`")) for c in names])).alias("at", "h")
    )
    marks = hashes.groupBy("at").agg(F.count("*"), F.bit_xor("h"), F.sum(F.col("h").bitwiseAND(F.lit((1 << 24) - 1)))).collect()
    found = {r[0]: ":".join(str(x) for x in r[1:]) for r in marks}
    return {c: found.get(i, "0") for i, c in enumerate(names)}


def config_hash(config: object) -> str:
    """Stable hash of everything that decides the predictions."""
    body = asdict(config) if is_dataclass(config) else config
    return hashlib.sha256(json.dumps(body, sort_keys=True, default=str).encode()).hexdigest()[:16]


def _marker(root: str, config: object, part: str) -> str:
    return f"{root}/{config_hash(config)}/{part}/current"


def save_predictions(parts: Mapping[str, DataFrame], root: str, config: object) -> None:
    """Write ``oof`` / ``test`` predictions, or other parts, under the hash of their configuration.

    Each write takes a new folder; a marker that names it is replaced last, so a run that is lost half-way
    leaves the former predictions in place.
    """
    for part, df in parts.items():
        path = f"{root}/{config_hash(config)}/{part}/{uuid.uuid4().hex}"
        df.write.partitionBy(*[c for c in ("model", "seed") if c in df.columns]).parquet(path)
        line = json.dumps({"path": path, "schema": df.schema.jsonValue()})
        df.sparkSession.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(
            _marker(root, config, part)
        )


def load_predictions(spark: SparkSession, root: str, config: object, part: str) -> DataFrame | None:
    """Stored predictions of exactly this configuration, or None."""
    try:
        line = spark.read.text(_marker(root, config, part)).first()
    except AnalysisException:
        return None
    if line is None:
        return None
    found = json.loads(line[0])
    return spark.read.schema(T.StructType.fromJson(found["schema"])).parquet(found["path"])


def stored(
    spark: SparkSession,
    root: str,
    config: object,
    build: Callable[[], Mapping[str, DataFrame]],
    recompute: bool = False,
    parts: Sequence[str] = ("oof", "test"),
) -> dict[str, DataFrame]:
    """Predictions from the store, built and written when absent or when ``recompute`` is set."""
    found = {part: load_predictions(spark, root, config, part) for part in parts}
    if recompute or any(df is None for df in found.values()):
        save_predictions(build(), root, config)
        found = {part: load_predictions(spark, root, config, part) for part in parts}
    return found
