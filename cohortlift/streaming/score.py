"""Incremental cleaning and feature derivation: the batch functions on a file stream, without state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_stream(df: DataFrame, path: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Append every file that is there now, then stop; files seen before are not read again."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start(path)


def run_available(source: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> DataFrame:
    """Transform what has arrived and return the table written so far."""
    out = transform(source)
    write_stream(out, path, checkpoint).awaitTermination()
    return source.sparkSession.read.schema(out.schema).parquet(path)
