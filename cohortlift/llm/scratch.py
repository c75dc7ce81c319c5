"""Intermediate tables that go as soon as nothing reads them any more, and tasks that hand their memory back."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlift.session import scratch_path


def table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._scratch = path
    return found


def discard(found: DataFrame, part: str = "") -> None:
    """Delete what ``table`` has written, or one part of it; no later step may read it."""
    jvm, spark = found.sparkSession._jvm, found.sparkSession
    path = jvm.org.apache.hadoop.fs.Path(f"{found._scratch}/{part}" if part else found._scratch)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def release(found: DataFrame) -> None:
    """Let Spark delete the shuffle files of results that nothing refers to any more.  It does so when the driver collects
    garbage, which a driver with little to do puts off for long.  Its listeners hold on to the last query that has ended,
    so an empty one goes first."""
    gc.collect()
    found.sparkSession.sql("SELECT 1").collect()
    found.sparkSession._jvm.System.gc()


def free(columns: Sequence[str], *names: str) -> list[str]:
    """``names`` with as many underscores in front that no column has one of them, whatever its case."""
    taken, mark = {c.lower() for c in columns}, ""
    while any((mark + n).lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def _lean(batches: Iterator[pa.RecordBatch], f: Callable, more: dict) -> Iterator[pa.RecordBatch]:
    try:
        yield from f(batches, **more)
    finally:
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # another C library keeps what it keeps


def lean(f: Callable, **more) -> Callable:
    """A task of ``f`` whose worker, which Spark keeps for other tasks, gives freed memory back to the system at its end."""
    return partial(_lean, f=f, more=more)
