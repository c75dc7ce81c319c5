"""A corpus pipeline over ``documents``: every stage reads what the stage before it has kept.

Each function takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlift.llm.jaccard import jaccard_join
from cohortlift.llm.lines import remove_boilerplate
from cohortlift.llm.mixing import mix
from cohortlift.llm.scratch import free
from cohortlift.llm.tiling import contaminated, tilings
from cohortlift.llm.toxicity import with_toxicity
from cohortlift.session import scratch_path


TOXIC = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score TOXIC or more go.  A null or empty text scores as a clean one; every row is looked at by itself."""
    (score,) = free(docs.columns, "_toxicity")
    scored = with_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), out=score)
    return scored.where(F.col(score) < TOXIC).drop(score)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, but for their first occurrence; every document stays, and ``n_chars`` follows its text.

    Null texts, sources and ids are treated as ``remove_boilerplate`` says.
    """
    lines, removed = free(docs.columns, "_lines", "_removed")
    cleaned = remove_boilerplate(docs, lines_out=lines, removed_out=removed)
    length = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length.cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose five-word shingles are similar by 0.8 or more, directly or over others, the smallest id stays.

    Documents without words stay, and so do rows without id, which no link names; rows of one id stay or go together.
    """
    (gone,) = free(docs.columns, "_gone")
    found = jaccard_join(docs, n=5, num=4, den=5)
    others = found.where("component_id <> doc_id").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(others, docs["doc_id"] == others[gone], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tiles cover half of a benchmark item or more go.

    Documents without words stay, and so do rows without id, which no match names; rows of one id stay or go together.
    """
    (hit_,) = free(docs.columns, "_hit")
    found = contaminated(tilings(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
    hit = found.select(F.col("doc_id").alias(hit_)).distinct()
    return docs.join(hit, docs["doc_id"] == hit[hit_], "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: a row per slot of an output shard, with the block's text and its documents."""
    return mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# No stage but the plainest has an equivalent in SQL; the tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages; each result but the last is written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
