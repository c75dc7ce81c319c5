"""Connected components by alternating large-star and small-star steps; every step is a join and a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlift.llm.scratch import discard, table


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node but the roots; the root is the smallest node that links reach.

    Rows with a null end or equal ends link nothing.  Only sums of the link table reach the driver.
    """
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    links = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    links = table(links.select(high.alias("u"), low.alias("v")).distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, links = links, table(near.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(old)
        before, state = state, _state(links)
        if state == before:
            break
    found = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found._scratch = links._scratch
    return found
