"""Mixing of sources to target weights.

The words of a source, its documents in pseudorandom order, are packed into blocks of fixed length.  Every output shard draws
how many of its slots each source fills, by a multinomial of the sources' quotas; what the draws of all shards give a source
beyond its quota goes to the sources below theirs.  The r-th slot of a source takes the block at place r of a pseudorandom
permutation of the source's block numbers, with another permutation for each pass, and blocks are joined by number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cohortlift.functions.ranking import running_total
from cohortlift.llm.scratch import lean
from cohortlift.session import materialise

BLOCK_WORDS, SHARD_SLOTS, BUCKET_ROWS, SHARE, PASSES, WEIGHTS, SEED = 128, 8192, 20_000, 1.5, 2, (5.0, 2.0, 1.0), 11
_WORD = r"[^\x20\x09-\x0D]+"
_WORDS = re.compile(_WORD)


def with_sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, keep_text: bool = False) -> DataFrame:
    """``(doc_id, source, size)`` and the document's place ``start`` in its source's words; ``text`` too, if wanted.

    The order in a source follows a hash of the row, and buckets of the hash keep each window's rows few.
    """
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"),
        *([text.alias("text")] if keep_text else []),
    )
    order = ["doc_id", "size", *(["_text"] if keep_text else [])]
    buckets = max(16, -(-docs.count() // BUCKET_ROWS))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(buckets)).cast("int"))
    if keep_text:
        rows = rows.withColumn("_text", F.xxhash64("text"))
    return running_total(rows, ["source"], "_bucket", order, F.col("size"), "start").drop("_bucket", "_text")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: float = PASSES) -> DataFrame:
    """``(source, source_size, weight, target)``: weights repeat over the sources by code point, null last.

    Targets share ``share`` times all words by weight and stop at ``passes`` times their source's words; what is beyond
    is shared again by weight among the others until none is above.  One row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by = materialise(by.select("*", weight.alias("weight"), (F.col("source_size") * float(passes)).alias("most")), "sources")
    total = by.agg(F.sum("source_size")).first()[0] or 0
    rate = full = 0.0
    while True:
        # Sources whose share at this rate is above their limit are filled to it; the rate of the others rises.
        held = F.col("weight") * rate >= F.col("most")
        filled, open_weight = by.agg(F.sum(F.when(held, F.col("most")).otherwise(0.0)), F.sum(F.when(held, 0.0).otherwise(F.col("weight")))).first()
        if not open_weight or (rate and filled == full):
            break
        full, rate = filled, max(rate, (share * total - filled) / open_weight)
        if not total:
            break
    return by.select("source", "source_size", "weight", F.least(F.col("weight") * rate, F.col("most")).alias("target"))


def _permuted(r: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place ``r`` of a keyed permutation of 0 to n-1: a four-round Feistel network that is walked until it lands inside."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = r.astype(np.uint64), np.arange(len(r))
    keys, limit = key.astype(np.int64).view(np.uint64), n.astype(np.uint64)
    while len(todo):
        h, m, k = half[todo], mask[todo], keys[todo]
        left, right = out[todo] >> h, out[todo] & m
        for step in range(4):
            x = (right + k) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((step + 1) * 0xD6E8FEB86659FD93 % (1 << 64))
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(29)
            left, right = right, left ^ (x & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= limit[todo]]
    return out.astype(np.int64)


@F.pandas_udf(LongType())
def permuted(r: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(_permuted(r.to_numpy(), n.to_numpy(), key.to_numpy()))


def _draw(batches: Iterator[pd.DataFrame], quotas: list[int], slots: int, seed: int) -> Iterator[pd.DataFrame]:
    """Multinomial counts of each shard; the last shard has what slots are left."""
    total = sum(quotas)
    p = np.array(quotas, float) / total
    for batch in batches:
        for shard in batch["id"]:
            n = min(slots, total - shard * slots)
            counts = np.random.default_rng((seed, int(shard))).multinomial(n, p)
            some = np.flatnonzero(counts)
            yield pd.DataFrame({"shard": shard, "k": some, "n": counts[some]})


def draw_slots(sources: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """``(shard, slot, source, pass_no, block)`` of every output slot; ``sources`` is what ``targets`` returns.

    One row per source reaches the driver, as the quotas are the multinomial's parameter.
    """
    spark = sources.sparkSession
    rows = sources.where("source_size > 0").orderBy(F.col("source").isNull(), "source").collect()
    blocks = [-(-r["source_size"] // block_words) for r in rows]
    quotas = [round(r["target"] * b / r["source_size"]) for r, b in zip(rows, blocks)]
    schema = "shard long, slot long, source string, pass_no long, block long"
    if not sum(quotas):
        return spark.createDataFrame([], schema)
    shards = -(-sum(quotas) // shard_slots)
    draw = partial(_draw, quotas=quotas, slots=shard_slots, seed=seed)
    drawn = materialise(spark.range(shards).mapInPandas(draw, "shard long, k long, n long"), "draws")
    before = Window.partitionBy("k").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n").over(before), F.lit(0))
    drawn = drawn.withColumn("own", own)
    drawn = drawn.select("shard", "k", F.explode(F.sequence(F.col("own"), F.col("own") + F.col("n") - 1)).alias("r"))
    got = dict(drawn.groupBy("k").agg(F.count("*")).collect())
    # The over-full sources' last slots go to the sources with too few, one by one in order.
    info, surplus, lack = [], 0, []
    for k, quota in enumerate(quotas):
        info.append((k, quota, surplus, blocks[k], rows[k]["source"]))
        surplus += max(0, got.get(k, 0) - quota)
        if quota > got.get(k, 0):
            lack.append((k, got.get(k, 0), quota))
    table = spark.createDataFrame(info, "k long, quota long, first long, blocks long, source string")
    slots = drawn.join(F.broadcast(table.select("k", "quota", "first")), "k")
    slots = slots.withColumn("g", F.when(F.col("r") >= F.col("quota"), F.col("first") + F.col("r") - F.col("quota")))
    sure = slots.where("g IS NULL").select("shard", "k", "r")
    if lack:
        short = spark.createDataFrame(lack, "k long, got long, quota long")
        start = F.coalesce(F.sum(F.col("quota") - F.col("got")).over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        short = short.withColumn("start", start)
        short = short.select("k", "start", F.posexplode(F.sequence(F.col("got"), F.col("quota") - 1)).alias("j", "r"))
        short = short.select((F.col("start") + F.col("j")).alias("g"), "k", "r")
        sure = sure.union(slots.where("g IS NOT NULL").select("shard", "g").join(short, "g").select("shard", "k", "r"))
    in_shard = Window.partitionBy("shard").orderBy(F.xxhash64("shard", "k", "r"), "k", "r")
    out = sure.join(F.broadcast(table.select("k", "blocks", "source")), "k")
    pass_no = F.floor(F.col("r") / F.col("blocks"))
    key = F.xxhash64(F.lit(seed), "k", pass_no)
    return out.select(
        "shard", (F.row_number().over(in_shard) - 1).cast("long").alias("slot"), "source", pass_no.cast("long").alias("pass_no"),
        permuted(F.pmod("r", "blocks"), F.col("blocks"), key).alias("block"),
    )


def pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """Adds to each row of ``with_sizes`` the blocks it reaches: ``block``, ``at`` (its first word there), ``words``."""
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    out = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return out.withColumn("at", low - F.col("start")).withColumn("words", high - low)


_PIECES = "source string, block long, start long, doc_id long, words long, text string"


def _cut(batches: Iterator[pa.RecordBatch], block_words: int) -> Iterator[pa.RecordBatch]:
    """The words of each document, by the block that they fall into."""
    names = ["source", "block", "start", "doc_id", "words", "text"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        rows = []
        for doc_id, source, start, text in zip(*(c.to_pylist() for c in batch.columns)):
            words, at = _WORDS.findall(text), 0
            while at < len(words):
                block = (start + at) // block_words
                n = min(len(words), (block + 1) * block_words - start) - at
                rows.append((source, block, start, doc_id, n, " ".join(words[at : at + n])))
                at += n
            if len(rows) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def taken_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)``, a row per row of ``docs``: the words that the mix takes of it."""
    placed = materialise(with_sizes(docs, id_col, text_col, source_col), "placed")
    sources = materialise(targets(placed), "targets")
    times = draw_slots(sources, block_words, shard_slots, seed).groupBy("source", "block").agg(F.count("*").alias("times"))
    part = pieces(placed, block_words).select("source", "start", "block", "words").alias("p")
    times = times.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "times")
    used = part.join(times, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
    used = used.groupBy(F.col("source").alias("_s"), F.col("start").alias("_at")).agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = placed.join(used, F.col("source").eqNullSafe(F.col("_s")) & (F.col("start") == F.col("_at")) & (F.col("size") > 0), "left")
    out = out.select("doc_id", "source", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    small = sources.select(F.col("source").alias("_s"), "source_size", "target")
    out = out.join(small, F.col("source").eqNullSafe(F.col("_s")), "left")
    return out.select(F.col("doc_id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED,
) -> DataFrame:
    """The mix: ``(shard, slot, source, pass_no, block, n_words, doc_ids, text)``, a row per output slot.

    Words are runs without blanks; a text that is null or has none gives nothing.  A null source is a source.  Repeated
    rows are documents of their own.  Same input, same mix.  Other columns are not looked at.
    """
    placed = with_sizes(docs, id_col, text_col, source_col, keep_text=True)
    sources = materialise(targets(with_sizes(docs, id_col, text_col, source_col)), "targets")
    slots = draw_slots(sources, block_words, shard_slots, seed).select("source", "block", F.struct("shard", "slot", "pass_no").alias("slot"))
    cut = placed.where("size > 0").select("doc_id", "source", "start", "text").mapInArrow(lean(_cut, block_words=block_words), _PIECES)
    part = cut.select("source", "block", F.struct("start", "doc_id", "words", "text").alias("piece"))
    # Pieces and slots of a block meet in one grouping; a block has block_words pieces and PASSES + 1 slots at most.
    both = part.unionByName(slots, allowMissingColumns=True).groupBy("source", "block")
    packed = both.agg(F.sort_array(F.collect_list("piece")).alias("p"), F.collect_list("slot").alias("slots"))
    return packed.select(
        F.explode("slots").alias("s"), "source", "block", F.aggregate("p.words", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_words"),
        F.col("p.doc_id").alias("doc_ids"), F.array_join("p.text", " ").alias("text"),
    ).select("s.shard", "s.slot", F.col("source").alias(source_col), "s.pass_no", "block", "n_words", "doc_ids", "text")
