"""Hard negatives by slots of scores.

The scores of an anchor's positives, from the highest down, are upper limits of overlapping windows.  They cut the scores
into disjoint slots: slot i lies at or below limit i and above limit i + 1.  Every block of candidates keeps the k best
negatives of each slot, a window over the blocks merges them, and as slots are disjoint and in order, the k best at or below
limit i are the first k of slots i, i + 1, ... merged from the top: no window is searched by itself.

Candidates are dealt to blocks by a hash of their id and stay there; anchors, which are few, go to every block.  A task
holds one block and a handful of anchors at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.llm import scratch
from cohortlift.llm.scratch import lean
from cohortlift.llm.vectors import by_width, packed, products

K_POSITIVE, K_NEGATIVE, FLOOR, CEILING, SCALE = 5, 5, 80, 100, 256
BLOCKS, BLOCK_ROWS, ANCHORS = 24, 65_536, 64


class Block:
    """Candidates of one block, rows that repeat another in every part taken once, by length of vector."""

    def __init__(self, rows: list[tuple[int, object, bytes]]):
        rows = list(dict.fromkeys(rows))
        self.parts = {}
        for width, (at, matrix) in by_width([r[2] for r in rows]).items():
            ids = np.array([rows[i][0] for i in at], np.int64)
            order = np.argsort(ids, kind="stable")
            labels = np.array([rows[i][1] for i in at], np.int64)
            self.parts[width] = ids[order], labels[order], matrix[order]

    def scores(self, anchors: list[tuple]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, ids, labels, scores) of each anchor and the candidates of its length, in order of their ids."""
        for width, (at, queries) in by_width([a[3] for a in anchors]).items():
            if width in self.parts:
                ids, labels, matrix = self.parts[width]
                for i, row in zip(at, products(queries, matrix)):
                    yield anchors[i], ids, labels, row


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, equal ones in their order."""
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= bar)
    else:
        some = np.arange(len(scores))
    return some[np.argsort(-scores[some], kind="stable")][:k]


def window(limit: int, floor: int, ceiling: int) -> tuple[int, int]:
    """Lowest and highest integer score s with floor * limit <= 100 * s <= ceiling * limit."""
    return -(-floor * limit // 100), min(ceiling * limit // 100, (1 << 63) - 1)


def positives(block: Block, anchors: list[tuple], k: int) -> Iterator[tuple]:
    """(anchor's key, positive's id, score): the k best of the anchor's label in the block."""
    for (key, vec_id, label, *_), ids, labels, scores in block.scores(anchors):
        own = np.flatnonzero((labels == label) & (ids != vec_id))
        for i in own[best(scores[own], k)].tolist():
            yield key, int(ids[i]), int(scores[i])


def negatives(block: Block, anchors: list[tuple], k: int, floor: int, ceiling: int) -> Iterator[tuple]:
    """(anchor's key, slot, negative's id, score): the k best of each slot in the block, of those that some window holds."""
    for (key, vec_id, label, _, limits), ids, labels, scores in block.scores(anchors):
        ends = [window(p, floor, ceiling) for p in limits]
        ends = sorted({e for e in ends if e[0] <= e[1]}, key=lambda e: -e[1])
        if not ends:
            continue
        uppers = np.array(sorted({e[1] for e in ends}), np.int64)  # ascending
        wanted = np.flatnonzero((labels != label) & (ids != vec_id) & (scores >= min(e[0] for e in ends)) & (scores <= uppers[-1]))
        slots = len(uppers) - 1 - np.searchsorted(uppers, scores[wanted])  # 0 holds the highest scores
        for slot in np.unique(slots).tolist():
            own = wanted[slots == slot]
            for i in own[best(scores[own], k)].tolist():
                yield key, slot, int(ids[i]), int(scores[i])


def _meet(batches: Iterator[pa.RecordBatch], search: Callable, schema: pa.Schema, at_once: int) -> Iterator[pa.RecordBatch]:
    """``search`` of each block (its candidates, kind 0, come first) with its anchors, a handful at a time."""
    number, rows, block, waiting = None, [], None, []

    def found() -> Iterator[pa.RecordBatch]:
        out = list(search(block, waiting)) if waiting and block is not None else []
        waiting.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    for batch in batches:
        for c, kind, key, vec_id, label, v, limits in zip(*(x.to_pylist() for x in batch.columns)):
            if c != number:
                yield from found()
                number, rows, block = c, [], None
            if kind == 0:
                rows.append((vec_id, label, v))
                continue
            if block is None:
                block, rows = Block(rows), []
            waiting.append((key, vec_id, label, v, limits))
            if len(waiting) >= at_once:
                yield from found()
    yield from found()


def _all_blocks(rows: DataFrame, anchors: DataFrame, n: int, search: Callable, schema: str, fields: pa.Schema, at_once: int) -> DataFrame:
    """What ``search`` finds in each of ``n`` blocks of ``rows`` for all ``anchors`` (key, vec_id, label, v, limits)."""
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    none = F.lit(None)
    met = rows.select(
        block.alias("c"), F.lit(0).alias("kind"), none.cast("long").alias("key"), "vec_id", "label", "v", none.cast("array<bigint>").alias("limits")
    ).union(anchors.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("c"), F.lit(1).alias("kind"), "key", "vec_id", "label", "v", "limits"))
    met = met.repartition(n, "c").sortWithinPartitions("c", "kind")
    return met.mapInArrow(lean(_meet, search=search, schema=fields, at_once=at_once), schema)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: str | Column = "label",
    k_positive: int = K_POSITIVE,
    k_negative: int = K_NEGATIVE,
    floor: int = FLOOR,
    ceiling: int = CEILING,
    scale: int = SCALE,
    blocks: int = BLOCKS,
    block_rows: int = BLOCK_ROWS,
    at_once: int = ANCHORS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows that ``is_anchor``, a condition on ``vec_id``; ``label`` names or makes an integer.  Components become
    floor(``scale`` * x), scores are inner products with the anchor, higher ones first and ties by the smaller id.  For each of
    an anchor's ``k_positive`` best rows of its label: the ``k_negative`` best rows of other labels whose score lies between
    ``floor`` and ``ceiling`` percent of the positive's (no row where the positive's score is below zero, as nothing does).

    Rows without id, label or vector, with an empty vector or with a component that is null or not finite take no part; nor do
    vectors with ``length * largest**2 >= 2^63`` after scaling, whose scores might not fit a long.  Vectors meet those of their
    length.  Rows that repeat id, label and vector are taken once; an anchor never meets rows of its own id; rows of one id
    with other labels or vectors are rows, and anchors, of their own.  Tables without rows or anchors give no rows.  Other
    columns are not looked at.
    """
    source = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), F.col(vector_col).alias("e")
    )
    rows = scratch.table(source.mapInArrow(lean(packed, scale=scale), "vec_id long, label long, v binary"), "vectors")
    n = max(blocks, -(-rows.count() // block_rows))
    anchors = rows.where(is_anchor).distinct().select(F.xxhash64("vec_id", "label", "v").alias("key"), "vec_id", "label", "v")
    bare = anchors.withColumn("limits", F.lit(None).cast("array<bigint>"))

    def keep(k: int):
        return lambda block, some: positives(block, some, k)

    fields = [("key", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())]
    near = _all_blocks(rows, bare, n, keep(k_positive), "key long, positive_id long, positive_score long", pa.schema(fields), at_once)
    order = Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k_positive)
    near = scratch.table(
        near.groupBy("key").agg(F.collect_list(F.struct("positive_score", "positive_id")).alias("positives")), "positives"
    )

    limited = anchors.join(near, "key").withColumn("limits", F.col("positives.positive_score")).drop("positives")
    fields = [("key", pa.int64()), ("slot", pa.int64()), ("negative_id", pa.int64()), ("negative_score", pa.int64())]
    far = _all_blocks(
        rows, limited, n, lambda block, some: negatives(block, some, k_negative, floor, ceiling),
        "key long, slot long, negative_id long, negative_score long", pa.schema(fields), at_once,
    )
    order = Window.partitionBy("key", "slot").orderBy(F.desc("negative_score"), "negative_id")
    slots = far.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k_negative)
    merged = slots.groupBy("key").agg(  # k rows of each slot at most, from the highest slot down
        F.array_sort(F.collect_list(F.struct((-F.col("negative_score")).alias("down"), "negative_id"))).alias("negatives")
    )

    owners = anchors.select("key", F.col("vec_id").alias("anchor_id"))
    pairs = near.join(owners, "key").join(merged, "key").select("anchor_id", F.inline("positives"), "negatives")
    wide = lambda c: c.cast("decimal(20,0)")  # noqa: E731  (a hundred times a score may not fit a long)
    low, high = (percent * wide(F.col("positive_score")) for percent in (floor, ceiling))
    suffix = F.slice(F.filter("negatives", lambda x: wide(-x["down"]) * 100 <= high), 1, k_negative)
    inside = F.filter(suffix, lambda x: wide(-x["down"]) * 100 >= low)
    found = pairs.select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("at", "x"))
    return found.select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.negative_id").alias("negative_id"),
        "positive_score", (-F.col("x.down")).alias("negative_score"),
    )
