"""Exact top-k inner products by aggregation without random access.

Components are quantised to integers.  Candidates are dealt to blocks by a hash of their id, and every query goes to every
block, as exactness asks.  A task sorts a block's candidates by each component once, for all queries; a query reads these
lists from the end that helps it, all to the same depth at a time (bounds are looked at after DEPTHS of them, for many queries
at once).  What it has read of a candidate, and the last value read
of each list, bound the candidate's score from below and above.  Reading stops when no candidate but a few can reach the k-th
best lower bound; their scores are then resolved.  The blocks of a task are read one after the other, and a query's k-th best
score so far is its bar in the next one: a block whose lists' ends bound every score below the bar is not read at all.
Tasks return k rows a query, which one window ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.llm.scratch import lean, table
from cohortlift.llm.vectors import by_width, packed, products

K, SCALE, CANDIDATES, TASKS, QUERIES_AT_ONCE = 5, 256, 4096, 24, 256
DEPTHS = (0.5, 0.8)  # shares of the lists after which bounds are looked at
SCHEMA = "query_id long, vec_id long, score long"


class Lists:
    """A block's vectors, and for each component its values in order and every row's place among them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        rows = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, rows, 0).T
        self.place = np.empty(vectors.shape, np.int32)
        np.put_along_axis(self.place, rows, np.arange(len(ids), dtype=np.int32)[:, None], 0)

    def bounds(self, queries: np.ndarray, depth: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest score (queries x rows) that the lists' entries up to ``depth`` leave possible.

        A list is read from its upper end by queries whose component is positive and from its lower end by the others, and an
        entry has been read when its place is that near to the end.  What was read counts as it is; a row that has not come
        up in a list holds the other end's value at worst and the last value read at best.
        """
        n, width = self.vectors.shape
        above, below = self.place >= n - depth, self.place < depth
        read = np.concatenate((self.vectors * above, self.vectors * below, above, below), 1).astype(kind)
        rising, falling = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)

        def unread(high: int, low: int) -> np.ndarray:
            up, down = self.values[:, high].astype(kind) * rising, self.values[:, low].astype(kind) * falling
            return np.concatenate((rising, falling, -up, -down), 1) @ read.T + (up + down).sum(1)[:, None]

        return unread(0, n - 1), unread(n - depth, depth - 1)

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """Per query the (ids, scores) of its k best candidates, ties to the smaller id, and the list entries read.

        Scores below a query's ``least`` may lack.
        """
        n, width = self.vectors.shape
        # Bounds are sums of products; as floats they are exact below 2^53.
        largest = float(np.abs(self.values[:, [0, -1]].astype(np.float64)).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, width)
        kind = np.float64 if largest < 2**51 else np.int64
        lowest = np.iinfo(np.int64).min
        bars = np.full(len(queries), lowest, np.int64) if least is None else least.copy()
        kept = {q: np.flatnonzero(self.ids != query_ids[q]) for q in range(len(queries))}
        active, read = np.arange(len(queries)), 0
        for share in DEPTHS if n > 4 * k else ():
            if not len(active):
                break
            depth = max(1, int(share * n))
            read += (depth if share == DEPTHS[0] else depth - int(DEPTHS[DEPTHS.index(share) - 1] * n)) * width * len(active)
            lower, upper = self.bounds(queries[active], depth, kind)
            own = query_ids[active][:, None] == self.ids[None, :]
            lower = np.where(own, lowest, lower.astype(np.int64))
            bars[active] = np.maximum(bars[active], np.partition(lower, n - k, axis=1)[:, n - k])
            able = (upper.astype(np.int64) >= bars[active][:, None]) & ~own
            for i, q in enumerate(active.tolist()):
                kept[q] = np.flatnonzero(able[i])
            active = active[able.sum(1) > 4 * k]
        found = []
        for q in range(len(queries)):
            scores = products(queries[q : q + 1], self.vectors[kept[q]])[0]
            order = np.lexsort((self.ids[kept[q]], -scores))[:k]
            found.append((self.ids[kept[q]][order], scores[order]))
        return found, read


def _search(batches: Iterator[pa.RecordBatch], k: int, candidates: int, at_once: int) -> Iterator[pa.RecordBatch]:
    """The k best of each query over a task's part of the candidates (kind 0), which come before the queries."""
    part, rows, blocks, waiting = None, [], None, []

    def found() -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []
        for width, (at, queries) in (by_width([d for _, d in waiting]) if waiting else {}).items():
            ids, queries = np.array([waiting[i][0] for i in at], np.int64), queries.astype(np.int64)
            best: list[list[tuple[int, int]]] = [[] for _ in at]
            least = np.full(len(at), np.iinfo(np.int64).min, np.int64)
            for lists in blocks.get(width, ()):
                for q, (near, scores) in enumerate(lists.best(ids, queries, k, least)[0]):
                    best[q] = sorted([*best[q], *((-int(s), int(i)) for s, i in zip(scores, near))])[:k]
                    if len(best[q]) == k:
                        least[q] = -best[q][-1][0]
            out += [(int(q), i, -s) for q, own in zip(ids, best) for s, i in own]
        waiting.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["query_id", "vec_id", "score"])

    for batch in batches:
        for c, kind, vec_id, data in zip(*(x.to_pylist() for x in batch.columns)):
            if c != part:
                if blocks is not None:
                    yield from found()
                part, rows, blocks = c, [], None
            if kind == 0:
                rows.append((vec_id, data))
                continue
            if blocks is None:
                rows, blocks = list(dict.fromkeys(rows)), {}
                for width, (at, matrix) in by_width([r[1] for r in rows]).items():
                    ids = np.array([rows[i][0] for i in at], np.int64)
                    cuts = range(0, len(ids), candidates)
                    blocks[width] = [Lists(ids[lo : lo + candidates], matrix[lo : lo + candidates]) for lo in cuts]
                rows = []
            waiting.append((vec_id, data))
            if len(waiting) >= at_once:
                yield from found()
    if blocks is not None:
        yield from found()


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    candidates: int = CANDIDATES,
    tasks: int = TASKS,
    task_rows: int = 16 * CANDIDATES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest inner products of each row that ``is_query``, a condition on ``vec_id``.

    Ties go to the smaller id.  Vectors that are null, empty or hold a null or a number that isn't finite take no part,
    neither do rows without id, nor vectors with ``length * largest**2 >= 2^63`` after scaling, whose scores might not fit a
    long.  A query is compared with vectors of its length, and not with rows of its id.  Rows that repeat id and vector are
    taken once.  Other columns are not looked at.  There are ``tasks`` parts of the candidates, or more of at most about
    ``task_rows``, in blocks of ``candidates``.
    """
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("e"))
    rows = table(source.mapInArrow(lean(packed, scale=scale), "vec_id long, v binary"), "vectors")
    n = max(tasks, -(-rows.count() // task_rows))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    met = rows.select(part.alias("c"), F.lit(0).alias("kind"), "vec_id", "v").union(
        rows.where(is_query).distinct().select(every.alias("c"), F.lit(1).alias("kind"), "vec_id", "v")
    )
    met = met.repartition(n, "c").sortWithinPartitions("c", "kind", "vec_id")
    found = met.mapInArrow(lean(_search, k=k, candidates=candidates, at_once=QUERIES_AT_ONCE), SCHEMA).distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
