"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters and digits.  A rolling (Karp-Rabin) hash of ``min_match`` words finds the seeds that
a document shares with a benchmark item; seeds on one diagonal grow to maximal matches, and the longest match that lies
on unmarked words of both texts is marked again and again.  The share of an item's words that tiles cover does not
depend on their order, so a reordered passage counts as well.

The corpus is scanned once for each block of the benchmark, and nothing of it is shuffled.  A block holds at most
``block_words`` words (8 bytes each, plus its seeds) and is sent to all tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlift.llm import words as W
from cohortlift.llm.scratch import lean, table
from cohortlift.session import materialise

MIN_MATCH, MIN_COVERAGE, BLOCK_WORDS = 5, 0.5, 1 << 20
_BITS = 22
_TILE = pa.struct([("doc_start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())])
SCHEMA = "doc_id long, item_id long, item_words long, covered long, coverage double, tiles array<struct<doc_start:long,item_start:long,length:long>>"


class Seeds:
    """The words of a block of items and where each of their seeds is."""

    def __init__(self, items: list[tuple[int, bytes]], min_match: int):
        self.min_match = min_match
        self.ids = [i for i, _ in items]
        self.words = [np.frombuffer(w, np.uint64) for _, w in items]
        found = [W.grams(w, min_match) for w in self.words]
        hashes = np.concatenate([np.zeros(0, np.uint64), *found])
        item = np.repeat(np.arange(len(items)), [len(g) for g in found])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in found)])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.item, self.place = hashes[order], item[order], place[order]
        self.bits = np.zeros(1 << _BITS, bool)
        self.bits[self.hashes >> np.uint64(64 - _BITS)] = True

    def shared(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, item, position in the item) of all seeds among ``grams``."""
        at = np.flatnonzero(self.bits[grams >> np.uint64(64 - _BITS)])
        low = np.searchsorted(self.hashes, grams[at], "left")
        many = np.searchsorted(self.hashes, grams[at], "right") - low
        at, low, many = at[many > 0], low[many > 0], many[many > 0]
        entry = np.repeat(low - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum()) if len(at) else low
        return np.repeat(at, many), self.item[entry], self.place[entry]


def _runs(free: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate(([0], free.astype(np.int8), [0])))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def tile(doc: np.ndarray, item: np.ndarray, at: np.ndarray, place: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in the document, start in the item, words); ``at`` and ``place`` are the shared seeds."""
    order = np.lexsort((at, at - place))
    at, place = at[order], place[order]
    new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(at - place) != 0)))
    begin = np.flatnonzero(new)
    lengths = np.diff(np.append(begin, len(at))) + min_match - 1
    heap = []
    for d, i, n in zip(at[begin].tolist(), place[begin].tolist(), lengths.tolist()):
        # a seed is a hash: only equal words count
        heap += [(low - high, i + low, d + low) for low, high in _runs(doc[d : d + n] == item[i : i + n]) if high - low >= min_match]
    heapq.heapify(heap)
    doc_free, item_free = np.ones(len(doc), bool), np.ones(len(item), bool)
    tiles = []
    while heap:
        n, i, d = heapq.heappop(heap)
        free = doc_free[d : d - n] & item_free[i : i - n]
        if free.all():
            doc_free[d : d - n] = item_free[i : i - n] = False
            tiles.append((d, i, -n))
            if not item_free.any():
                break
        else:
            for low, high in _runs(free):
                if high - low >= min_match:
                    heapq.heappush(heap, (low - high, i + low, d + low))
    return tiles


def _scan(batches: Iterator[pa.RecordBatch], seeds) -> Iterator[pa.RecordBatch]:
    block: Seeds = seeds.value
    k = block.min_match
    for batch in batches:
        ids = batch.column(0).to_pylist()
        hashes, offsets, _ = W.find_words(*W.text_buffer(batch.column(1)), W.NOT_ALNUM)
        grams, whole = W.all_grams(hashes, offsets, k)
        at, item, place = block.shared(grams)
        keep = whole[at]
        at, item, place = at[keep], item[keep], place[keep]
        if not len(at):
            continue
        doc = np.searchsorted(offsets, at, "right") - 1
        order = np.lexsort((at, item, doc))
        at, item, place, doc = at[order], item[order], place[order], doc[order]
        new = np.flatnonzero(np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(item) != 0))))
        rows = []
        for low, high in zip(new, np.append(new[1:], len(at))):
            d, i = int(doc[low]), int(item[low])
            first = int(offsets[d])
            tiles = tile(hashes[first : offsets[d + 1]], block.words[i], at[low:high] - first, place[low:high], k)
            if tiles:
                covered, size = sum(t[2] for t in tiles), len(block.words[i])
                rows.append((ids[d], block.ids[i], size, covered, covered / size, [dict(zip(("doc_start", "item_start", "length"), t)) for t in sorted(tiles)]))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(_TILE))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)],
                ["doc_id", "item_id", "item_words", "covered", "coverage", "tiles"],
            )


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, at, _ = W.find_words(*W.text_buffer(batch.column(1)), W.NOT_ALNUM)
        found = [hashes[at[i] : at[i + 1]] for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([w.tobytes() for w in found], pa.binary()), pa.array([len(w) for w in found], pa.int64())],
            ["item_id", "words", "n"],
        )


def tilings(
    docs: DataFrame,
    bench: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_match: int = MIN_MATCH,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``(doc_id, item_id, item_words, covered, coverage, tiles)`` of each document and item that share a tile.

    ``tiles`` are word positions.  Null or empty texts and items of fewer than ``min_match`` words share nothing; repeated
    rows of a document are tiled each, a repeated item id stands for each of its texts.  Other columns are not looked at.
    The benchmark is sent in blocks of about ``block_words`` words, an item of more words as a block of its own; with more than one
    block, each scan of the documents is written before the next block is sent.
    """
    spark = docs.sparkSession
    items = materialise(
        bench.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).cast("string").alias("t"))
        .where("t IS NOT NULL")
        .distinct()
        .mapInArrow(lean(_item_words), "item_id long, words binary, n long")
        .where(F.col("n") >= min_match),
        "items",
    )
    long = F.col("n") > block_words
    total, n_long = items.agg(F.coalesce(F.sum(F.when(~long, F.col("n"))), F.lit(0)), F.count_if(long)).first()
    source = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("t")).where("t IS NOT NULL")
    # Twice as many blocks as the words ask for, as the hash deals them unevenly.
    count = 1 if total <= block_words else 2 * -(-total // block_words)
    name = F.xxhash64("item_id", "words")
    parts = [~long & (F.pmod(name, F.lit(count)) == b) for b in range(count)]
    parts += [long & (name == r[0]) for r in items.where(long).select(name).distinct().collect()] if n_long else []
    scans = []
    for part in parts:
        block = items.where(part).sort("item_id", "words").collect()
        if not block:
            continue
        sent = spark.sparkContext.broadcast(Seeds([(r["item_id"], bytes(r["words"])) for r in block], min_match))
        scans.append(source.mapInArrow(lean(_scan, seeds=sent), SCHEMA))
        if len(parts) > 1:  # one block at a time lies in memory
            scans[-1] = table(scans[-1], "tiles")
            sent.destroy()
    return reduce(DataFrame.union, scans) if scans else spark.createDataFrame([], SCHEMA)


def contaminated(found: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """The rows of ``tilings`` whose tiles cover ``min_coverage`` of the item or more."""
    return found.where(F.col("coverage") >= min_coverage)
