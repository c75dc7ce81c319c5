"""Fill-in-the-middle texts, cut at ranks that an indexable skip list finds.

A text's units are a run of blanks with the word behind it, or the blanks at its end.  Lane 0 of the skip list holds every
unit; an express lane holds about a quarter of the lane below, chosen by hash.  A node carries how many units and how many
code points lie between it and the next one of its lane.  A search goes along a lane while the units passed don't exceed
the wanted rank and goes down otherwise; the code points passed by then are the exact place of the cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cohortlift.llm import words as W
from cohortlift.llm.scratch import lean

SEED, RATE, SUFFIX_FIRST = 42, 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SLICE = 4 << 20


class SkipList:
    """Units with their widths in code points, packed lane by lane: a node's neighbour is the next entry of its lane."""

    def __init__(self, widths: np.ndarray):
        units, points, place = np.ones(len(widths), np.int64), np.asarray(widths, np.int64), np.arange(len(widths))
        #: per lane: units and code points up to the next node, and the node's place in the lane below
        self.lanes = [(units, points, place)]
        while len(units) > 4:
            chance = W.mix(place.astype(np.uint64) + np.uint64(len(self.lanes) << 40))
            chosen = np.flatnonzero(chance >> np.uint64(62) == 0)
            if not len(chosen) or chosen[0]:
                chosen = np.concatenate(([0], chosen))  # every lane begins at the first unit
            if len(chosen) == len(units):
                break
            units, points = np.add.reduceat(units, chosen), np.add.reduceat(points, chosen)
            place = place[chosen]
            self.lanes.append((units, points, chosen))

    def seek(self, rank: int) -> tuple[int, int]:
        """(code points before the unit of this rank, nodes passed); the rank behind the last unit is the end."""
        passed = points = steps = node = 0
        for units, widths, down in reversed(self.lanes):
            while node < len(units) and passed + units[node] <= rank:
                passed += int(units[node])
                points += int(widths[node])
                node += 1
                steps += 1
            if passed == rank:
                break
            node = int(down[node])  # passed < rank, so a node is left that begins before it
        return points, steps


def unit_widths(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of every unit of all texts, and the offsets of each text's units."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    blank = W.SPACES[raw]
    ends = np.zeros(len(raw), bool)
    np.logical_and(~blank[:-1], blank[1:], out=ends[:-1])
    ends[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = True
    stops = np.flatnonzero(ends) + 1
    begins = np.concatenate(([0], stops[:-1]))
    widths = np.add.reduceat((raw & 0xC0) != 0x80, begins, dtype=np.int64)
    return widths, np.searchsorted(stops, offsets, "right")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of units, and the code points before either cut, which two hashes choose."""
    for batch in batches:
        raw, offsets = W.text_buffer(batch.column(1))
        first, second = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
        found = np.zeros((3, batch.num_rows), np.int64)
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + _SLICE, "right")) - 1)
            widths, at = unit_widths(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            for i in range(lo, hi):
                own = widths[at[i - lo] : at[i - lo + 1]]
                n = len(own)
                found[0, i] = n
                if n:
                    ranks = sorted((int(first[i]) % (n + 1), int(second[i]) % (n + 1)))
                    units = SkipList(own)
                    found[1, i], found[2, i] = (units.seek(r)[0] for r in ranks)
            lo = hi
        yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], [*batch.schema.names, "n", "cut1", "cut2"])


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output was made of: sentinels neither occur in its parts nor overlap each other."""
    parts = F.split(output, "|".join(rf"\Q{s}\E" for s in sentinels), -1)
    of = lambda *at: F.concat(*[F.element_at(parts, i) for i in at])
    return F.when(form == "psm", of(2, 4, 3)).when(form == "spm", of(3, 4, 2)).otherwise(output)


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """``(id, n, form, prefix, middle, suffix, output)``, a row per row of ``docs``.

    ``n`` counts the units.  The eight-digit groups of the sha256 of "seed:id" decide: two cuts (each remainder by n + 1; the
    smaller one ends the prefix, the larger one the middle), whether the text is cut at all (``rate`` percent are) and whether
    the suffix comes first (``suffix_first`` percent).  Form ``plain`` is the text itself, with no parts; so is an empty text
    and one that holds a sentinel.  A null text is an empty one; a null id counts as no digits; rows that repeat an id and a
    text give the same row again; ids that differ in text share their hashes.  Texts of any length are taken whole, one at a
    time if need be.  Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    number = F.col(id_col).cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(number.cast("string"), F.lit(""))).cast("binary"), 256)
    group = lambda k: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")
    source = docs.select(number.alias("id"), text.alias("text"), *[group(k).alias(f"h{k + 1}") for k in range(4)])
    schema = StructType([*source.schema.fields, *[StructField(c, LongType()) for c in ("n", "cut1", "cut2")]])
    cut = source.mapInArrow(lean(_cut), schema)

    p, s, m = sentinels
    marked = F.lit(False)
    for sentinel in sentinels:
        marked = marked | F.contains("text", F.lit(sentinel))
    form = F.when((F.col("text") == "") | marked | (F.col("h3") % 100 >= rate), "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm")
    whole = F.col("form") == "plain"
    place = lambda c: F.col(c).cast("int")
    parts = cut.withColumn("form", form).select(
        F.col("id").alias(id_col), "n", "form", "text",
        F.when(~whole, F.col("text").substr(F.lit(1), place("cut1"))).alias("prefix"),
        F.when(~whole, F.col("text").substr(place("cut1") + 1, place("cut2") - place("cut1"))).alias("middle"),
        F.when(~whole, F.col("text").substr(place("cut2") + 1, F.length("text"))).alias("suffix"),
    )
    end = F.concat(F.lit(m), "middle")
    psm = F.concat(F.lit(p), "prefix", F.lit(s), "suffix", end)
    spm = F.concat(F.lit(s), "suffix", F.lit(p), "prefix", end)
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text"))
    return parts.withColumn("output", output).drop("text")
