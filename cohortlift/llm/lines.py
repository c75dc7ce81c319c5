"""Cross-site boilerplate lines by distinct-site spread.

A line is named by two hashes of its trimmed, lower-cased text.  HyperLogLog sketches of the sites that hold it are merged
by aggregation, in each task first, so a line that is everywhere costs a sketch per task.  Lines whose estimate is clearly above or
below the threshold are settled; the sites of those between are counted exactly.  Of a boilerplate line the first
occurrence (smallest id, then line number) stays, so that nothing is lost to the corpus, and all others go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift.llm.scratch import discard, free, table

MIN_SITES, MIN_WORDS, SKETCH_BITS, MARGIN = 5, 3, 12, 0.1
_SPACE, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def _names(line: Column) -> Column:
    plain = F.lower(F.regexp_replace(line, rf"^{_SPACE}+|{_SPACE}+$", ""))
    return F.struct(F.xxhash64(plain).alias("h1"), F.xxhash64(F.lit(7), plain).alias("h2"))


def _occurrences(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_words: int) -> DataFrame:
    lines = docs.select(
        F.col(id_col).cast("long").alias("doc"),
        F.xxhash64(F.col(site_col)).alias("s"),
        F.col(site_col).isNotNull().alias("has"),
        F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("pos", "line"),
    )
    enough = F.col("line").rlike(rf"^{_SPACE}*" + rf"{_SPACE}+".join([f"{_WORD}+"] * (min_words - 1) + [_WORD]))
    return lines.where(enough).select("doc", F.when(F.col("has"), F.col("s")).alias("site"), "pos", _names(F.col("line")).alias("k")).select(
        "doc", "site", "pos", "k.h1", "k.h2"
    )


def boilerplate(lines: DataFrame, min_sites: int, bits: int = SKETCH_BITS, margin: float = MARGIN) -> DataFrame:
    """``(h1, h2)`` of the lines that ``min_sites`` or more distinct sites hold; ``lines`` is read more than once."""
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(bits))).alias("sites"))
    low, high = min_sites * (1 - margin) - 1, min_sites * (1 + margin) + 1
    spread = table(spread.where(F.col("sites") >= low), "spread")
    near = spread.where(F.col("sites") <= high).select("h1", "h2")
    exact = lines.join(near, ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
    exact = exact.groupBy("h1", "h2").agg(F.count("site").alias("n")).where(F.col("n") >= min_sites)
    return spread.where(F.col("sites") > high).select("h1", "h2").union(exact.select("h1", "h2"))


def remove_boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
    lines_out: str = "n_lines",
    removed_out: str = "n_removed",
) -> DataFrame:
    """``docs`` with the lines left in ``text`` and two more columns: how many lines there were, and how many went.

    Lines of fewer than ``min_words`` words stay.  A null text stays null and has no line, an empty one has an empty line.
    A null site counts as no site.  Rows without id spread lines but keep theirs.  Rows that repeat an id are one
    document: each keeps a first occurrence.  Existing columns of the two new names are replaced, others are kept.
    """
    if min_sites < 2 or min_words < 1:
        raise ValueError("a line needs two sites and one word at least")
    lines = table(_occurrences(docs, id_col, text_col, site_col, min_words), "lines")
    found = table(boilerplate(lines, min_sites), "boilerplate")
    known = lines.where("doc IS NOT NULL").select("doc", "pos", "h1", "h2").join(found, ["h1", "h2"])
    first = known.groupBy("h1", "h2").agg(F.min(F.struct("doc", "pos")).alias("first"))
    gone = known.join(first, ["h1", "h2"]).where(F.struct("doc", "pos") != F.col("first"))
    gone = gone.groupBy("doc").agg(F.collect_set(F.struct("pos", "h1", "h2")).alias("_gone")).withColumnRenamed("doc", "_doc")
    gone = table(gone, "gone")
    discard(lines)
    kept = [c for c in docs.columns if c not in (lines_out, removed_out)]
    doc_, gone_, left_ = free([*docs.columns, lines_out, removed_out], "_doc", "_gone", "_left")
    gone = gone.withColumnsRenamed({"_doc": doc_, "_gone": gone_})
    joined = docs.join(gone, docs[id_col].cast("long") == gone[doc_], "left")
    text = docs[text_col].cast("string")
    split = F.split(text, "\n")
    left = F.filter(split, lambda line, i: ~F.array_contains(F.col(gone_), F.struct(i.alias("pos"), _names(line)["h1"].alias("h1"), _names(line)["h2"].alias("h2"))))
    joined = joined.withColumn(left_, F.when(F.col(gone_).isNotNull(), left))
    lines_of = F.when(text.isNull(), 0).otherwise(F.size(split))
    new_text = F.when(F.col(left_).isNotNull(), F.array_join(F.col(left_), "\n")).otherwise(text)
    removed = F.when(F.col(left_).isNotNull(), lines_of - F.size(F.col(left_))).otherwise(0)
    return joined.select(
        *[new_text.alias(c) if c == text_col else docs[c] for c in kept],
        lines_of.cast("long").alias(lines_out), removed.cast("long").alias(removed_out),
    )
