"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlift.llm.infill import fill_in_middle, restore
from cohortlift.llm.jaccard import jaccard_join
from cohortlift.llm.kneser_ney import score, train
from cohortlift.llm.language import identify
from cohortlift.llm.lines import remove_boilerplate
from cohortlift.llm.mixing import taken_words
from cohortlift.llm.negatives import hard_negatives
from cohortlift.llm.quality import quality
from cohortlift.llm.surrogates import replace_personal_data
from cohortlift.llm.tiling import contaminated, tilings
from cohortlift.llm.revisits import records_of_pages, resolve_revisits
from cohortlift.llm.topk import top_k
from cohortlift.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(column: str, n: int) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def op1_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = identify(docs, train=_remainder("id", 5) != 0)
    return found.withColumn("held_out", F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False)))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_boilerplate(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(_table(spark, sf_dir, "documents"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder("doc_id", 7) == 2, F.lit(False))
    model = train(docs.where(~held_out).select("text"), order=3)
    return score(docs, model).withColumn("held_out", held_out)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    found = toxicity(docs, labels, train=_remainder("i", 4) != 2)
    return found.select(
        "doc_id",
        F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(records_of_pages(_table(spark, sf_dir, "pages")))
    fields = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return found.select(
        "record_id", "url_key", "state", "source_id", F.array_join(fields, "; ").alias("fields"), F.md5(F.col("payload").cast("binary")).alias("payload_md5")
    )


def op9_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(tilings(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))
    longest = F.array_max(F.transform("tiles", lambda t: t["length"]))
    return found.select(
        "doc_id", "item_id", "item_words", "covered", "coverage", F.size("tiles").cast("long").alias("n_tiles"), longest.alias("longest")
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_table(spark, sf_dir, "documents"), n=4, num=85, den=100)


def op11_slot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op12_skip_list_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(_table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select(
        "doc_id",
        "n",
        "form",
        F.length("prefix").cast("long").alias("prefix_chars"),
        F.length("middle").cast("long").alias("middle_chars"),
        digest(F.col("output")).alias("output_sha256"),
        digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def op13_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    found = quality(docs, labels, train=_remainder("i", 5) != 0, spans=False)
    return found.select(
        "doc_id",
        F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_byte_gru,
        op2_line_dedup,
        op3_source_mixing,
        op4_surrogates,
        op5_kneser_ney,
        op6_exact_top_k,
        op7_toxicity,
        op8_revisits,
        op9_string_tiling,
        op10_jaccard_join,
        op11_slot_negatives,
        op12_skip_list_infill,
        op13_line_quality,
    )
}

_KEPT_LINES = r"""
WITH split AS (
  SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split
), named AS (
  SELECT doc_id, source, pos, line, lower(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) AS name,
    regexp_matches(line, '^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+[\x20\x09-\x0D]+){2}[^\x20\x09-\x0D]') AS counts
  FROM lines
), spread AS (
  SELECT name, count(DISTINCT source) AS sites, min((doc_id, pos)) AS first FROM named WHERE counts GROUP BY name
), marked AS (
  SELECT n.*, n.counts AND s.sites >= 5 AND (n.doc_id, n.pos) <> s.first AS gone
  FROM named n LEFT JOIN spread s ON n.name = s.name
)
SELECT d.doc_id, coalesce(m.n_lines, 0) AS n_lines, coalesce(m.n_removed, 0) AS n_removed, md5(m.kept) AS kept_md5
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT coalesce(gone, false)), '') AS kept
  FROM marked GROUP BY doc_id
) m ON d.doc_id = m.doc_id
"""

_TOP_K = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_REVISITS = r"""
WITH bare AS (
  SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM pages
), parts AS (
  SELECT *, regexp_extract(u, '^([^?]*)', 1) AS p,
    list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
      lambda a: a <> '' AND NOT regexp_matches(lower(a), '^(utm_[a-z]+|ref|gclid|fbclid|sessionid|phpsessid|jsessionid)(=|$)'))) AS args
  FROM bare
), keyed AS (
  SELECT page_id, html, '"' || substr(md5(html), 1, 16) || '"' AS tag,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(p, '^([^/]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www[0-9]*\.', '')
    || regexp_replace(regexp_extract(p, '^[^/]*(/.*)$', 1), '/+$', '')
    || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS url_key
  FROM parts
), revisits AS (
  SELECT page_id, url_key, CASE WHEN page_id % 8 = 1 THEN NULL WHEN page_id % 4 = 3 THEN '"stale"' ELSE tag END AS etag,
    page_id * 60 + 30 + 60 * (page_id % 7) AS ts
  FROM keyed
), joined AS (
  SELECT r.*, s.page_id AS source, s.html, s.tag,
    CASE WHEN r.etag IS NULL THEN r.page_id = s.page_id ELSE r.etag = s.tag END AS agrees
  FROM revisits r ASOF LEFT JOIN (SELECT *, page_id * 60 AS at FROM keyed) s ON r.url_key = s.url_key AND r.ts > s.at
)
SELECT page_id * 2 + 1 AS record_id, url_key, CASE WHEN agrees THEN 'resolved' ELSE 'mismatch' END AS state,
  CASE WHEN agrees THEN source * 2 END AS source_id,
  CASE WHEN agrees THEN 'cache-control=max-age=120; content-length=' || length(html) || '; content-type=text/html; date=' || ts
      || '; etag=' || coalesce(etag, CASE WHEN source % 5 = 0 THEN 'W/' ELSE '' END || tag) || '; last-modified=' || page_id
    ELSE 'cache-control=max-age=120; connection=close; content-length=0; date=' || ts || coalesce('; etag=' || etag, '')
      || '; last-modified=' || page_id END AS fields,
  CASE WHEN agrees THEN md5(html) END AS payload_md5
FROM joined
UNION ALL
SELECT page_id * 2, url_key, 'response', page_id * 2, 'cache-control=max-age=60; content-length=' || length(html) || '; content-type=text/html; etag='
  || CASE WHEN page_id % 5 = 0 THEN 'W/' ELSE '' END || tag || '; last-modified=' || page_id, md5(html)
FROM keyed
"""

_HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, a.e AS ae, c.vec_id, c.label,
    CAST(list_inner_product(CAST(a.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id, own, ae ORDER BY score DESC, vec_id) AS r FROM scored WHERE label = own
), met AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.own, p.ae, p.r ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND p.own = n.own AND p.ae = n.ae AND n.label <> n.own
    AND 80 * p.score <= 100 * n.score AND n.score <= p.score
  WHERE p.r <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM met WHERE rank <= 5
"""

_INFILL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM t
), c AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
    greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, CASE WHEN a > 0 THEN array_to_string(units[1:a], '') ELSE '' END AS prefix,
    CASE WHEN b > a THEN array_to_string(units[a + 1:b], '') ELSE '' END AS middle,
    CASE WHEN n > b THEN array_to_string(units[b + 1:n], '') ELSE '' END AS suffix
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""

ORACLES: dict[str, str] = {
    "op2_line_dedup": _KEPT_LINES,
    "op6_exact_top_k": _TOP_K,
    "op8_revisits": _REVISITS,
    "op11_slot_negatives": _HARD_NEGATIVES,
    "op12_skip_list_infill": _INFILL,
}
