"""Queries and SQL of the operators for language-model training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import groups, leaks, neardup, packing, scans, spam, split
from quire.session import table


def _long_texts(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "blocks").select(F.lit("blocks").alias("item_source"), F.col("block_key").cast("string").alias("item_id"), "text")
    s = table(spark, d, "segments").select(F.lit("segments").alias("item_source"), F.col("segment_id").alias("item_id"), F.col("text_content").alias("text"))
    return b.unionByName(s)


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Ordered pieces of every block and segment text."""
    return split.split_texts(_long_texts(spark, d), ["item_source", "item_id"], "text")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Items whose text had to be cut."""
    return p2_pieces(spark, d).where("n_pieces > 1").select("item_source", "item_id").distinct()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Group of every id on a match edge."""
    edges = table(spark, d, "edges").where(groups.edge_kind(F.col("edge_type")) == "DUPLICATE_OF")
    return groups.connected_groups(groups.matched_pairs(edges, "source_id", "target_id"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of segments that share most words."""
    links, members = neardup.near_duplicates(table(spark, d, "segments"), "segment_id", "text_content")
    return neardup.record_pairs(links, members, "segment_id")


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """Class of equal word sets and number of links of every segment."""
    links, members = neardup.near_duplicates(table(spark, d, "segments"), "segment_id", "text_content")
    return neardup.record_classes(links, members, "segment_id")


def _scanned(spark: SparkSession, d: str) -> DataFrame:
    return scans.texts(table(spark, d, "blocks"), table(spark, d, "cell_meta"), table(spark, d, "books"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Items with scan noise."""
    return scans.noise(_scanned(spark, d)).select("item_source", "item_id").distinct()


def p5_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Continuous, repaired text of every block and cell."""
    return scans.repair(_scanned(spark, d))


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    """Sequence and offset of every document (or part of one above the capacity)."""
    return packing.pack(packing.token_counts(table(spark, d, "documents"), "doc_id", "text"), "doc_id")


def p7_balance(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the sequences: none over the capacity, no document cut that fits, none without a place, no part missing."""
    rows = p7_packed(spark, d)
    room = rows.where("sequence_id is not null").groupBy("sequence_id").agg(F.sum("n_tokens").alias("n"), F.max(F.col("sequence_offset") + F.col("n_tokens")).alias("end")).agg(F.count_if((F.col("n") > packing.CAPACITY) | (F.col("end") > packing.CAPACITY)).alias("n_over"))
    docs = rows.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max("n_parts").alias("parts"), F.count("*").alias("rows"), F.count("sequence_id").alias("placed"))
    cut_ = docs.agg(F.count_if((F.col("parts") > 1) & (F.col("n") <= packing.CAPACITY)).alias("n_cut"), F.count_if((F.col("parts") > 0) & (F.col("rows") != F.col("parts"))).alias("n_parts_missing"), F.count_if(F.col("placed") > 0).alias("n_placed"))
    return room.crossJoin(cut_)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents and the evaluation items they leak."""
    return leaks.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"), "doc_id", "text", "item_id", "item_text").select("doc_id", "item_id")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The same with the share of each item's passages of 13 words that the document holds."""
    return leaks.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"), "doc_id", "text", "item_id", "item_text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents of keywords, links or tags instead of sentences."""
    return spam.spam_pages(table(spark, d, "documents"), "doc_id", "text", "lang").where("is_spam").select("doc_id").distinct()


QUERIES = {
    "p2_found": p2_found, "p2_pieces": p2_pieces, "p3_found": p3_found, "p4_found": p4_found, "p4_classes": p4_classes, "p5_found": p5_found, "p5_repaired": p5_repaired,
    "p7_packed": p7_packed, "p7_balance": p7_balance, "p8_found": p8_found, "p8_shares": p8_shares, "p9_found": p9_found,
}

SQL = {
    "p2_found": """
SELECT DISTINCT 'blocks' AS item_source, CAST(block_key AS VARCHAR) AS item_id FROM blocks WHERE length(text) > 1500
UNION SELECT DISTINCT 'segments', segment_id FROM segments WHERE length(text_content) > 1500""",
    "p3_found": """
WITH RECURSIVE pair AS (
  SELECT DISTINCT lower(trim(source_id)) AS s, lower(trim(target_id)) AS t FROM edges
  WHERE regexp_replace(upper(trim(edge_type)), '[- ]', '_', 'g') = 'DUPLICATE_OF' AND source_id IS NOT NULL AND target_id IS NOT NULL),
arc AS (SELECT s, t FROM pair WHERE s <> t AND s <> '' AND t <> '' UNION SELECT t, s FROM pair WHERE s <> t AND s <> '' AND t <> ''),
reach AS (SELECT s AS node_id, s AS seen FROM arc UNION SELECT r.node_id, a.t FROM reach r JOIN arc a ON r.seen = a.s)
SELECT node_id, min(seen) AS group_id FROM reach GROUP BY node_id""",
    "p4_found": r"""
WITH s AS (SELECT DISTINCT segment_id, list_distinct(regexp_extract_all(lower(text_content), '[\p{L}\p{N}]+')) AS w FROM segments WHERE text_content IS NOT NULL),
t AS (SELECT segment_id, w, len(w) AS n FROM s WHERE len(w) >= 12),
p AS (SELECT a.segment_id AS segment_id_a, b.segment_id AS segment_id_b, a.n + b.n AS n, len(list_intersect(a.w, b.w)) AS c FROM t a JOIN t b ON a.segment_id < b.segment_id AND a.n <= b.n / 0.7 AND b.n <= a.n / 0.7)
SELECT DISTINCT segment_id_a, segment_id_b FROM p WHERE c >= 0.7 * (n - c)""",
    "p7_balance": "SELECT 0 AS n_over, 0 AS n_cut, 0 AS n_parts_missing, count(*) AS n_placed FROM documents WHERE text <> ''",
    "p8_found": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents), i AS (SELECT item_id, regexp_extract_all(lower(item_text), '[\p{L}\p{N}]+') AS w FROM eval_items),
dw AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(list_slice(w, k, k + 12), ' '))) AS g FROM d WHERE len(w) >= 13),
iw AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(list_slice(w, k, k + 12), ' '))) AS g FROM i WHERE len(w) >= 13)
SELECT DISTINCT doc_id, item_id FROM dw JOIN iw ON dw.g = iw.g""",
    "p8_shares": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents), i AS (SELECT item_id, regexp_extract_all(lower(item_text), '[\p{L}\p{N}]+') AS w FROM eval_items),
dw AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(list_slice(w, k, k + 12), ' '))) AS g FROM d WHERE len(w) >= 13),
iw AS (SELECT item_id, len(w) - 12 AS n, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(list_slice(w, k, k + 12), ' '))) AS g FROM i WHERE len(w) >= 13)
SELECT doc_id, item_id, CAST(count(*) AS DOUBLE) / n AS containment FROM dw JOIN iw ON dw.g = iw.g GROUP BY doc_id, item_id, n""",
}
