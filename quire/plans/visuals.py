"""Queries on visuals, sections and concept terms, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import graph, layout, visuals
from quire.plans.books import _HEADS, _LATEST, BOOK_SQL, book_blocks
from quire.session import table


def formula_fragments(spark, d):
    """Formula fragments merged a page."""
    b = book_blocks(spark, d).where("block_type in ('formula', 'text')")
    return visuals.merge_fragments(b, gap=60.0, side=25.0)


def word_columns(spark, d):
    """Column centres a page of words."""
    w = table(spark, d, "lineitem").select((F.col("l_orderkey") % 200).alias("page_id"), (F.col("l_partkey") % 600).cast("double").alias("x"))
    return visuals.cluster_columns(w, 40.0).select("page_id", "col_no", F.round("centre", 6).alias("centre"), "n_words")


def drawing_groups(spark, d):
    """Visual blocks grouped around seeds."""
    return visuals.cluster_drawings(book_blocks(spark, d).where("block_type in ('table', 'image', 'formula')"), 300.0, 2)


def unclaimed_regions(spark, d):
    """Tables that no image overlaps much."""
    b = book_blocks(spark, d)
    tall = b.where("block_type = 'table'").withColumn("y1", F.when(F.col("ord") % 5 == 0, F.col("y1") + 45).otherwise(F.col("y1")))
    return visuals.unclaimed(tall, b.where("block_type = 'image'"), 0.4).groupBy("doc_id").agg(F.count("*").alias("n_tables"))


_UNCLAIMED = BOOK_SQL + """, t AS (SELECT *, CASE WHEN ord % 5 = 0 THEN y1 + 45 ELSE y1 END AS yy FROM book_blocks WHERE block_type = 'table')
SELECT doc_id, count(*) AS n_tables FROM t WHERE NOT EXISTS (SELECT 1 FROM book_blocks i WHERE i.block_type = 'image' AND i.doc_id = t.doc_id AND i.page_idx = t.page_idx AND least(t.x1, i.x1) > greatest(t.x0, i.x0) AND least(t.yy, i.y1) > greatest(t.y0, i.y0)
  AND (least(t.x1, i.x1) - greatest(t.x0, i.x0)) * (least(t.yy, i.y1) - greatest(t.y0, i.y0)) > 0.4 * least((t.x1 - t.x0) * (t.yy - t.y0), (i.x1 - i.x0) * (i.y1 - i.y0))) GROUP BY 1"""


def filled_sections(spark, d):
    """Sections whose subtree holds a block, with the number of its blocks."""
    b = book_blocks(spark, d)
    return visuals.prune_sections(layout.sections(b), b).select("doc_id", "start_idx", "level", "subtree_end", "n_filled")


_FILLED = _HEADS + """, h AS (SELECT doc_id, ord AS start_idx, level FROM lev WHERE level IS NOT NULL), l AS (SELECT doc_id, max(ord) AS last FROM book_blocks GROUP BY 1),
n AS (SELECT *, min(CASE WHEN level <= 1 THEN start_idx END) OVER w AS n1, min(start_idx) OVER w AS n2 FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY start_idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
e AS (SELECT n.doc_id, start_idx, level, coalesce(CASE WHEN level = 1 THEN n1 ELSE n2 END - 1, last) AS subtree_end FROM n JOIN l ON l.doc_id = n.doc_id), r AS (SELECT doc_id, ord, sum(CASE WHEN block_type <> 'heading' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord) AS upto FROM book_blocks)
SELECT e.doc_id, start_idx, level, subtree_end, CAST(b.upto - a.upto AS BIGINT) AS n_filled FROM e JOIN r a ON a.doc_id = e.doc_id AND a.ord = start_idx JOIN r b ON b.doc_id = e.doc_id AND b.ord = subtree_end WHERE b.upto > a.upto"""


def candidate_pages(spark, d):
    """Pages that hold or follow a question on each third page, a document; ``question_pages`` takes all."""
    b = book_blocks(spark, d).where("text like '%. Calculate%' and page_idx % 3 = 0")
    return visuals.candidate_pages(b).groupBy("doc_id").agg(F.count("*").alias("n_pages"))


_PAGES = BOOK_SQL + ", c AS (SELECT doc_id, page_idx FROM book_blocks WHERE text LIKE '%. Calculate%' AND page_idx % 3 = 0) SELECT doc_id, count(*) AS n_pages FROM (SELECT * FROM c UNION SELECT doc_id, page_idx + 1 FROM c) GROUP BY 1"


def question_pages(spark, d):
    """Pages that hold or follow a question, a document."""
    b = book_blocks(spark, d).where("text like '%. Calculate%'")
    return visuals.candidate_pages(b).groupBy("doc_id").agg(F.count("*").alias("n_pages"))


_QUESTION_PAGES = BOOK_SQL + ", c AS (SELECT doc_id, page_idx FROM book_blocks WHERE text LIKE '%. Calculate%') SELECT doc_id, count(*) AS n_pages FROM (SELECT * FROM c UNION SELECT doc_id, page_idx + 1 FROM c) GROUP BY 1"


def page_zones(spark, d):
    """Block type with most weight of each page of real layouts."""
    b = table(spark, d, "blocks").select(F.col("layout_id").alias("doc_id"), "page_idx", F.col("block_type").alias("zone"), F.lit(1).alias("weight"))
    return visuals.page_votes(b)


_ZONES = "WITH v AS (SELECT layout_id AS doc_id, page_idx, block_type AS zone, count(*) AS votes FROM blocks GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY votes DESC, zone) AS k FROM v) SELECT doc_id, page_idx, zone, votes FROM r WHERE k = 1"


def formula_examples(spark, d):
    """Number of segments that reference each formula."""
    s = graph.latest_nodes(table(spark, d, "segments"))
    return visuals.back_links(s).select("formula_id", F.size("example_ids").cast("long").alias("n_segments"), F.get("example_ids", F.lit(0)).alias("first_segment"))


_EXAMPLES = _LATEST + ", e AS (SELECT DISTINCT segment_id, unnest(referenced_formula_ids) AS formula_id FROM latest) SELECT formula_id, count(*) AS n_segments, min(segment_id) AS first_segment FROM e GROUP BY 1"


def derivation_targets(spark, d):
    """Inputs and target of every derivation that names formulas."""
    s = graph.latest_nodes(table(spark, d, "segments")).where("segment_type = 'derivation'")
    r = visuals.derivation_roles(F.col("derived_from_formula_ids"))
    return s.select("segment_id", r["target"].alias("last_formula"), F.size(r["inputs"]).cast("long").alias("n_inputs")).where("last_formula is not null")


_TARGETS = _LATEST + " SELECT segment_id, derived_from_formula_ids[-1] AS last_formula, len(derived_from_formula_ids) - 1 AS n_inputs FROM latest WHERE segment_type = 'derivation' AND len(derived_from_formula_ids) > 0"


def concept_term_roles(spark, d):
    """Terms of concepts by role, and how many are generic."""
    return visuals.concept_terms(table(spark, d, "concepts")).groupBy("role", "generic").agg(F.count("*").alias("n_terms"), F.count_distinct("concept_id").alias("n_concepts"))


def visual_concepts(spark, d):
    """Concepts of captions of images and tables."""
    b = table(spark, d, "blocks").where("block_type in ('image', 'table') and text <> ''").select(F.col("block_key").alias("visual_id"), "text").distinct()
    return visuals.visual_concepts(b, visuals.concept_terms(table(spark, d, "concepts")))


def table_descriptions(spark, d):
    """A sentence on every table."""
    t = table(spark, d, "table_segments")
    return t.select("segment_id", visuals.describe_table(F.col("col_headers"), F.col("caption")).alias("description")).distinct()


_DESCRIBE = """SELECT DISTINCT segment_id, 'Table of ' || CASE WHEN regexp_matches(h, 'principal|amorti[sz]') THEN 'amortisation schedule' WHEN regexp_matches(h, 'coupon|yield|maturity') THEN 'bond figures' WHEN regexp_matches(h, 'cash ?flow|npv|present value') THEN 'cash flows' ELSE 'figures' END
  || ' with ' || len(coalesce(col_headers, [])) || ' columns: ' || coalesce(caption, 'untitled') AS description FROM (SELECT *, lower(array_to_string(coalesce(col_headers, []), ' ')) AS h FROM table_segments)"""

QUERIES = {
    f.__name__: f
    for f in (
        formula_fragments, word_columns, drawing_groups, unclaimed_regions, filled_sections, candidate_pages, question_pages, page_zones, formula_examples, derivation_targets, concept_term_roles, visual_concepts, table_descriptions,
    )
}
SQL = {
    "unclaimed_regions": _UNCLAIMED, "filled_sections": _FILLED, "candidate_pages": _PAGES, "question_pages": _QUESTION_PAGES, "page_zones": _ZONES, "formula_examples": _EXAMPLES, "derivation_targets": _TARGETS, "table_descriptions": _DESCRIBE,
}
