"""Queries on segments, regions and questions, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import patterns as P
from quire.functions import qa
from quire.functions import text as T
from quire.operators import graph, layout, regions, segments
from quire.operators.tables import one_cell_each
from quire.plans.books import _HEADS, _LATEST, _ONE_CELL, _SYMBOLS, _any, BOOK_SQL, HEIGHT, book_blocks
from quire.session import table
from quire.sources import backends


def _typed(spark, d):
    return segments.classify(book_blocks(spark, d), HEIGHT)


def segment_kinds(spark, d):
    """Segments of the books by section and type."""
    return _typed(spark, d).groupBy("section", "block_type", "segment_type").agg(F.count("*").alias("n_blocks"), F.min("ord").alias("first_ord"))


_SIGNS = {
    **{name: (weight, _any("low", [pattern], "")) for name, weight, pattern in qa.DERIVATION_SIGNS},
    "by_definition_math": (2, f"({_any('low', [qa.BY_DEFINITION], '')} AND (contains(t, '=') OR {_any('low', [P.EQUATION_MENTION], '')}))"),
    "eq_ref_transform": (2, f"({_any('low', [P.EQUATION_MENTION], '')} AND {_any('low', [qa.REF_TRANSFORM], '')})"),
    "eq_with_result": (2, f"(contains(t, '=') AND {_any('low', [qa.RESULT], '')})"),
    "symbolic_chain": (2, "(length(t) - length(replace(t, '=', '')) >= 2)"),
    "arrow_chain": (2, "(contains(t, '->') OR contains(t, '=>') OR contains(t, '⇒'))"),
    "too_short": (-2, f"(len(string_split_regex(t, '\\s+')) < 6 AND NOT contains(t, '=') AND NOT {_any('low', [P.EQUATION_MENTION], '')})"),
}
_SCORE = " + ".join(f"CASE WHEN {c} THEN {w} ELSE 0 END" for w, c in _SIGNS.values())


def _has(*names: str) -> str:
    return "(" + " OR ".join(_SIGNS[n][1] for n in names) + ")"


_SHOWN = _has("eq_with_result", "by_definition_math", "symbolic_chain", "arrow_chain")
_DERIV = f"(score >= 4 AND ({_has('strong_heading')} OR (({_has('equation_ref', 'eq_ref_transform')} OR {_SHOWN}) AND ({_has('transform_verb', 'transform_verb_more', 'eq_ref_transform')} OR ({_has('derivation_word')} AND {_SHOWN})))))"
_EXAMPLE = "(low LIKE 'example%' OR contains(substr(low, 1, 50), 'worked example') OR (contains(substr(low, 1, 100), 'given') AND regexp_matches(low, '\\d') AND regexp_matches(low, 'answer|solution|therefore|thus|find|calculate')))"
_PROBLEM = f"(contains(low, '?') OR {_any('low', qa.PROBLEM_SIGNS, '')})"
_CLASSIFIED = BOOK_SQL + f""", st AS (SELECT *, trim(text) AS t, lower(trim(text)) AS low, CASE {' '.join(f"WHEN {_any('lower(trim(text))', [p], '')} THEN '{n}'" for n, p in qa.SECTIONS)} END AS opened FROM book_blocks),
s1 AS (SELECT *, last_value(opened IGNORE NULLS) OVER w AS sec0, count(opened) OVER w AS run, CASE WHEN block_type = 'text' THEN try_cast(regexp_extract(text, '^\\s*(\\d{{1,4}})\\s*[.)]\\s', 1) AS INTEGER) END AS n FROM st WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING)),
s2 AS (SELECT *, last_value(n IGNORE NULLS) OVER (PARTITION BY doc_id, run ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s1),
s3 AS (SELECT *, CASE WHEN bool_or(coalesce(sec0 = 'problem_set' AND before >= 20 AND n <= 2, false)) OVER (PARTITION BY doc_id, run ORDER BY ord ROWS UNBOUNDED PRECEDING) THEN 'cfa' ELSE sec0 END AS section, {_SCORE} AS score,
  CASE WHEN t = '' OR low LIKE 'example%' OR low LIKE 'concept check%' OR regexp_matches(substr(t, 1, 20), '[=+\\-*/]') THEN 0 ELSE
    CASE WHEN low LIKE 'chapter%' THEN 2 ELSE 0 END + CASE WHEN regexp_matches(t, '^\\d+(\\.\\d+)+(\\s+|$)') THEN 2 ELSE 0 END + CASE WHEN length(t) <= 80 THEN 1 ELSE 0 END + CASE WHEN y0 / {HEIGHT} < 0.25 THEN 1 ELSE 0 END
    + CASE WHEN NOT regexp_matches(t, '(^| )[a-z]') AND NOT regexp_matches(t, '[^ ][A-Z]') OR (t = upper(t) AND t <> low) THEN 1 ELSE 0 END END AS header_score FROM s2),
s4 AS (SELECT *, regexp_matches(low, '^\\d+\\s*[.)]\\s+') AS numbered FROM s3),
typed AS (SELECT *, CASE WHEN opened IS NOT NULL THEN 'header' WHEN numbered AND section IN ('problem_set', 'cfa') AND {_PROBLEM} THEN 'question' WHEN numbered AND section = 'concept_check_solutions' THEN 'solution' WHEN {_DERIV} THEN 'derivation'
  WHEN length(low) >= 10 AND ((regexp_matches(low, '^\\d+[.:)]') AND (section = 'concept_check_solutions' OR (section = 'concept_check' AND regexp_matches(substr(low, 1, 200), 'solution|answer|therefore|thus|we find|we get|=')))) IS TRUE
    OR ((regexp_matches(substr(low, 1, 100), 'solution to|answer to|solution:|answer:') OR {_any('low', qa.SOLUTION_STARTS, '')}) AND NOT {_EXAMPLE})) THEN 'solution'
  WHEN NOT {_EXAMPLE} AND ((contains(substr(low, 1, 100), 'given') AND regexp_matches(t, '\\d') AND contains(t, '=') AND regexp_matches(low, 'therefore|thus|we get|we find|result|answer'))
    OR (regexp_matches(t, '\\d') AND contains(t, '=') AND regexp_matches(t, '[+\\-*/×÷^]') AND regexp_matches(t, '^\\d+[.)]\\s+'))) THEN 'calculation'
  WHEN {_EXAMPLE} THEN 'worked_example' WHEN regexp_matches(low, '^concept\\s+check\\s+\\d+\\.\\d+') THEN 'question' WHEN numbered AND {_PROBLEM} THEN 'question' WHEN header_score >= 3 THEN 'header' END AS segment_type FROM s4)
"""
_KINDS = _CLASSIFIED + "SELECT section, block_type, segment_type, count(*) AS n_blocks, min(ord) AS first_ord FROM typed GROUP BY 1, 2, 3"


def derivation_scores(spark, d):
    """Score and number of signs of every text of the books."""
    b = book_blocks(spark, d).select("doc_id", "ord", qa.derivation_signs(F.col("text")).alias("s"))
    return b.groupBy(qa.derivation_score(F.col("s")).alias("score"), F.size("s").cast("long").alias("n_signs")).agg(F.count("*").alias("n_blocks"), F.min("ord").alias("first_ord"))


_SCORES = _CLASSIFIED + "SELECT score, " + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for _, c in _SIGNS.values()) + " AS n_signs, count(*) AS n_blocks, min(ord) AS first_ord FROM s3 GROUP BY 1, 2"


def question_types(spark, d):
    """Types and numbers of questions."""
    s = graph.latest_nodes(table(spark, d, "segments")).where("segment_type = 'question'")
    return s.groupBy(qa.question_type(F.col("text_content")).alias("question_type"), qa.is_noisy_question(F.col("text_content")).alias("noisy"), (qa.question_number(F.col("question_number")).isNotNull()).alias("numbered")).agg(F.count("*").alias("n_questions"))


def given_values(spark, d):
    """Values that the examples of the books state, what they ask for, and their last line."""
    b = book_blocks(spark, d).where("block_type = 'text' and text like 'Example %'")
    g = qa.given_data(F.col("text"))
    return b.select("doc_id", "ord", g["a"].alias("a"), F.size(F.map_keys(g)).cast("long").alias("n_values"), F.array_join(qa.output_variables(F.col("text")), ",").alias("outputs"), qa.final_answer(F.col("text")).alias("answer"))


_GIVEN = BOOK_SQL + "SELECT doc_id, ord, regexp_extract(text, 'a = (\\d+,)', 1) AS a, 1 AS n_values, 'r' AS outputs, text AS answer FROM book_blocks WHERE block_type = 'text' AND text LIKE 'Example %'"


def variable_definitions(spark, d):
    """Meanings of symbols stated in formula segments: the most frequent meaning of each symbol of a book and chapter."""
    s = graph.latest_nodes(table(spark, d, "segments")).where("segment_type = 'formula'")
    # a formula that isn't given apart stands in the text before its definitions
    formula = F.coalesce("formula_text_raw", F.regexp_replace("text_content", r"(?is)\b(?:where|here|with|in which)\b.*", ""))
    rows = s.select("book_id", "chapter_number", F.explode(qa.formula_definitions(qa.definitions(F.col("text_content")), formula)).alias("v")).groupBy("book_id", "chapter_number", "v.symbol", "v.meaning").agg(F.count("*").alias("n"))
    return rows.groupBy("book_id", "chapter_number", "symbol").agg(F.max_by("meaning", F.struct("n", "meaning")).alias("meaning"), F.sum("n").alias("n_statements"))


def worked_examples(spark, d):
    """Examples with the calculations and derivations that follow them."""
    return segments.absorb(_typed(spark, d), "worked_example", ["calculation", "derivation"]).select("doc_id", "ord", "n_parts", "page_end", F.md5("text").alias("text_md5"))


_ABSORB = _CLASSIFIED + """, tt AS (SELECT * FROM typed WHERE segment_type IS NOT NULL), m AS (SELECT *, max(CASE WHEN segment_type = 'worked_example' THEN ord END) OVER w AS head, max(CASE WHEN segment_type NOT IN ('calculation', 'derivation') THEN ord END) OVER w AS stop
  FROM tt WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING)), i AS (SELECT m.*, h.page_idx AS hp FROM m JOIN tt h ON h.doc_id = m.doc_id AND h.ord = m.head WHERE m.head = m.stop)
SELECT doc_id, head AS ord, count(*) AS n_parts, max(page_idx) AS page_end, md5(string_agg(text, chr(10) ORDER BY ord)) AS text_md5 FROM i WHERE page_idx <= hp + 1 GROUP BY 1, 2"""


def merged_questions(spark, d):
    """Questions with their continuation blocks."""
    return segments.merge_questions(_typed(spark, d))


def pruned_segments(spark, d):
    """Counts of types after refining derivations and pruning questions."""
    return segments.prune_questions(segments.refine_derivations(_typed(spark, d))).groupBy("segment_type").agg(F.count("*").alias("n_segments"))


_PRUNED = _CLASSIFIED + f"""SELECT segment_type, count(*) AS n_segments FROM typed WHERE segment_type IS NOT NULL AND NOT (segment_type = 'question' AND (regexp_matches(t, '(?i)^concept\\s+check\\s*\\d*(?:\\.\\d+)*\\s*$')
  OR len(regexp_extract_all(t, '[A-Za-z]+')) <= 1 OR (len(regexp_extract_all(t, '[A-Za-z]+')) <= 2 AND NOT {_PROBLEM}))) GROUP BY 1"""


def unlinked_solutions(spark, d):
    """Solutions that stay: linked, or neither question-like nor heading-like."""
    s = graph.latest_nodes(table(spark, d, "segments")).where("segment_type = 'solution'").select(graph.node_id(F.col("segment_id")).alias("segment_id"), F.col("text_content").alias("text"))
    return segments.prune_solutions(s, graph.edge_rows(table(spark, d, "edges")).where("edge_type = 'ANSWER_OF'")).select("segment_id")


_UNLINKED = _LATEST + f""", a AS (SELECT DISTINCT lower(trim(source_id)) AS i FROM edges WHERE regexp_replace(upper(trim(edge_type)), '[- ]', '_', 'g') = 'ANSWER_OF'), s AS (SELECT lower(trim(segment_id)) AS segment_id, text_content AS t, lower(text_content) AS low FROM latest WHERE segment_type = 'solution')
SELECT segment_id FROM s WHERE segment_id IN (SELECT i FROM a WHERE i IS NOT NULL) OR NOT (({_PROBLEM} AND contains(t, '?')) OR length(trim(t)) < 20)"""


def chapter_state(spark, d):
    """Chapter and section carried to every block, counted."""
    return segments.chapter_state(book_blocks(spark, d)).groupBy("doc_id", "chapter", "section_number").agg(F.count("*").alias("n_blocks"), F.min("section_title").alias("section_title"))


_STATE = _HEADS + """, h AS (SELECT *, CASE WHEN block_type = 'heading' AND regexp_matches(text, '^\\d+(\\.\\d+)+') THEN regexp_extract(text, '^(\\d+(?:\\.\\d+)+)', 1) WHEN block_type = 'heading' AND regexp_matches(text, '(?i)chapter\\s+\\d+') THEN regexp_extract(text, '(?i)chapter\\s+(\\d+)', 1) END AS n FROM book_blocks),
f AS (SELECT *, last_value(n IGNORE NULLS) OVER w AS section_number, last_value(CASE WHEN n IS NOT NULL THEN trim(text) END IGNORE NULLS) OVER w AS section_title FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING))
SELECT doc_id, string_split(section_number, '.')[1] AS chapter, section_number, count(*) AS n_blocks, min(section_title) AS section_title FROM f GROUP BY 1, 2, 3"""


_SYMBOL_SCORES = _STATE.rsplit("SELECT doc_id, string_split", 1)[0] + f""", o AS (SELECT f.doc_id, string_split(f.section_number, '.')[1] AS chapter, f.text, lower(outlined.heading_path) AS hp FROM f JOIN outlined ON outlined.doc_id = f.doc_id AND outlined.ord = f.ord WHERE f.block_type = 'formula'),
p AS (SELECT doc_id, chapter, unnest({_SYMBOLS}) AS symbol, 2 + CASE WHEN regexp_matches(hp, 'key equations|definition|notation') THEN 2 ELSE 0 END AS p FROM o), s AS (SELECT doc_id, chapter, symbol, CAST(sum(p) AS BIGINT) AS score FROM p GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chapter ORDER BY score DESC, symbol) AS rank FROM s) SELECT * FROM r WHERE rank <= 14"""


def chapter_gaps(spark, d):
    """Chapters of the books without each fifth heading, gaps filled, in natural order; ``filled_chapters`` takes all."""
    b = book_blocks(spark, d).where("block_type = 'heading' and ord % 5 <> 0")
    c = b.select("doc_id", F.regexp_extract("text", r"^(?:Chapter )?(\d+(?:\.\d+)?)", 1).alias("number")).where("number <> ''")
    return segments.chapter_gaps(c)


_GAPS = BOOK_SQL + """, c AS (SELECT DISTINCT doc_id, coalesce(nullif(regexp_extract(text, '^Chapter (\\d+)', 1), ''), nullif(regexp_extract(text, '^(\\d+\\.\\d+)', 1), '')) AS number FROM book_blocks WHERE block_type = 'heading' AND ord % 5 <> 0),
k AS (SELECT * FROM c WHERE number IS NOT NULL), p AS (SELECT doc_id, string_split(number, '.')[1] AS p, max(CAST(string_split(number, '.')[2] AS INTEGER)) AS k FROM k WHERE contains(number, '.') GROUP BY 1, 2),
f AS (SELECT doc_id, p AS number FROM p UNION SELECT doc_id, p || '.' || unnest(range(1, k + 1)) FROM p), a AS (SELECT * FROM k UNION SELECT * FROM f)
SELECT a.doc_id, a.number, k.number IS NULL AS filled_in, row_number() OVER (PARTITION BY a.doc_id ORDER BY CAST(string_split(a.number, '.')[1] AS INTEGER), CAST(coalesce(string_split(a.number, '.')[2], '0') AS INTEGER)) AS position FROM a LEFT JOIN k ON k.doc_id = a.doc_id AND k.number = a.number"""


def filled_chapters(spark, d):
    """Chapters of the books with gaps filled, in natural order."""
    b = book_blocks(spark, d).where("block_type = 'heading'")
    c = b.select("doc_id", F.regexp_extract("text", r"^(?:Chapter )?(\d+(?:\.\d+)?)", 1).alias("number")).where("number <> ''")
    return segments.chapter_gaps(c)


_FILLED_CHAPTERS = BOOK_SQL + """, c AS (SELECT DISTINCT doc_id, coalesce(nullif(regexp_extract(text, '^Chapter (\\d+)', 1), ''), nullif(regexp_extract(text, '^(\\d+\\.\\d+)', 1), '')) AS number FROM book_blocks WHERE block_type = 'heading'),
k AS (SELECT * FROM c WHERE number IS NOT NULL), p AS (SELECT doc_id, string_split(number, '.')[1] AS p, max(CAST(string_split(number, '.')[2] AS INTEGER)) AS k FROM k WHERE contains(number, '.') GROUP BY 1, 2),
f AS (SELECT doc_id, p AS number FROM p UNION SELECT doc_id, p || '.' || unnest(range(1, k + 1)) FROM p), a AS (SELECT * FROM k UNION SELECT * FROM f)
SELECT a.doc_id, a.number, k.number IS NULL AS filled_in, row_number() OVER (PARTITION BY a.doc_id ORDER BY CAST(string_split(a.number, '.')[1] AS INTEGER), CAST(coalesce(string_split(a.number, '.')[2], '0') AS INTEGER)) AS position FROM a LEFT JOIN k ON k.doc_id = a.doc_id AND k.number = a.number"""


def chapter_symbols(spark, d):
    """Most used symbols of each chapter of the books."""
    from quire.functions import formulas as X

    o = segments.chapter_state(layout.outline(book_blocks(spark, d))).where("block_type = 'formula'")
    t = F.col("text")
    f = o.select("doc_id", "chapter", X.symbols(t).alias("symbols"), X.usage_type(t, F.col("heading_path")).alias("usage_type"), X.equation_number(t).alias("equation_number"))
    return segments.symbol_scores(f)


def table_checks(spark, d):
    """Validity of every table, with the reason."""
    return regions.table_validity(one_cell_each(table(spark, d, "cell_meta")), table(spark, d, "table_segments"))


_CHECKS = _ONE_CELL + """, st AS (SELECT segment_id, count(DISTINCT row_index) AS n_rows, count(*) AS n_cells, count(*) FILTER (WHERE v <> '') AS n_filled, count(*) FILTER (WHERE length(v) > 500) AS n_long, max(length(v)) AS longest,
  count(*) FILTER (WHERE v <> '' AND (length(v) < 150 OR detected_type IN ('number', 'currency', 'percent'))) AS n_data FROM kinds GROUP BY 1),
o AS (SELECT segment_id, max(caption) AS caption, max(len(col_headers)) AS cols FROM table_segments GROUP BY 1), j AS (SELECT o.segment_id, lower(coalesce(caption, '')) AS c, coalesce(cols, 0) AS cols, st.* EXCLUDE (segment_id), regexp_matches(lower(coalesce(caption, '')), '\\btable\\b') AS named FROM o LEFT JOIN st ON st.segment_id = o.segment_id)
SELECT segment_id, CASE WHEN regexp_matches(c, 'figure|chart|graph|diagram') THEN 'caption names a figure' WHEN coalesce(n_rows, 0) < 1 THEN 'no rows' WHEN cols < 1 THEN 'no columns' WHEN n_cells < 2 THEN 'too few cells' WHEN n_filled > 0 AND n_long / n_filled > 0.5 THEN 'long text cells'
  WHEN cols = 1 AND longest > 300 THEN 'one column of long text' WHEN NOT named AND (cols < 2 OR n_rows < 3) THEN 'no table word and little structure' WHEN n_data > 0 THEN 'ok' WHEN named AND cols >= 2 AND n_cells >= 4 THEN 'ok' ELSE 'little structure' END AS reason, n_rows, n_cells, named FROM j"""


def captions_near(spark, d):
    """Texts next to the tables and images of the books, with the number of the caption."""
    b = book_blocks(spark, d)
    near = regions.near_captions(b.where("block_type in ('formula')"), b)
    return near.select("doc_id", "ord", "text_ord", regions.caption_parts(F.col("caption"))["number"].alias("number"))


_NEAR = BOOK_SQL + """, j AS (SELECT r.doc_id, r.ord, t.ord AS text_ord, row_number() OVER (PARTITION BY r.doc_id, r.ord ORDER BY CASE WHEN r.y0 - t.y1 >= 0 THEN r.y0 - t.y1 ELSE t.y0 - r.y1 END, t.ord) AS k FROM book_blocks r JOIN book_blocks t ON t.doc_id = r.doc_id AND t.page_idx = r.page_idx AND t.ord <> r.ord
  AND (r.y0 - t.y1 BETWEEN 0 AND 50 OR t.y0 - r.y1 BETWEEN 0 AND 30) WHERE r.block_type = 'formula')
SELECT doc_id, ord, text_ord, CAST(NULL AS VARCHAR) AS number FROM j WHERE k = 1"""


def region_conflicts(spark, d):
    """Overlapping regions of a page."""
    b = book_blocks(spark, d)
    tall = b.where("block_type = 'table'").withColumn("y1", F.col("y1") + 45)
    return regions.conflicts(tall, b.where("block_type = 'image'").withColumn("y1", F.col("y1") - 10)).groupBy("doc_id").agg(F.count("*").alias("n_conflicts"), F.round(F.sum("share"), 4).alias("share"))


_CONFLICT = BOOK_SQL + """, j AS (SELECT a.doc_id, round((least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1 + 45, b.y1 - 10) - greatest(a.y0, b.y0)) / least((a.x1 - a.x0) * (a.y1 + 45 - a.y0), (b.x1 - b.x0) * (b.y1 - 10 - b.y0)), 6) AS share
  FROM book_blocks a JOIN book_blocks b ON a.doc_id = b.doc_id AND a.page_idx = b.page_idx WHERE a.block_type = 'table' AND b.block_type = 'image' AND least(a.y1 + 45, b.y1 - 10) > greatest(a.y0, b.y0) AND least(a.x1, b.x1) > greatest(a.x0, b.x0))
SELECT doc_id, count(*) AS n_conflicts, round(sum(share), 4) AS share FROM j WHERE share > 0.4 GROUP BY 1"""


def page_gaps(spark, d):
    """Largest white space of each page of real layouts."""
    b = table(spark, d, "blocks").where("bbox is not null").groupBy(F.col("layout_id").alias("doc_id"), "page_idx", F.col("block_key").alias("ord")).agg(F.min("bbox.y0").alias("y0"), F.max("bbox.y1").alias("y1"))
    return regions.largest_gap(b).select("doc_id", "page_idx", "ord", F.round("gap", 4).alias("gap"))


_PAGE_GAPS = """WITH b AS (SELECT layout_id AS doc_id, page_idx, block_key AS ord, min(bbox.y0) AS y0, max(bbox.y1) AS y1 FROM blocks WHERE bbox IS NOT NULL GROUP BY 1, 2, 3),
g AS (SELECT *, lead(y0) OVER w - max(y1) OVER (PARTITION BY doc_id, page_idx ORDER BY y0, ord ROWS UNBOUNDED PRECEDING) AS gap FROM b WINDOW w AS (PARTITION BY doc_id, page_idx ORDER BY y0, ord)), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY gap DESC, ord) AS k FROM g WHERE gap > 20)
SELECT doc_id, page_idx, ord, round(gap, 4) AS gap FROM r WHERE k = 1"""


def reference_stubs(spark, d):
    """References with their surroundings in segments."""
    return regions.reference_stubs(graph.latest_nodes(table(spark, d, "segments")), "segment_id", "text_content")


def contents_alignment(spark, d):
    """Contents entries matched to headings by page window and similar title."""
    h = segments.headings(book_blocks(spark, d)).where("title like 'Chapter %' or title rlike '^[0-9]'")
    toc = h.select("doc_id", F.col("ord").alias("entry"), F.concat("title", F.lit(" etc")).alias("title"), (F.col("page") + 1).alias("page"))
    return regions.aligned_contents(toc, h)


def word_medians(spark, d):
    """Medians of sizes a page."""
    w = table(spark, d, "lineitem").select((F.col("l_orderkey") % 500).alias("page_id"), F.col("l_quantity").alias("h"), F.col("l_extendedprice").alias("w"))
    return regions.page_medians(w)


_MEDIANS = "SELECT l_orderkey % 500 AS page_id, median(l_quantity) AS median_h, median(l_extendedprice) AS median_w, count(*) AS n_words FROM lineitem GROUP BY 1"


def book_lookup(spark, d):
    """Edition and publisher of each document's book."""
    docs = table(spark, d, "documents").select("doc_id", "book_id")
    return backends.book_metadata(docs, table(spark, d, "books"))


_LOOKUP = "SELECT doc_id, d.book_id, title, edition, publisher FROM documents d LEFT JOIN books b ON b.book_id = d.book_id"


def enrichment_status(spark, d):
    """Status of image enrichment without a backend."""
    b = table(spark, d, "blocks").where("block_type = 'image'")
    return backends.enrich(b, "vision", "block_key", F.element_at(F.col("image_paths"), 1)).groupBy("status", "reason").agg(F.count("*").alias("n_blocks"))


_ENRICH = "SELECT 'skipped' AS status, 'no backend named vision' AS reason, count(*) AS n_blocks FROM blocks WHERE block_type = 'image'"


def main_body(spark, d):
    """Blocks of the main body, by type."""
    b = book_blocks(spark, d).withColumn("text", F.when((F.col("block_type") == "heading") & (F.col("page_idx") >= 100) & F.startswith("text", F.lit("Key Terms")), "Glossary").otherwise(F.col("text")))
    return layout.main_body(b).groupBy("doc_id", "block_type").agg(F.count("*").alias("n_blocks"), F.max("ord").alias("last_ord"))


_MAIN = BOOK_SQL + """, g AS (SELECT *, CASE WHEN block_type = 'heading' AND page_idx >= 100 AND text = 'Key Terms' THEN 'Glossary' ELSE text END AS tx FROM book_blocks),
r AS (SELECT doc_id, min(CASE WHEN block_type = 'heading' AND tx LIKE 'Chapter%' THEN ord END) AS f, min(CASE WHEN block_type = 'heading' AND tx = 'Glossary' THEN ord END) AS b FROM g GROUP BY 1)
SELECT g.doc_id, block_type, count(*) AS n_blocks, max(ord) AS last_ord FROM g JOIN r ON r.doc_id = g.doc_id WHERE ord >= coalesce(f, 0) AND (b IS NULL OR ord < b) GROUP BY 1, 2"""


def special_terms(spark, d):
    """Texts that define a term."""
    return book_blocks(spark, d).where(T.is_special_term(F.col("text"))).groupBy("block_type").agg(F.count("*").alias("n_blocks"), F.min("ord").alias("first_ord"))


_SPECIAL = BOOK_SQL + f"SELECT block_type, count(*) AS n_blocks, min(ord) AS first_ord FROM book_blocks WHERE {_any('lower(text)', P.SPECIAL_TERM, '')} OR (contains(text, ':') AND length(text) <= 140) GROUP BY 1"

QUERIES = {
    f.__name__: f
    for f in (
        segment_kinds, derivation_scores, question_types, given_values, variable_definitions, worked_examples, merged_questions, pruned_segments, unlinked_solutions, chapter_state, chapter_gaps, filled_chapters, chapter_symbols, table_checks,
        captions_near, region_conflicts, page_gaps, reference_stubs, contents_alignment, word_medians, book_lookup, enrichment_status, main_body, special_terms,
    )
}
SQL = {
    "segment_kinds": _KINDS, "derivation_scores": _SCORES, "given_values": _GIVEN, "worked_examples": _ABSORB, "pruned_segments": _PRUNED, "chapter_symbols": _SYMBOL_SCORES, "unlinked_solutions": _UNLINKED, "chapter_state": _STATE, "chapter_gaps": _GAPS, "filled_chapters": _FILLED_CHAPTERS, "table_checks": _CHECKS,
    "captions_near": _NEAR, "region_conflicts": _CONFLICT, "page_gaps": _PAGE_GAPS, "word_medians": _MEDIANS, "book_lookup": _LOOKUP, "enrichment_status": _ENRICH, "main_body": _MAIN, "special_terms": _SPECIAL,
}
