"""Queries on laid-out books, with their SQL.

``book_blocks`` derives 40 laid-out books from ``lineitem`` with the cues that the operators look for;
other queries run on the tables of blocks, segments, edges and cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import formulas as X
from quire.functions import patterns as P
from quire.functions import text as T
from quire.operators import concepts, graph, layout, links, tables
from quire.session import table
from quire.streaming.ingest import windowed_counts

HEIGHT = 750.0

BOOK_SQL = """
WITH lines AS (
  SELECT l_orderkey % 40 AS doc_id, row_number() OVER (PARTITION BY l_orderkey % 40 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS ord,
         l_partkey AS pk, l_suppkey AS sk, CAST(l_quantity AS BIGINT) AS qty FROM lineitem),
placed AS (
  SELECT doc_id, ord, pk, sk, qty, ord % 12 AS slot, CAST(floor(ord / 12) AS BIGINT) AS page_idx, CAST(floor(ord / 60) AS BIGINT) + 1 AS ch, CAST(floor(ord / 12) AS BIGINT) % 5 + 1 AS sec FROM lines),
book_blocks AS MATERIALIZED (
  SELECT doc_id, CAST(ord AS BIGINT) AS ord, CAST(page_idx AS BIGINT) AS page_idx,
    CAST(50.0 + 10 * (sk % 3) AS DOUBLE) AS x0, CAST(60.0 + 55 * slot AS DOUBLE) AS y0, CAST(450.0 + 10 * (sk % 3) AS DOUBLE) AS x1, CAST(100.0 + 55 * slot AS DOUBLE) AS y1,
    CASE WHEN slot IN (0, 1) THEN 'heading' WHEN slot = 4 THEN 'formula' WHEN slot = 8 THEN 'table' WHEN slot = 9 THEN 'image' ELSE 'text' END AS block_type,
    CASE slot
      WHEN 0 THEN CASE WHEN sec = 1 THEN 'Chapter ' || ch || ': Topic ' || (pk % 7) ELSE ch || '.' || sec || ' Section Topic ' || (pk % 7) END
      WHEN 1 THEN CASE sec WHEN 4 THEN 'Concept Check' WHEN 5 THEN 'Problem Sets' ELSE 'Key Terms' END
      WHEN 2 THEN 'The measure ' || (pk % 11) || ' depends on supplier ' || sk || ' and'
      WHEN 3 THEN 'part ' || pk || ' as in Table ' || ch || '.' || sec || '.'
      WHEN 4 THEN 'r = a + ' || qty || ' * beta (' || ch || '.' || sec || ')'
      WHEN 5 THEN CASE WHEN qty % 2 = 0 THEN 'Using Equation (' || ch || '.' || sec || ') we substitute r = ' || qty || ' and rearrange.' ELSE 'Example ' || ch || '.' || sec || ' Given: a = ' || qty || ', find r.' END
      WHEN 6 THEN (qty % 9 + 1) || '. Calculate the return for part ' || pk || '?'
      WHEN 7 THEN 'Solution to Question ' || (qty % 9 + 1) || ': therefore r = ' || qty || '.'
      WHEN 8 THEN 'Table ' || ch || '.' || sec || ' Quantity ' || qty
      WHEN 9 THEN 'Figure ' || ch || '.' || sec || ' Supplier ' || sk
      WHEN 10 THEN '- item ' || pk || ' see Fig. ' || ch || '.' || sec
      ELSE 'Term ' || (pk % 13) || ': value of ' || qty END AS text
  FROM placed)
"""


def book_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The derived books (doc_id, ord, page_idx, box, block_type, text)."""
    li = table(spark, d, "lineitem").select((F.col("l_orderkey") % 40).alias("doc_id"), "l_orderkey", "l_linenumber", F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"), "l_extendedprice", F.col("l_quantity").cast("long").alias("qty"))
    w = Window.partitionBy("doc_id").orderBy("l_orderkey", "l_linenumber", "pk", "sk", "l_extendedprice")
    b = li.withColumn("ord", (F.row_number().over(w) - 1).cast("long"))
    slot, page = F.col("ord") % 12, F.floor(F.col("ord") / 12)
    b = b.withColumns({"slot": slot, "page_idx": page, "ch": F.floor(F.col("ord") / 60) + 1, "sec": page % 5 + 1})
    number, n = F.concat_ws(".", "ch", "sec"), F.col("qty") % 9 + 1
    s, qty, pk, sk = F.col("slot"), F.col("qty"), F.col("pk"), F.col("sk")

    def say(*parts) -> F.Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    text = (
        F.when(s == 0, F.when(F.col("sec") == 1, say("Chapter ", F.col("ch"), ": Topic ", pk % 7)).otherwise(say(number, " Section Topic ", pk % 7)))
        .when(s == 1, F.when(F.col("sec") == 4, "Concept Check").when(F.col("sec") == 5, "Problem Sets").otherwise("Key Terms"))
        .when(s == 2, say("The measure ", pk % 11, " depends on supplier ", sk, " and")).when(s == 3, say("part ", pk, " as in Table ", number, "."))
        .when(s == 4, say("r = a + ", qty, " * beta (", number, ")"))
        .when(s == 5, F.when(qty % 2 == 0, say("Using Equation (", number, ") we substitute r = ", qty, " and rearrange.")).otherwise(say("Example ", number, " Given: a = ", qty, ", find r.")))
        .when(s == 6, say(n, ". Calculate the return for part ", pk, "?")).when(s == 7, say("Solution to Question ", n, ": therefore r = ", qty, "."))
        .when(s == 8, say("Table ", number, " Quantity ", qty)).when(s == 9, say("Figure ", number, " Supplier ", sk)).when(s == 10, say("- item ", pk, " see Fig. ", number))
        .otherwise(say("Term ", pk % 13, ": value of ", qty))
    )
    kind = F.when(s.isin(0, 1), "heading").when(s == 4, "formula").when(s == 8, "table").when(s == 9, "image").otherwise("text")
    left, top = 10.0 * (sk % 3), 55.0 * s
    return b.select("doc_id", "ord", "page_idx", (left + 50).alias("x0"), (top + 60).alias("y0"), (left + 450).alias("x1"), (top + 100).alias("y1"), kind.alias("block_type"), text.alias("text"))


def _any(c: str, patterns: list[str], flags: str = "(?i)") -> str:
    joined = "|".join(f"(?:{p})" for p in patterns).replace("'", "''")
    return f"regexp_matches({c}, '{flags}{joined}')"


# ---- blocks ------------------------------------------------------------------------------------

def block_types(spark, d):
    """Block classes from raw types, and whether the front-matter filter keeps a block."""
    b = table(spark, d, "blocks")
    keep = T.keeps_block(F.col("block_type"), F.col("text"), F.col("page_idx"))
    return b.groupBy(T.map_block_type(F.col("raw_type")).alias("mapped_type"), "block_type", keep.alias("kept")).agg(F.count("*").alias("n_blocks"))


_BLOCK_TYPES = f"""
SELECT CASE WHEN lower(raw_type) IN ('title','header') THEN 'heading' WHEN lower(raw_type) IN ('list','list_item') THEN 'list' WHEN lower(raw_type) = 'table' THEN 'table'
  WHEN lower(raw_type) IN ('image','picture') THEN 'image' WHEN lower(raw_type) IN ('interline_equation','equation') THEN 'formula' ELSE 'text' END AS mapped_type, block_type,
  (block_type IN ('image','table','formula') OR (length(regexp_replace(coalesce(text,''), '^\\s+|\\s+$', '', 'g')) >= 2 AND NOT (page_idx <= 5 AND {_any("lower(coalesce(text,''))", P.FRONT_MATTER, "")}))) AS kept, count(*) AS n_blocks
FROM blocks GROUP BY 1, 2, 3"""


def clean_text(spark, d):
    """Texts of derived books and headings with soft hyphens, control signs and spaced capitals."""
    b = book_blocks(spark, d)
    dirty = F.concat(F.lit("  C H A P T E R\t"), F.col("ord").cast("string"), F.lit("\n "), "text", F.lit(" ­ "))
    return b.select("doc_id", "ord", T.collapse_spaced_capitals(T.normalize_spaces(dirty)).alias("clean"), T.alnum_key(F.col("text")).alias("alnum_key"))


_CLEAN_TEXT = BOOK_SQL + """SELECT doc_id, ord, trim('CHAPTER ' || ord || ' ' || trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS clean, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS alnum_key FROM book_blocks"""


def classify_objects(spark, d):
    """Label, zone and role of every text of the books."""
    o = layout.outline(book_blocks(spark, d)).where("block_type = 'text'")
    o = o.withColumn("segment_type", T.text_object(F.col("text"), F.col("heading_path")))
    o = o.withColumn("qa_zone", T.qa_zone(F.col("heading_path"), F.col("segment_type"))).withColumn("role", T.candidate_role(F.col("segment_type")))
    cand = T.is_candidate(F.col("text"), F.col("role"), F.col("block_type"))
    return o.groupBy("segment_type", "qa_zone", "role", cand.alias("candidate")).agg(F.count("*").alias("n_blocks"), F.min("ord").alias("first_ord"))


_ANCHOR = f"(contains(t, '=') OR contains(t, '->') OR contains(t, '⇒') OR {_any('t', [P.EQUATION_MENTION])})"
_LABEL = f"""CASE WHEN t = '' THEN 'text' WHEN lower(t) LIKE 'note:%' OR lower(t) LIKE 'source:%' THEN 'note'
  WHEN {_any('t', P.SOLUTION)} THEN 'solution_candidate' WHEN {_any('t', P.WORKED_EXAMPLE)} THEN 'worked_example_candidate'
  WHEN {_any('t', P.DERIVATION)} AND ({_any('t', [P.EXPLICIT_DERIVATION])} OR (({_any('t', [P.TRANSFORM])} OR {_any('t', [P.WE_CAN_SHOW])}) AND {_ANCHOR})) THEN 'derivation_candidate'
  WHEN {_any('t', P.CALCULATION)} THEN 'calculation_candidate'
  WHEN contains(h, 'problem set') THEN 'problem_sets' WHEN contains(h, 'concept check') THEN 'concept_check' WHEN contains(h, 'key term') OR contains(h, 'glossary') THEN 'key_terms'
  WHEN contains(h, 'learning objective') THEN 'learning_objectives' WHEN contains(h, 'references') OR contains(h, 'bibliography') THEN 'references'
  WHEN {_any('t', P.LEARNING_OBJECTIVES)} THEN 'learning_objectives' WHEN {_any('t', P.KEY_TERMS)} THEN 'key_terms' WHEN {_any('t', P.PROBLEM_SETS)} THEN 'problem_sets'
  WHEN {_any('t', P.CONCEPT_CHECK_SOLUTION)} THEN 'concept_check_solution' WHEN {_any('t', P.CONCEPT_CHECK)} THEN 'concept_check' WHEN {_any('t', P.PROCEDURE)} THEN 'procedure'
  WHEN {_any('t', P.BULLET)} THEN 'list' WHEN contains(t, ':') AND length(t) <= 200 THEN 'definition' ELSE 'text' END"""
_HEADS = BOOK_SQL + """,
lev AS (SELECT *, CASE WHEN block_type <> 'heading' THEN NULL WHEN regexp_matches(text, '(?i)^(part|chapter)\\b') THEN 1 WHEN regexp_matches(text, '(?i)^section\\b') THEN 2
  WHEN regexp_matches(text, '^\\d') THEN len(string_split(regexp_extract(text, '^(\\d+(?:\\.\\d+)*)', 1), '.')) ELSE 2 END AS level FROM book_blocks),
filled AS (SELECT *, max(CASE WHEN level = 1 THEN ord END) OVER w AS o1, max(CASE WHEN level = 2 THEN ord END) OVER w AS o2 FROM lev WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING)),
outlined AS MATERIALIZED (
  SELECT f.*, CASE WHEN o2 > coalesce(o1, -1) THEN o2 ELSE o1 END AS section_ord, concat_ws(' > ', a.text, CASE WHEN o2 > coalesce(o1, -1) THEN b.text END) AS heading_path
  FROM filled f LEFT JOIN book_blocks a ON a.doc_id = f.doc_id AND a.ord = f.o1 LEFT JOIN book_blocks b ON b.doc_id = f.doc_id AND b.ord = f.o2),
labelled AS (SELECT *, """ + _LABEL + """ AS segment_type FROM (SELECT *, trim(text) AS t, lower(heading_path) AS h FROM outlined WHERE block_type = 'text')),
zoned AS (SELECT *, CASE WHEN contains(h, 'concept check') THEN 'concept_check' WHEN contains(h, 'problem set') OR contains(h, 'review question') OR contains(h, 'exercise') THEN 'problem_set'
  WHEN segment_type IN ('concept_check_solution','solution_candidate') THEN 'concept_check_solution' WHEN segment_type = 'concept_check' THEN 'concept_check' WHEN segment_type = 'problem_sets' THEN 'problem_set' ELSE 'other' END AS qa_zone,
  CASE WHEN segment_type IN ('solution_candidate','concept_check_solution') THEN 'solution_candidate' WHEN segment_type IN ('worked_example_candidate','derivation_candidate','calculation_candidate') THEN segment_type
  WHEN segment_type IN ('problem_sets','concept_check') THEN 'question_candidate' ELSE 'none' END AS role FROM labelled)
"""
_HEADLIKE = f"""(regexp_matches(t, '^\\d+(?:\\.\\d+)+\\s+[A-Z]') OR (len(regexp_extract_all(t, '[A-Za-z]+')) <= 8 AND NOT contains(t, ':') AND NOT contains(t, '=') AND NOT {_any('t', [P.ANSWER_WORDS])} AND regexp_matches(t, '^\\d')))"""
_CLASSIFY = _HEADS + f"SELECT segment_type, qa_zone, role, (length(t) >= 8 AND NOT {_HEADLIKE} AND (role <> 'none' OR {_any('t', P.CANDIDATE)})) AS candidate, count(*) AS n_blocks, min(ord) AS first_ord FROM zoned GROUP BY 1, 2, 3, 4"


def numbering(spark, d):
    """Leading numbers of texts with parent and subpart."""
    b = book_blocks(spark, d).select("doc_id", "ord", T.numbering(F.col("text")).alias("n"), T.is_heading_like(F.col("text")).alias("heading_like"))
    return b.where("n is not null").select("doc_id", "ord", "n.raw", "n.normalized", "n.parent", "n.subpart", "heading_like")


_NUMBERING = BOOK_SQL + f""", r AS (SELECT doc_id, ord, text AS t, coalesce({', '.join(f"nullif(regexp_extract(text, '(?i){p}', 1), '')" for p in P.NUMBERING)}) AS raw FROM book_blocks)
SELECT doc_id, ord, raw, raw AS normalized, CASE WHEN contains(raw, '.') THEN regexp_replace(raw, '\\.[^.]*$', '') ELSE raw END AS parent, CASE WHEN contains(raw, '.') THEN regexp_extract(raw, '([^.]*)$', 1) END AS subpart, {_HEADLIKE} AS heading_like
FROM r WHERE raw IS NOT NULL"""


def title_objects(spark, d):
    """Labels and levels of headings."""
    b = book_blocks(spark, d).where("block_type = 'heading'")
    return b.groupBy(T.title_object(F.col("text")).alias("title_label"), T.heading_level(F.col("text")).alias("level"), T.any_of(F.lower("text"), P.MAIN_BODY).alias("main_body")).agg(F.count("*").alias("n_headings"))


_TITLES = _HEADS + "SELECT CASE " + " ".join(f"WHEN {_any('text', p)} THEN '{name}'" for name, p in P.TITLE_LABELS) + f" ELSE '' END AS title_label, level, {_any('lower(text)', P.MAIN_BODY[:2], '')} AS main_body, count(*) AS n_headings FROM lev WHERE block_type = 'heading' GROUP BY 1, 2, 3"


def refs_linked(spark, d):
    """References of texts with the block that defines them: the last definition wins."""
    b = book_blocks(spark, d)
    return links.linked_references(b.where("block_type = 'text'"), links.reference_index(b.where("block_type in ('image','table','formula')")))


_REF_ROWS = " UNION ALL ".join(f"SELECT doc_id, ord, block_type, '{k}' AS type, unnest(regexp_extract_all(text, '{p}', 1)) AS id FROM book_blocks" for k, p in P.CROSS_REFERENCES)
_REFS = BOOK_SQL + f""", refs AS (SELECT DISTINCT * FROM ({_REF_ROWS})),
idx AS (SELECT doc_id, type, id, max(ord) AS target_ord FROM refs WHERE block_type IN ('image','table','formula') GROUP BY 1, 2, 3)"""
_REFS_LINKED = _REFS + " SELECT r.doc_id, r.type, r.id, r.ord, i.target_ord FROM refs r LEFT JOIN idx i ON r.doc_id = i.doc_id AND r.type = i.type AND r.id = i.id WHERE block_type = 'text'"


def refs_dangling(spark, d):
    """References that nothing in their document defines, by kind."""
    return refs_linked(spark, d).where("target_ord is null").groupBy("type").agg(F.count("*").alias("n_refs"), F.count_distinct("doc_id", "id").alias("n_targets"))


_REFS_DANGLING = _REFS + " SELECT r.type, count(*) AS n_refs, count(DISTINCT (r.doc_id, r.id)) AS n_targets FROM refs r LEFT JOIN idx i ON r.doc_id = i.doc_id AND r.type = i.type AND r.id = i.id WHERE block_type = 'text' AND target_ord IS NULL GROUP BY 1"


def equation_links(spark, d):
    """Texts that mention an equation number, with the formula of that number."""
    b = book_blocks(spark, d)
    f = b.where("block_type = 'formula'").select("doc_id", F.regexp_replace(X.equation_number(F.col("text")), "[()]", "").alias("id"), F.col("ord").alias("formula_ord")).where("id is not null")
    f = f.groupBy("doc_id", "id").agg(F.max("formula_ord").alias("formula_ord"))
    pattern = P.CROSS_REFERENCES[2][1]
    t = b.where("block_type = 'text'").select("doc_id", "ord", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)))).alias("id"))
    return t.join(f, ["doc_id", "id"])


_EQ = BOOK_SQL + f""", f AS (SELECT doc_id, regexp_extract(text, '\\((\\d+(?:\\.\\d+)*)\\)\\s*$', 1) AS id, max(ord) AS formula_ord FROM book_blocks WHERE block_type = 'formula' GROUP BY 1, 2),
t AS (SELECT DISTINCT doc_id, ord, unnest(regexp_extract_all(text, '{P.CROSS_REFERENCES[2][1]}', 1)) AS id FROM book_blocks WHERE block_type = 'text')
SELECT t.doc_id, t.ord, t.id, f.formula_ord FROM t JOIN f ON t.doc_id = f.doc_id AND t.id = f.id"""


def adjacency(spark, d):
    """Neighbours and contexts in reading order of real layouts."""
    b = table(spark, d, "blocks").withColumn("doc_id", F.col("layout_id")).withColumns({"x0": F.col("bbox.x0"), "y0": F.col("bbox.y0")})
    one = b.groupBy("doc_id", "block_key").agg(F.min(F.struct("page_idx", "block_index", "y0", "x0", "text")).alias("b")).select("doc_id", "block_key", "b.*")
    return layout.adjacency(layout.reading_order(one), "block_key", "text").select("doc_id", "block_key", "ord", "prev_id", "next_id", F.char_length("context_before").cast("long").alias("n_before"), F.char_length("context_after").cast("long").alias("n_after"))


_ADJ = """
WITH one AS (SELECT layout_id AS doc_id, block_key, min(page_idx) AS page_idx, min(block_index) AS block_index, min(bbox.y0) AS y0, min(bbox.x0) AS x0, min(text) AS text, count(DISTINCT coalesce(text, '~')) AS k FROM blocks GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_idx, CASE WHEN block_index IS NOT NULL THEN block_index ELSE coalesce(y0, 0) END, CASE WHEN block_index IS NOT NULL THEN 0 ELSE coalesce(x0, 0) END, block_key) - 1 AS ord FROM one)
SELECT doc_id, block_key, ord, lag(block_key) OVER w AS prev_id, lead(block_key) OVER w AS next_id, length(substr(lag(text) OVER w, 1, 200)) AS n_before, length(substr(lead(text) OVER w, 1, 200)) AS n_after
FROM o WINDOW w AS (PARTITION BY doc_id ORDER BY ord)"""


def section_paths(spark, d):
    """Sections with range and path, and the number of blocks that fall in each."""
    o = layout.outline(book_blocks(spark, d))
    n = o.where("section_ord is not null").groupBy("doc_id", F.col("section_ord").alias("start_idx")).agg(F.count("*").alias("n_blocks"))
    return layout.sections(book_blocks(spark, d)).join(n, ["doc_id", "start_idx"])


_SECTIONS = _HEADS + """, heads AS (SELECT *, lead(ord) OVER w AS nxt, lead(page_idx) OVER w AS nxt_page FROM outlined WHERE level IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
ends AS (SELECT doc_id, max(ord) AS last, max(page_idx) AS last_page FROM book_blocks GROUP BY 1), n AS (SELECT doc_id, section_ord, count(*) AS n_blocks FROM outlined WHERE section_ord IS NOT NULL GROUP BY 1, 2)
SELECT h.doc_id, h.ord AS start_idx, coalesce(nxt - 1, last) AS end_idx, text AS title, level, heading_path, page_idx AS start_page, greatest(page_idx, coalesce(nxt_page, last_page)) AS end_page, n_blocks
FROM heads h JOIN ends e ON h.doc_id = e.doc_id JOIN n ON n.doc_id = h.doc_id AND n.section_ord = h.ord"""


def contents_to_block(spark, d):
    """First block on or after the page of each contents entry."""
    b = book_blocks(spark, d)
    toc = b.where("block_type = 'heading' and text like 'Chapter %'").select("doc_id", F.col("ord").alias("entry"), (F.col("page_idx") + 1).alias("page"))
    return layout.forward_block(toc, b)


_TOC = BOOK_SQL + """, toc AS (SELECT doc_id, ord AS entry, page_idx + 1 AS page FROM book_blocks WHERE block_type = 'heading' AND text LIKE 'Chapter %'),
firsts AS (SELECT doc_id, page_idx, min(ord) AS o FROM book_blocks GROUP BY 1, 2)
SELECT t.doc_id, t.entry, t.page, min(f.o) AS block_ord FROM toc t LEFT JOIN firsts f ON f.doc_id = t.doc_id AND f.page_idx >= t.page GROUP BY 1, 2, 3"""


def list_groups(spark, d):
    """Groups of list items."""
    return layout.list_groups(book_blocks(spark, d)).select("doc_id", "group_no", "page_start", "page_end", "n_blocks", F.md5("content").alias("content_md5"))


_ITEM = "(" + " OR ".join([_any("text", P.LIST_ITEM, ""), _any("text", P.PROCEDURE_ITEM)]) + ")"
_LISTS = BOOK_SQL + f""", k AS (SELECT *, CASE WHEN block_type = 'text' AND {_ITEM} THEN 2 WHEN block_type = 'text' AND ({_any("text", [P.CONTINUATION], "")} OR regexp_matches(text, '^[a-z]')) THEN 1 ELSE 0 END AS kind FROM book_blocks),
s AS (SELECT *, max(CASE WHEN kind = 0 THEN ord END) OVER w AS stop, max(CASE WHEN kind = 2 THEN ord END) OVER w AS item FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING)),
i AS (SELECT *, (item IS NOT NULL AND (stop IS NULL OR item > stop) AND kind > 0) AS inside FROM s),
g AS (SELECT *, CASE WHEN inside AND NOT coalesce(lag(inside) OVER (PARTITION BY doc_id ORDER BY ord), false) THEN 1 ELSE 0 END AS start FROM i),
n AS (SELECT *, sum(start) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS group_no FROM g)
SELECT doc_id, CAST(group_no AS BIGINT) AS group_no, min(page_idx) AS page_start, max(page_idx) AS page_end, count(*) AS n_blocks, md5(string_agg(trim(text), chr(10) ORDER BY ord)) AS content_md5 FROM n WHERE inside GROUP BY 1, 2"""


def title_groups(spark, d):
    """Titles with their following texts and box union."""
    return layout.title_groups(book_blocks(spark, d)).select("doc_id", "head_ord", "page_start", "page_end", "x0", "y0", "x1", "y1", "n_blocks", F.md5("content").alias("content_md5"))


_TITLE_GROUPS = BOOK_SQL + """, m AS (SELECT *, max(CASE WHEN block_type = 'heading' THEN ord END) OVER w AS head, max(CASE WHEN block_type IN ('heading','table','image','formula') THEN ord END) OVER w AS stop FROM book_blocks
  WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING))
SELECT doc_id, head AS head_ord, min(page_idx) AS page_start, max(page_idx) AS page_end, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n_blocks, md5(string_agg(trim(text), chr(10) ORDER BY ord)) AS content_md5
FROM m WHERE head = stop GROUP BY 1, 2"""


def furniture_lines(spark, d):
    """Repeated short texts in the edge bands of the pages."""
    b = book_blocks(spark, d)
    f = layout.repeated_lines(b, "page_idx", "text")
    return layout.furniture(b, f, HEIGHT, 0.2, 0.1).groupBy("doc_id", "line").agg(F.count("*").alias("n_blocks"), F.max("n_pages").alias("n_pages"))


_FURNITURE = BOOK_SQL + f""", l AS (SELECT *, lower(regexp_replace(trim(text), '\\s+', ' ', 'g')) AS line FROM book_blocks),
f AS (SELECT doc_id, line, count(DISTINCT page_idx) AS n_pages FROM l WHERE line <> '' AND len(string_split(line, ' ')) <= 8 GROUP BY 1, 2), p AS (SELECT doc_id, count(DISTINCT page_idx) AS pages FROM book_blocks GROUP BY 1)
SELECT l.doc_id, l.line, count(*) AS n_blocks, max(n_pages) AS n_pages FROM l JOIN p ON p.doc_id = l.doc_id LEFT JOIN f ON f.doc_id = l.doc_id AND f.line = l.line
WHERE (y0 < {HEIGHT} * 0.2 OR y1 > {HEIGHT} * (1 - 0.2)) AND (coalesce(n_pages, 0) > 0.1 * pages OR regexp_matches(l.line, '^\\d{{1,4}}$')) GROUP BY 1, 2"""


def stitched(spark, d):
    """Paragraphs joined over block breaks."""
    return layout.stitch(book_blocks(spark, d), HEIGHT)


# ---- formulas ----------------------------------------------------------------------------------

def formula_items(spark, d):
    """Number, key, symbols, usage and meaning of every formula of the books."""
    o = layout.outline(book_blocks(spark, d)).where("block_type = 'formula'")
    t = F.col("text")
    o = o.withColumn("equation_number", X.equation_number(t)).withColumn("usage_type", X.usage_type(t, F.col("heading_path")))
    return o.select("doc_id", "ord", "equation_number", X.canonical_key(t).alias("canonical_key"), F.array_join(X.symbols(t), ",").alias("symbols"), "usage_type", X.short_meaning(t, F.col("usage_type"), F.col("equation_number")).alias("short_meaning"), X.needs_review(t, F.col("equation_number")).alias("needs_review"))


_FORMULAS = _HEADS + f"""SELECT doc_id, ord, '(' || regexp_extract(text, '\\((\\d+(?:\\.\\d+)*)\\)\\s*$', 1) || ')' AS equation_number, md5(regexp_replace(text, '\\s+', '', 'g')) AS canonical_key,
  array_to_string(list_sort(list_distinct(list_concat(regexp_extract_all(text, '\\b([a-zA-Z])\\b', 1), regexp_extract_all(text, '(?i)\\b({'|'.join(P.GREEK)})\\b', 1)))), ',') AS symbols,
  CASE WHEN regexp_matches(lower(heading_path), 'key equations|definition|notation') THEN 'definition' ELSE 'application' END AS usage_type,
  'Computes ' || trim(string_split(text, '=')[1]) || ' from related inputs (' || CASE WHEN regexp_matches(lower(heading_path), 'key equations|definition|notation') THEN 'definition' ELSE 'application' END || ').' AS short_meaning, false AS needs_review
FROM outlined WHERE block_type = 'formula'"""


def formula_canonical(spark, d):
    """Canonical formula of each book, chapter and key, and its duplicates."""
    s = graph.latest_nodes(table(spark, d, "segments")).where("segment_type = 'formula' and canonical_formula_key is not null")
    s = s.withColumn("y0", F.col("bbox.y0"))
    return graph.canonical_formulas(s).groupBy("canonical_id").agg(F.count("*").alias("n_formulas"), F.count_if("is_duplicate").alias("n_duplicates")).where("n_formulas > 1")


_LATEST = """
WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(segment_id)) ORDER BY loaded_at DESC NULLS LAST, heading_path DESC NULLS LAST, segment_id) AS r FROM segments) WHERE r = 1)"""
_CANONICAL = _LATEST + """, c AS (SELECT segment_id, first_value(segment_id) OVER (PARTITION BY book_id, chapter_number, canonical_formula_key ORDER BY page_start NULLS FIRST, bbox.y0 NULLS FIRST, segment_id) AS canonical_id
  FROM latest WHERE segment_type = 'formula' AND canonical_formula_key IS NOT NULL)
SELECT canonical_id, count(*) AS n_formulas, count(*) FILTER (WHERE segment_id <> canonical_id) AS n_duplicates FROM c GROUP BY 1 HAVING count(*) > 1"""


def symbol_overlap(spark, d):
    """Top formulas of each derivation by shared symbols."""
    b = book_blocks(spark, d)
    f = b.where("block_type = 'formula'").withColumn("symbols", X.symbols(F.col("text")))
    t = b.where("block_type = 'text' and text like 'Using Equation%'").withColumn("symbols", X.symbols(F.col("text")))
    return links.shared_symbols(f, t, pages=2).withColumn("score", F.round("score", 6))


_SYMBOLS = "list_distinct(list_concat(regexp_extract_all(text, '\\b([a-zA-Z])\\b', 1), regexp_extract_all(text, '(?i)\\b(" + "|".join(P.GREEK) + ")\\b', 1)))"
_OVERLAP = BOOK_SQL + f""", f AS (SELECT doc_id, ord AS formula_ord, page_idx AS fp, unnest({_SYMBOLS}) AS symbol FROM book_blocks WHERE block_type = 'formula'),
t AS (SELECT doc_id, ord, page_idx, unnest({_SYMBOLS}) AS symbol FROM book_blocks WHERE block_type = 'text' AND text LIKE 'Using Equation%'),
s AS (SELECT t.doc_id, t.ord, f.formula_ord, count(*) - any_value(abs(page_idx - fp)) / 4.0 AS score FROM t JOIN f ON t.doc_id = f.doc_id AND t.symbol = f.symbol AND abs(page_idx - fp) <= 2 GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, ord ORDER BY score DESC, formula_ord) AS rank FROM s)
SELECT doc_id, ord, formula_ord, round(score, 6) AS score, rank FROM r WHERE rank <= 3"""


# ---- links -------------------------------------------------------------------------------------

def source_match(spark, d):
    """Chunk with most overlap for each derivation, among the blocks of its page."""
    b = book_blocks(spark, d)
    seg = b.where("block_type = 'text' and text like 'Using Equation%'").withColumns({"y0": F.col("y0") - 30, "y1": F.col("y1") + 10})
    return links.source_match(seg, b.where("block_type = 'text'"))


_SOURCE = BOOK_SQL + """, s AS (SELECT doc_id, ord, page_idx, x0, y0 - 30 AS y0, x1, y1 + 10 AS y1 FROM book_blocks WHERE block_type = 'text' AND text LIKE 'Using Equation%'),
c AS (SELECT * FROM book_blocks WHERE block_type = 'text'),
j AS (SELECT s.doc_id, s.ord, c.ord AS chunk_ord, s.page_idx - c.page_idx AS tier,
  greatest(0, least(s.x1, c.x1) - greatest(s.x0, c.x0)) * greatest(0, least(s.y1, c.y1) - greatest(s.y0, c.y0)) / ((s.x1 - s.x0) * (s.y1 - s.y0)) AS overlap, abs((s.y0 + s.y1) / 2 - (c.y0 + c.y1) / 2) AS dist
  FROM s JOIN c ON s.doc_id = c.doc_id AND c.page_idx IN (s.page_idx, s.page_idx - 1)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, ord ORDER BY tier, overlap DESC, dist, chunk_ord) AS k FROM j)
SELECT doc_id, ord, chunk_ord, CAST(tier AS INTEGER) AS tier, round(overlap, 6) AS overlap FROM r WHERE k = 1"""


def region_blocks(spark, d):
    """Blocks near a question of their page."""
    b = book_blocks(spark, d)
    return links.near_regions(b, b.where("text like '%. Calculate%'")).groupBy("doc_id", "block_type").agg(F.count("*").alias("n_blocks"))


_REGION = BOOK_SQL + """SELECT b.doc_id, b.block_type, count(*) AS n_blocks FROM book_blocks b WHERE EXISTS (SELECT 1 FROM book_blocks r WHERE r.doc_id = b.doc_id AND r.page_idx = b.page_idx AND r.text LIKE '%. Calculate%' AND b.y0 <= r.y1 + 140 AND b.y1 >= r.y0 - 140) GROUP BY 1, 2"""


def _qa(spark, d):
    o = layout.outline(book_blocks(spark, d)).where("block_type = 'text'")
    o = o.withColumns({"chapter": T.chapter_main(F.col("heading_path")), "zone": T.qa_zone(F.col("heading_path"), F.lit("")), "words": F.slice(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))), 1, 20)})
    q = o.where("text like '%. Calculate%'").withColumn("num", F.regexp_extract("text", r"^(\d+)\.", 1))
    s = o.where("text like 'Solution to Question %'").withColumn("num", F.regexp_extract("text", r"^Solution to Question (\d+)", 1))
    return q, s


def answer_score(spark, d):
    """Best question of each solution by the additive score."""
    return links.answer_scores(*_qa(spark, d))


_QA = _HEADS + """, qa AS (SELECT *, CASE WHEN regexp_matches(heading_path, '(?i)(?:chapter|ch)\\s+\\d+') THEN regexp_extract(heading_path, '(?i)(?:chapter|ch)\\s+(\\d+)', 1) END AS chapter,
  CASE WHEN contains(h, 'concept check') THEN 'concept_check' WHEN contains(h, 'problem set') THEN 'problem_set' ELSE 'other' END AS zone, list_distinct(regexp_extract_all(lower(text), '[a-z]+'))  AS words FROM labelled),
q AS (SELECT *, regexp_extract(text, '^(\\d+)\\.', 1) AS num FROM qa WHERE text LIKE '%. Calculate%'), s AS (SELECT *, regexp_extract(text, '^Solution to Question (\\d+)', 1) AS num FROM qa WHERE text LIKE 'Solution to Question %'),
j AS (SELECT s.doc_id, s.ord, q.ord AS q_ord, round(CASE WHEN s.num = q.num THEN 0.7 ELSE 0 END + CASE WHEN s.zone = q.zone THEN 0.2 ELSE 0 END + 0.1 + 0.2 * len(list_intersect(s.words, q.words)) / len(list_distinct(list_concat(s.words, q.words))), 6) AS score
  FROM s JOIN q ON s.doc_id = q.doc_id AND s.chapter = q.chapter), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, ord ORDER BY score DESC, q_ord) AS k FROM j WHERE score >= 0.75)
SELECT doc_id, ord, q_ord, score FROM r WHERE k = 1"""


def answer_assignment(spark, d):
    """One-to-one assignment of solutions to questions by tiers."""
    return links.assign_answers(*_qa(spark, d))


def nearest_chapter(spark, d):
    """Chapter nearest in pages to each question."""
    b = book_blocks(spark, d)
    marks = b.where("text like 'Chapter %'").withColumn("chapter", F.regexp_extract("text", r"Chapter (\d+)", 1))
    return links.nearest_chapter(b.where("text like '%. Calculate%'"), marks)


_NEAREST = BOOK_SQL + """, m AS (SELECT doc_id, page_idx AS mp, min(ord) AS mo, arg_min(regexp_extract(text, 'Chapter (\\d+)', 1), ord) AS chapter FROM book_blocks WHERE text LIKE 'Chapter %' GROUP BY 1, 2),
j AS (SELECT b.doc_id, b.ord, m.chapter, row_number() OVER (PARTITION BY b.doc_id, b.ord ORDER BY abs(page_idx - mp), mo) AS k FROM book_blocks b JOIN m ON m.doc_id = b.doc_id AND abs(page_idx - mp) <= 120 WHERE text LIKE '%. Calculate%')
SELECT doc_id, ord, chapter FROM j WHERE k = 1"""


# ---- graph -------------------------------------------------------------------------------------

def _nodes(spark, d):
    s = graph.latest_nodes(table(spark, d, "segments").where("deleted_at is null")).select(graph.node_id(F.col("segment_id")).alias("node_id"), F.col("segment_type").alias("kind"), F.col("page_start").alias("page"))
    c = table(spark, d, "concepts").select(graph.node_id(F.col("concept_id")).alias("node_id"), F.lit("concept").alias("kind"), F.lit(None).cast("int").alias("page")).distinct()
    return s.unionByName(c)


_GRAPH = """
WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(segment_id)) ORDER BY loaded_at DESC NULLS LAST, heading_path DESC NULLS LAST, segment_id) AS r FROM segments WHERE deleted_at IS NULL) WHERE r = 1),
nodes AS (SELECT lower(trim(segment_id)) AS node_id, segment_type AS kind, page_start AS page FROM latest UNION ALL SELECT DISTINCT lower(trim(concept_id)), 'concept', NULL FROM concepts),
e0 AS (SELECT edge_id, lower(trim(source_id)) AS source_id, lower(trim(target_id)) AS target_id, regexp_replace(upper(trim(edge_type)), '[- ]', '_', 'g') AS edge_type,
  row_number() OVER (PARTITION BY edge_id ORDER BY loaded_at DESC NULLS LAST, strength DESC NULLS LAST) AS r FROM edges),
ed AS (SELECT edge_id, source_id, target_id, edge_type FROM e0 WHERE r = 1)"""


def graph_edges(spark, d):
    """Distinct edges between known nodes, by type."""
    e = graph.evidence(graph.known_ends(graph.edge_rows(table(spark, d, "edges")), _nodes(spark, d)))
    return e.groupBy("edge_type").agg(F.count("*").alias("n_pairs"), F.sum("n_edges").alias("n_edges"))


_GRAPH_EDGES = _GRAPH + """, known AS (SELECT * FROM ed WHERE source_id IN (SELECT node_id FROM nodes) AND target_id IN (SELECT node_id FROM nodes)), p AS (SELECT source_id, target_id, edge_type, count(*) AS n FROM known GROUP BY 1, 2, 3)
SELECT edge_type, count(*) AS n_pairs, CAST(sum(n) AS BIGINT) AS n_edges FROM p GROUP BY 1"""


def graph_dangling(spark, d):
    """Edges without a target node, by type."""
    return graph.dangling(graph.edge_rows(table(spark, d, "edges")), _nodes(spark, d)).groupBy("edge_type").agg(F.count("*").alias("n_edges"))


_GRAPH_DANGLING = _GRAPH + " SELECT edge_type, count(*) AS n_edges FROM ed WHERE target_id IS NULL OR target_id NOT IN (SELECT node_id FROM nodes WHERE node_id IS NOT NULL) GROUP BY 1"


def graph_admitted(spark, d):
    """Edges that the admission rules keep, by types of both ends."""
    return graph.admitted(graph.edge_rows(table(spark, d, "edges")), _nodes(spark, d)).groupBy("source_kind", "edge_type", "target_kind").agg(F.count("*").alias("n_edges"))


_KEPT = "('question','solution','derivation','worked_example','calculation','reference_stub')"
_GRAPH_ADMITTED = _GRAPH + f""" SELECT s.kind AS source_kind, edge_type, t.kind AS target_kind, count(*) AS n_edges FROM ed JOIN nodes s ON s.node_id = source_id JOIN nodes t ON t.node_id = target_id
WHERE (s.kind IN {_KEPT} AND t.kind IN {_KEPT}) OR (s.kind IN {_KEPT} AND t.kind = 'formula' AND edge_type IN ('USES_FORMULA','EXPLAINS','REFERENCES')) OR edge_type = 'WORKED_EXAMPLE_OF' OR (s.kind = 'formula' AND t.kind = 'concept' AND edge_type = 'DEFINES') OR edge_type = 'DUPLICATE_OF'
GROUP BY 1, 2, 3"""


def graph_counts(spark, d):
    """Nodes by kind."""
    return graph.node_counts(_nodes(spark, d))


def graph_chains(spark, d):
    """Formula, example, question and solution chains."""
    return graph.chains(graph.edge_rows(table(spark, d, "edges")), _nodes(spark, d))


def _chain_hop(name: str, kind: str, types: str, at: str, rows: str, keep: str) -> str:
    return f"""{name} AS (SELECT {keep}, e.source_id AS {name}_id FROM {rows} r JOIN (SELECT DISTINCT source_id, target_id FROM ed WHERE edge_type IN ({types})) e ON e.target_id = r.{at} JOIN nodes n ON n.node_id = e.source_id AND n.kind = '{kind}'
  QUALIFY row_number() OVER (PARTITION BY {keep} ORDER BY abs(n.page - r.page) NULLS FIRST, e.source_id) = 1)"""


_USES = "'USES_FORMULA', 'REFERENCES', 'EXPLAINS'"
_CHAIN = _GRAPH + """, f AS (SELECT node_id AS formula_id, page FROM nodes WHERE kind = 'formula'), """ + ", ".join([
    _chain_hop("example", "worked_example", _USES, "formula_id", "f", "formula_id, r.page"),
    _chain_hop("question", "question", _USES, "formula_id", "example", "formula_id, r.page, example_id"),
    _chain_hop("solution", "solution", "'ANSWER_OF', 'REFERENCES', 'EXPLAINS'", "question_id", "question", "formula_id, r.page, example_id, question_id"),
]) + " SELECT formula_id, example_id, question_id, solution_id FROM solution"


def question_status(spark, d):
    """Questions by solution status."""
    q = _nodes(spark, d).where("kind = 'question'")
    return graph.question_status(q, graph.edge_rows(table(spark, d, "edges"))).groupBy("solution_status").agg(F.count("*").alias("n_questions"))


_STATUS = _GRAPH + " SELECT CASE WHEN node_id IN (SELECT target_id FROM ed WHERE edge_type = 'ANSWER_OF' AND target_id IS NOT NULL) THEN 'linked' ELSE 'not_found_in_book' END AS solution_status, count(*) AS n_questions FROM nodes WHERE kind = 'question' GROUP BY 1"


def quality_stats(spark, d):
    """Counts and link rates of all segments."""
    return graph.quality(graph.latest_nodes(table(spark, d, "segments")))


_QUALITY = _LATEST + """ SELECT count(*) AS n_segments, count(*) FILTER (WHERE segment_type = 'question') AS n_questions, count(*) FILTER (WHERE segment_type = 'solution') AS n_solutions,
  round(avg(CASE WHEN segment_type = 'solution' THEN CASE WHEN solution_for_question_id IS NOT NULL THEN 1.0 ELSE 0.0 END END), 6) AS solution_link_rate,
  round(avg(CASE WHEN segment_type = 'derivation' THEN CASE WHEN derived_to_formula_id IS NOT NULL THEN 1.0 ELSE 0.0 END END), 6) AS derivation_link_rate,
  round(avg(CASE WHEN needs_human_review THEN 1.0 WHEN NOT needs_human_review THEN 0.0 END), 6) AS review_rate FROM latest"""


def chapter_rollup(spark, d):
    """Chapters with title, size and solutions."""
    return graph.chapters(graph.latest_nodes(table(spark, d, "segments")))


_CHAPTERS = _LATEST + """ SELECT book_id, chapter_number, min(chapter_title) AS chapter_title, count(*) AS n_segments, bool_or(segment_type = 'solution') AS solutions_present, min(page_start) AS first_page, len(string_split(chapter_number, '.')) AS level
FROM latest WHERE regexp_matches(chapter_number, '^\\d+(\\.\\d+)*$') GROUP BY 1, 2"""


# ---- concepts ----------------------------------------------------------------------------------

def concept_top5(spark, d):
    """Best concepts of each segment by weighted terms."""
    s = graph.latest_nodes(table(spark, d, "segments")).select("segment_id", F.col("text_content").alias("text"))
    c = table(spark, d, "concepts").select("concept_id", F.concat_ws(" ", "concept_name", "description", F.array_join("tags", " ")).alias("concept_text"))
    return concepts.concept_links(s, c)


_CONCEPTS = _LATEST + """, c AS (SELECT concept_id, concat_ws(' ', concept_name, description, array_to_string(tags, ' ')) AS text FROM concepts),
ct AS (SELECT concept_id, term, count(*) AS tf FROM (SELECT concept_id, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS term FROM c) GROUP BY 1, 2), dfs AS (SELECT term, count(*) AS df FROM ct GROUP BY 1), n AS (SELECT count(DISTINCT concept_id) AS n FROM c),
cw AS (SELECT concept_id, term, tf * (1 + n / (df + 1)) AS w FROM ct JOIN dfs USING (term), n), cn AS (SELECT concept_id, sqrt(sum(w * w)) AS norm FROM cw GROUP BY 1),
st AS (SELECT segment_id, term, count(*) AS tf FROM (SELECT segment_id, unnest(regexp_extract_all(lower(text_content), '[a-z]{3,}')) AS term FROM latest) GROUP BY 1, 2),
sw AS (SELECT segment_id, term, tf * (1 + n / (df + 1)) AS w FROM st JOIN dfs USING (term), n), sn AS (SELECT segment_id, sqrt(sum(w * w)) AS norm FROM sw GROUP BY 1),
dots AS (SELECT sw.segment_id, cw.concept_id, sum(sw.w * cw.w) / (any_value(sn.norm) * any_value(cn.norm)) AS score FROM sw JOIN cw ON sw.term = cw.term JOIN sn ON sn.segment_id = sw.segment_id JOIN cn ON cn.concept_id = cw.concept_id GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY round(score, 6) DESC, concept_id) AS rank FROM dots WHERE score > 0.18)
SELECT segment_id, concept_id, round(score, 6) AS score, rank FROM r WHERE rank <= 5"""


def concept_phrases(spark, d):
    """Segments that hold a name or alias of a concept as a phrase, by concept."""
    s = graph.latest_nodes(table(spark, d, "segments")).select("segment_id", F.col("text_content").alias("text"))
    a = table(spark, d, "concepts").select("concept_id", F.explode(F.concat(F.array("concept_name"), F.coalesce("aliases", F.array()))).alias("alias"))
    return concepts.phrase_links(s, a).groupBy("concept_id").agg(F.count("*").alias("n_segments"))


_PHRASES = _LATEST + """, a AS (SELECT DISTINCT concept_id, trim(lower(regexp_replace(alias, '[^A-Za-z0-9]+', ' ', 'g'))) AS gram FROM (SELECT concept_id, unnest(list_concat([concept_name], coalesce(aliases, []))) AS alias FROM concepts)),
s AS (SELECT segment_id, ' ' || trim(lower(regexp_replace(text_content, '[^A-Za-z0-9]+', ' ', 'g'))) || ' ' AS t FROM latest)
SELECT concept_id, count(DISTINCT segment_id) AS n_segments FROM a JOIN s ON contains(t, ' ' || gram || ' ') WHERE gram <> '' GROUP BY 1"""


def concept_pages(spark, d):
    """Pages of each concept, parsed."""
    return table(spark, d, "concepts").where("pages is not null").select("concept_id", F.explode(T.page_list(F.col("pages"))).alias("page"))


_CONCEPT_PAGES = """WITH p AS (SELECT concept_id, regexp_replace(unnest(string_split_regex(pages, '[,;]')), '\\s', '', 'g') AS x FROM concepts WHERE pages IS NOT NULL),
e AS (SELECT concept_id, CAST(regexp_extract(x, '^(\\d+)', 1) AS INTEGER) AS a, CAST(regexp_extract(x, '(\\d+)$', 1) AS INTEGER) AS b FROM p WHERE regexp_matches(x, '^\\d+(-\\d+)?$'))
SELECT DISTINCT concept_id, CAST(unnest(range(least(a, b), greatest(a, b) + 1)) AS INTEGER) AS page FROM e"""


def embedding_top5(spark, d):
    """Five nearest vectors of every query vector (ids divisible by 50), against all vectors."""
    v = table(spark, d, "embeddings")
    return concepts.nearest_vectors(v, "vec_id", "embedding", v.where("vec_id % 50 = 0"))


_EMBED = """
WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS a FROM embeddings WHERE vec_id % 50 = 0), j AS (SELECT query_id, vec_id AS neighbour_id, round(list_cosine_similarity(a, CAST(embedding AS DOUBLE[])), 9) AS s FROM q, embeddings WHERE vec_id <> query_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, neighbour_id) AS rank FROM j) SELECT query_id, neighbour_id, round(s, 6) AS score, rank FROM r WHERE rank <= 5"""


# ---- tables ------------------------------------------------------------------------------------

def _cells(spark, d):
    return tables.one_cell_each(table(spark, d, "cell_meta"))


_ONE_CELL = """
WITH one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY loaded_at DESC NULLS LAST, raw_value NULLS FIRST, normalized_value NULLS FIRST) AS r FROM cell_meta) WHERE r = 1),
typed AS (SELECT *, trim(coalesce(raw_value, '')) AS v FROM one), kinds AS (SELECT *, CASE WHEN v = '' THEN 'blank'
  WHEN (regexp_matches(v, '^[=@]') OR regexp_matches(v, '[+\\-*/=]')) AND (contains(v, 'SUM') OR contains(v, 'AVG') OR contains(v, 'IF') OR contains(v, 'VLOOKUP') OR contains(v, '=')) THEN 'formula'
  WHEN regexp_matches(v, '^\\$[\\d,]+(\\.\\d{2})?$') OR contains(upper(v), 'USD') THEN 'currency' WHEN v LIKE '%\\%' ESCAPE '\\' OR contains(lower(v), 'percent') THEN 'percent' WHEN regexp_matches(v, '^\\d{1,2}[/-]\\d{1,2}[/-]\\d{2,4}') THEN 'date'
  WHEN regexp_matches(replace(v, ',', ''), '^\\d+(\\.\\d+)?$') THEN 'number' ELSE 'text' END AS detected_type FROM typed)"""
_NUM = """CASE detected_type WHEN 'currency' THEN try_cast(regexp_replace(raw_value, '[$,\\s]', '', 'g') AS DOUBLE) WHEN 'percent' THEN try_cast(regexp_replace(raw_value, '[%\\s]', '', 'g') AS DOUBLE) / 100
  WHEN 'number' THEN try_cast(regexp_replace(raw_value, '[,\\s]', '', 'g') AS DOUBLE) END"""


def cell_types(spark, d):
    """Detected against stored cell types, with numbers."""
    c = _cells(spark, d)
    t = tables.typed_cells(c).join(c.select("cell_id", "cell_type"), "cell_id")
    return t.groupBy("cell_type", "detected_type").agg(F.count("*").alias("n_cells"), F.count("num_value").alias("n_numbers"))


_CELL_TYPES = _ONE_CELL + f" SELECT cell_type, detected_type, count(*) AS n_cells, count({_NUM}) AS n_numbers FROM kinds GROUP BY 1, 2"


def table_fill(spark, d):
    """Rows and filled cells of every table."""
    return tables.fill_rate(_cells(spark, d))


_FILL = _ONE_CELL + """, r AS (SELECT segment_id, row_index, sum(CASE WHEN v <> '' THEN 1 ELSE 0 END) AS f FROM typed GROUP BY 1, 2) SELECT segment_id, count(*) AS n_rows, count(*) FILTER (WHERE f > 0) AS n_filled_rows, round(avg(f), 6) AS mean_filled FROM r GROUP BY 1"""


def table_markdown(spark, d):
    """Markdown of every table, as a hash."""
    return tables.markdown(_cells(spark, d)).select("segment_id", F.md5("markdown").alias("markdown_md5"))


_MARKDOWN = _ONE_CELL + """, l AS (SELECT segment_id, row_index, '| ' || string_agg(regexp_replace(replace(coalesce(raw_value, ''), '|', '\\|'), '\\s*\\n\\s*', ' ', 'g'), ' | ' ORDER BY col_index NULLS FIRST, raw_value) || ' |' AS line, count(*) AS n FROM one GROUP BY 1, 2),
f AS (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY row_index) AS k FROM l)
SELECT segment_id, md5(string_agg(CASE WHEN k = 1 THEN line || chr(10) || '|' || repeat('---|', n) ELSE line END, chr(10) ORDER BY k)) AS markdown_md5 FROM f GROUP BY 1"""


def computed_columns(spark, d):
    """Columns that are a constant multiple of another."""
    return tables.computed_columns(tables.typed_cells(_cells(spark, d)))


_COMPUTED = _ONE_CELL + f""", v AS (SELECT segment_id, row_index, col_index, {_NUM} AS x FROM kinds WHERE row_index <= 9), p AS (SELECT a.segment_id, a.col_index AS from_col, b.col_index AS to_col, round(b.x / a.x, 9) AS q FROM v a JOIN v b ON a.segment_id = b.segment_id AND a.row_index = b.row_index AND a.col_index < b.col_index
  WHERE a.x IS NOT NULL AND b.x IS NOT NULL AND a.x <> 0 AND b.x <> 0) SELECT segment_id, from_col, to_col, count(*) AS n_rows, min(q) AS ratio FROM p GROUP BY 1, 2, 3 HAVING count(*) >= 2 AND min(q) = max(q)"""


def table_mentions(spark, d):
    """Documents that mention a table of their book by number."""
    t = table(spark, d, "documents").select("book_id", F.col("doc_id").alias("item_id"), "text")
    return tables.cross_table_mentions(t, table(spark, d, "table_segments"))


_MENTIONS = """WITH m AS (SELECT DISTINCT book_id, doc_id AS item_id, unnest(regexp_extract_all(text, '(?:^|[^\\p{L}\\p{N}_])[Tt]able\\s+(\\d+(?:\\.\\d+)*)', 1)) AS table_number FROM documents)
SELECT DISTINCT item_id, segment_id FROM m JOIN (SELECT DISTINCT book_id, table_number, segment_id FROM table_segments) t ON m.book_id = t.book_id AND m.table_number = t.table_number"""


def word_rows(spark, d):
    """Rows of word positions by running average."""
    e = table(spark, d, "lineitem").select((F.col("l_orderkey") % 200).alias("page_id"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("word_id"), (F.col("l_partkey") % 700).cast("double").alias("y"))
    return layout.cluster_rows(e, 6.0).groupBy("page_id").agg(F.max("row_no").alias("last_row"), F.count("*").alias("n_words"))


def legend_groups(spark, d):
    """Neighbouring words grouped where the gap is small."""
    e = table(spark, d, "lineitem").select((F.col("l_orderkey") % 200).alias("page_id"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("item_id"), (F.col("l_extendedprice") % 700).alias("y"))
    return layout.gap_groups(e, "page_id", "y", 5.0).groupBy("page_id").agg(F.max("group_no").alias("n_gaps"), F.count("*").alias("n_words"))


_LEGEND = """WITH e AS (SELECT l_orderkey % 200 AS page_id, l_extendedprice % 700 AS y FROM lineitem), g AS (SELECT *, y - lag(y) OVER (PARTITION BY page_id ORDER BY y) AS gap FROM e)
SELECT page_id, count(*) FILTER (WHERE gap > 5) AS n_gaps, count(*) AS n_words FROM g GROUP BY 1"""


def event_windows(spark, d):
    """Extension: events and value an hour and type."""
    return windowed_counts(table(spark, d, "events")).withColumn("sum_value", F.round("sum_value", 4))


_EVENTS = "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n_events, round(sum(value), 4) AS sum_value FROM events GROUP BY 1, 2"

QUERIES = {
    f.__name__: f
    for f in (
        block_types, clean_text, classify_objects, numbering, title_objects, refs_linked, refs_dangling, equation_links, adjacency, section_paths, contents_to_block, list_groups, title_groups, furniture_lines, stitched,
        formula_items, formula_canonical, symbol_overlap, source_match, region_blocks, answer_score, answer_assignment, nearest_chapter, graph_edges, graph_dangling, graph_admitted, graph_counts, graph_chains, question_status,
        quality_stats, chapter_rollup, concept_top5, concept_phrases, concept_pages, embedding_top5, cell_types, table_fill, table_markdown, computed_columns, table_mentions, word_rows, legend_groups, event_windows,
    )
}
SQL = {
    "block_types": _BLOCK_TYPES, "clean_text": _CLEAN_TEXT, "classify_objects": _CLASSIFY, "numbering": _NUMBERING, "title_objects": _TITLES, "refs_linked": _REFS_LINKED, "refs_dangling": _REFS_DANGLING, "equation_links": _EQ, "adjacency": _ADJ,
    "section_paths": _SECTIONS, "contents_to_block": _TOC, "list_groups": _LISTS, "title_groups": _TITLE_GROUPS, "furniture_lines": _FURNITURE, "formula_items": _FORMULAS, "formula_canonical": _CANONICAL, "symbol_overlap": _OVERLAP,
    "source_match": _SOURCE, "region_blocks": _REGION, "answer_score": _QA, "nearest_chapter": _NEAREST, "graph_edges": _GRAPH_EDGES, "graph_dangling": _GRAPH_DANGLING, "graph_admitted": _GRAPH_ADMITTED,
    "graph_counts": _GRAPH + " SELECT kind, count(*) AS n_nodes FROM nodes GROUP BY 1", "graph_chains": _CHAIN, "question_status": _STATUS, "quality_stats": _QUALITY, "chapter_rollup": _CHAPTERS, "concept_top5": _CONCEPTS, "concept_phrases": _PHRASES, "concept_pages": _CONCEPT_PAGES,
    "embedding_top5": _EMBED, "cell_types": _CELL_TYPES, "table_fill": _FILL, "table_markdown": _MARKDOWN, "computed_columns": _COMPUTED, "table_mentions": _MENTIONS, "legend_groups": _LEGEND, "event_windows": _EVENTS,
}
