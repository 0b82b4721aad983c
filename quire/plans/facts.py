"""Queries on the tables of segments, concepts, tables, blocks and edges, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import formulas as X
from quire.functions import qa
from quire.operators import concepts as C
from quire.operators import graph, links, tables
from quire.session import table

_KIND = "CASE WHEN contains(lower(heading_path), 'concept check') THEN 'concept_check' WHEN contains(lower(heading_path), 'problem set') THEN 'problem_set' WHEN contains(lower(heading_path), 'cfa') THEN 'cfa' END"


def _segments(spark, d, *types):
    s = graph.latest_nodes(table(spark, d, "segments"))
    return s.where(F.col("segment_type").isin(*types)) if types else s


def _set_type():
    h = F.lower("heading_path")
    return F.when(F.contains(h, F.lit("concept check")), "concept_check").when(F.contains(h, F.lit("problem set")), "problem_set").when(F.contains(h, F.lit("cfa")), "cfa")


_LATEST = """
WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(segment_id)) ORDER BY loaded_at DESC NULLS LAST, heading_path DESC NULLS LAST, segment_id) AS r FROM segments) WHERE r = 1)"""


def _number_sql(c: str) -> str:
    bare = f"regexp_replace(regexp_replace(lower(trim({c})), '^(?:question|problem|q)\\s*\\.?\\s*', ''), '[()\\s]', '', 'g')"
    return f"coalesce(nullif(regexp_extract({bare}, '^(\\d+(?:\\.\\d+)*[a-z]?)$', 1), ''), nullif(regexp_extract({bare}, '(\\d+[a-z]?)', 1), ''))"


def _answers_sql(c: str) -> str:
    part = "(\\d+)\\s*\\(?([a-z])?\\)?"
    ps = [f"(?i){start}{part}" for start in ("solution\\s+to\\s+(?:question\\s+)?(?:q\\s*)?", "answer\\s+to\\s+(?:question\\s+)?(?:q\\s*)?", "for\\s+question\\s+(?:q\\s*)?")] + [f"(?i)question\\s+(?:q\\s*)?{part}\\s*:"]
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '{p}') THEN regexp_extract({c}, '{p}', 1) || regexp_extract({c}, '{p}', 2)" for p in ps) + " END"


def question_keys(spark, d):
    """Number, reference key, bare key and question key of every question."""
    q = _segments(spark, d, "question").select("segment_id", "chapter_number", qa.question_number(F.col("question_number")).alias("num"), _set_type().alias("kind"))
    ref = qa.reference_key(F.col("chapter_number"), F.col("num"), "Q", F.col("kind"))
    key = qa.qa_key(F.element_at(F.split("chapter_number", r"\."), 1), F.col("kind"), F.col("num"))
    return q.select("segment_id", "num", ref.alias("ref_key"), qa.bare_key(ref).alias("bare_key"), key.alias("qa_key"), qa.key_number(key).alias("key_num"))


_QUESTION_KEYS = _LATEST + f""", q AS (SELECT segment_id, chapter_number AS ch, {_number_sql('question_number')} AS num, {_KIND} AS kind FROM latest WHERE segment_type = 'question'),
k AS (SELECT *, CASE WHEN ch <> 'Unknown' AND num IS NOT NULL THEN 'Ch' || regexp_replace(string_split(ch, '.')[1], '[^0-9]', '', 'g') || '-Q' || num END AS bare FROM q)
SELECT segment_id, num, bare || CASE kind WHEN 'concept_check' THEN '-CC' WHEN 'problem_set' THEN '-PS' WHEN 'cfa' THEN '-CFA' ELSE '' END AS ref_key, bare AS bare_key,
  coalesce(nullif(string_split(ch, '.')[1], ''), 'na') || '|' || coalesce(kind, 'other') || '|' || coalesce(num, 'na') AS qa_key, coalesce(num, 'na') AS key_num FROM k"""


def solution_numbers(spark, d):
    """Number that a solution names, leading number and reference key of every solution."""
    t = F.col("text_content")
    return _segments(spark, d, "solution").select("segment_id", qa.solution_number(t).alias("num"), qa.leading_number(t).alias("leading"), qa.reference_key(F.col("chapter_number"), qa.solution_number(t), "S").alias("ref_key"))


_SOLUTION_NUMBERS = _LATEST + f""", s AS (SELECT segment_id, chapter_number AS ch, text_content AS t, {_answers_sql('text_content')} AS num FROM latest WHERE segment_type = 'solution')
SELECT segment_id, num, nullif(regexp_extract(trim(t), '^(\\d+)\\s*[.:)]', 1), '') AS leading, CASE WHEN ch <> 'Unknown' AND num IS NOT NULL THEN 'Ch' || regexp_replace(string_split(ch, '.')[1], '[^0-9]', '', 'g') || '-S' || num END AS ref_key FROM s"""


def answer_signals(spark, d):
    """Best question of each solution by key, chapter, shared formulas and words."""

    def side(kind, number):
        key = F.concat_ws("-", F.element_at(F.split("chapter_number", r"\."), 1), number)
        known = (F.col("chapter_number") != "Unknown") & number.isNotNull()
        return _segments(spark, d, kind).select(F.col("segment_id").alias("id"), "book_id", F.col("chapter_number").alias("chapter"), F.when(known, key).alias("key"), F.col("referenced_formula_ids").alias("formulas"), F.lit(None).cast("array<string>").alias("concepts"), F.col("text_content").alias("text"))

    return links.answer_signals(side("question", qa.question_number(F.col("question_number"))), side("solution", qa.solution_number(F.col("text_content"))))


_ANSWER_SIGNALS = _LATEST + f""", b AS (SELECT segment_id AS id, segment_type AS kind, book_id, chapter_number AS ch, referenced_formula_ids AS f, list_filter(list_distinct(string_split_regex(lower(coalesce(text_content, '')), '\\s+')), lambda w: w <> '') AS w,
  CASE WHEN segment_type = 'question' THEN {_number_sql('question_number')} ELSE {_answers_sql('text_content')} END AS num FROM latest WHERE segment_type IN ('question', 'solution')),
k AS (SELECT *, CASE WHEN ch <> 'Unknown' AND num IS NOT NULL THEN string_split(ch, '.')[1] || '-' || num END AS key FROM b),
p AS (SELECT s.id, q.id AS q_id, s.key = q.key AS same, s.ch, q.ch AS q_ch, len(list_intersect(list_distinct(coalesce(s.f, [])), list_distinct(coalesce(q.f, [])))) AS nf, len(coalesce(q.f, [])) AS qf, len(list_intersect(s.w, q.w)) AS both_w, len(s.w) + len(q.w) AS sum_w
  FROM k s JOIN k q ON s.kind = 'solution' AND q.kind = 'question' AND s.book_id = q.book_id),
c AS (SELECT *, CASE WHEN same THEN 0.7 ELSE 0.0 END + CASE WHEN ch <> 'Unknown' AND ch = q_ch THEN 0.1 ELSE 0.0 END + least(0.3, 0.1 * nf) + CASE WHEN qf > 0 AND both_w / greatest(sum_w - both_w, 1) > 0.3 THEN 0.1 ELSE 0.0 END AS score FROM p
  WHERE NOT coalesce(ch <> 'Unknown' AND q_ch <> 'Unknown' AND ch <> q_ch AND abs(coalesce(try_cast(regexp_extract(ch, '(\\d+)', 1) AS INT), 0) - coalesce(try_cast(regexp_extract(q_ch, '(\\d+)', 1) AS INT), 0)) > 1, false))
SELECT id AS solution_id, q_id AS question_id, CAST(round(score, 6) AS DOUBLE) AS score FROM c WHERE round(score, 6) >= 0.75 QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(score, 6) DESC, q_id) = 1"""


def formula_predicates(spark, d):
    """What each formula text is: formula, formula-like, prose, label, and its usage from the text before it."""
    t = F.coalesce("formula_text_raw", "text_content")
    return _segments(spark, d).select("segment_id", X.is_formula(t).alias("formula"), X.is_formula_like(t).alias("formula_like"), X.is_prose(t).alias("prose"), X.is_equation_label(t).alias("label"), X.usage_in_context(F.col("context_before")).alias("usage"))


_SIGN, _PROSE, _LIKE = "[=∑√∫σπθλ+−×÷^/\\\\()\\[\\]]|\\*\\*", "[=∑√∫σπθλ+−×÷^/\\\\]|\\*\\*", "[=∑√∫σπθλ+−×÷^∂∆]|\\*\\*"
_PREDICATES = _LATEST + f""", t AS (SELECT segment_id, coalesce(formula_text_raw, text_content) AS raw, regexp_replace(coalesce(formula_text_raw, text_content), '^\\s+|\\s+$', '', 'g') AS t, lower(coalesce(context_before, '')) AS c FROM latest),
w AS (SELECT *, list_filter(string_split_regex(t, '\\s+'), lambda x: x <> '') AS w, regexp_matches(t, '\\(\\d+\\.\\d+\\)') AS labelled FROM t)
SELECT segment_id, NOT (((length(t) <= 3 AND NOT regexp_matches(t, '[=+\\-*/×÷∑∫√]')) OR (regexp_matches(t, '^[\\d.\\-%\\s]+$') AND len(w) <= 2) OR regexp_matches(t, '^[A-Za-z]\\s*=\\s*-?\\d+(?:\\.\\d+)?$')) AND NOT labelled)
  AND (len(list_filter(w, lambda x: regexp_matches(x, '{_SIGN}|[A-Za-z]\\d|\\d[A-Za-z]|[A-Za-z]_[A-Za-z]'))) / greatest(len(w), 1) >= 0.3 OR labelled OR contains(t, 'Eq.') OR contains(t, 'Equation')) AND regexp_matches(t, '{_SIGN}') AS formula,
  t <> '' AND NOT regexp_matches(t, '(?i)https?://|www\\.|\\.com\\b|\\.edu\\b|\\.net\\b') AND NOT regexp_matches(t, '^\\(?\\d+(?:\\.\\d+)+[a-z]?\\)?$') AND (regexp_matches(t, '{_LIKE}') OR regexp_matches(t, '[A-Za-z][_(]')) AS formula_like,
  len(w) >= 8 AND len(list_filter(w, lambda x: regexp_matches(x, '{_PROSE}'))) / greatest(len(w), 1) < 0.2 AS prose,
  regexp_matches(t, '^\\(?\\d+(?:\\.\\d+)+[a-z]?\\)?$') OR regexp_matches(t, '(?i)\\b(?:eq|equation)\\.?\\s*\\d+(?:\\.\\d+)+') AS label,
  CASE WHEN contains(c, 'where') OR contains(c, 'let') OR contains(c, 'define') OR contains(c, 'denote') THEN 'definition' WHEN regexp_matches(c, '(?:use|using|from|see|according to)\\s+(?:eq|equation)') THEN 'reference' ELSE 'application' END AS usage FROM w"""


def formula_symbols(spark, d):
    """Candidate symbols of every formula, and those that are valid."""
    s = _segments(spark, d, "formula").select("segment_id", X.candidate_symbols(F.col("formula_text_raw")).alias("c"))
    return s.select("segment_id", F.array_join("c", " ").alias("candidates"), F.array_join(F.filter("c", X.is_symbol), " ").alias("valid"))


_LISTED = lambda xs: ", ".join(f"'{x}'" for x in xs)
_CANDIDATES = f"list_filter(list_sort(list_distinct(regexp_extract_all(coalesce(formula_text_raw, ''), '([A-Za-zα-ωΑ-Ω][A-Za-z0-9_()]*)', 1))), lambda x: lower(x) NOT IN ({_LISTED(X.COMMON_WORDS + X.FUNCTION_NAMES)}) AND length(x) <= 15)[1:20]"
_SYMBOLS = _LATEST + f""", f AS (SELECT segment_id, {_CANDIDATES} AS c FROM latest WHERE segment_type = 'formula')
SELECT segment_id, array_to_string(c, ' ') AS candidates, array_to_string(list_filter(c, lambda x: lower(x) NOT IN ({_LISTED(X.UNIT_WORDS)}) AND (lower(x) IN ({_LISTED(X.GREEK_NAMES)}) OR regexp_matches(x, '^(?:[A-Za-z]{{1,4}}|[A-Za-zα-ωΑ-Ω]{{1,3}}_[A-Za-z0-9]{{1,6}}|[α-ωΑ-Ω])$'))), ' ') AS valid FROM f"""


def solution_alignment(spark, d):
    """Share of the symbols of its formulas that each solution mentions."""
    formulas = _segments(spark, d, "formula").select(F.col("segment_id").alias("f"), X.candidate_symbols(F.col("formula_text_raw")).alias("c"))
    s = _segments(spark, d, "solution").select("segment_id", "text_content", F.explode(F.array_distinct("referenced_formula_ids")).alias("f"))
    held = s.join(formulas, "f").groupBy("segment_id", "text_content").agg(F.array_distinct(F.flatten(F.collect_list("c"))).alias("c"))
    return held.select("segment_id", F.size(F.array_distinct(F.transform("c", lambda x: F.lower(x)))).alias("n_symbols"), F.round(X.alignment(F.col("c"), F.col("text_content")), 6).alias("alignment"))


_ALIGNMENT = _LATEST + f""", f AS (SELECT segment_id AS f, unnest({_CANDIDATES}) AS x FROM latest WHERE segment_type = 'formula'),
e AS (SELECT segment_id, text_content, unnest(list_distinct(referenced_formula_ids)) AS f FROM latest WHERE segment_type = 'solution'), known AS (SELECT segment_id AS f FROM latest WHERE segment_type = 'formula'),
s AS (SELECT segment_id, text_content, lower(x) AS x FROM e JOIN known USING (f) LEFT JOIN f USING (f) GROUP BY 1, 2, 3)
SELECT segment_id, CAST(count(x) AS INT) AS n_symbols, round(count(CASE WHEN contains(lower(coalesce(text_content, '')), x) THEN 1 END) / greatest(count(x), 1), 6) AS alignment FROM s GROUP BY segment_id"""


def concept_fallback(spark, d):
    """One concept of every segment by the words of its headings."""
    s = _segments(spark, d).select("segment_id", F.lower(F.concat_ws(" ", "heading_path", "chapter_title")).alias("text"))
    return C.fallback_concepts(s, table(spark, d, "concepts"))


_NAMES = "list_distinct(regexp_extract_all(lower(coalesce({}, '')), '([A-Za-z][A-Za-z\\-]+)', 1))"
_FALLBACK = _LATEST + f""", w AS (SELECT segment_id, unnest({_NAMES.format("concat_ws(' ', heading_path, chapter_title)")}) AS word FROM latest), c AS (SELECT concept_id, {_NAMES.format('concept_name')} AS l FROM concepts), n AS (SELECT concept_id, len(l) AS n, unnest(l) AS word FROM c),
s AS (SELECT segment_id, concept_id, count(*) / max(n) AS score FROM w JOIN n USING (word) GROUP BY 1, 2), b AS (SELECT segment_id, concept_id FROM s QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY score DESC, concept_id) = 1)
SELECT segment_id, coalesce(concept_id, (SELECT min(concept_id) FROM concepts)) AS concept_id, CASE WHEN concept_id IS NULL THEN 0.1 ELSE 0.25 END::DOUBLE AS confidence FROM latest LEFT JOIN b USING (segment_id)"""


def _table_texts(spark, d):
    t = table(spark, d, "table_segments").groupBy("segment_id").agg(F.max(F.struct(F.coalesce("caption", F.lit("")).alias("caption"), F.array_join(F.coalesce("col_headers", F.array().cast("array<string>")), " ").alias("heads"))).alias("t"))
    return t.select("segment_id", F.concat_ws(" ", "t.caption", "t.heads").alias("text"))


def table_concepts(spark, d):
    """Concepts of every table by keywords: tags and names."""
    c = table(spark, d, "concepts").select("concept_id", "concept_name", F.col("tags").alias("keywords"))
    return C.table_concepts(_table_texts(spark, d), c).select("segment_id", "concept_id", F.round("confidence", 6).alias("confidence"), "method")


_TABLE_CONCEPTS = """
WITH t AS (SELECT segment_id, max({'c': coalesce(caption, ''), 'h': array_to_string(coalesce(col_headers, []), ' ')}) AS m FROM table_segments GROUP BY 1), x AS (SELECT segment_id, lower(m.c || ' ' || m.h) AS text FROM t),
c AS (SELECT concept_id, greatest(len(coalesce(tags, [])), 1) AS n, list_append(coalesce(tags, []), concept_name) AS k FROM concepts),
h AS (SELECT segment_id, concept_id, 0.8 * least(1.0, len(list_filter(k, lambda w: w IS NOT NULL AND w <> '' AND contains(text, lower(w)))) / n) AS confidence FROM x, c)
SELECT segment_id, concept_id, CAST(round(confidence, 6) AS DOUBLE) AS confidence, 'keyword' AS method FROM h WHERE confidence >= 0.4"""


def chain_report(spark, d):
    """The eight fullest chains from a formula to example, question, solution and derivation."""
    n = _segments(spark, d).select(graph.node_id(F.col("segment_id")).alias("node_id"), F.col("segment_type").alias("kind"), F.col("page_start").alias("page"))
    return graph.fullest_chains(graph.partial_chains(graph.edge_rows(table(spark, d, "edges")), n))


def _hop_sql(name: str, kind: str, types: list[str], at: str) -> str:
    return f"""{name} AS (SELECT e.t AS at, e.s AS id FROM (SELECT DISTINCT t, s FROM e WHERE k IN ({_LISTED(types)})) e JOIN n ON n.id = e.s AND n.kind = '{kind}' JOIN n a ON a.id = e.t QUALIFY row_number() OVER (PARTITION BY e.t ORDER BY abs(n.page - a.page) NULLS FIRST, e.s) = 1)"""


_CHAINS = _LATEST + """, n AS (SELECT lower(trim(segment_id)) AS id, segment_type AS kind, page_start AS page FROM latest),
e AS (SELECT lower(trim(source_id)) AS s, lower(trim(target_id)) AS t, regexp_replace(upper(trim(edge_type)), '[- ]', '_', 'g') AS k FROM edges QUALIFY row_number() OVER (PARTITION BY edge_id ORDER BY loaded_at DESC NULLS LAST, strength DESC NULLS LAST) = 1),
""" + ", ".join(_hop_sql(*h) for h in graph.HOPS) + """,
o AS (SELECT n.id AS formula_id, x.id AS example_id, q.id AS question_id, s.id AS solution_id, v.id AS derivation_id FROM n LEFT JOIN example_id x ON x.at = n.id LEFT JOIN question_id q ON q.at = n.id LEFT JOIN solution_id s ON s.at = q.id LEFT JOIN derivation_id v ON v.at = n.id WHERE n.kind = 'formula')
SELECT *, CAST((example_id IS NOT NULL)::INT + (question_id IS NOT NULL)::INT + (solution_id IS NOT NULL)::INT + (derivation_id IS NOT NULL)::INT AS INT) AS n_hops FROM o ORDER BY n_hops DESC, formula_id LIMIT 8"""


def sidecar_checks(spark, d):
    """Checks of the delivered graph."""
    return graph.graph_checks(table(spark, d, "segments"), table(spark, d, "edges"))


_CHECKS = """
WITH ids AS (SELECT segment_id, count(*) AS n FROM segments GROUP BY 1), known AS (SELECT segment_id FROM ids WHERE segment_id IS NOT NULL)
SELECT 'missing_id' AS "check", CAST(coalesce(sum(n) FILTER (segment_id IS NULL), 0) AS BIGINT) AS n_bad FROM ids UNION ALL SELECT 'repeated_id', count(*) FILTER (segment_id IS NOT NULL AND n > 1) FROM ids
UNION ALL SELECT 'edge_fields', count(*) FILTER (source_id IS NULL OR target_id IS NULL OR edge_type IS NULL OR strength IS NULL OR anchor_metadata IS NULL) FROM edges
UNION ALL SELECT 'dangling_edge', count(*) FROM edges e LEFT JOIN known a ON a.segment_id = e.source_id LEFT JOIN known b ON b.segment_id = e.target_id WHERE a.segment_id IS NULL OR b.segment_id IS NULL"""


def table_bodies(spark, d):
    """Every table with its cells as JSON."""
    t = table(spark, d, "table_segments").groupBy("segment_id").agg(F.max("table_number").alias("table_number"), F.max("caption").alias("caption"), F.max("page_start").alias("page_start"), F.max("page_end").alias("page_end"))
    return tables.table_json(t, tables.one_cell_each(table(spark, d, "cell_meta")))


_BODIES = """
WITH t AS (SELECT segment_id, max(table_number) AS table_number, max(caption) AS caption, max(page_start) AS page_start, max(page_end) AS page_end FROM table_segments WHERE segment_id IS NOT NULL GROUP BY 1),
one AS (SELECT * FROM cell_meta QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY loaded_at DESC NULLS LAST, raw_value NULLS FIRST, normalized_value NULLS FIRST) = 1),
c AS (SELECT segment_id, list({'row_index': row_index, 'col_index': col_index, 'cell_id': cell_id, 'cell_type': cell_type, 'raw_value': raw_value, 'rowspan': rowspan, 'colspan': colspan, 'formula_text': formula_text, 'units': units} ORDER BY row_index, col_index, cell_id) AS cells FROM one GROUP BY 1)
SELECT t.segment_id, CAST(to_json({'segment_id': t.segment_id, 'table_number': table_number, 'caption': caption, 'page_start': page_start, 'page_end': page_end, 'cells': coalesce(cells, [])}) AS VARCHAR) AS body FROM t LEFT JOIN c USING (segment_id)"""


def extraction_summary(spark, d):
    """Tables, last page and mean confidence of each extractor."""
    return tables.table_summary(table(spark, d, "table_segments"))


_SUMMARY = "SELECT extractor, count(*) AS n_tables, max(coalesce(page_end, page_start, 0)) AS total_pages, round(avg(confidence), 6) AS mean_confidence FROM table_segments GROUP BY 1"


def page_texts(spark, d):
    """Text of every page of every layout."""
    return tables.page_texts(table(spark, d, "blocks"))


_PAGES = """
WITH o AS (SELECT * FROM blocks QUALIFY row_number() OVER (PARTITION BY block_key ORDER BY coalesce(loaded_at, TIMESTAMP '9999-01-01'), coalesce(text, ''), layout_id NULLS FIRST, page_idx NULLS FIRST, block_index NULLS FIRST) = 1)
SELECT layout_id, page_idx, string_agg(text, chr(10) ORDER BY coalesce(block_index, 2147483647), block_key) AS page_text FROM o WHERE text <> '' GROUP BY 1, 2"""


def block_regions(spark, d):
    """First block at each place of a page, and how many stand there."""
    b = table(spark, d, "blocks").where("bbox is not null").select("block_key", "layout_id", "page_idx", F.col("bbox.x0").alias("x0"), F.col("bbox.y0").alias("y0"), F.col("bbox.x1").alias("x1"), F.col("bbox.y1").alias("y1"))
    return tables.unique_regions(b, "block_key", ["layout_id", "page_idx", "x0", "y0", "x1", "y1"])


_REGIONS = "SELECT layout_id, page_idx, bbox.x0 AS x0, bbox.y0 AS y0, bbox.x1 AS x1, bbox.y1 AS y1, min(block_key) AS block_key, count(DISTINCT block_key) AS n_regions FROM blocks WHERE bbox IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6"


def phrase_keys(spark, d):
    """Key of every concept name."""
    return table(spark, d, "concepts").select("concept_id", qa.phrase_key(F.col("concept_name")).alias("phrase_key"))


_PHRASE_KEYS = """
WITH w AS (SELECT concept_id, list_filter(string_split_regex(trim(regexp_replace(lower(concept_name), '[^a-z0-9\\s_-]', ' ', 'g')), '\\s+'), lambda x: x <> '' AND x NOT IN ('the', 'a', 'an', 'of', 'to', 'in', 'on', 'for')) AS w FROM concepts)
SELECT concept_id, CASE WHEN len(w) > 0 THEN array_to_string(w[1:4], '_') END AS phrase_key FROM w"""


def table_references(spark, d):
    """Segments that mention a table of any book by number, and how many tables have it."""
    t = table(spark, d, "table_segments").where("table_number is not null").select(F.lit("all").alias("book_id"), "table_number", "segment_id")
    s = _segments(spark, d).select(F.lit("all").alias("book_id"), F.col("segment_id").alias("item_id"), F.col("text_content").alias("text"))
    return tables.cross_table_mentions(s, t).groupBy("item_id").agg(F.count("*").alias("n_tables"))


_TABLE_REFERENCES = _LATEST + r""", m AS (SELECT DISTINCT segment_id AS item_id, unnest(regexp_extract_all(text_content, '(?:^|[^\p{L}\p{N}_])[Tt]able\s+(\d+(?:\.\d+)*)', 1)) AS table_number FROM latest)
SELECT item_id, count(DISTINCT t.segment_id) AS n_tables FROM m JOIN table_segments t USING (table_number) GROUP BY 1"""


def allowed_types(spark, d):
    """Segments of the types of an allowlist, by type."""
    return graph.of_types(table(spark, d, "segments"), ["Question", "Solution", "Derivation"]).groupBy("segment_type").agg(F.count("*").alias("n_segments"))


_ALLOWED = "SELECT segment_type, count(*) AS n_segments FROM segments WHERE lower(segment_type) IN ('question', 'solution', 'derivation') GROUP BY 1"

QUERIES = {
    f.__name__: f
    for f in (
        question_keys, solution_numbers, answer_signals, formula_predicates, formula_symbols, solution_alignment, concept_fallback, table_concepts, chain_report, sidecar_checks, table_bodies, extraction_summary,
        page_texts, block_regions, phrase_keys, table_references, allowed_types,
    )
}
SQL = {
    "question_keys": _QUESTION_KEYS, "solution_numbers": _SOLUTION_NUMBERS, "answer_signals": _ANSWER_SIGNALS, "formula_predicates": _PREDICATES, "formula_symbols": _SYMBOLS, "solution_alignment": _ALIGNMENT, "concept_fallback": _FALLBACK,
    "table_concepts": _TABLE_CONCEPTS, "chain_report": _CHAINS, "sidecar_checks": _CHECKS, "table_bodies": _BODIES, "extraction_summary": _SUMMARY, "page_texts": _PAGES, "block_regions": _REGIONS, "phrase_keys": _PHRASE_KEYS, "table_references": _TABLE_REFERENCES, "allowed_types": _ALLOWED,
}
