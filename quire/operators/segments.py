"""Segments of a document from its blocks: section state, classification, merging, pruning.

The section a block stands in is a forward fill of the section headings; with it, classification is one
ordered rule chain, and numbered blocks are exploded into their items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import qa
from quire.functions.formulas import equation_number
from quire.functions.text import heading_level, stable_id, strip
from quire.operators.folds import fold_groups

#: Problem numbers after which a restart opens the next block of problems.
MANY, FEW = 20, 2
#: Characters of a block that no longer follows a question of full length, and of a bare number's question.
LONG, NUMBER_MOST = 200, 2000
#: Characters of a formula inside a concept check, and its distance below it.
INLINE_CHARS, INLINE_GAP = 80, 120


def _so_far(*keys: str):
    return Window.partitionBy(*keys).orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def section_state(df: DataFrame) -> DataFrame:
    """Add ``section``: the last section heading so far; problem sets whose numbers restart become ``cfa``."""
    opened = qa.section_of(F.col("text"))
    df = df.withColumn("_opened", opened).withColumn("section", F.last("_opened", ignorenulls=True).over(_so_far("doc_id")))
    df = df.withColumn("_run", F.count("_opened").over(_so_far("doc_id"))).withColumn("_n", F.when(F.col("block_type") == "text", F.regexp_extract("text", r"^\s*(\d{1,4})\s*[.)]\s", 1).try_cast("int")))
    before = F.last("_n", ignorenulls=True).over(Window.partitionBy("doc_id", "_run").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1))
    restart = (F.col("section") == "problem_set") & (before >= MANY) & (F.col("_n") <= FEW)
    df = df.withColumn("_restart", F.coalesce(restart, F.lit(False)))
    df = df.withColumn("section", F.when(F.max("_restart").over(_so_far("doc_id", "_run")), "cfa").otherwise(F.col("section")))
    return df.withColumn("is_section_heading", F.col("_opened").isNotNull()).drop("_opened", "_run", "_n", "_restart")


def header_score(df: DataFrame, height: float) -> DataFrame:
    """Add ``header_score``: chapter word, dotted number, shortness, place on the page, title case."""
    t = strip(F.col("text"))
    low = F.lower(t)
    title_case = (t == F.initcap(low)) | ((t == F.upper(t)) & (t != low))
    score = (
        F.when(F.startswith(low, F.lit("chapter")), 2).otherwise(0) + F.when(t.rlike(r"^\d+(\.\d+)+(\s+|$)"), 2).otherwise(0) + F.when(F.char_length(t) <= 80, 1).otherwise(0)
        + F.when(F.coalesce(F.col("y0") / height < 0.25, F.lit(False)), 1).otherwise(0) + F.when(title_case, 1).otherwise(0)
    )
    bad = (t == "") | F.startswith(low, F.lit("example")) | F.startswith(low, F.lit("concept check")) | F.substring(t, 1, 20).rlike(r"[=+\-*/]")
    return df.withColumn("header_score", F.when(bad, 0).otherwise(score))


def classify(df: DataFrame, height: float = 750.0) -> DataFrame:
    """Add ``signs`` and ``segment_type``; a block that no rule takes has a null type."""
    df = header_score(section_state(df), height).withColumn("signs", qa.derivation_signs(F.col("text")))
    t, s = F.col("text"), F.coalesce("section", F.lit(""))
    low = F.lower(strip(t))
    numbered = low.rlike(r"^\d+\s*[.)]\s+")
    derivation, example, solution = qa.is_derivation(F.col("signs")), qa.is_worked_example(t), qa.is_solution(t, s)
    in_sets = s.isin("problem_set", "cfa")
    label = (
        F.when(F.col("is_section_heading"), "header")
        .when(numbered & in_sets & qa.is_likely_problem(t), "question")
        .when(numbered & (s == "concept_check_solutions"), "solution")
        .when(derivation, "derivation")
        .when(solution, "solution")
        .when(qa.is_calculation(t) & ~example, "calculation")
        .when(example, "worked_example")
        .when(low.rlike(r"^concept\s+check\s+\d+\.\d+"), "question")
        .when(numbered & qa.is_likely_problem(t), "question")
        .when(F.col("header_score") >= 3, "header")
    )
    return df.withColumn("segment_type", label)


def explode_numbered(df: DataFrame) -> DataFrame:
    """One row an item of texts with several numbered items; other texts stay one row (part 0)."""
    parts = qa.numbered_parts(F.col("text"))
    many = F.when(F.size(parts) > 1, parts).otherwise(F.array("text"))
    names = [c for c in df.columns if c != "text"]
    return df.select(*names, F.posexplode(many).alias("part", "text"))


def chapter_state(df: DataFrame) -> DataFrame:
    """Add ``chapter``, ``section_number`` and ``section_title`` carried on from the last numbered heading."""
    head = (F.col("block_type") == "heading") & F.col("text").rlike("[A-Za-z]") & ~F.col("text").rlike(r"(?i)https?://|www\.|\.com\b|\.edu\b|\.net\b")
    chapter = F.regexp_extract("text", r"(?i)chapter\s+(\d+)", 1)
    number = F.regexp_extract("text", r"^(\d+(?:\.\d+)+)", 1)
    state = F.when(head & (number != ""), F.struct(F.regexp_extract(number, r"^(\d+)", 1).alias("chapter"), number.alias("section_number"), strip(F.col("text")).alias("section_title")))
    state = state.when(head & (chapter != ""), F.struct(chapter.alias("chapter"), chapter.alias("section_number"), strip(F.col("text")).alias("section_title")))
    return df.withColumn("_s", F.last(state, ignorenulls=True).over(_so_far("doc_id"))).withColumns({c: F.col(f"_s.{c}") for c in ("chapter", "section_number", "section_title")}).drop("_s")


def absorb(df: DataFrame, start: str, follow: list[str], pages: int = 1) -> DataFrame:
    """Texts of each ``start`` segment with the following segments of the given types, on the next ``pages``.

    An island ends at the first other type; null types (dropped blocks) don't end it.
    """
    typed = df.where(F.col("segment_type").isNotNull())
    stop = ~F.col("segment_type").isin(follow)
    typed = typed.withColumn("_head", F.max(F.when(F.col("segment_type") == start, F.col("ord"))).over(_so_far("doc_id"))).withColumn("_stop", F.max(F.when(stop, F.col("ord"))).over(_so_far("doc_id")))
    page = F.first(F.when(F.col("segment_type") == start, F.col("page_idx")), ignorenulls=True).over(Window.partitionBy("doc_id", "_head").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    inside = typed.where(F.col("_head") == F.col("_stop")).withColumn("_page", page).where(F.col("page_idx") <= F.col("_page") + pages)
    parts = F.array_sort(F.collect_list(F.struct("ord", "text")))
    return inside.groupBy("doc_id", F.col("_head").alias("ord")).agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"), F.count("*").alias("n_parts"), F.max("page_idx").alias("page_end"))


def _continuation_columns(df: DataFrame) -> DataFrame:
    """Columns that the fold over questions reads; ``kind`` is stop, question, text, formula or other."""
    t, low = strip(F.col("text")), F.lower(strip(F.col("text")))
    # what the layout calls a formula, table or image is data of a question, however much its text looks like a heading
    data = F.col("block_type").isin("formula", "table", "image")
    shell = F.col("section").isin("problem_set", "cfa") & F.col("segment_type").isNull() & ~data & (F.col("block_type") != "heading") & t.rlike(qa.NUMBER_ONLY)
    kind = (
        F.when((F.col("segment_type") == "question") | shell, "question")
        .when(F.col("is_section_heading") | (F.col("block_type") == "heading") | F.col("segment_type").isin("worked_example", "solution"), "stop")
        .when((F.col("segment_type") == "header") & ~data, "stop")
        .when((F.col("block_type") == "formula") | (F.col("segment_type") == "calculation"), "formula")
        .when(F.col("segment_type").isNull() | (F.col("segment_type") == "header"), "text")
        .otherwise("other")
    )
    check = (F.col("section") == "concept_check") | low.rlike(r"^concept\s+check\s+\d+\.\d+")
    numbered = (F.col("block_type") == "formula") & equation_number(t).isNotNull()
    names = ["doc_id", "ord", "page_idx", *[c for c in ("x0", "y0", "x1", "y1") if c in df.columns]]
    return df.select(*names, kind.alias("kind"), data.alias("data"), F.coalesce(check, F.lit(False)).alias("check"), numbered.alias("numbered"), F.coalesce(t, F.lit("")).alias("text"))


def _inline(q, r) -> bool:
    """A short formula without a number, close below the question on its page."""
    box = [getattr(x, c, None) for x in (q, r) for c in ("x0", "y0", "x1", "y1")]
    if r.numbered or len(r.text) > INLINE_CHARS or q.page_idx != r.page_idx or None in box:
        return False
    return not (r.x1 < q.x0 or r.x0 > q.x1) and 0 <= r.y0 - q.y1 <= INLINE_GAP


def merge_questions(df: DataFrame, most: int = 1200) -> DataFrame:
    """Questions with their continuation blocks: an ordered fold bounded by length, page and cue.

    Texts, formulas and calculations on the same or next page continue a question until another question, a
    heading, example, solution, section marker or heading-like line; blank blocks are passed over. Beyond
    ``most`` characters only blocks of up to ``LONG`` follow. A bare number in a problem set opens a question
    that takes all that follows until it has ``NUMBER_MOST`` characters; with a table header in the question,
    table lines follow at any length. A concept check takes texts with a cue and inline formulas only.
    """

    def fold(rows: list) -> list[tuple]:
        out: list[list] = []
        q, number, tabular = None, False, False
        for r in rows:
            text = r.text
            if r.kind == "question":
                q, number = r, qa.is_number_only(text)
                tabular = number or qa.is_table_header(text)
                out.append([r.doc_id, r.ord, r.page_idx, [text], len(text)])
                continue
            if q is None:
                continue
            if r.page_idx not in (q.page_idx, q.page_idx if q.page_idx is None else q.page_idx + 1) or r.kind == "stop":
                q = None
            elif text:
                stop = qa.is_section_marker(text) or (not tabular and not r.data and qa.is_heading_line(text)) or r.kind == "other"
                if q.check:
                    stop = stop or not (qa.continues_question(text) if r.kind == "text" else _inline(q, r))
                elif not number and not (tabular and qa.is_table_line(text)):
                    stop = stop or (out[-1][4] > most and len(text) > LONG)
                if not stop:
                    out[-1][3].append(text)
                    out[-1][4] += len(text)
                if stop or (number and not q.check and out[-1][4] > NUMBER_MOST):
                    q = None
        return [(d, o, p, "\n".join(parts), len(parts)) for d, o, p, parts, _ in out]

    return fold_groups(_continuation_columns(df), ["doc_id"], ["ord"], fold, "doc_id long, ord long, page_idx long, text string, n_parts long")


def refine_derivations(df: DataFrame) -> DataFrame:
    """Keep a derivation with mathematics, make one with numbers only a calculation, drop the rest."""
    score = qa.derivation_score(F.col("signs"))
    keep = F.when(score >= 4, "derivation").when(qa.is_calculation(F.col("text")) | F.contains(F.col("text"), F.lit("=")), "calculation")
    return df.withColumn("segment_type", F.when(F.col("segment_type") == "derivation", keep).otherwise(F.col("segment_type"))).where(F.col("segment_type").isNotNull())


def prune_questions(df: DataFrame) -> DataFrame:
    """Drop questions that are bare section names or single words."""
    return df.where((F.col("segment_type") != "question") | ~qa.is_noisy_question(F.col("text")))


def prune_solutions(solutions: DataFrame, answers: DataFrame) -> DataFrame:
    """Drop solutions that answer nothing and read like a question or a heading; ``answers`` has source_id."""
    linked = answers.select(F.col("source_id").alias("segment_id")).distinct().withColumn("_linked", F.lit(True))
    t = F.col("text")
    question_like, heading_like = qa.is_likely_problem(t) & F.contains(t, F.lit("?")), F.char_length(strip(t)) < 20
    return solutions.join(linked, "segment_id", "left").where(F.coalesce("_linked", F.lit(False)) | ~(question_like | heading_like)).drop("_linked")


def supplementary(chunks: DataFrame, solutions: DataFrame) -> DataFrame:
    """Answer-like chunks that no solution covers yet, as new solutions with ids from their content."""
    t = F.col("text")
    answer = ~F.contains(t, F.lit("?")) & (F.lower(t).rlike(qa.ANSWER_LINE) | (F.contains(t, F.lit("=")) & (F.size(F.split(t, r"\s+")) >= 14)))
    rest = chunks.where(answer).join(solutions.select("doc_id", "ord"), ["doc_id", "ord"], "left_anti")
    return rest.withColumn("segment_id", stable_id("solution_", F.col("doc_id"), F.col("ord"), t)).withColumn("segment_type", F.lit("solution"))


def chapter_gaps(chapters: DataFrame) -> DataFrame:
    """Chapters (doc_id, number) with implied parents and the missing n.1 .. n.k-1 filled in."""
    main = F.split("number", r"\.")
    parents = chapters.where(F.size(main) == 2).select("doc_id", F.get(main, F.lit(0)).alias("p"), F.get(main, F.lit(1)).cast("int").alias("k"))
    filled = parents.groupBy("doc_id", "p").agg(F.max("k").alias("k")).select("doc_id", F.explode(F.concat(F.array("p"), F.transform(F.sequence(F.lit(1), "k"), lambda i: F.concat_ws(".", F.col("p"), i.cast("string"))))).alias("number"))
    known = chapters.select("doc_id", "number").distinct()
    rows = known.unionByName(filled).distinct().join(known.withColumn("_k", F.lit(True)), ["doc_id", "number"], "left")
    order = F.transform(F.split("number", r"\."), lambda x: x.cast("int"))
    return rows.select("doc_id", "number", F.col("_k").isNull().alias("filled_in"), F.row_number().over(Window.partitionBy("doc_id").orderBy(order)).alias("position"))


def contiguous_chapters(chapters: DataFrame) -> DataFrame:
    """Main chapters that count on from 1 without a gap."""
    n = chapters.where(F.col("number").rlike(r"^\d+$")).select("doc_id", F.col("number").cast("int").alias("n")).distinct()
    return n.withColumn("_r", F.row_number().over(Window.partitionBy("doc_id").orderBy("n"))).where(F.col("n") == F.col("_r")).select("doc_id", F.col("n").cast("string").alias("number"))


def symbol_scores(formulas: DataFrame, most: int = 14) -> DataFrame:
    """Most used symbols of each chapter: one a formula, two more in definitions, one more if numbered."""
    points = 1 + F.when(F.col("usage_type") == "definition", 2).otherwise(0) + F.when(F.col("equation_number").isNotNull(), 1).otherwise(0)
    s = formulas.select("doc_id", "chapter", F.explode("symbols").alias("symbol"), points.alias("p")).groupBy("doc_id", "chapter", "symbol").agg(F.sum("p").alias("score"))
    return s.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id", "chapter").orderBy(F.desc("score"), "symbol"))).where(F.col("rank") <= most)


def headings(df: DataFrame) -> DataFrame:
    """Headings as contents entries, each (title, page) once."""
    h = df.where("block_type = 'heading'").select("doc_id", strip(F.col("text")).alias("title"), F.col("page_idx").alias("page"), heading_level(F.col("text")).alias("level"), "ord")
    return h.groupBy("doc_id", "title", "page").agg(F.min("ord").alias("ord"), F.first("level").alias("level"))
