"""Column functions on block texts: clean-up, headings, lists, classification, numbering, references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import patterns as P


def strip(c: Column) -> Column:
    """Trim all white space, not only blanks; null becomes empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")


def any_of(c: Column, patterns: list[str], ignore_case: bool = True) -> Column:
    """Whether any pattern is found in ``c``; null text matches nothing. One alternation is one scan of the text."""
    flags = "(?iU)" if ignore_case else "(?U)"
    return F.coalesce(c.rlike(flags + "|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def contains_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def normalize_spaces(c: Column) -> Column:
    """Drop soft hyphens, turn control characters into blanks, squeeze white space."""
    x = F.regexp_replace(F.regexp_replace(c, "­", ""), r"[\x00-\x1F\x7F]", " ")
    return strip(F.regexp_replace(x, r"(?U)\s+", " "))


def collapse_spaced_capitals(c: Column) -> Column:
    """``C H A P T E R 1`` to ``CHAPTER 1``: runs of at least three single capitals."""
    run = r"(?U)\b(?:[A-Z]\s){2,}[A-Z]\b"
    pieces, runs = F.split(c, run, -1), F.regexp_extract_all(c, F.lit(run), F.lit(0))
    joined = F.zip_with(pieces, runs, lambda a, b: F.concat(a, F.coalesce(F.regexp_replace(b, r"\s", ""), F.lit(""))))
    return F.array_join(joined, "")


def alnum_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def heading_level(title: Column) -> Column:
    """Part and chapter are level 1, section 2, a dotted number has its depth, anything else 2."""
    t = strip(title)
    number = F.regexp_extract(t, r"^(\d+(?:\.\d+)*)", 1)
    return F.when(any_of(t, [r"^(?:part|chapter)\b"]), 1).when(any_of(t, [r"^section\b"]), 2).when(number != "", F.size(F.split(number, r"\."))).otherwise(2)


def roman_to_int(c: Column) -> Column:
    """Value of a roman numeral; null for other texts."""
    values = F.create_map(*[F.lit(x) for pair in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items() for x in pair])
    signs = F.transform(F.reverse(F.split(F.upper(strip(c)), "")), lambda s: F.element_at(values, s))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("last"))
    fold = F.aggregate(signs, start, lambda a, v: F.struct((a.total + F.when(v < a.last, -v).otherwise(v)).alias("total"), F.greatest(a.last, v).alias("last")), lambda a: a.total)
    return F.when(F.upper(strip(c)).rlike("^[IVXLCDM]+$"), fold)


def is_list_item(c: Column) -> Column:
    return any_of(strip(c), P.LIST_ITEM, ignore_case=False)


def is_procedure_item(c: Column) -> Column:
    return any_of(strip(c), P.PROCEDURE_ITEM)


def is_list_continuation(c: Column) -> Column:
    """A line that goes on from a list item: a joining word, a bracket or a lower-case start."""
    t = strip(c)
    return (t != "") & ~is_list_item(c) & ~is_procedure_item(c) & (any_of(t, [P.CONTINUATION], False) | any_of(t, [r"^\p{Ll}"], False))


def is_derivation_like(c: Column) -> Column:
    """An explicit derivation heading, or a transforming verb together with mathematics."""
    t = strip(c)
    anchor = contains_any(t, ["=", "->", "⇒"]) | any_of(t, [P.EQUATION_MENTION])
    return (t != "") & (any_of(t, [P.EXPLICIT_DERIVATION]) | ((any_of(t, [P.TRANSFORM]) | any_of(t, [P.WE_CAN_SHOW])) & anchor))


def text_object(text: Column, heading_path: Column | None = None, list_context: bool = False) -> Column:
    """Label of a text block: one of 15, the first rule that holds."""
    t, h = strip(text), F.lower(F.coalesce(heading_path if heading_path is not None else F.lit(""), F.lit("")))
    c = F.when(F.coalesce(text, F.lit("")) == "", "text").when(F.lower(t).startswith("note:") | F.lower(t).startswith("source:"), "note")
    c = c.when(any_of(t, P.SOLUTION), "solution_candidate").when(any_of(t, P.WORKED_EXAMPLE), "worked_example_candidate")
    c = c.when(any_of(t, P.DERIVATION) & is_derivation_like(text), "derivation_candidate").when(any_of(t, P.CALCULATION), "calculation_candidate")
    if list_context:
        c = c.when(any_of(t, P.PROCEDURE), "procedure").when(any_of(t, P.BULLET), "list")
    for words, label in ((["problem set"], "problem_sets"), (["concept check"], "concept_check"), (["key term", "glossary"], "key_terms"), (["learning objective"], "learning_objectives"), (["references", "bibliography"], "references")):
        c = c.when(contains_any(h, words), label)
    for rule, label in (
        (P.LEARNING_OBJECTIVES, "learning_objectives"), (P.KEY_TERMS, "key_terms"), (P.PROBLEM_SETS, "problem_sets"), (P.CONCEPT_CHECK_SOLUTION, "concept_check_solution"),
        (P.CONCEPT_CHECK, "concept_check"), (P.PROCEDURE, "procedure"), (P.BULLET, "list"),
    ):
        c = c.when(any_of(t, rule), label)
    return c.when(F.contains(t, F.lit(":")) & (F.char_length(t) <= 200), "definition").otherwise("text")


def title_object(title: Column) -> Column:
    """Label of a heading, empty if none."""
    t = F.lower(strip(title))
    c = F.when(t == "", "")
    for label, rule in P.TITLE_LABELS:
        c = c.when(any_of(t, rule), label)
    return c.otherwise("")


def qa_zone(heading_path: Column, segment_type: Column) -> Column:
    """Question-and-answer zone of a block from its heading path, else from its label."""
    h, s = F.lower(F.coalesce(heading_path, F.lit(""))), F.lower(F.coalesce(segment_type, F.lit("")))
    return (
        F.when(contains_any(h, ["concept check solution", "solutions to concept checks", "solution to concept checks", "answers to concept checks"]), "concept_check_solution")
        .when(F.contains(h, F.lit("concept check")), "concept_check")
        .when(contains_any(h, ["problem set", "review question", "end-of-chapter problem", "exercise"]), "problem_set")
        .when(s.isin("concept_check_solution", "solution_candidate"), "concept_check_solution")
        .when(s == "concept_check", "concept_check")
        .when(s == "problem_sets", "problem_set")
        .otherwise("other")
    )


def candidate_role(segment_type: Column) -> Column:
    s = F.lower(F.coalesce(segment_type, F.lit("")))
    return (
        F.when(s.isin("solution_candidate", "concept_check_solution"), "solution_candidate")
        .when(s.isin("worked_example_candidate", "derivation_candidate", "calculation_candidate"), s)
        .when(s.isin("problem_sets", "concept_check"), "question_candidate")
        .otherwise("none")
    )


def numbering(text: Column) -> Column:
    """Struct (raw, normalized, parent, subpart) of a leading number, null if there is none."""
    t = strip(text)
    found = [F.regexp_extract(t, "(?iU)" + p, 1) for p in P.NUMBERING]
    raw = F.coalesce(*[F.when(f != "", f) for f in found])

    def parse(r: Column) -> Column:
        norm = F.regexp_replace(F.regexp_replace(r, "[^0-9.]", ""), r"^\.+|\.+$", "")
        last = F.regexp_extract(norm, r"\.(\d+)$", 1)
        return F.struct(r.alias("raw"), norm.alias("normalized"), F.regexp_replace(norm, r"\.\d+$", "").alias("parent"), F.when(last != "", last).alias("subpart"))

    # the array holds the number once, so its search isn't repeated for each field
    return F.get(F.filter(F.transform(F.filter(F.array(raw), lambda r: r.isNotNull()), parse), lambda n: n["normalized"] != ""), F.lit(0))


def is_heading_like(text: Column) -> Column:
    """A numbered title, or a short line that starts with a digit and holds no answer word."""
    t = strip(text)
    words = F.size(F.regexp_extract_all(t, F.lit("[A-Za-z]+"), F.lit(0)))
    short = (words <= 8) & ~contains_any(t, [":", "="]) & ~any_of(t, [P.ANSWER_WORDS]) & t.rlike(r"^\d")
    return (t != "") & (t.rlike(r"^\d+(?:\.\d+)+\s+[A-Z]") | short)


def is_candidate(text: Column, role: Column, block_type: Column) -> Column:
    """Whether a text block may hold a question, solution, derivation, example or calculation."""
    hinted = role.isin("question_candidate", "solution_candidate", "derivation_candidate", "calculation_candidate", "worked_example_candidate")
    return (block_type == "text") & (F.char_length(strip(text)) >= 8) & ~is_heading_like(text) & (hinted | any_of(strip(text), P.CANDIDATE))


def cross_references(text: Column) -> Column:
    """Array of (type, id) that a text refers to, in search order, each once."""

    def of(kind: str, pattern: str) -> Column:
        ids = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(1))
        return F.transform(ids, lambda x: F.struct(F.lit(kind).alias("type"), x.alias("id")))

    return F.array_distinct(F.concat(*[of(kind, p) for kind, p in P.CROSS_REFERENCES]))


def keeps_block(block_type: Column, text: Column, page_idx: Column) -> Column:
    """Visual blocks stay; texts of one character and front matter on the first pages go."""
    t = strip(text)
    front = (page_idx <= 5) & any_of(F.lower(t), P.FRONT_MATTER)
    return block_type.isin("image", "table", "formula") | ((F.char_length(t) >= 2) & ~front)


def is_special_term(text: Column) -> Column:
    t = F.lower(strip(text))
    return (t != "") & (any_of(t, P.SPECIAL_TERM) | (F.contains(t, F.lit(":")) & (F.char_length(t) <= 140)))


def map_block_type(raw: Column) -> Column:
    """Six block classes; an unknown raw type is text."""
    r = F.lower(F.coalesce(raw, F.lit("")))
    return (
        F.when(r.isin("title", "header"), "heading").when(r.isin("list", "list_item"), "list").when(r == "table", "table")
        .when(r.isin("image", "picture"), "image").when(r.isin("interline_equation", "equation"), "formula").otherwise("text")
    )


def chapter_main(heading_path: Column) -> Column:
    """Main chapter number named in a heading path."""
    named = F.regexp_extract(heading_path, r"(?iU)(?:chapter|ch)\s+(\d+)", 1)
    leading = F.regexp_extract(heading_path, r"(?:^| > )(\d+)(?:\.\d+)*", 1)
    return F.when(named != "", named).when(leading != "", leading)


def taxonomy_path(heading_path: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(heading_path, F.lit("")), " > "), lambda p: strip(p)), lambda p: p != "")


def stable_id(prefix: str, *parts: Column) -> Column:
    """Id from content: the same row gets the same id on every run and retry."""
    return F.concat(F.lit(prefix), F.substring(F.md5(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, 12))


def page_list(pages: Column) -> Column:
    """Sorted distinct pages of a text like ``1-3, 7; 9``."""
    parts = F.filter(F.split(F.coalesce(pages, F.lit("")), "[,;]"), lambda p: F.regexp_replace(p, r"\s", "").rlike(r"^\d+(-\d+)?$"))
    ends = F.transform(parts, lambda p: F.transform(F.split(F.regexp_replace(p, r"\s", ""), "-"), lambda x: x.cast("int")))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(ends, lambda e: F.sequence(F.array_min(e), F.array_max(e))))))
