"""Fragments, columns and clusters of a page, and concept links of visuals.

The clusterings depend on order (a centre or a group's first element decides), so they run as folds a
page in Python; a page is small. Concept links are equi-joins on terms.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import strip
from quire.operators.folds import fold_groups

#: An equation number at the end of a formula.
NUMBERED = re.compile(r"\(\d+(?:\.\d+)*\)\s*$")

#: Common words that make no concept term.
STOP = ["the", "and", "for", "with", "from", "that", "this", "are", "its"]


def merge_fragments(df: DataFrame, gap: float = 40.0, side: float = 60.0) -> DataFrame:
    """Formula fragments of a page joined while they stay near the group's first one; a number closes a group."""

    def fold(rows: list) -> list[tuple]:
        out: list[list] = []
        for r in rows:
            text = (r.text or "").strip()
            last = out[-1] if out else None
            if last is not None and not NUMBERED.search(last[3]) and r.y0 - last[5] <= gap and abs(r.x0 - last[4]) <= side:
                last[3] = f"{last[3]} {text}".strip()
                last[5] = max(last[5], r.y1)
                last[6] += 1
            else:
                out.append([r.doc_id, r.page_idx, r.ord, text, r.x0, r.y1, 1])
        return [(o[0], o[1], o[2], o[3], o[6]) for o in out]

    names = ["doc_id", "page_idx", "ord", "x0", "y0", "y1", "text"]
    placed = df.select(*names).where("x0 is not null and y0 is not null and y1 is not null")
    return fold_groups(placed, ["doc_id", "page_idx"], ["y0", "x0", "ord"], fold, "doc_id long, page_idx long, ord long, text string, n_merged int")


def cluster_columns(words: DataFrame, threshold: float) -> DataFrame:
    """Column centres of each page (page_id, x): a word joins the first centre within reach and moves it."""

    def fold(rows: list) -> list[tuple]:
        centres: list[list[float]] = []
        for r in rows:
            near = next((c for c in centres if abs(c[0] - r.x) <= threshold), None)
            if near:
                near[0], near[1] = (near[0] * near[1] + r.x) / (near[1] + 1), near[1] + 1
            else:
                centres.append([r.x, 1])
        return [(rows[0].page_id, i, c[0], int(c[1])) for i, c in enumerate(sorted(centres))]

    return fold_groups(words.select("page_id", "x").where("x is not null"), ["page_id"], ["x"], fold, "page_id long, col_no int, centre double, n_words int")


def cluster_drawings(df: DataFrame, reach: float = 100.0, least: int = 3) -> DataFrame:
    """Drawings grouped around seeds: each free box opens a group and takes all free boxes within reach of it."""

    def apart(a, b) -> float:
        return math.hypot(max(0.0, a.x0 - b.x1, b.x0 - a.x1), max(0.0, a.y0 - b.y1, b.y0 - a.y1))

    def fold(rows: list) -> list[tuple]:
        out = []
        while rows:
            s = rows[0]
            group = [r for r in rows if r is s or apart(r, s) < reach]
            rows = [r for r in rows if r is not s and apart(r, s) >= reach]
            if len(group) >= least:
                out.append((s.doc_id, s.page_idx, s.ord, len(group), min(r.x0 for r in group), min(r.y0 for r in group), max(r.x1 for r in group), max(r.y1 for r in group)))
        return out

    names = ["doc_id", "page_idx", "ord", "x0", "y0", "x1", "y1"]
    placed = df.select(*names).where("x0 is not null and y0 is not null and x1 is not null and y1 is not null")
    return fold_groups(placed, ["doc_id", "page_idx"], ["y0", "x0", "ord"], fold, "doc_id long, page_idx long, seed long, n_items int, x0 double, y0 double, x1 double, y1 double")


def unclaimed(regions: DataFrame, taken: DataFrame, share: float = 0.5) -> DataFrame:
    """Regions that no taken region of their page overlaps by more than ``share`` of the smaller one: an anti-join."""
    r, t = regions.alias("r"), taken.alias("t")

    def c(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    w = F.least(c("r", "x1"), c("t", "x1")) - F.greatest(c("r", "x0"), c("t", "x0"))
    h = F.least(c("r", "y1"), c("t", "y1")) - F.greatest(c("r", "y0"), c("t", "y0"))
    small = F.least((c("r", "x1") - c("r", "x0")) * (c("r", "y1") - c("r", "y0")), (c("t", "x1") - c("t", "x0")) * (c("t", "y1") - c("t", "y0")))
    return r.join(t, (c("r", "doc_id") == c("t", "doc_id")) & (c("r", "page_idx") == c("t", "page_idx")) & (w > 0) & (h > 0) & (w * h > share * small), "left_anti")


def prune_sections(sections: DataFrame, blocks: DataFrame) -> DataFrame:
    """Sections (doc_id, start_idx, end_idx, level) that hold a text or visual block, or have a descendant that does.

    A section's subtree ends before the next heading of its level or above; block counts are running sums,
    so no section meets the blocks one by one.
    """
    w = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = F.sum(F.when((F.col("block_type") != "heading") & ((strip(F.col("text")) != "") | F.col("block_type").isin("image", "table", "formula")), 1).otherwise(0)).over(w)
    running = blocks.select("doc_id", "ord", filled.alias("upto"))
    deeper = Window.partitionBy("doc_id").orderBy("start_idx").rowsBetween(1, Window.unboundedFollowing)
    nxt = None
    for level in range(6, 0, -1):
        at = F.min(F.when(F.col("level") <= level, F.col("start_idx"))).over(deeper)
        nxt = F.when(F.col("level") == level, at) if nxt is None else nxt.when(F.col("level") == level, at)
    last = blocks.groupBy("doc_id").agg(F.max("ord").alias("_last"))
    s = sections.withColumn("_next", nxt).join(last, "doc_id").withColumn("subtree_end", F.coalesce(F.col("_next") - 1, F.col("_last"))).drop("_next", "_last")
    at_end = running.select("doc_id", F.col("ord").alias("subtree_end"), F.col("upto").alias("_e"))
    at_start = running.select("doc_id", F.col("ord").alias("start_idx"), F.col("upto").alias("_s"))
    return s.join(at_end, ["doc_id", "subtree_end"]).join(at_start, ["doc_id", "start_idx"]).withColumn("n_filled", F.col("_e") - F.col("_s")).where(F.col("n_filled") > 0).drop("_e", "_s")


def candidate_pages(candidates: DataFrame, last_page: int | None = None) -> DataFrame:
    """Pages of the candidates and the page after each, once each."""
    both = candidates.select("doc_id", "page_idx").unionByName(candidates.select("doc_id", (F.col("page_idx") + 1).alias("page_idx"))).distinct()
    return both if last_page is None else both.where(F.col("page_idx") <= last_page)


def page_votes(hints: DataFrame) -> DataFrame:
    """Zone with the largest summed weight of each page; ties go to the smaller name."""
    v = hints.groupBy("doc_id", "page_idx", "zone").agg(F.sum("weight").alias("votes"))
    w = Window.partitionBy("doc_id", "page_idx").orderBy(F.desc("votes"), "zone")
    return v.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def backfill(rows: DataFrame, source: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Null or empty fields filled from the row of ``source`` with the same key."""
    s = source.groupBy(key).agg(F.max(F.struct(*fields)).alias("_s"))
    return rows.join(s, key, "left").withColumns({f: F.coalesce(F.when(F.col(f).cast("string") != "", F.col(f)), F.col(f"_s.{f}")) for f in fields}).drop("_s")


def derivation_roles(refs: Column) -> Column:
    """Inputs and target of a derivation: the last referenced formula is the target."""
    return F.when(F.size(refs) > 0, F.struct(F.slice(refs, 1, F.greatest(F.size(refs) - 1, F.lit(0))).alias("inputs"), F.element_at(refs, -1).alias("target")))


def back_links(examples: DataFrame) -> DataFrame:
    """Examples of each formula, from rows (segment_id, referenced_formula_ids)."""
    e = examples.select("segment_id", F.explode("referenced_formula_ids").alias("formula_id")).distinct()
    return e.groupBy("formula_id").agg(F.array_sort(F.collect_list("segment_id")).alias("example_ids"))


def ngrams(text: Column, low: int = 2, high: int = 4) -> Column:
    """Word n-grams of a text without stop words, longest first."""
    words = F.filter(F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9]+", " ")), " "), lambda w: (w != "") & ~w.isin(STOP))

    def of(n: int) -> Column:
        return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.array(*[of(n) for n in range(high, low - 1, -1)])))


def concept_terms(concepts: DataFrame) -> DataFrame:
    """Terms (concept_id, term, role, generic) of concepts: name without brackets, acronym in brackets, aliases, tags.

    A single word is generic if it stands in a longer concept's name, or in 8 % of the concepts and at least three.
    """
    name = F.coalesce("concept_name", F.lit(""))
    inside = F.regexp_extract(name, r"\(([A-Z][A-Za-z0-9&-]{1,9})\)", 1)
    bare = F.trim(F.regexp_replace(name, r"\s*\([^)]*\)", ""))
    rows = concepts.select("concept_id", F.explode(F.concat(
        F.array(F.struct(bare.alias("term"), F.lit("name").alias("role")), F.struct(inside.alias("term"), F.lit("acronym").alias("role"))),
        F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.struct(a.alias("term"), F.lit("alias").alias("role"))),
        F.transform(F.coalesce("tags", F.array().cast("array<string>")), lambda a: F.struct(a.alias("term"), F.lit("tag").alias("role"))),
    )).alias("t")).select("concept_id", F.trim(F.regexp_replace(F.lower("t.term"), r"[^a-z0-9]+", " ")).alias("term"), "t.role")
    rows = rows.where("term <> ''").distinct()
    words = rows.select("concept_id", F.explode(F.split("term", " ")).alias("word"), (F.size(F.split("term", " ")) > 1).alias("many")).groupBy("word").agg(F.count_distinct("concept_id").alias("df"), F.bool_or("many").alias("in_longer"))
    n = concepts.select("concept_id").distinct().count()
    single = F.size(F.split("term", " ")) == 1
    generic = single & (F.coalesce("in_longer", F.lit(False)) | ((F.col("df") >= 3) & (F.col("df") >= 0.08 * n)))
    return rows.join(words.withColumnRenamed("word", "term"), "term", "left").select("concept_id", "term", "role", F.coalesce(generic, F.lit(False)).alias("generic"))


def visual_concepts(texts: DataFrame, terms: DataFrame, least: float = 0.5, k: int = 5) -> DataFrame:
    """Concepts of each visual (visual_id, text): terms found as phrases, weighted by role and length.

    Names and aliases of several words and acronyms count 1, single words 0.7, tags 0.3, generic single words
    nothing alone; the score is capped at 1, kept from ``least`` on, at most ``k`` a visual.
    """
    sizes = [r[0] for r in terms.select(F.size(F.split("term", " ")).alias("n")).distinct().orderBy("n").collect()]
    w = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[^a-z0-9]+", " ")), " ")

    def of(n: int) -> Column:
        return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))

    grams = F.flatten(F.array(*[of(n) for n in sizes])) if sizes else F.array().cast("array<string>")
    hit = texts.select("visual_id", F.explode(F.array_distinct(grams)).alias("term")).join(terms, "term")
    weight = F.when(F.col("role") == "tag", 0.3).when(F.col("generic"), 0.0).when((F.col("role") == "acronym") | F.contains("term", F.lit(" ")), 1.0).otherwise(0.7)
    scored = hit.groupBy("visual_id", "concept_id").agg(F.least(F.lit(1.0), F.round(F.sum(weight), 6)).alias("score")).where(F.col("score") >= least)
    best = Window.partitionBy("visual_id").orderBy(F.desc("score"), "concept_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def describe_table(headers: Column, title: Column) -> Column:
    """A sentence on what a table holds, from words of its headers."""
    h = F.lower(F.array_join(F.coalesce(headers, F.array().cast("array<string>")), " "))
    kind = F.when(h.rlike("principal|amorti[sz]"), "amortisation schedule").when(h.rlike("coupon|yield|maturity"), "bond figures").when(h.rlike("cash ?flow|npv|present value"), "cash flows").otherwise("figures")
    return F.concat(F.lit("Table of "), kind, F.lit(" with "), F.size(F.coalesce(headers, F.array().cast("array<string>"))).cast("string"), F.lit(" columns: "), F.coalesce(title, F.lit("untitled")))


def page_bounds(span: Column, pages: Column) -> Column:
    """First and last page, counted from 1, from a span or else a list; reversed spans are turned."""
    both = F.when(F.size(span) >= 2, span).otherwise(pages)
    return F.struct(F.greatest(F.lit(1), F.coalesce(F.array_min(both), F.lit(0)) + 1).alias("page_start"), F.greatest(F.lit(1), F.coalesce(F.array_max(both), F.lit(0)) + 1).alias("page_end"))


def box(values: Column) -> Column:
    """Array of four numbers as a struct, null if shorter."""
    return F.when(F.size(values) >= 4, F.struct(*[F.get(values, F.lit(i)).cast("double").alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]))
