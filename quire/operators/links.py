"""Joins between the parts of a document: references, formulas, questions and answers, regions.

Every join has the document (and often the page or chapter) as equality key, so range and nearest
conditions only act inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import cross_references
from quire.operators.folds import fold_groups


def reference_index(defs: DataFrame) -> DataFrame:
    """Defining block of each (doc_id, type, id): the last definition in document order wins."""
    rows = defs.select("doc_id", "ord", F.explode(cross_references(F.col("text"))).alias("r")).select("doc_id", "ord", "r.type", "r.id")
    return rows.groupBy("doc_id", "type", "id").agg(F.max("ord").alias("target_ord"))


def linked_references(df: DataFrame, index: DataFrame) -> DataFrame:
    """Each reference of each block with its target, null where nothing defines it."""
    refs = df.select("doc_id", "ord", F.explode(cross_references(F.col("text"))).alias("r")).select("doc_id", "ord", "r.type", "r.id")
    return refs.join(index, ["doc_id", "type", "id"], "left")


def shared_symbols(formulas: DataFrame, texts: DataFrame, pages: int = 40, k: int = 3) -> DataFrame:
    """Top ``k`` formulas of each text by shared symbols, in the same document and within ``pages``.

    ``formulas`` and ``texts`` have doc_id, ord, page_idx and an array ``symbols``; the join is on
    (document, symbol), never all pairs.
    """
    f = formulas.select("doc_id", F.col("ord").alias("formula_ord"), F.col("page_idx").alias("fp"), F.explode("symbols").alias("symbol"))
    t = texts.select("doc_id", "ord", "page_idx", F.explode("symbols").alias("symbol"))
    near = t.join(f, ["doc_id", "symbol"]).where((F.abs(F.col("page_idx") - F.col("fp")) <= pages))
    scored = near.groupBy("doc_id", "ord", "formula_ord").agg((F.count("*") - F.first(F.abs(F.col("page_idx") - F.col("fp"))) / (2.0 * pages)).alias("score"))
    best = Window.partitionBy("doc_id", "ord").orderBy(F.desc("score"), "formula_ord")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def overlap_ratio(a: str, b: str) -> Column:
    """Overlap of box ``b`` with box ``a`` as a share of ``a``; columns a_x0 ... b_y1."""
    w = F.greatest(F.lit(0.0), F.least(f"{a}_x1", f"{b}_x1") - F.greatest(f"{a}_x0", f"{b}_x0"))
    h = F.greatest(F.lit(0.0), F.least(f"{a}_y1", f"{b}_y1") - F.greatest(f"{a}_y0", f"{b}_y0"))
    area = (F.col(f"{a}_x1") - F.col(f"{a}_x0")) * (F.col(f"{a}_y1") - F.col(f"{a}_y0"))
    return F.when(area > 0, w * h / area).otherwise(0.0)


def rect_distance(a: str, b: str) -> Column:
    """Distance of two boxes, zero if they touch."""
    dx = F.greatest(F.lit(0.0), F.col(f"{a}_x0") - F.col(f"{b}_x1"), F.col(f"{b}_x0") - F.col(f"{a}_x1"))
    dy = F.greatest(F.lit(0.0), F.col(f"{a}_y0") - F.col(f"{b}_y1"), F.col(f"{b}_y0") - F.col(f"{a}_y1"))
    return F.hypot(dx, dy)


def _boxes(df: DataFrame, p: str) -> DataFrame:
    return df.select("doc_id", F.col("page_idx").alias("page"), F.col("ord").alias(f"{p}_ord"), *[F.col(c).alias(f"{p}_{c}") for c in ("x0", "y0", "x1", "y1")])


def source_match(segments: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunk that each segment comes from: its page before the page ahead of it; most overlap, then nearest centre."""
    s = _boxes(segments, "s")
    c = _boxes(chunks, "c")
    same = s.join(c, ["doc_id", "page"]).withColumn("tier", F.lit(0))
    before = s.join(c.withColumn("page", F.col("page") + 1), ["doc_id", "page"]).withColumn("tier", F.lit(1))
    both = same.unionByName(before).withColumn("overlap", overlap_ratio("s", "c")).withColumn("dist", F.abs((F.col("s_y0") + F.col("s_y1")) / 2 - (F.col("c_y0") + F.col("c_y1")) / 2))
    best = Window.partitionBy("doc_id", "s_ord").orderBy("tier", F.desc("overlap"), "dist", "c_ord")
    return both.withColumn("_r", F.row_number().over(best)).where("_r = 1").select("doc_id", F.col("s_ord").alias("ord"), F.col("c_ord").alias("chunk_ord"), "tier", F.round("overlap", 6).alias("overlap"))


def near_regions(blocks: DataFrame, regions: DataFrame, reach: float = 140.0) -> DataFrame:
    """Blocks that overlap a region of their page or lie within ``reach`` above or below one."""
    r = _boxes(regions, "r").select("doc_id", F.col("page").alias("page_idx"), "r_y0", "r_y1")
    # one interval list a page would do, but a semi-join keeps memory flat for pages with many regions
    near = (F.col("y0") <= F.col("r_y1") + reach) & (F.col("y1") >= F.col("r_y0") - reach)
    b = blocks.alias("b")
    r = r.alias("r")
    return b.join(r, (F.col("b.doc_id") == F.col("r.doc_id")) & (F.col("b.page_idx") == F.col("r.page_idx")) & near, "left_semi")


def answer_scores(questions: DataFrame, solutions: DataFrame, least: float = 0.75) -> DataFrame:
    """Best question of each solution by number, zone, chapter and shared words, from ``least`` on.

    Both sides have doc_id, ord, chapter, zone, num and an array ``words`` (the first 20 of the text).
    """
    q = questions.select("doc_id", "chapter", F.col("ord").alias("q_ord"), F.col("zone").alias("q_zone"), F.col("num").alias("q_num"), F.col("words").alias("q_words"))
    both = solutions.join(q, ["doc_id", "chapter"])
    union = F.size(F.array_union("words", "q_words"))
    jaccard = F.when(union > 0, F.size(F.array_intersect("words", "q_words")) / union).otherwise(0.0)
    score = F.when(F.col("num") == F.col("q_num"), 0.7).otherwise(0.0) + F.when(F.col("zone") == F.col("q_zone"), 0.2).otherwise(0.0) + 0.1 + 0.2 * jaccard
    best = Window.partitionBy("doc_id", "ord").orderBy(F.desc("score"), "q_ord")
    return both.withColumn("score", F.round(score, 6)).where(F.col("score") >= least).withColumn("_r", F.row_number().over(best)).where("_r = 1").select("doc_id", "ord", "q_ord", "score")


#: Tiers of the one-to-one assignment: same zone required, pages apart at most.
TIERS = [("key", True, 0), ("chapter_zone", True, 25), ("chapter_number", False, 80), ("chapter_number_far", False, 160), ("zone_number", True, 120), ("chapter", False, 80)]


def assign_answers(questions: DataFrame, solutions: DataFrame) -> DataFrame:
    """One-to-one pairs (doc_id, ord, q_ord, tier): solutions in page order take the nearest free question.

    The pass depends on order, so it runs per document; candidates are indexed by number and chapter.
    """
    fields = ["doc_id", "ord", "page_idx", "chapter", "zone", "num"]
    q = questions.select(*fields).withColumn("side", F.lit(0))
    rows = q.unionByName(solutions.select(*fields).withColumn("side", F.lit(1)))

    def fold(rows: list) -> list[tuple]:
        free: dict[tuple, list] = {}
        for r in rows:
            if r.side == 0:
                free.setdefault(("n", r.num), []).append(r)
                free.setdefault(("c", r.chapter), []).append(r)
        used: set[int] = set()
        out = []
        for s in rows:
            if s.side == 0:
                continue
            for tier, zoned, reach in TIERS:
                pool = free.get(("c", s.chapter) if tier == "chapter" else ("n", s.num), [])
                fit = [
                    (abs(x.page_idx - s.page_idx), x.ord)
                    for x in pool
                    if x.ord not in used and (not zoned or x.zone == s.zone) and (tier == "zone_number" or x.chapter == s.chapter) and (tier == "key" or abs(x.page_idx - s.page_idx) <= reach)
                ]
                if fit:
                    took = min(fit)[1]
                    used.add(took)
                    out.append((s.doc_id, s.ord, took, tier))
                    break
        return out

    return fold_groups(rows, ["doc_id"], ["page_idx", "ord"], fold, "doc_id long, ord long, q_ord long, tier string")


def nearest_chapter(items: DataFrame, marks: DataFrame, reach: int = 120) -> DataFrame:
    """Chapter of the mark (doc_id, page_idx, chapter) nearest in pages to each item; earlier marks win ties."""
    m = marks.select("doc_id", F.col("page_idx").alias("mp"), F.col("ord").alias("mo"), "chapter")
    m = m.groupBy("doc_id", "mp").agg(F.min_by("chapter", "mo").alias("chapter"), F.min("mo").alias("mo"))
    dist = F.abs(F.col("page_idx") - F.col("mp"))
    near = items.select("doc_id", "ord", "page_idx").join(m, "doc_id").where(dist <= reach)
    return near.groupBy("doc_id", "ord").agg(F.min_by("chapter", F.struct(dist.alias("d"), F.col("mo"))).alias("chapter"))


def answer_signals(questions: DataFrame, solutions: DataFrame, least: float = 0.75) -> DataFrame:
    """Best question (solution_id, question_id, score) of each solution in a book by several signals, from ``least`` on.

    Both sides have id, book_id, chapter, key (chapter and number), formulas (array), concepts (array) and text.
    Signals: the key 0.7; the chapter 0.1, and chapters more than one apart never match; shared concepts 0.1 to 0.25;
    shared formulas 0.1 each up to 0.3; 0.1 for more than 0.3 of shared words where the question has formulas. Word
    similarity counts below a score of 0.5 only and adds 0.2 at most, so it can't lift a pair to ``least``. Without an
    equal key or a shared formula no pair reaches 0.75 either: pairs come from two equi-joins on these.
    """
    if least < 0.75:
        raise ValueError("pairs below 0.75 need no shared key or formula, so they can't be found by joins on these")
    fields = ["id", "book_id", "chapter", "key", "formulas", "concepts", "text"]
    q = questions.select(*[F.col(c).alias(f"q_{c}") for c in fields])
    s = solutions.select(*fields)
    by_key = s.join(q, (F.col("book_id") == F.col("q_book_id")) & (F.col("key") == F.col("q_key"))).select("id", "q_id")
    qf, sf = q.select("q_id", "q_book_id", F.explode("q_formulas").alias("qf")), s.select("id", "book_id", F.explode("formulas").alias("f"))
    by_formula = sf.join(qf, (F.col("book_id") == F.col("q_book_id")) & (F.col("f") == F.col("qf"))).select("id", "q_id")
    pairs = by_key.unionByName(by_formula).distinct().join(s, "id").join(q, "q_id")
    number = lambda c: F.coalesce(F.regexp_extract(c, r"(\d+)", 1).try_cast("int"), F.lit(0))
    known = (F.col("chapter") != "Unknown") & (F.col("q_chapter") != "Unknown")
    far = known & (F.col("chapter") != F.col("q_chapter")) & (F.abs(number(F.col("chapter")) - number(F.col("q_chapter"))) > 1)
    empty = F.array().cast("array<string>")
    shared = lambda c: F.size(F.array_intersect(F.coalesce(F.col(c), empty), F.coalesce(F.col(f"q_{c}"), empty)))
    union = F.size(F.array_union(F.coalesce(F.col("concepts"), empty), F.coalesce(F.col("q_concepts"), empty)))
    concepts = F.when(shared("concepts") > 0, F.least(F.lit(0.25), 0.1 + 0.15 * shared("concepts") / union)).otherwise(0.0)
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.coalesce(F.col(c), F.lit(""))), r"\s+"), lambda w: w != ""))
    a, b = words("text"), words("q_text")
    alike = F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))
    score = (
        F.when(F.col("key") == F.col("q_key"), 0.7).otherwise(0.0) + F.when(known & (F.col("chapter") == F.col("q_chapter")), 0.1).otherwise(0.0) + concepts
        + F.least(F.lit(0.3), 0.1 * shared("formulas")) + F.when((F.size(F.coalesce(F.col("q_formulas"), empty)) > 0) & (alike > 0.3), 0.1).otherwise(0.0)
    )
    best = pairs.where(~F.coalesce(far, F.lit(False))).withColumn("score", F.round(F.least(F.lit(1.0), score), 6)).where(F.col("score") >= least)
    best = best.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("q_id"))).alias("b"))
    return best.select(F.col("id").alias("solution_id"), F.col("b.q_id").alias("question_id"), (-F.col("b.s")).alias("score"))
