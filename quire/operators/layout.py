"""Order, outline and grouping of the blocks of a document.

Rows have ``doc_id`` and ``ord``; all windows and folds are keyed by document, so the work is parallel
over documents. Only the stitching fold, whose state isn't associative, runs in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quire.functions.text import any_of, heading_level, is_list_continuation, is_list_item, is_procedure_item, strip
from quire.functions import patterns as P
from quire.operators.folds import fold_groups

#: Heading levels that an outline keeps apart.
DEPTH = 6


def _doc() -> WindowSpec:
    """Blocks of a document in order."""
    return Window.partitionBy("doc_id").orderBy("ord")


def _so_far() -> WindowSpec:
    """Blocks of a document up to this one."""
    return _doc().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def reading_order(df: DataFrame) -> DataFrame:
    """Add ``ord``: blocks by page, then index, else top and left edge; ties by id."""
    has = F.col("block_index").isNotNull()
    w = Window.partitionBy("doc_id").orderBy("page_idx", F.when(has, F.col("block_index")).otherwise(F.coalesce("y0", F.lit(0.0))), F.when(has, 0.0).otherwise(F.coalesce("x0", F.lit(0.0))), "block_key")
    return df.withColumn("ord", (F.row_number().over(w) - 1).cast("long"))


def adjacency(df: DataFrame, key: str, text: str, width: int = 200) -> DataFrame:
    """Previous and next id, and the start of the neighbours' texts."""
    return df.withColumns({
        "prev_id": F.lag(key).over(_doc()), "next_id": F.lead(key).over(_doc()),
        "context_before": F.substring(F.lag(text).over(_doc()), 1, width), "context_after": F.substring(F.lead(text).over(_doc()), 1, width),
    })


def outline(df: DataFrame) -> DataFrame:
    """Add ``level`` (headings only), ``heading_path`` and ``section_ord`` (ord of the innermost heading).

    The heading stack is a forward fill: for each level the last heading of it, kept while no heading
    of a higher level came after it.
    """
    level = F.when(F.col("block_type") == "heading", F.least(heading_level(F.col("text")), F.lit(DEPTH)))
    df = df.withColumn("level", level)
    for k in range(1, DEPTH + 1):
        df = df.withColumn(f"_h{k}", F.last(F.when(F.col("level") == k, F.struct("ord", F.trim("text").alias("title"))), ignorenulls=True).over(_so_far()))
    titles: list[Column] = []
    higher: Column = F.lit(-1).cast("long")
    for k in range(1, DEPTH + 1):
        here = F.col(f"_h{k}")
        open_ = here.isNotNull() & (here["ord"] > higher)
        titles.append(F.when(open_, here["title"]))
        higher = F.greatest(higher, F.coalesce(here["ord"], F.lit(-1)))
    return df.withColumn("heading_path", F.concat_ws(" > ", *titles)).withColumn("section_ord", F.when(higher >= 0, higher)).drop(*[f"_h{k}" for k in range(1, DEPTH + 1)])


def sections(df: DataFrame) -> DataFrame:
    """One row a heading: title, level, path, its block range and page range."""
    heads = outline(df).where("level is not null")
    last = df.groupBy("doc_id").agg(F.max("ord").alias("_last"), F.max("page_idx").alias("_page"))
    nxt = F.lead("ord").over(_doc())
    rows = heads.join(last, "doc_id")
    return rows.select("doc_id", F.col("ord").alias("start_idx"), F.coalesce(nxt - 1, F.col("_last")).alias("end_idx"), F.trim("text").alias("title"), "level", "heading_path", F.col("page_idx").alias("start_page"), F.greatest(F.col("page_idx"), F.coalesce(F.lead("page_idx").over(_doc()), F.col("_page"))).alias("end_page"))


def blocks_in_range(df: DataFrame, first_page: Column) -> DataFrame:
    """Blocks from the first page of the main body on; ``first_page`` aggregates a document."""
    start = df.groupBy("doc_id").agg(first_page.alias("_first"))
    return df.join(start, "doc_id").where(F.col("page_idx") >= F.coalesce("_first", F.lit(0))).drop("_first")


def main_body(df: DataFrame) -> DataFrame:
    """Blocks of root sections from the first main-body title up to the first back-matter title."""
    o = outline(df)
    root = F.when((F.col("level") == 1) | any_of(F.lower(strip(F.col("text"))), P.BACK_MATTER), F.lower(strip(F.col("text"))))
    head = F.col("block_type") == "heading"
    whole = Window.partitionBy("doc_id")
    first = F.min(F.when(head & any_of(root, P.MAIN_BODY), F.col("ord"))).over(whole)
    back = F.min(F.when(head & any_of(root, P.BACK_MATTER), F.col("ord"))).over(whole)
    return o.withColumns({"_first": first, "_back": back}).where((F.col("ord") >= F.coalesce("_first", F.lit(0))) & (F.col("_back").isNull() | (F.col("ord") < F.col("_back")))).drop("_first", "_back")


def forward_block(toc: DataFrame, df: DataFrame) -> DataFrame:
    """First block on or after the page of each entry (doc_id, entry, page): a forward as-of join.

    Entries and blocks are merged in page order and filled backwards, so no range join is planned.
    """
    blocks = df.select("doc_id", F.col("page_idx").alias("page"), F.lit(None).cast("long").alias("entry"), "ord")
    both = toc.select("doc_id", "page", F.col("entry").cast("long").alias("entry"), F.lit(None).cast("long").alias("ord")).unionByName(blocks)
    w = Window.partitionBy("doc_id").orderBy("page", F.col("entry").isNull(), "ord").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return both.withColumn("block_ord", F.first("ord", ignorenulls=True).over(w)).where("entry is not null").select("doc_id", "entry", "page", "block_ord")


def list_groups(df: DataFrame) -> DataFrame:
    """Consecutive list or procedure items with their continuation lines as one group (islands)."""
    t = F.col("text")
    item = (F.col("block_type").isin("text", "list")) & (is_list_item(t) | is_procedure_item(t))
    follow = F.col("block_type").isin("text", "list") & is_list_continuation(t)
    marked = df.withColumn("_kind", F.when(item, 2).when(follow, 1).otherwise(0))
    # a continuation belongs to a group only if everything since the last item continues it
    marked = marked.withColumn("_stop", F.max(F.when(F.col("_kind") == 0, F.col("ord"))).over(_so_far())).withColumn("_item", F.max(F.when(F.col("_kind") == 2, F.col("ord"))).over(_so_far()))
    inside = F.col("_item").isNotNull() & (F.col("_stop").isNull() | (F.col("_item") > F.col("_stop"))) & (F.col("_kind") > 0)
    marked = marked.withColumn("_in", inside)
    start = F.col("_in") & ~F.coalesce(F.lag("_in").over(_doc()), F.lit(False))
    marked = marked.withColumn("_group", F.sum(start.cast("int")).over(_so_far()))
    return marked.where("_in").groupBy("doc_id", F.col("_group").cast("long").alias("group_no")).agg(*_union("ord", "text"))


def title_groups(df: DataFrame) -> DataFrame:
    """A heading with the texts after it up to the next heading or visual block."""
    stop = F.col("block_type").isin("heading", "table", "image", "formula")
    m = df.withColumn("_head", F.max(F.when(F.col("block_type") == "heading", F.col("ord"))).over(_so_far())).withColumn("_stop", F.max(F.when(stop, F.col("ord"))).over(_so_far()))
    m = m.where((F.col("_head") == F.col("_stop")) & (F.trim("text") != ""))
    return m.groupBy("doc_id", F.col("_head").alias("head_ord")).agg(*_union("ord", "text"))


def _union(order: str, text: str) -> list[Column]:
    """Content in order, page span, box union and size of a group."""
    parts = F.array_sort(F.collect_list(F.struct(order, text)))
    return [
        F.array_join(F.transform(parts, lambda p: strip(p[text])), "\n").alias("content"), F.min("page_idx").alias("page_start"), F.max("page_idx").alias("page_end"),
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("n_blocks"),
    ]


def repeated_lines(df: DataFrame, page: str, text: str, most_words: int = 8) -> DataFrame:
    """Distinct pages on which each short normalised text stands: running headers and footers repeat."""
    t = F.lower(F.regexp_replace(strip(F.col(text)), r"\s+", " "))
    rows = df.select("doc_id", F.col(page).alias("page"), t.alias("line")).where((F.col("line") != "") & (F.size(F.split("line", " ")) <= most_words)).distinct()
    return rows.groupBy("doc_id", "line").agg(F.count("*").alias("n_pages"))


def furniture(df: DataFrame, frequency: DataFrame, height: float, band: float = 0.1, share: float = 0.2) -> DataFrame:
    """Blocks in the top or bottom band of the page whose text stands on more than ``share`` of the pages, or is a short number."""
    pages = df.groupBy("doc_id").agg(F.count_distinct("page_idx").alias("_pages"))
    t = F.lower(F.regexp_replace(strip(F.col("text")), r"\s+", " "))
    edge = (F.col("y0") < height * band) | (F.col("y1") > height * (1 - band))
    rows = df.withColumn("line", t).join(pages, "doc_id").join(frequency, ["doc_id", "line"], "left")
    return rows.where(edge & ((F.coalesce("n_pages", F.lit(0)) > share * F.col("_pages")) | F.col("line").rlike(r"^\d{1,4}$"))).drop("_pages")


_OPEN = (".", "!", "?", ":", ";")


def stitch(df: DataFrame, height: float = 750.0) -> DataFrame:
    """Join paragraphs broken across blocks: an ordered fold in which page and box of the first block stay."""

    def fold(rows: list) -> list[tuple]:
        out: list[list] = []
        for r in rows:
            text = (r.text or "").strip()
            last = out[-1] if out else None
            joins = False
            if last and last[2] == r.block_type == "text" and text:
                broken = not last[6].rstrip().endswith(_OPEN) or text[:1].islower()
                if last[3] == r.page_idx:
                    near = last[4] is None or r.x0 is None or abs(last[4] - r.x0) <= 20
                else:
                    near = r.page_idx == last[3] + 1 and (last[5] or 0) >= 0.9 * height and (r.y0 or 0) <= 0.1 * height
                joins = near and broken
            if joins:
                old = last[6].rstrip()
                last[6] = old[:-1] + text if old.endswith("-") else f"{old} {text}"
                last[7] += 1
            else:
                out.append([r.doc_id, r.ord, r.block_type, r.page_idx, r.x0, r.y1, text, 1])
        return [(o[0], o[1], o[2], o[3], o[6], o[7]) for o in out]

    names = ["doc_id", "ord", "block_type", "page_idx", "x0", "y0", "y1", "text"]
    return fold_groups(df.select(*names), ["doc_id"], ["ord"], fold, "doc_id long, ord long, block_type string, page_idx long, text string, n_merged int")


def cluster_rows(words: DataFrame, threshold: float) -> DataFrame:
    """Row number of each OCR word (page_id, y): the centre of a row is the running mean of its words."""

    def fold(rows: list) -> list[tuple]:
        out, centre, n, k = [], 0.0, 0, -1
        for r in rows:
            if n and abs(r.y - centre) <= threshold:
                centre, n = (centre * n + r.y) / (n + 1), n + 1
            else:
                centre, n, k = r.y, 1, k + 1
            out.append((r.page_id, r.word_id, k))
        return out

    return fold_groups(words.select("page_id", "word_id", "y"), ["page_id"], ["y", "word_id"], fold, "page_id long, word_id long, row_no int")


def gap_groups(df: DataFrame, by: str, at: str, gap: float) -> DataFrame:
    """Sessionise positions: a new group starts where the gap to the one before exceeds ``gap``."""
    w = Window.partitionBy(by).orderBy(at, "item_id")
    new = (F.coalesce(F.col(at) - F.lag(at).over(w), F.lit(0.0)) > gap).cast("int")
    return df.withColumn("_new", new).withColumn("group_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_new")
