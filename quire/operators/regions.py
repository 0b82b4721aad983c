"""Regions of a page: validity, captions, conflicts, gaps; and approximate matching of headings."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.formulas import cell_type
from quire.functions.text import alnum_key, any_of, contains_any, strip

FIGURE_WORDS = ["figure", "chart", "graph", "diagram"]
CAPTION = r"(?i)^\s*(figure|fig\.?|table|exhibit|chart|graph)\s+(\d+(?:\.\d+)*)"
REFERS = [r"\b(?:see|shown in|as in|refer to|according to|in|from)\s+(?:figure|fig\.?|table|exhibit)\s+\d"]


def is_decorative(x0: Column, y0: Column, x1: Column, y1: Column, width: float, height: float) -> Column:
    """Lines, dots and logos: tiny area, a very short side or an extreme shape."""
    w, h = x1 - x0, y1 - y0
    return (w <= 0) | (h <= 0) | (w * h < 0.002 * width * height) | (w < 0.03 * width) | (h < 0.03 * height) | (F.greatest(w / h, h / w) > 12)


def clipped(df: DataFrame, width: float, height: float) -> DataFrame:
    """Boxes clipped to the page; boxes outside vanish."""
    c = df.withColumns({"x0": F.greatest("x0", F.lit(0.0)), "y0": F.greatest("y0", F.lit(0.0)), "x1": F.least("x1", F.lit(width)), "y1": F.least("y1", F.lit(height))})
    return c.where((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")))


def table_validity(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """Reason why a table is no table, or ``ok``; the first rule that holds."""
    v = F.trim(F.coalesce("raw_value", F.lit("")))
    kind = cell_type(F.col("raw_value"))
    stats = cells.groupBy("segment_id").agg(
        F.count_distinct("row_index").alias("n_rows"), F.count("*").alias("n_cells"), F.count_if(v != "").alias("n_filled"), F.count_if(F.char_length(v) > 500).alias("n_long"), F.max(F.char_length(v)).alias("longest"),
        F.count_if((v != "") & ((F.char_length(v) < 150) | kind.isin("number", "currency", "percent"))).alias("n_data"),
    )
    caption = F.lower(F.coalesce("caption", F.lit("")))
    named = any_of(caption, [r"\btable\b"])
    cols = F.size(F.coalesce("col_headers", F.array()))
    reason = (
        F.when(contains_any(caption, FIGURE_WORDS), "caption names a figure").when(F.coalesce("n_rows", F.lit(0)) < 1, "no rows").when(cols < 1, "no columns").when(F.col("n_cells") < 2, "too few cells")
        .when((F.col("n_filled") > 0) & (F.col("n_long") / F.col("n_filled") > 0.5), "long text cells").when((cols == 1) & (F.col("longest") > 300), "one column of long text")
        .when(~named & ((cols < 2) | (F.col("n_rows") < 3)), "no table word and little structure").when(F.col("n_data") > 0, "ok").when(named & (cols >= 2) & (F.col("n_cells") >= 4), "ok").otherwise("little structure")
    )
    one = tables.groupBy("segment_id").agg(F.max(F.struct("caption", "col_headers")).alias("t")).select("segment_id", "t.*")
    return one.join(stats, "segment_id", "left").select("segment_id", reason.alias("reason"), "n_rows", "n_cells", named.alias("named"))


def caption_parts(text: Column) -> Column:
    """Struct (kind, number) of a caption, null for a text that only refers to one or is too long."""
    kind, number = F.lower(F.regexp_extract(text, CAPTION, 1)), F.regexp_extract(text, CAPTION, 2)
    return F.when((number != "") & (F.char_length(text) < 400) & ~any_of(F.substring(text, 1, 60), REFERS), F.struct(kind.alias("kind"), number.alias("number")))


def near_captions(regions: DataFrame, texts: DataFrame, above: float = 50.0, below: float = 30.0) -> DataFrame:
    """Text nearest to each region within ``above`` over or ``below`` under it on the same page."""
    t = texts.select("doc_id", "page_idx", F.col("ord").alias("text_ord"), F.col("y0").alias("ty0"), F.col("y1").alias("ty1"), F.col("text").alias("caption"))
    r = regions.select("doc_id", "page_idx", "ord", "y0", "y1")
    gap_up, gap_down = F.col("y0") - F.col("ty1"), F.col("ty0") - F.col("y1")
    near = r.join(t, ["doc_id", "page_idx"]).where((F.col("ord") != F.col("text_ord")) & (gap_up.between(0, above) | gap_down.between(0, below)))
    gap = F.when(gap_up >= 0, gap_up).otherwise(gap_down)
    return near.groupBy("doc_id", "ord").agg(F.min_by(F.struct("text_ord", "caption"), F.struct(gap.alias("g"), F.col("text_ord"))).alias("c")).select("doc_id", "ord", "c.text_ord", "c.caption")


def conflicts(a: DataFrame, b: DataFrame, share: float = 0.4) -> DataFrame:
    """Pairs of regions of a page that overlap by more than ``share`` of the smaller one."""

    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select("doc_id", "page_idx", F.col("ord").alias(f"{p}_ord"), *[F.col(c).alias(f"{p}_{c}") for c in ("x0", "y0", "x1", "y1")])

    j = side(a, "a").join(side(b, "b"), ["doc_id", "page_idx"])
    w = F.least("a_x1", "b_x1") - F.greatest("a_x0", "b_x0")
    h = F.least("a_y1", "b_y1") - F.greatest("a_y0", "b_y0")

    def area(p: str) -> Column:
        return (F.col(f"{p}_x1") - F.col(f"{p}_x0")) * (F.col(f"{p}_y1") - F.col(f"{p}_y0"))

    part = F.when((w > 0) & (h > 0), w * h / F.least(area("a"), area("b"))).otherwise(0.0)
    return j.withColumn("share", F.round(part, 6)).where(F.col("share") > share).select("doc_id", "page_idx", "a_ord", "b_ord", "share")


def largest_gap(df: DataFrame, least: float = 20.0) -> DataFrame:
    """Largest vertical white space of each page, from bottom to top of neighbouring blocks."""
    w = Window.partitionBy("doc_id", "page_idx").orderBy("y0", "ord")
    gap = F.lead("y0").over(w) - F.max("y1").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = df.select("doc_id", "page_idx", "ord", gap.alias("gap")).where(F.col("gap") > least)
    return rows.groupBy("doc_id", "page_idx").agg(F.max_by("ord", F.struct("gap", -F.col("ord"))).alias("ord"), F.max("gap").alias("gap"))


def nearest_column(words: DataFrame, centres: DataFrame) -> DataFrame:
    """Column of each word: the nearest column centre of its page."""
    j = words.join(centres, "page_id")
    return j.groupBy("page_id", "word_id").agg(F.min_by("col_no", F.struct(F.abs(F.col("x") - F.col("centre")).alias("d"), F.col("col_no"))).alias("col_no"))


def page_medians(words: DataFrame) -> DataFrame:
    """Median height and width of the words of a page."""
    return words.groupBy("page_id").agg(F.median("h").alias("median_h"), F.median("w").alias("median_w"), F.count("*").alias("n_words"))


def scaled_number(text: Column) -> Column:
    """Number with a K, M or B multiplier, null for other texts."""
    n = F.regexp_extract(text, r"^\s*\$?\s*(-?\d[\d,]*(?:\.\d+)?)\s*([KkMmBb]?)%?\s*$", 1)
    unit = F.upper(F.regexp_extract(text, r"^\s*\$?\s*(-?\d[\d,]*(?:\.\d+)?)\s*([KkMmBb]?)%?\s*$", 2))
    return F.regexp_replace(n, ",", "").try_cast("double") * F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9).otherwise(1.0)


def table_number(caption: Column) -> Column:
    """Number after table, else exhibit, else figure."""
    found = [F.regexp_extract(caption, rf"(?i)\b{word}\s+(\d+(?:\.\d+)*)", 1) for word in ("table", "exhibit", "figure")]
    return F.coalesce(*[F.when(f != "", f) for f in found])


def reference_stubs(df: DataFrame, key: str, text: str, around: int = 80, most: int = 220) -> DataFrame:
    """References to tables, figures, appendices and sections with their surroundings, each once a text."""
    import re

    pattern = re.compile(r"\b(table|figure|appendix|section)\s+([A-Za-z]?\d+(?:\.\d+)*[a-z]?|[A-Z]\b)", re.I)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t in zip(b[key], b["_text"]):
                seen = set()
                for m in pattern.finditer(t):
                    kind = (m[1].lower(), m[2])
                    if kind not in seen:
                        seen.add(kind)
                        rows.append((k, *kind, " ".join(t[max(0, m.start() - around) : m.end() + around].split())[:most]))
            yield pd.DataFrame(rows, columns=[key, "ref_type", "ref_id", "snippet"])

    kind = dict(df.dtypes)[key]
    return df.where(F.col(text).isNotNull()).select(key, F.col(text).alias("_text")).mapInPandas(run, f"{key} {kind}, ref_type string, ref_id string, snippet string")


def similarity(a: Column, b: Column) -> Column:
    """Ratio of matching parts of two texts, 0 to 1."""

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, p or "", q or "").ratio() for p, q in zip(x, y)])

    return ratio(a, b)


def aligned_contents(contents: DataFrame, heads: DataFrame, window: int = 2, least: float = 0.7) -> DataFrame:
    """Heading block of each contents entry (doc_id, entry, title, page): equal keys first, then similar titles.

    Headings are spread over the pages of the window, so the join is an equality on document and page and
    the costly comparison sees the few headings near the page only.
    """
    h = heads.select("doc_id", F.col("title").alias("h_title"), "ord", F.explode(F.sequence(F.col("page") - window, F.col("page") + window)).alias("page"))
    j = contents.join(h, ["doc_id", "page"]).withColumns({"_a": alnum_key(F.col("title")), "_b": alnum_key(F.col("h_title"))})
    same = F.col("_a") == F.col("_b")
    j = j.withColumn("ratio", F.when(same, 1.0).otherwise(similarity(F.col("_a"), F.col("_b")))).where(F.col("ratio") >= least)
    best = Window.partitionBy("doc_id", "entry").orderBy(F.desc("ratio"), "ord")
    return j.withColumn("_r", F.row_number().over(best)).where("_r = 1").select("doc_id", "entry", "title", "page", "ord", F.round("ratio", 6).alias("ratio"))


def salvaged_json(text: Column) -> Column:
    """The first balanced JSON object or array in a model's answer, null if there is none."""
    import json

    @F.pandas_udf("string")
    def salvage(values: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            decoder = json.JSONDecoder()
            for i, c in enumerate(t or ""):
                if c in "{[":
                    try:
                        return json.dumps(decoder.raw_decode(t[i:])[0])
                    except ValueError:
                        continue
            return None

        return pd.Series([one(t) for t in values], dtype=object)

    return salvage(text)


def page_kind(pages: DataFrame) -> DataFrame:
    """Page type from text length, ruling lines and images."""
    n, lines, images = F.coalesce("n_chars", F.lit(0)), F.coalesce("n_lines", F.lit(0)), F.coalesce("n_images", F.lit(0))
    return pages.withColumn("page_type", F.when((n < 50) & (images > 0), "image").when(lines >= 10, "grid").when(n >= 50, "text").otherwise("unknown"))


def title_case(text: Column) -> Column:
    """Whether every word of a line starts in upper case and goes on in lower case."""

    @F.pandas_udf("boolean")
    def istitle(values: pd.Series) -> pd.Series:
        return pd.Series([bool(t) and t.istitle() for t in values])

    return istitle(strip(text))
