"""Sources: layout JSON of documents, concept catalogues, contents pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import map_block_type, roman_to_int, strip

_SPAN = T.StructType([T.StructField("type", T.StringType()), T.StructField("content", T.StringType()), T.StructField("image_path", T.StringType())])
_LINE = T.StructType([T.StructField("spans", T.ArrayType(_SPAN))])


def _block(depth: int) -> T.StructType:
    fields = [T.StructField("type", T.StringType()), T.StructField("index", T.IntegerType()), T.StructField("bbox", T.ArrayType(T.DoubleType())), T.StructField("lines", T.ArrayType(_LINE))]
    if depth:
        fields.append(T.StructField("blocks", T.ArrayType(_block(depth - 1))))
    return T.StructType(fields)


#: Schema of a layout file; blocks nest once (captions and bodies of images and tables).
LAYOUT = T.StructType([
    T.StructField("pdf_info", T.ArrayType(T.StructType([T.StructField("page_idx", T.IntegerType()), T.StructField("page_size", T.ArrayType(T.DoubleType())), T.StructField("para_blocks", T.ArrayType(_block(1)))]))),
])


def read_layouts(spark: SparkSession, path: str) -> DataFrame:
    """One row a layout file: doc_id (file stem) and its pages. The schema is given, never inferred."""
    df = spark.read.schema(LAYOUT).option("multiLine", True).json(path)
    return df.withColumn("doc_id", F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.json)?$", 1))


def span_text(span: Column) -> Column:
    kind, text = span["type"], F.coalesce(span["content"], F.lit(""))
    return F.when(kind == "inline_equation", F.concat(F.lit("$"), text, F.lit("$"))).when(kind == "interline_equation", F.concat(F.lit("$$"), text, F.lit("$$"))).otherwise(text)


def line_texts(lines: Column) -> Column:
    """Texts of lines: spans joined by blanks, white space squeezed, empty lines dropped."""
    one = F.transform(F.coalesce(lines, F.array()), lambda x: strip(F.regexp_replace(F.array_join(F.filter(F.transform(F.coalesce(x["spans"], F.array()), span_text), lambda s: s != ""), " "), r"\s+", " ")))
    return F.filter(one, lambda t: t != "")


def image_paths(lines: Column) -> Column:
    return F.flatten(F.transform(F.coalesce(lines, F.array()), lambda x: F.filter(F.transform(F.coalesce(x["spans"], F.array()), lambda s: s["image_path"]), lambda p: p.isNotNull())))


def layout_blocks(layouts: DataFrame) -> DataFrame:
    """Blocks of layouts: type, text, box, image paths and id ``p{page}_b{index}``.

    Only image blocks read their nested captions. A block without index gets the running count of its
    document, one without box a box of zeros.
    """
    page = layouts.select("doc_id", F.posexplode("pdf_info").alias("page_pos", "p"))
    raw = page.select("doc_id", "page_pos", F.col("p.page_idx").alias("page_idx"), F.posexplode("p.para_blocks").alias("block_pos", "b"))
    w = Window.partitionBy("doc_id").orderBy("page_pos", "block_pos")
    nested = F.coalesce(F.col("b.blocks"), F.array())
    own = line_texts(F.col("b.lines"))
    inner = F.flatten(F.transform(nested, lambda x: line_texts(x["lines"])))
    kind = map_block_type(F.col("b.type"))
    box = F.when(F.size("b.bbox") >= 4, F.col("b.bbox")).otherwise(F.array(*[F.lit(0.0)] * 4))
    rows = raw.withColumn("ord", (F.row_number().over(w) - 1).cast("long"))
    return rows.select(
        "doc_id", "ord", "page_idx", kind.alias("block_type"), F.col("b.type").alias("raw_type"), F.array_join(F.when(kind == "image", F.concat(own, inner)).otherwise(own), "\n").alias("text"),
        F.format_string("p%d_b%d", F.col("page_idx"), F.coalesce(F.col("b.index"), F.col("ord").cast("int"))).alias("id"), F.col("b.index").alias("block_index"),
        *[F.get(box, F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))],
        F.array_distinct(F.concat(image_paths(F.col("b.lines")), F.flatten(F.transform(nested, lambda x: image_paths(x["lines"]))))).alias("image_paths"),
    )


def read_concepts(spark: SparkSession, path: str) -> DataFrame:
    """Concept catalogue from tab-separated text with any of the usual column names."""
    df = spark.read.csv(path, sep="\t", header=True)
    have = {c.strip().lower(): c for c in df.columns}

    def pick(*names: str) -> Column:
        there = [F.col(f"`{have[n]}`") for n in names if n in have]
        return F.coalesce(*there, F.lit(None).cast("string")) if there else F.lit(None).cast("string")

    def many(c: Column, marks: str) -> Column:
        return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), marks), strip), lambda x: x != "")

    return df.select(
        pick("concept_id", "id").alias("concept_id"), pick("name", "concept_name", "concept").alias("concept_name"), many(pick("aliases", "alias"), ",").alias("aliases"),
        pick("description", "desc").alias("description"), many(pick("tags", "tag", "tag(s)"), "[,;]").alias("tags"), pick("level").try_cast("int").alias("concept_level"), pick("pages", "page", "page(s)").alias("pages"),
    ).where(F.coalesce("concept_id", "concept_name").isNotNull())


def contents_entries(pages: DataFrame) -> DataFrame:
    """Entries of contents pages (doc_id, page_idx, text): title, dotted leader, arabic or roman page."""
    pattern = r"(?m)^\s*(.+?)\s*\.{3,}\s*(\d+|[ivxlcIVXLC]+)\s*$"
    both = F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)).alias("title"), F.regexp_extract_all("text", F.lit(pattern), F.lit(2)).alias("page"))
    rows = pages.where(F.col("page_idx") < 40).select("doc_id", "page_idx", F.posexplode(both).alias("pos", "e"))
    return rows.select("doc_id", "page_idx", "pos", F.col("e.title").alias("title"), F.coalesce(F.col("e.page").try_cast("int"), roman_to_int(F.col("e.page"))).alias("page"))
