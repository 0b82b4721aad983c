"""Table cells: typing, values, matrix, markdown and computed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.formulas import cell_number, cell_type


def one_cell_each(cells: DataFrame) -> DataFrame:
    """One row a cell id: the one loaded last."""
    w = Window.partitionBy("cell_id").orderBy(F.col("loaded_at").desc_nulls_last(), F.col("raw_value").asc_nulls_first(), F.col("normalized_value").asc_nulls_first())
    return cells.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def typed_cells(cells: DataFrame) -> DataFrame:
    """Type and number of each cell from its raw value."""
    kind = cell_type(F.col("raw_value"))
    return cells.select("cell_id", "segment_id", "row_index", "col_index", "raw_value", kind.alias("detected_type")).withColumn("num_value", cell_number(F.col("raw_value"), F.col("detected_type")))


def markdown(cells: DataFrame) -> DataFrame:
    """Each table as markdown: first row as header, cells joined by bars, rows in order."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce("raw_value", F.lit("")), r"\|", "\\\\|"), r"\s*\n\s*", " ")
    rows = cells.groupBy("segment_id", "row_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_index", text.alias("t")))), lambda c: c["t"]), " | ").alias("line"), F.count("*").alias("n"))
    rows = rows.select("segment_id", "row_index", F.concat(F.lit("| "), "line", F.lit(" |")).alias("line"), "n")
    whole = rows.groupBy("segment_id").agg(F.array_sort(F.collect_list(F.struct("row_index", "line", "n"))).alias("r"))
    first, rest = F.get("r", F.lit(0)), F.slice("r", 2, F.greatest(F.size("r") - 1, F.lit(0)))
    rule = F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit("---|"), first["n"].cast("int")), ""))
    return whole.select("segment_id", F.array_join(F.concat(F.array(first["line"], rule), F.transform(rest, lambda x: x["line"])), "\n").alias("markdown"))


def fill_rate(cells: DataFrame) -> DataFrame:
    """Rows, filled cells and their mean a row of each table."""
    filled = F.when(F.trim(F.coalesce("raw_value", F.lit(""))) != "", 1).otherwise(0)
    rows = cells.groupBy("segment_id", "row_index").agg(F.sum(filled).alias("filled"))
    return rows.groupBy("segment_id").agg(F.count("*").alias("n_rows"), F.count_if(F.col("filled") > 0).alias("n_filled_rows"), F.round(F.avg("filled"), 6).alias("mean_filled"))


def computed_columns(cells: DataFrame, most_rows: int = 9) -> DataFrame:
    """Pairs of columns of a table whose ratio is the same in every row (first rows, at least two)."""
    v = cells.where(F.col("num_value").isNotNull() & (F.col("num_value") != 0) & (F.col("row_index") <= most_rows)).select("segment_id", "row_index", "col_index", "num_value")
    w = v.select("segment_id", "row_index", F.col("col_index").alias("to_col"), F.col("num_value").alias("to_value"))
    pairs = v.join(w, ["segment_id", "row_index"]).where(F.col("col_index") < F.col("to_col")).withColumn("ratio", F.round(F.col("to_value") / F.col("num_value"), 9))
    g = pairs.groupBy("segment_id", F.col("col_index").alias("from_col"), "to_col").agg(F.count("*").alias("n_rows"), F.min("ratio").alias("ratio"), F.max("ratio").alias("_most"))
    return g.where((F.col("n_rows") >= 2) & (F.col("ratio") == F.col("_most"))).drop("_most")


def cross_table_mentions(texts: DataFrame, tables: DataFrame) -> DataFrame:
    """Texts that mention a table of their book by number: numbers are extracted, then joined."""
    pattern = r"\b[Tt]able\s+(\d+(?:\.\d+)*)"
    m = texts.select("book_id", "item_id", F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(pattern), F.lit(1)))).alias("table_number"))
    t = tables.where("table_number is not null").select("book_id", "table_number", "segment_id").distinct()
    return m.join(t, ["book_id", "table_number"]).select("item_id", "segment_id").distinct()


def table_json(tables: DataFrame, cells: DataFrame) -> DataFrame:
    """(segment_id, body): each table with its cells in order of row and column as one JSON text; nulls are kept."""
    cell = F.struct("row_index", "col_index", "cell_id", "cell_type", "raw_value", "rowspan", "colspan", "formula_text", "units")
    held = cells.where(F.col("segment_id").isNotNull()).groupBy("segment_id").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    whole = tables.join(held, "segment_id", "left").withColumn("cells", F.coalesce("cells", F.array().cast(dict(held.dtypes)["cells"])))
    return whole.select("segment_id", F.to_json(F.struct("segment_id", "table_number", "caption", "page_start", "page_end", "cells"), {"ignoreNullFields": "false"}).alias("body"))


def table_summary(tables: DataFrame) -> DataFrame:
    """Tables, last page and mean confidence of each extractor."""
    return tables.groupBy("extractor").agg(F.count("*").alias("n_tables"), F.max(F.coalesce("page_end", "page_start", F.lit(0))).alias("total_pages"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


def page_texts(blocks: DataFrame) -> DataFrame:
    """(layout_id, page_idx, page_text): the texts of a page in the order of their index, joined by line ends.

    A block that was delivered again counts once, as it came first; blocks without index come last, by key.
    """
    once = blocks.groupBy("block_key").agg(F.min(F.struct(F.coalesce("loaded_at", F.lit("9999-01-01").cast("timestamp")).alias("t"), F.coalesce("text", F.lit("")).alias("text"), "layout_id", "page_idx", "block_index")).alias("b"))
    rows = once.select("block_key", "b.*").where("text <> ''")
    item = F.struct(F.coalesce("block_index", F.lit(2**31 - 1)).alias("i"), "block_key", "text")
    return rows.groupBy("layout_id", "page_idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["text"]), "\n").alias("page_text"))


def unique_regions(regions: DataFrame, key: str, place: list[str]) -> DataFrame:
    """The first region (smallest ``key``) at each place, and how many stand there."""
    return regions.groupBy(*place).agg(F.min(key).alias(key), F.countDistinct(key).alias("n_regions"))
