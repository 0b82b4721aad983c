"""Sinks: segments and graph as files, tables as markdown, a cache of model answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHE = T.StructType([T.StructField("key", T.StringType(), False), T.StructField("value", T.StringType()), T.StructField("written_at", T.TimestampType())])


def write_elements(df: DataFrame, path: str, by: str = "doc_id") -> None:
    """One JSON line an element, in folders by document."""
    df.write.mode("overwrite").partitionBy(by).json(path)


def graph_tables(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Statistics of a graph: nodes, edges and nodes by kind; also for an empty graph."""
    kinds = nodes.groupBy("kind").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("node_type_counts"), F.coalesce(F.sum("n"), F.lit(0)).alias("node_count"))
    return kinds.withColumn("_1", F.lit(1)).join(edges.agg(F.count("*").alias("edge_count")).withColumn("_1", F.lit(1)), "_1").drop("_1")


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes, edges and statistics side by side; empty tables keep their schema."""
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")
    graph_tables(nodes, edges).write.mode("overwrite").parquet(f"{path}/stats")


def write_summary_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_new(df: DataFrame, path: str, key: str = "segment_id") -> None:
    """Append rows whose key is not stored yet: an anti-join instead of rewriting the store."""
    spark = df.sparkSession
    df = df.dropDuplicates([key])
    try:
        old = spark.read.parquet(path).select(key)
    except Exception as e:  # the first batch finds no store
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        old = None
    (df if old is None else df.join(old, key, "left_anti")).write.mode("append").parquet(path)


def cache_key(model: Column, params: Column, prompt: Column) -> Column:
    return F.md5(F.concat_ws("::", model, params, prompt))


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The newest value of each key of a parquet cache; empty if there is none."""
    try:
        rows = spark.read.schema(CACHE).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], CACHE)
    return rows.groupBy("key").agg(F.max_by("value", "written_at").alias("value"))


def split_hits(requests: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests answered from the cache, and distinct keys that aren't."""
    return requests.join(cache, "key"), requests.join(cache, "key", "left_anti").dropDuplicates(["key"])
