"""Incremental runs: layout files as they arrive, and windowed counts of events.

The windowed counts are an extension; documents themselves are atomic and need no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions.text import stable_id, text_object
from quire.sources.layout_json import LAYOUT, layout_blocks
from quire.sources.sinks import append_new


def stream_layouts(spark: SparkSession, source: str, store: str, checkpoint: str) -> StreamingQuery:
    """Blocks of newly arrived layout files, labelled and appended once each to ``store``."""
    files = spark.readStream.schema(LAYOUT).option("multiLine", True).json(source)
    files = files.withColumn("doc_id", F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.json)?$", 1))

    def batch(df: DataFrame, _: int) -> None:
        b = layout_blocks(df)
        b = b.withColumn("segment_id", stable_id("seg_", F.col("doc_id"), F.col("ord"), F.col("text"))).withColumn("segment_type", text_object(F.col("text")))
        append_new(b, store)

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and value a window and type; works on streams (with watermark) and on tables."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    g = rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n_events"), F.sum("value").alias("sum_value"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "n_events", "sum_value")
