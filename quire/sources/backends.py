"""Optional backends (OCR, vision, language models) and the status that each row reports.

A backend is a function from a DataFrame to a DataFrame with the columns ``key`` and ``result``. None
ships with this package but a mock; without a backend every row reports ``skipped`` and nothing fails.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Backend = Callable[[DataFrame], DataFrame]
REGISTRY: dict[str, Backend] = {}


def register(name: str, backend: Backend) -> None:
    REGISTRY[name] = backend


def mock(df: DataFrame) -> DataFrame:
    """Answers with a hash of the request, for tests."""
    return df.select("key", F.md5("request").alias("result"))


def enrich(df: DataFrame, name: str, key: str, request: Column) -> DataFrame:
    """Add ``result``, ``status`` and ``reason``: ok, empty, error or skipped.

    Equal requests are answered once: distinct requests go to the backend, the answers are joined back.
    """
    backend = REGISTRY.get(name)
    if backend is None:
        return df.withColumns({"result": F.lit(None).cast("string"), "status": F.lit("skipped"), "reason": F.lit(f"no backend named {name}")})
    asked = df.withColumn("_request", request).withColumn("_key", F.md5(F.coalesce("_request", F.lit(""))))
    try:
        answers = backend(asked.where("_request is not null").select(F.col("_key").alias("key"), F.col("_request").alias("request")).dropDuplicates(["key"])).select("key", "result")
    except Exception as e:  # a backend that can't start fails its rows, not the job
        return df.withColumns({"result": F.lit(None).cast("string"), "status": F.lit("error"), "reason": F.lit(f"{type(e).__name__}: {str(e)[:200]}")})
    out = asked.join(answers.select(F.col("key").alias("_key"), "result"), "_key", "left")
    status = F.when(F.col("_request").isNull(), "empty").when(F.col("result").isNull(), "error").otherwise("ok")
    return out.withColumn("status", status).withColumn("reason", F.when(status == "error", "the backend gave no result").when(status == "empty", "nothing to ask")).drop("_request", "_key")


def book_metadata(numbers: DataFrame, *sources: DataFrame) -> DataFrame:
    """Title, edition and publisher of each document from the first source that knows its book.

    Sources are tables (book_id, title, edition, publisher) in order of priority.
    """
    out = numbers
    for i, s in enumerate(sources):
        one = s.groupBy("book_id").agg(F.max(F.struct("title", "edition", "publisher")).alias(f"_s{i}"))
        out = out.join(one, "book_id", "left")
    pick = {c: F.coalesce(*[F.col(f"_s{i}.{c}") for i in range(len(sources))], F.lit(None).cast("string")) for c in ("title", "edition", "publisher")}
    return out.withColumns(pick).drop(*[f"_s{i}" for i in range(len(sources))])
