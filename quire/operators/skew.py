"""Equi-joins in which one key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import partitions


#: Rows of one key that one task takes without salting.
FAIR_SHARE = 20_000


def fair_share(spark: SparkSession, total: int) -> int:
    """Rows of one key that a task takes without salting; at most ``4 * partitions`` keys have more."""
    return max(FAIR_SHARE, total // (4 * partitions(spark)))


def hot_keys(counts: DataFrame, key: str, n: str, total: int) -> tuple[DataFrame | None, int]:
    """Keys with more rows than a fair share of a task, and the number of rows that share is.

    ``counts`` has one row or few rows a key with the number of its records in ``n``. At most
    ``4 * partitions`` keys can exceed the share, so the result may always be broadcast. Where all
    rows together are no more than the share there are none (None).
    """
    share = fair_share(counts.sparkSession, total)
    if total <= share:
        return None, share
    hot = counts.groupBy(key).agg(F.sum(n).alias("_n")).where(F.col("_n") > share)
    return hot.select(key, F.ceil(F.col("_n") / F.lit(share)).cast("int").alias("_salts")), share


def hot_rows(counts: DataFrame, key: str, total: int) -> DataFrame | None:
    """Keys of a written table of counts whose ``n`` is above a fair share of ``total``, with their salts; None if none is."""
    share = fair_share(counts.sparkSession, total)
    if total <= share:
        return None
    hot = counts.where(F.col("n") > share).groupBy(key).agg(F.max(F.ceil(F.col("n") / F.lit(share))).cast("int").alias("_salts"))
    return None if hot.isEmpty() else hot


def salted_join(many: DataFrame, few: DataFrame, on: list[str], hot: DataFrame | None, key: str, spread: Column, how: str = "inner") -> DataFrame:
    """Inner or left join of ``many`` with ``few`` on ``on``; rows of a hot key go to several tasks.

    ``hot`` (from :func:`hot_keys`) is bounded and broadcast. Rows of ``many`` get a salt from
    ``spread``, rows of ``few`` are repeated once a salt; all other keys keep the salt 0.
    """
    if hot is None:
        return many.join(few, on, how)
    hot = F.broadcast(hot)
    left = many.join(hot, key, "left").withColumn("_salt", F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(spread), F.col("_salts"))).otherwise(0).cast("int")).drop("_salts")
    right = few.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
