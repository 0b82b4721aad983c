"""References to records that do not exist, by field and month.

Keys are dictionary-encoded as integers inside hash ranges of the key space; per range, field and
period a compressed bitmap holds the referenced keys, and one cumulative bitmap the parents present
by the end of the period. ``reference AND NOT parent`` leaves the orphans, which are decoded.

Defined results:

* a null or blank reference is no reference; ids compare trimmed and lower-cased;
* a null ``created_at`` gives a null period: such a reference is an orphan if its key has no row or
  is deleted (late arrival can't be told without a period);
* a parent whose ``loaded_at`` is null in all rows never arrived; one with any deleted row is deleted;
* repeated referring rows give one result row; empty tables give an empty result; columns beyond the
  named ones are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.skew import hot_keys, salted_join
from quire.session import cut, partitions

#: Period of references without a date: no month, so no parent can come too late for it.
NO_PERIOD = 2**31 - 1
#: Period of parents that are always there.
ALWAYS = -(2**31)
#: References that one key range should hold.
RANGE_KEYS = 200_000


class Bitmap:
    """Compressed set of integers: containers of 2**16 values, sorted arrays while sparse, else bits."""

    __slots__ = ("parts",)
    DENSE = 4096

    def __init__(self, codes: np.ndarray):
        codes = np.unique(np.asarray(codes, np.int64))
        high = codes >> 16
        cuts = np.flatnonzero(np.diff(high)) + 1
        self.parts = {int(c[0] >> 16): self._pack((c & 0xFFFF).astype(np.uint16)) for c in np.split(codes, cuts) if len(c)}

    @classmethod
    def _pack(cls, low: np.ndarray) -> np.ndarray:
        if len(low) <= cls.DENSE:
            return low
        bits = np.zeros(1 << 16, np.uint8)
        bits[low] = 1
        return np.packbits(bits)

    @staticmethod
    def _low(part: np.ndarray) -> np.ndarray:
        return part if part.dtype == np.uint16 else np.flatnonzero(np.unpackbits(part)).astype(np.uint16)

    def __ior__(self, other: Bitmap) -> Bitmap:
        for high, part in other.parts.items():
            mine = self.parts.get(high)
            if mine is None:
                self.parts[high] = part
            elif mine.dtype == part.dtype == np.uint8:
                self.parts[high] = mine | part
            else:
                self.parts[high] = self._pack(np.union1d(self._low(mine), self._low(part)))
        return self

    def and_not(self, other: Bitmap) -> np.ndarray:
        """Codes of this set that ``other`` lacks, in order."""
        out = []
        for high, part in sorted(self.parts.items()):
            theirs = other.parts.get(high)
            if theirs is not None:
                if part.dtype == theirs.dtype == np.uint8:
                    part = part & ~theirs
                else:
                    low = self._low(part)
                    if theirs.dtype == np.uint8:
                        low = low[(theirs[low >> 3] >> (7 - (low & 7)).astype(np.uint8)) & 1 == 0]
                    else:
                        low = np.setdiff1d(low, theirs, assume_unique=True)
                    part = low
            out.append(self._low(part).astype(np.int64) + (high << 16))
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def _range_orphans(refs: pd.DataFrame, parents: pd.DataFrame) -> pd.DataFrame:
    """Orphans of one key range: (ref_field, ref_key, period)."""
    words = pd.Index(pd.unique(refs["ref_key"]))
    code = words.get_indexer(refs["ref_key"])
    known = words.get_indexer(parents["key"])
    first = parents["first"].to_numpy()[known >= 0]
    known = known[known >= 0]
    order = np.argsort(first, kind="stable")
    known, first = known[order], first[order]
    period = refs["period"].to_numpy()
    field = refs["ref_field"].to_numpy()
    present, done, out = Bitmap(np.zeros(0)), 0, []
    for p in np.unique(period):
        upto = int(np.searchsorted(first, p, "right"))
        if upto > done:
            present |= Bitmap(known[done:upto])
            done = upto
        here = period == p
        for f in np.unique(field[here]):
            left = Bitmap(code[here & (field == f)]).and_not(present)
            if len(left):
                out.append(pd.DataFrame({"ref_field": f, "ref_key": words.to_numpy()[left], "period": np.int32(p)}))
    return pd.concat(out) if out else pd.DataFrame({"ref_field": pd.Series(dtype=str), "ref_key": pd.Series(dtype=str), "period": pd.Series(dtype=np.int32)})


def clean_key(c: Column) -> Column:
    """Id for comparison: trimmed, lower-cased; blank becomes null."""
    x = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return F.when(x != "", x)


def month_index(c: Column) -> Column:
    return (F.year(c) * 12 + F.month(c) - 1).cast("int")


def references(df: DataFrame, field: str, record_id: str, ref: str, created_at: str = "created_at") -> DataFrame:
    """Uniform rows (ref_field, record_id, ref_key, period) of one referring column."""
    return df.select(
        F.lit(field).alias("ref_field"), F.col(record_id).alias("record_id"), clean_key(F.col(ref)).alias("ref_key"), F.coalesce(month_index(F.col(created_at)), F.lit(NO_PERIOD)).alias("period")
    ).where(F.col("ref_key").isNotNull())


def parents(df: DataFrame, key: str, loaded_at: str | None = None, deleted_at: str | None = None) -> DataFrame:
    """Rows (key, first): the month from which a key is there. Deleted keys have no row."""
    rows = df.select(
        clean_key(F.col(key)).alias("key"),
        (F.lit(ALWAYS) if loaded_at is None else month_index(F.col(loaded_at))).cast("int").alias("first"),
        (F.lit(False) if deleted_at is None else F.col(deleted_at).isNotNull()).alias("gone"),
    ).where(F.col("key").isNotNull())
    return rows.groupBy("key").agg(F.min("first").alias("first"), F.max("gone").alias("gone")).where(~F.col("gone") & F.col("first").isNotNull()).select("key", "first")


def orphan_references(refs: DataFrame, parent: DataFrame) -> DataFrame:
    """Distinct (ref_field, record_id, ref_period) of references that name no present parent.

    References are first reduced to distinct (field, key, period), so a key that holds a third of
    all rows costs no more than its periods. The decoded orphans are joined back to the records
    with salts for hot keys.
    """
    spark = refs.sparkSession
    seen = cut(refs.groupBy("ref_field", "ref_key", "period").agg(F.count("*").alias("n")), "refs")
    size = seen.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    ranges = max(2 * partitions(spark), -(-size[0] // RANGE_KEYS))

    def rng(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c)), F.lit(ranges)).cast("int")

    known = parent.groupBy("key").agg(F.min("first").alias("first")).withColumn("rng", rng("key"))
    orphans = (
        seen.select("ref_field", "ref_key", "period")
        .withColumn("rng", rng("ref_key"))
        .groupBy("rng")
        .cogroup(known.groupBy("rng"))
        .applyInPandas(lambda a, b: _range_orphans(a, b), "ref_field string, ref_key string, period int")
    )
    hot, _ = hot_keys(seen, "ref_key", "n", size[1])
    rows = salted_join(refs, orphans, ["ref_field", "ref_key", "period"], hot, "ref_key", F.col("record_id"))
    y, m = F.floor(F.col("period") / 12), F.col("period") % 12 + 1
    text = F.when(F.col("period") != NO_PERIOD, F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-"), F.lpad(m.cast("string"), 2, "0")))
    return rows.select("ref_field", "record_id", text.alias("ref_period")).distinct()


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans per field and month."""
    return found.groupBy("ref_field", "ref_period").agg(F.count("*").alias("n_orphans"))


