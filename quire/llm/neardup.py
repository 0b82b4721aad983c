"""Near-duplicate records: MinHash banding, then verification on the full n-gram sets.

Records with equal n-gram sets form one class; only classes are compared. Bands of ``ROWS`` minima
are shuffled; a row carries the class and a sketch of one-bit minima, so most chance collisions end
in the join itself. Surviving pairs are verified on all n-grams of both classes.

Bands, rows and sketch are chosen for the threshold 0.7. A pair must share a band and agree in the sketch: one
with that similarity is found with probability 0.982, one with 0.72 with 0.993, one with 0.75 with 0.9986 and
one with 0.8 with 0.9999; so not all pairs near the threshold are found.

Defined results: a null text and a text with fewer than ``least`` distinct n-grams match nothing;
an id that comes with several texts matches by any of them; an id never matches itself; repeated
rows count once; no bucket is capped; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.words import WordHash, mix, words_of
from quire.operators.skew import hot_rows, salted_join
from quire.session import cut

BANDS, ROWS = 48, 7
#: One-bit minima carried with each band row, and how many must agree (0.7: 99.8 % of pairs do).
SKETCH, AGREE = 24, 15
THRESHOLD = 0.7
LEAST = 12
_SLICE = 20_000


def gram_sets(df: DataFrame, key: str, text: str, n: int = 1, least: int = LEAST) -> DataFrame:
    """Distinct (key, h1, h2, grams): the set of hashed n-grams and a 128-bit hash of the set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHash()
        for b in batches:
            keys, h1, h2, sets = [], [], [], []
            for k, t in zip(b[key], b["_text"]):
                ws = words_of(t)
                grams = set(ws) if n == 1 else {" ".join(ws[i : i + n]) for i in range(len(ws) - n + 1)}
                if len(grams) < least:
                    continue
                s = np.sort(np.fromiter(map(cache.__getitem__, grams), np.uint64, len(grams)))
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                keys.append(k)
                h1.append((d >> 64) - (1 << 63))
                h2.append((d & ((1 << 64) - 1)) - (1 << 63))
                sets.append((s >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pd.DataFrame({key: pd.Series(keys, dtype=object), "h1": np.array(h1, np.int64), "h2": np.array(h2, np.int64), "grams": pd.Series(sets, dtype=object)})

    kind = dict(df.dtypes)[key]
    rows = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, F.col(text).alias("_text"))
    return rows.mapInPandas(run, f"{key} {kind}, h1 long, h2 long, grams array<int>")


def classes(sets: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Classes (class_id, grams) with small integer ids, and members (key, class_id)."""
    members = cut(sets.select(key, "h1", "h2", "grams"), "sets")
    one = members.groupBy("h1", "h2").agg(F.first("grams").alias("grams"), F.count("*").alias("n")).withColumn("m", F.monotonically_increasing_id())
    one = cut(one, "classes")
    width = one.agg(F.coalesce(F.max(F.shiftright("m", 33)), F.lit(0))).first()[0] + 1
    dense = (F.col("m").bitwiseAND((1 << 33) - 1) * F.lit(width) + F.shiftright("m", 33)).cast("long")
    one = one.withColumn("class_id", dense)
    hot = hot_rows(one.select("h1", "n"), "h1", members.count())
    belongs = salted_join(members.select(key, "h1", "h2").distinct(), one.select("h1", "h2", "class_id"), ["h1", "h2"], hot, "h1", F.col(key)).select(key, "class_id")
    return one.select("class_id", "grams"), cut(belongs, "members")


def band_rows(one: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(band, v): a hash of each band of minima; ``v`` holds the class id above the sketch bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng(20240601)
        k = bands * rows + SKETCH
        mul = rng.integers(1, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        add = rng.integers(0, 1 << 63, k, dtype=np.uint64)
        weight = rng.integers(1, 1 << 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        place = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for b in batches:
            sizes = b["grams"].map(len).to_numpy()
            ends = np.cumsum(sizes)
            lo = 0
            while lo < len(b):
                # a slice of records with a bounded number of n-grams
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _SLICE, "right")))
                part = b["grams"].iloc[lo:hi]
                uniq, inverse = np.unique(np.concatenate(part.to_list()), return_inverse=True)
                table = ((uniq.view(np.uint32).astype(np.uint64)[:, None] * mul + add) >> np.uint64(32)).astype(np.uint32)
                starts = np.concatenate([[0], np.cumsum(sizes[lo:hi])[:-1]])
                low = np.minimum.reduceat(table[inverse], starts, axis=0)
                keys = (low[:, : bands * rows].reshape(-1, bands, rows).astype(np.uint64) * weight).sum(axis=2, dtype=np.uint64)
                keys = mix(keys + place)
                bits = ((low[:, bands * rows :] >> np.uint32(7)) & np.uint32(1)).astype(np.int64) @ (1 << np.arange(SKETCH, dtype=np.int64))
                v = (b["class_id"].to_numpy()[lo:hi] << SKETCH) | bits
                yield pd.DataFrame({"band": keys.reshape(-1).view(np.int64), "v": np.repeat(v, bands)})
                lo = hi

    return one.mapInPandas(run, "band long, v long")


def candidate_pairs(bands: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of classes that share a band and whose sketches agree enough."""
    # both sides have the same form, so one exchange serves both
    left, right = bands.select("band", F.col("v").alias("x")), bands.select("band", F.col("v").alias("y"))
    differ = F.bit_count(F.col("x").bitwiseXOR(F.col("y")).bitwiseAND((1 << SKETCH) - 1))
    a, b = F.shiftright("x", SKETCH), F.shiftright("y", SKETCH)
    return left.join(right, "band").where((a < b) & (differ <= SKETCH - AGREE)).select(a.alias("a"), b.alias("b")).distinct()


def verified(pairs: DataFrame, one: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (a, b, similarity) whose Jaccard similarity over all n-grams reaches the threshold."""
    left = one.select(F.col("class_id").alias("a"), F.col("grams").alias("x"))
    right = one.select(F.col("class_id").alias("b"), F.col("grams").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    whole = F.size("x") + F.size("y") - both
    return pairs.join(left, "a").join(right, "b").select("a", "b", (both / whole).alias("similarity")).where(F.col("similarity") >= F.lit(threshold - 1e-12))


def near_duplicates(df: DataFrame, key: str, text: str, n: int = 1, threshold: float = THRESHOLD, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Links between classes (a, b, similarity) and members (key, class_id)."""
    one, members = classes(gram_sets(df, key, text, n, least), key)
    pairs = cut(candidate_pairs(band_rows(one)), "candidates")
    return cut(verified(pairs, one, threshold), "links"), members


def record_pairs(links: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """All pairs of different ids (a < b): across linked classes and within a class."""
    sizes = cut(members.groupBy("class_id").agg(F.count("*").alias("n")), "sizes")
    hot = hot_rows(sizes, "class_id", members.count())
    m1, m2 = members.select("class_id", F.col(key).alias("k1")), members.select("class_id", F.col(key).alias("k2"))
    across = salted_join(m1, links.select(F.col("a").alias("class_id"), "b"), ["class_id"], hot, "class_id", F.col("k1")).select(F.col("b").alias("class_id"), "k1")
    across = salted_join(m2, across, ["class_id"], hot, "class_id", F.col("k2")).select("k1", "k2")
    within = salted_join(m1, m2, ["class_id"], hot, "class_id", F.col("k1")).where("k1 < k2").select("k1", "k2")
    both = across.unionByName(within).where("k1 <> k2")
    return both.select(F.least("k1", "k2").alias(f"{key}_a"), F.greatest("k1", "k2").alias(f"{key}_b")).distinct()


def record_classes(links: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """One row a record and class: the class, its number of members and of links to other classes."""
    ends = links.select(F.col("a").alias("class_id")).unionByName(links.select(F.col("b").alias("class_id"))).groupBy("class_id").agg(F.count("*").alias("n_links"))
    heads = members.groupBy("class_id").agg(F.min(key).alias("class_key"), F.count("*").alias("n_members"))
    heads = heads.join(ends, "class_id", "left").select("class_id", "class_key", "n_members", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return members.join(heads, "class_id").select(key, "class_key", "n_members", "n_links")
