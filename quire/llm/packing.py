"""Documents put into sequences of fixed capacity by best-fit decreasing.

Sizes are tokens of a public tokenizer. Items go in order of decreasing size into the open bin with
the least room that still holds them; a segment tree over remaining capacities finds that bin in
logarithmic time. Shards of bounded size are packed independently, so the work is parallel; one
shard loses at most about one bin's room.

Defined results: a null or empty text has no tokens and gets no sequence (``sequence_id`` null); a
document above the capacity is cut into full sequences and one rest, which is packed like any other
item; repeated texts are packed each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import cut, single_thread

CAPACITY = 2048
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Items of one shard; a shard is the unit that one task packs.
SHARD_ITEMS = 100_000
# Fixed value: the split pattern that belongs to the vocabulary file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_tokenizer(path: str):
    """Encoder of a rank file (base64 token and rank a line)."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, key: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(key, n_tokens) of every row; whole texts are encoded. The file ``tokenizer`` is sent to every executor."""
    df.sparkSession.sparkContext.addFile(tokenizer)
    name = os.path.basename(tokenizer)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        single_thread()
        encoder = load_tokenizer(SparkFiles.get(name))
        for b in batches:
            yield pd.DataFrame({key: b[key], "n_tokens": np.array([len(encoder.encode_ordinary(t)) if t else 0 for t in b["_text"]], np.int64)})

    kind = dict(df.dtypes)[key]
    return df.select(key, F.col(text).alias("_text")).mapInPandas(run, f"{key} {kind}, n_tokens long")


class OpenBins:
    """Bins by remaining capacity: a segment tree of counts over 0..capacity, a stack of bins a leaf."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, bin_id: int) -> None:
        self.stacks[room].append(bin_id)
        i = room + self.size
        while i:
            self.tree[i] += 1
            i >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, bin) with the least room of at least ``need``."""
        tree, i = self.tree, need + self.size
        if not tree[i]:
            while i > 1 and not (i % 2 == 0 and tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if tree[2 * i] else 2 * i + 1
        room = i - self.size
        while i:
            tree[i] -= 1
            i >>= 1
        return room, self.stacks[room].pop()


def best_fit_decreasing(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; ``sizes`` are between 1 and ``capacity``."""
    bins, at = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    free, n = OpenBins(capacity), 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        got = free.tightest(size)
        if got is None:
            got, n = (capacity, n), n + 1
        room, b = got
        bins[i], at[i] = b, capacity - room
        if room > size:
            free.add(room - size, b)
    return bins, at


def pack(counts: DataFrame, key: str, n_tokens: str = "n_tokens", capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """(key, part_no, n_parts, token_start, n_tokens, sequence_id, sequence_offset) of every document.

    A full part of a long document is a sequence by itself and stays in the JVM. What is left, at most one item a
    document, is packed in shards of about ``shard_items`` items, so a task's memory is bounded; its
    ``sequence_id`` is the shard and the number of the bin in it.
    """
    kind = dict(counts.dtypes)[key]
    counts = cut(counts.select(key, F.col(n_tokens).cast("long").alias("n_tokens"), F.monotonically_increasing_id().alias("row")), "sizes")
    n, cap = F.col("n_tokens"), F.lit(capacity)
    shards = max(1, -(-counts.where(n % cap > 0).count() // shard_items))
    whole = (n / cap).cast("long")
    items = counts.where(n > 0).withColumn("n_parts", F.ceil(n / cap).cast("int"))
    full = items.where(n >= cap).withColumn("part_no", F.explode(F.sequence(F.lit(0), (whole - 1).cast("int"))))
    full = full.select(
        key, "part_no", "n_parts", (F.col("part_no") * cap).cast("long").alias("token_start"), F.lit(capacity).cast("long").alias("n_tokens"),
        F.concat(F.lit("full-"), "row", F.lit("-"), "part_no").alias("sequence_id"), F.lit(0).cast("long").alias("sequence_offset"),
    )
    items = items.where(n % cap > 0).select(key, "row", (F.col("n_parts") - 1).alias("part_no"), "n_parts", (whole * cap).alias("token_start"), (n % cap).alias("n_tokens"))
    items = items.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    names = [key, "part_no", "n_parts", "token_start", "n_tokens"]

    def run(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("row", kind="stable")
        bins, at = best_fit_decreasing(b["n_tokens"].to_numpy(), capacity)
        out = b[names].copy()
        out["sequence_id"] = [f"{b['shard'].iloc[0]}-{x}" for x in bins]
        out["sequence_offset"] = at
        return out

    schema = f"{key} {kind}, part_no int, n_parts int, token_start long, n_tokens long, sequence_id string, sequence_offset long"
    packed = items.groupBy("shard").applyInPandas(run, schema)
    none = counts.where(F.coalesce(n, F.lit(0)) <= 0).select(
        key, F.lit(0).alias("part_no"), F.lit(0).alias("n_parts"), F.lit(0).cast("long").alias("token_start"), F.lit(0).cast("long").alias("n_tokens"), F.lit(None).cast("string").alias("sequence_id"), F.lit(None).cast("long").alias("sequence_offset")
    )
    return full.unionByName(packed).unionByName(none)
