"""Evaluation items that stand, whole or in part, in a corpus of documents.

MinHash containment search over sets of one size class: items and documents are cut into windows of
``run`` words, each a set of ``run - SHINGLE + 1`` word shingles. Containment of a set in another of
the same size equals their Jaccard similarity, so a window that both texts share has the same minimum
in both with certainty, and one minimum a window suffices; equal minima of consecutive windows are
kept once, about one in five. Longer items and documents only have more such windows: length does
not lower the chance of a hit. The signature of an item is the set of its minima; the share of them that a
document has estimates how much of the item it contains. Every candidate is verified exactly: the
words before and after the shingle are compared, and the windows of the item that the document holds give
the exact containment.

Defined results: null texts and texts with fewer than ``run`` words leak nothing; case, punctuation
and white space do not matter; repeated rows give one result row; an item that comes with several texts
leaks by any of them, and its containment is the largest; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.words import WordHash, shingle_hashes, sliding_min, words_of
from quire.operators.skew import hot_keys, salted_join
from quire.session import cut

RUN = 13
SHINGLE = 5
#: Bytes of items that may be sent to every task; beyond, both sides are shuffled on their minima.
BROADCAST_BYTES = 64_000_000
#: What a character of an item adds to what is sent at most: a word of one character and a blank are 8 bytes of
#: hash and at most one index entry of 8 bytes of minimum and 8 of position.
CHAR_BYTES = 12


def word_hashes(text: str | None, cache: WordHash) -> np.ndarray:
    ws = words_of(text)
    return np.fromiter(map(cache.__getitem__, ws), np.uint64, len(ws))


def minima(words: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a text and the MinHash minimum of each of its windows of ``run`` words."""
    if len(words) < run:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = shingle_hashes(words, SHINGLE)
    return h, sliding_min(h, run - SHINGLE + 1)


def places(h: np.ndarray, low: np.ndarray, windows: np.ndarray, run: int = RUN) -> np.ndarray:
    """Distinct positions of the last shingle that is the minimum of each of ``windows``."""
    at, least = windows.astype(np.int64), low[windows]
    for j in range(run - SHINGLE + 1):
        here = windows + j
        at = np.where(h[here] == least, here, at)
    return np.unique(at)


def shared_run(a: np.ndarray, i: int, b: np.ndarray, j: int) -> tuple[int, int]:
    """Bounds in ``b`` of the longest run of equal words around ``a[i]`` and ``b[j]``."""
    back = min(i, j)
    x, y = a[i - back : i][::-1], b[j - back : j][::-1]
    left = int(np.argmax(x != y)) if (x != y).any() else back
    on = min(len(a) - i, len(b) - j)
    x, y = a[i : i + on], b[j : j + on]
    right = int(np.argmax(x != y)) if (x != y).any() else on
    return j - left, j + right


class ItemIndex:
    """Word hashes of all items, and the place of every minimum in them."""

    def __init__(self, items: list[tuple], run: int):
        cache = WordHash()
        self.run, self.keys = run, [k for k, _ in items]
        self.words = [word_hashes(t, cache) for _, t in items]
        lows, owner, at = [], [], []
        for n, words in enumerate(self.words):
            h, low = minima(words, run)
            p = places(h, low, np.arange(len(low)), run)
            lows.append(h[p])
            owner.append(np.full(len(p), n, np.int32))
            at.append(p.astype(np.int32))
        if lows:
            self.lows, self.owner, self.at = np.concatenate(lows), np.concatenate(owner), np.concatenate(at)
            order = np.argsort(self.lows, kind="stable")
            self.lows, self.owner, self.at = self.lows[order], self.owner[order], self.at[order]
        else:
            self.lows = np.zeros(0, np.uint64)

    def search(self, words: np.ndarray) -> dict:
        """Item -> share of its windows that a document with these words holds."""
        h, low = minima(words, self.run)
        if not len(low) or not len(self.lows):
            return {}
        first = np.searchsorted(self.lows, low)
        hits = np.flatnonzero(self.lows[np.minimum(first, len(self.lows) - 1)] == low)
        held: dict[int, set] = {}
        for p in places(h, low, hits, self.run).tolist():
            lo, hi = np.searchsorted(self.lows, h[p], "left"), np.searchsorted(self.lows, h[p], "right")
            for n, q in zip(self.owner[lo:hi].tolist(), self.at[lo:hi].tolist()):
                start, stop = shared_run(words, p, self.words[n], q)
                if stop - start >= self.run:
                    held.setdefault(n, set()).update(range(start, stop - self.run + 1))
        out: dict = {}
        for n, windows in held.items():
            k = self.keys[n]
            out[k] = max(out.get(k, 0.0), len(windows) / (len(self.words[n]) - self.run + 1))
        return out


def _local(documents: DataFrame, items: list, doc: str, run: int, schema: str) -> DataFrame:
    """Search with the index of all items in every task."""
    shared = documents.sparkSession.sparkContext.broadcast(ItemIndex(items, run))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, cache = shared.value, WordHash()
        for b in batches:
            rows = [(d, k, share) for d, t in zip(b[doc], b["_text"]) for k, share in index.search(word_hashes(t, cache)).items()]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return documents.mapInPandas(search, schema)


def _minima_rows(df: DataFrame, key: str, run: int) -> DataFrame:
    """(key, low, n, at, before, after): each minimum with the words around it, as far as a window reaches, and the text's windows."""
    reach = run - SHINGLE

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHash()
        for b in batches:
            out = []
            for k, t in zip(b[key], b["_text"]):
                words = word_hashes(t, cache)
                h, low = minima(words, run)
                signed = words.view(np.int64)
                for p in places(h, low, np.arange(len(low)), run).tolist():
                    out.append((k, int(h[p].view(np.int64)), len(low), p, signed[max(0, p - reach) : p][::-1], signed[p : p + run]))
            yield pd.DataFrame(out, columns=[key, "low", "n", "at", "before", "after"])

    return df.mapInPandas(emit, f"{key} {dict(df.dtypes)[key]}, low long, n int, at int, before array<long>, after array<long>")


def _equal_words(a: str, b: str):
    """Leading equal words of two arrays."""
    both = F.arrays_zip(F.col(a).alias("x"), F.col(b).alias("y"))
    size = F.least(F.size(a), F.size(b))
    return F.coalesce(F.array_position(F.transform(F.slice(both, F.lit(1), size), lambda e: e["x"] == e["y"]), False), F.lit(0)), size


def _shuffled(documents: DataFrame, items: DataFrame, doc: str, item: str, run: int) -> DataFrame:
    """Search with both sides shuffled on their minima, for any number of items; no text is read twice."""
    mine = cut(_minima_rows(documents, doc, run), "minima")
    asked = _minima_rows(items, item, run).withColumnsRenamed({"n": "n_item", "at": "at_item", "before": "before_item", "after": "after_item"})
    counts = mine.groupBy("low").agg(F.count("*").alias("n"))
    hot, _ = hot_keys(counts, "low", "n", mine.count())
    pairs = salted_join(mine.select(doc, "low", "before", "after"), asked, ["low"], hot, "low", F.col(doc))
    back, size = _equal_words("before", "before_item")
    left = F.when(back == 0, size).otherwise(back - 1)
    on, size = _equal_words("after", "after_item")
    right = F.when(on == 0, size).otherwise(on - 1)
    found = pairs.withColumns({"left": left, "right": right}).where(F.col("left") + F.col("right") >= run)
    windows = F.explode(F.sequence(F.col("at_item") - F.col("left"), F.col("at_item") + F.col("right") - run))
    held = found.select(doc, item, "n_item", windows.alias("w")).distinct().groupBy(doc, item, "n_item").agg(F.count("*").alias("held"))
    return held.select(doc, item, (F.col("held") / F.col("n_item")).alias("containment"))


def leaked_items(documents: DataFrame, items: DataFrame, doc: str, doc_text: str, item: str, item_text: str, run: int = RUN, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc, item, containment) of all pairs that share at least ``run`` consecutive words.

    ``containment`` is the share of the item's windows of ``run`` words that stand in the document.
    """
    if doc == item:
        raise ValueError("the two keys need different names")
    docs = documents.where(F.col(doc_text).isNotNull() & F.col(doc).isNotNull()).select(doc, F.col(doc_text).alias("_text"))
    asked = items.where(F.col(item_text).isNotNull() & F.col(item).isNotNull()).select(item, F.col(item_text).alias("_text")).distinct()
    schema = f"{doc} {dict(docs.dtypes)[doc]}, {item} {dict(asked.dtypes)[item]}, containment double"
    size = asked.agg(F.coalesce(F.sum(F.char_length("_text") + 1), F.lit(0))).first()[0]
    if size * CHAR_BYTES <= broadcast_bytes:
        found = _local(docs, [tuple(r) for r in asked.collect()], doc, run, schema)
    else:
        found = _shuffled(docs, asked, doc, item, run)
    return found.groupBy(doc, item).agg(F.max("containment").alias("containment"))
