"""Oversized texts cut into overlapping pieces at natural boundaries.

Every position of a text has a boundary strength (paragraph, line, sentence, word, none). A sparse
table answers in constant time where the strongest cut of a length window lies, the rightmost of
equals. From there the next piece starts at least ``overlap`` characters earlier, again at the
strongest boundary of the half overlap before that place. The table covers a stretch of the text and no
range longer than a piece, so it stays small however long the text is.

Defined results: a null text has no piece; an empty or short one is a single piece equal to the
text; a text without any boundary is cut at the limit; repeated rows are split each, and ``text_hash`` tells
pieces of different texts under one key apart; extra columns are kept, as long as they are named in ``keys``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1500
OVERLAP = 150
#: A cut is looked for in the last part of a piece, and the start of the next one so far before the overlap.
WINDOW = 0.5
SLACK = 0.5
#: Positions that one sparse table covers.
STRETCH = 1 << 16

# Strength of a cut before a position, from the weakest to the strongest.
NONE, WORD, SENTENCE, LINE, PARAGRAPH = 0, 1, 2, 3, 4
_WORD = re.compile(r"(?<=\s)(?=\S)")
_SENTENCE = re.compile(r"(?<=[.!?…。])[\"')\]»”]*\s+(?=\S)")
_LINE = re.compile(r"\r?\n\s*(?=\S)")
_PARAGRAPH = re.compile(r"\r?\n[ \t]*\r?\n\s*(?=\S)")


def strengths(text: str) -> np.ndarray:
    """Strength of the cut before each position 0..len(text)."""
    s = np.zeros(len(text) + 1, np.int8)
    for pattern, value in ((_WORD, WORD), (_SENTENCE, SENTENCE), (_LINE, LINE), (_PARAGRAPH, PARAGRAPH)):
        at = [m.end() for m in pattern.finditer(text)]
        s[at] = value
    s[0] = s[-1] = PARAGRAPH
    return s


class StrongestCut:
    """Sparse table: for every start and power of two, the position of the rightmost strongest cut."""

    def __init__(self, s: np.ndarray, widest: int | None = None):
        self.s = s
        n = min(len(s), widest or len(s))
        self.rows = [np.arange(len(s), dtype=np.int32)]
        width = 1
        while 2 * width <= n:
            a, b = self.rows[-1][:-width], self.rows[-1][width:]
            self.rows.append(np.where(s[a] > s[b], a, b).astype(np.int32))
            width *= 2

    def query(self, lo: int, hi: int) -> int:
        """Position of the strongest cut in ``lo..hi`` (both included), the rightmost of equals."""
        k = (hi - lo + 1).bit_length() - 1
        a, b = int(self.rows[k][lo]), int(self.rows[k][hi - (1 << k) + 1])
        if self.s[a] == self.s[b]:
            return max(a, b)
        return a if self.s[a] > self.s[b] else b


def spans(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Bounds of the pieces of ``text``: each at most ``limit`` long, together the whole text."""
    if not 0 <= overlap < limit // 2:
        raise ValueError("overlap must be less than half the limit")
    n = len(text)
    if n <= limit:
        return [(0, n)]
    s, slack = strengths(text), int(overlap * SLACK)
    out, start, base, index = [], 0, 0, None
    while n - start > limit:
        if index is None or start + limit >= base + len(index.s):
            base = start
            index = StrongestCut(s[base : base + max(STRETCH, 2 * limit)], limit + 1)
        least = max(start + int(limit * (1 - WINDOW)), start + 2 * overlap + 1)
        end = base + index.query(min(least, start + limit) - base, start + limit - base)
        out.append((start, end))
        if overlap:
            start = base + index.query(max(start + 1, end - overlap - slack) - base, max(start + 1, end - overlap) - base)
        else:
            start = end
    out.append((start, n))
    return out


def split_texts(df: DataFrame, keys: list[str], text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces (keys..., text_hash, piece_no, n_pieces, start_at, piece) of every text of ``df``.

    Texts within the limit never leave the JVM; only longer ones go to Python workers.
    """
    rows = df.select(*keys, F.col(text).alias("_text")).where(F.col("_text").isNotNull()).withColumn("text_hash", F.xxhash64("_text"))
    keys = [*keys, "text_hash"]
    short = rows.where(F.char_length("_text") <= limit).select(*keys, F.lit(0).alias("piece_no"), F.lit(1).alias("n_pieces"), F.lit(0).alias("start_at"), F.col("_text").alias("piece"))
    # long texts are split where they are read: a scan task has a bounded number of bytes
    long = rows.where(F.char_length("_text") > limit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cuts = [spans(t, limit, overlap) for t in b["_text"]]
            at = np.repeat(np.arange(len(b)), [len(c) for c in cuts])
            out = b[keys].iloc[at].reset_index(drop=True)
            out["piece_no"] = np.concatenate([np.arange(len(c)) for c in cuts] or [[]]).astype(np.int32)
            out["n_pieces"] = np.repeat([len(c) for c in cuts], [len(c) for c in cuts]).astype(np.int32)
            out["start_at"] = np.array([a for c in cuts for a, _ in c], np.int32)
            out["piece"] = [t[a:z] for t, c in zip(b["_text"], cuts) for a, z in c]
            yield out

    schema = ", ".join(f"{k} {t}" for k, t in rows.select(*keys).dtypes) + ", piece_no int, n_pieces int, start_at int, piece string"
    return short.unionByName(long.mapInPandas(run, schema))
