"""Pages of repeated keywords, link lists and tag lists instead of sentences.

Each text is compressed block by block. Its ratio is compared with what ordinary texts of the same
language and block length reach (median and median absolute deviation over the whole corpus), since
short blocks compress worse. A text far below that is redundant; it is spam if, besides, less than
``SENTENCES`` of its words stand in punctuated sentences.

Defined results: a null text, and one without words, is no spam; a null or rare language is judged
against all languages; very long texts are many blocks; repeated rows are judged each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.words import WORD
from quire.session import cut

BLOCK = 1500
#: Deviations below the usual ratio from which a text is redundant.
REDUNDANT = -1.5
#: Share of words in sentences under which a text is no prose. Some words of any prose stand outside
#: sentences (headings, labels, broken lines); compression tells such texts apart.
SENTENCES = 0.5
#: Share of words in sentences from which a text tells what is usual.
PROSE = 0.5
#: Words that a sentence has at least.
SENTENCE_WORDS = 7
#: Ordinary texts that a group needs to be judged by its own figures.
GROUP_TEXTS = 50
#: Groups of language and block length that go to every task; more of them are joined.
BROADCAST_GROUPS = 50_000

_END = re.compile(r"(?<=[.!?…。])[\"')\]»”]*\s+|\n+")
_LINK = re.compile(r"https?:|www\.|\]\(|<a\b|\||#\w+\s+#|\w\.\w{2,}/\w")


def sentence_share(text: str) -> tuple[float, int]:
    """Share of the words that stand in punctuated sentences, and the number of words."""
    total = inside = 0
    for unit in _END.split(text):
        n = len(WORD.findall(unit))
        total += n
        if n >= SENTENCE_WORDS and unit.rstrip()[-1:] in ".!?…。\"')»”" and not _LINK.search(unit):
            inside += n
    return (inside / total if total else 1.0), total


def block_ratio(text: str, block: int = BLOCK) -> tuple[float, float]:
    """Compressed over plain size of the blocks of a text, and the length of a block."""
    data = text.encode("utf-8", "surrogatepass")
    count = max(1, round(len(data) / block))
    step = -(-len(data) // count)
    packed = sum(len(zlib.compress(data[i : i + step], 6)) for i in range(0, len(data), step))
    return packed / len(data), len(data) / count


def features(df: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(key, lang, n_words, sentence_share, ratio, size_class) of every text that has words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t, g in zip(b[key], b["_text"], b["_lang"]):
                share, n = sentence_share(t)
                if n:
                    ratio, length = block_ratio(t)
                    rows.append((k, g, n, share, ratio, int(np.log2(max(length, 16)) * 4)))
            yield pd.DataFrame(rows, columns=[key, "lang", "n_words", "sentence_share", "ratio", "size_class"])

    rows = df.where(F.col(text) != "").select(key, F.col(text).alias("_text"), F.lower(F.coalesce(F.col(lang), F.lit("und"))).alias("_lang"))
    return rows.mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, lang string, n_words int, sentence_share double, ratio double, size_class int")


def _usual(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    quartiles = F.percentile_approx("ratio", [0.25, 0.5, 0.75], 1000)
    usual = rows.groupBy(*by).agg(F.count("*").alias("n"), quartiles.alias("q")).where(F.col("n") >= GROUP_TEXTS)
    # half the distance of the quartiles is the median absolute deviation of a symmetric sample
    return usual.select(*by, F.struct(F.col("q")[1].alias("mid"), (1.4826 * (F.col("q")[2] - F.col("q")[0]) / 2 + 0.005).alias("dev")).alias(name))


def spam_pages(df: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(key, lang, n_words, sentence_share, ratio, deviation, is_spam) of every text with words."""
    rows = cut(features(df, key, text, lang), "features")
    prose = rows.where(F.col("sentence_share") >= PROSE)
    q = prose.agg(F.percentile_approx("ratio", [0.25, 0.5, 0.75], 1000)).first()[0] or [0.5, 0.55, 0.6]
    whole = F.struct(F.lit(q[1]).alias("mid"), F.lit(1.4826 * (q[2] - q[0]) / 2 + 0.005).alias("dev"))
    by_class = _usual(prose, ["size_class"], "u2")  # a few dozen rows: blocks have less than two sizes of a block
    by_lang = cut(_usual(prose, ["lang", "size_class"], "u1"), "usual")
    if by_lang.count() <= BROADCAST_GROUPS:
        by_lang = F.broadcast(by_lang)
    judged = rows.join(by_lang, ["lang", "size_class"], "left").join(F.broadcast(by_class), "size_class", "left").withColumn("u", F.coalesce("u1", "u2", whole))
    deviation = (F.col("ratio") - F.col("u.mid")) / F.col("u.dev")
    spam = (deviation < REDUNDANT) & (F.col("sentence_share") < SENTENCES)
    return judged.select(key, "lang", "n_words", "sentence_share", "ratio", deviation.alias("deviation"), spam.alias("is_spam"))
