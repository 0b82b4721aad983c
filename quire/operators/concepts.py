"""Concept linking: weighted terms joined on the term, dense vectors compared in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Query vectors that go to each task at once.
QUERY_BLOCK = 4096


def terms(c: Column) -> Column:
    """Lower-cased words of at least three letters."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[a-z]{3,}"), F.lit(0))


def term_counts(df: DataFrame, key: str, text: Column) -> DataFrame:
    """Long form (key, term, tf)."""
    return df.select(key, F.explode(terms(text)).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def weights(counts: DataFrame, key: str, df_counts: DataFrame, n: int) -> DataFrame:
    """Weighted terms (key, term, weight): tf * (1 + N / (df + 1)), with the norm of each key."""
    w = counts.join(df_counts, "term").select(key, "term", (F.col("tf") * (1 + F.lit(float(n)) / (F.col("df") + 1))).alias("weight"))
    norm = w.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return w.join(norm, key)


def document_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def concept_links(segments: DataFrame, concepts: DataFrame, least: float = 0.18, k: int = 5) -> DataFrame:
    """Top ``k`` concepts of each segment by cosine of weighted terms, from ``least`` on.

    ``segments`` (segment_id, text), ``concepts`` (concept_id, concept_text). The sparse vectors meet
    in an equi-join on the term with terms of concepts only, so no segment meets every concept.
    """
    c = term_counts(concepts, "concept_id", F.col("concept_text"))
    df_counts = document_frequency(c)
    n = concepts.select("concept_id").distinct().count()
    cw = weights(c, "concept_id", df_counts, n).select("concept_id", "term", F.col("weight").alias("cw"), F.col("norm").alias("cn"))
    sw = weights(term_counts(segments, "segment_id", F.col("text")), "segment_id", df_counts, n)
    dots = sw.join(cw, "term").groupBy("segment_id", "concept_id").agg((F.sum(F.col("weight") * F.col("cw")) / (F.first("norm") * F.first("cn"))).alias("score"))
    best = Window.partitionBy("segment_id").orderBy(F.desc(F.round("score", 6)), "concept_id")
    return dots.where(F.col("score") > least).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("segment_id", "concept_id", F.round("score", 6).alias("score"), "rank")


def phrase_links(segments: DataFrame, aliases: DataFrame) -> DataFrame:
    """Segments that hold an alias as a whole phrase: n-grams of the text meet aliases in an equi-join.

    ``aliases`` has concept_id, alias; a text is cut into n-grams of the lengths that aliases have.
    """
    clean = F.lower(F.regexp_replace(F.col("alias"), r"[^A-Za-z0-9]+", " "))
    a = aliases.select("concept_id", F.trim(clean).alias("gram")).where(F.col("gram") != "").distinct()
    sizes = [r[0] for r in a.select(F.size(F.split("gram", " ")).alias("n")).distinct().orderBy("n").collect()]
    words = F.split(F.trim(F.lower(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[^A-Za-z0-9]+", " "))), " ")
    s = segments.select("segment_id", words.alias("w"))

    def of(n: int) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))
        return F.when(F.size("w") >= n, each).otherwise(F.array().cast("array<string>"))

    grams = F.flatten(F.array(*[of(n) for n in sizes])) if sizes else F.array().cast("array<string>")
    return s.select("segment_id", F.explode(F.array_distinct(grams)).alias("gram")).join(a, "gram").select("segment_id", "concept_id").distinct()


def nearest_vectors(vectors: DataFrame, key: str, vector: str, queries: DataFrame, k: int = 5) -> DataFrame:
    """Exact top ``k`` cosine neighbours of each query vector among all others.

    Queries go to the tasks in blocks of bounded size; each task keeps its own best ``k`` a query, and
    only those are shuffled for the final ranking.
    """
    spark = vectors.sparkSession
    out = None
    kind = dict(vectors.dtypes)[key]
    schema = f"query_id {kind}, neighbour_id {kind}, score double"
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    for i in range(blocks):
        part = queries.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == i).select(key, vector).collect()
        ids = np.array([r[0] for r in part])
        q = np.array([r[1] for r in part], np.float64).reshape(len(part), -1)
        shared = spark.sparkContext.broadcast((ids, q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12) if len(part) else q))

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            ids, q = shared.value
            for b in batches:
                if not len(ids) or not len(b):
                    continue
                x = np.array(b[vector].to_list(), np.float64)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                mine = b[key].to_numpy()
                scores = np.round(q @ x.T, 9)
                scores[ids[:, None] == mine[None, :]] = -np.inf
                order = np.lexsort((np.broadcast_to(mine, scores.shape), -scores), axis=1)[:, :k]
                r = np.repeat(np.arange(len(ids)), order.shape[1])
                out = pd.DataFrame({"query_id": ids[r], "neighbour_id": mine[order.ravel()], "score": scores[r, order.ravel()]})
                yield out[np.isfinite(out["score"])]

        found = vectors.select(key, vector).mapInPandas(search, schema)
        out = found if out is None else out.unionByName(found)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "neighbour_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "neighbour_id", F.round("score", 6).alias("score"), "rank")


#: Words and keywords of a catalogue that go to every task; a larger catalogue is joined or refused.
MOST_KEYWORDS = 200_000
_NAME_WORD = r"([A-Za-z][A-Za-z\-]+)"


def fallback_concepts(segments: DataFrame, concepts: DataFrame) -> DataFrame:
    """One concept (segment_id, concept_id, confidence) of every segment: the best by words of its name.

    ``segments`` (segment_id, text), ``concepts`` (concept_id, concept_name). The score is the share of the name's
    words in the text; the first concept wins ties. Confidence is 0.25, and 0.1 for the first concept of all where no
    word is shared.
    """
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(_NAME_WORD), F.lit(1)))
    names = concepts.select("concept_id", words(F.col("concept_name")).alias("w")).select("concept_id", F.size("w").alias("n"), F.explode("w").alias("word"))
    small = names.count() <= MOST_KEYWORDS
    hits = segments.select("segment_id", F.explode(words(F.col("text"))).alias("word")).distinct().join(F.broadcast(names) if small else names, "word")
    scores = hits.groupBy("segment_id", "concept_id").agg((F.count("*") / F.first("n")).alias("score"))
    best = scores.groupBy("segment_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "concept_id")).alias("b")).select("segment_id", F.col("b.concept_id").alias("concept_id"))
    first = concepts.agg(F.min("concept_id")).first()[0]
    all_ = segments.select("segment_id").distinct().join(best, "segment_id", "left")
    return all_.select("segment_id", F.coalesce("concept_id", F.lit(first)).alias("concept_id"), F.when(F.col("concept_id").isNotNull(), 0.25).otherwise(0.1).alias("confidence"))


def unique_concepts(matches: DataFrame, key: str) -> DataFrame:
    """One match of each ``key`` and concept name: of the lowest level, then the highest confidence, then the smallest id."""
    order = F.struct("concept_level", (-F.col("confidence")).alias("c"), "concept_id")
    return matches.groupBy(key, "concept_name").agg(F.min(order).alias("b")).select(key, "concept_name", F.col("b.concept_id").alias("concept_id"), F.col("b.concept_level").alias("concept_level"), (-F.col("b.c")).alias("confidence"))


def table_concepts(tables: DataFrame, concepts: DataFrame, semantic: DataFrame | None = None, least: float = 0.4, k: int = 5) -> DataFrame:
    """Concepts (segment_id, concept_id, confidence, method) of tables by keywords and, where given, similarity.

    ``tables`` (segment_id, text), ``concepts`` (concept_id, concept_name, keywords), ``semantic`` (segment_id,
    concept_id, similarity), of which the ``k`` best count. A keyword or name counts where it stands anywhere in the
    text, in any case: one automaton of all keywords reads each text once. Keywords alone give 0.8 of the share of
    keywords found, at most 1; they add 0.2 to a similarity.
    """
    rows = concepts.select("concept_id", "concept_name", "keywords").limit(MOST_KEYWORDS + 1).collect()
    if sum(1 + len(r["keywords"] or []) for r in rows) > MOST_KEYWORDS:
        raise ValueError("the concept catalogue must be a bounded table")
    names = [(r["concept_id"], [x.lower() for x in [*(r["keywords"] or []), r["concept_name"]] if x], max(len(r["keywords"] or []), 1)) for r in rows]

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        found_by: dict[str, list] = {}
        for i, (_, words, _) in enumerate(names):
            for w in words:
                found_by.setdefault(w, []).append(i)
        machine = ahocorasick.Automaton()
        for w in found_by:
            machine.add_word(w, w)
        machine.make_automaton()
        for b in batches:
            out = []
            for key, text in zip(b["segment_id"], b["text"]):
                hits: dict[int, int] = {}
                words = {w for _, w in machine.iter(text.lower())} if text and found_by else ()
                for w in words:
                    for i in set(found_by[w]):
                        hits[i] = hits.get(i, 0) + names[i][1].count(w)
                out += [(key, names[i][0], min(1.0, n / names[i][2])) for i, n in hits.items()]
            yield pd.DataFrame(out, columns=["segment_id", "concept_id", "share"])

    kind = dict(concepts.dtypes)["concept_id"]
    hits = tables.select("segment_id", "text").mapInPandas(match, f"segment_id {dict(tables.dtypes)['segment_id']}, concept_id {kind}, share double")
    hits = hits.groupBy("segment_id", "concept_id").agg(F.max("share").alias("share"))
    if semantic is None:
        out = hits.select("segment_id", "concept_id", (0.8 * F.col("share")).alias("confidence"), F.lit("keyword").alias("method"))
    else:
        rank = F.row_number().over(Window.partitionBy("segment_id").orderBy(F.desc("similarity"), "concept_id"))
        near = semantic.withColumn("_r", rank).where(F.col("_r") <= k).select("segment_id", "concept_id", F.col("similarity").cast("double").alias("similarity"))
        both = hits.join(near, ["segment_id", "concept_id"], "full")
        confidence = F.when(F.col("share").isNull(), F.col("similarity")).when(F.col("similarity").isNull(), 0.8 * F.col("share")).otherwise(F.least(F.lit(1.0), F.col("similarity") + 0.2))
        method = F.when(F.col("share").isNull(), "semantic").when(F.col("similarity").isNull(), "keyword").otherwise("semantic+keyword")
        out = both.select("segment_id", "concept_id", confidence.alias("confidence"), method.alias("method"))
    return out.where(F.col("confidence") >= least)
