"""Nodes and edges: deduplication, admission, integrity, statistics and chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import strip


def node_id(c: Column) -> Column:
    return F.lower(strip(c))


def latest_nodes(segments: DataFrame) -> DataFrame:
    """One row a segment: the one loaded last, ties by the fuller heading path."""
    rows = segments.withColumn("_id", node_id(F.col("segment_id")))
    w = Window.partitionBy("_id").orderBy(F.col("loaded_at").desc_nulls_last(), F.col("heading_path").desc_nulls_last(), "segment_id")
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_id")


def edge_rows(edges: DataFrame) -> DataFrame:
    """Edges with normalised ends and type, one row an edge id (the one loaded last)."""
    kind = F.regexp_replace(F.upper(strip(F.col("edge_type"))), r"[\s-]", "_")
    rows = edges.select("edge_id", node_id(F.col("source_id")).alias("source_id"), node_id(F.col("target_id")).alias("target_id"), kind.alias("edge_type"), "strength", "loaded_at")
    w = Window.partitionBy("edge_id").orderBy(F.col("loaded_at").desc_nulls_last(), F.col("strength").desc_nulls_last())
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def evidence(edges: DataFrame) -> DataFrame:
    """One edge for each (source, target, type), the one with the smallest id."""
    return edges.groupBy("source_id", "target_id", "edge_type").agg(F.min("edge_id").alias("edge_id"), F.count("*").alias("n_edges"))


def known_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges of which both ends are nodes: two semi-joins."""
    ids = nodes.select("node_id").distinct()
    return edges.join(ids.withColumnRenamed("node_id", "source_id"), "source_id", "left_semi").join(ids.withColumnRenamed("node_id", "target_id"), "target_id", "left_semi")


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose target is no node: an anti-join."""
    return edges.join(nodes.select(F.col("node_id").alias("target_id")).distinct(), "target_id", "left_anti")


def admitted(edges: DataFrame, kinds: DataFrame) -> DataFrame:
    """Edges by the types of their ends: between kept types, to formulas, from formulas to concepts, duplicates."""
    k = kinds.select("node_id", "kind")
    e = edges.join(k.select(F.col("node_id").alias("source_id"), F.col("kind").alias("source_kind")), "source_id").join(k.select(F.col("node_id").alias("target_id"), F.col("kind").alias("target_kind")), "target_id")
    kept = ["question", "solution", "derivation", "worked_example", "calculation", "reference_stub"]
    s, t, y = F.col("source_kind"), F.col("target_kind"), F.col("edge_type")
    ok = (s.isin(kept) & t.isin(kept)) | (s.isin(kept) & (t == "formula") & y.isin("USES_FORMULA", "EXPLAINS", "REFERENCES")) | (y == "WORKED_EXAMPLE_OF") | ((s == "formula") & (t == "concept") & (y == "DEFINES")) | (y == "DUPLICATE_OF")
    return e.where(ok)


def node_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("kind").agg(F.count("*").alias("n_nodes"))


def question_status(questions: DataFrame, edges: DataFrame) -> DataFrame:
    """``linked`` or ``not_found_in_book`` for each question."""
    answered = edges.where("edge_type = 'ANSWER_OF'").select(F.col("target_id").alias("node_id")).distinct().withColumn("_a", F.lit(True))
    return questions.join(answered, "node_id", "left").select("node_id", F.when(F.col("_a"), "linked").otherwise("not_found_in_book").alias("solution_status"))


def quality(segments: DataFrame) -> DataFrame:
    """Shares and counts that a run is judged by, in one aggregate."""
    return segments.agg(
        F.count("*").alias("n_segments"), F.count_if(F.col("segment_type") == "question").alias("n_questions"), F.count_if(F.col("segment_type") == "solution").alias("n_solutions"),
        F.round(F.avg(F.when(F.col("segment_type") == "solution", F.col("solution_for_question_id").isNotNull().cast("double"))), 6).alias("solution_link_rate"),
        F.round(F.avg(F.when(F.col("segment_type") == "derivation", F.col("derived_to_formula_id").isNotNull().cast("double"))), 6).alias("derivation_link_rate"),
        F.round(F.avg(F.col("needs_human_review").cast("double")), 6).alias("review_rate"),
    )


def chains(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Formula, example, question and solution chains: at each hop the neighbour nearest in pages.

    ``nodes`` has node_id, kind, page; the hops are equi-joins on edges, never on all nodes.
    """
    n = nodes.select("node_id", "kind", "page")

    def hop(rows: DataFrame, at: str, kind: str, types: list[str], reverse: bool, name: str) -> DataFrame:
        near, far = ("target_id", "source_id") if reverse else ("source_id", "target_id")
        e = edges.where(F.col("edge_type").isin(types)).select(F.col(near).alias(at), F.col(far).alias("_n")).distinct()
        to = n.where(F.col("kind") == kind).select(F.col("node_id").alias("_n"), F.col("page").alias("_p"))
        best = rows.join(e, at).join(to, "_n").groupBy(*rows.columns).agg(F.min_by("_n", F.struct(F.abs(F.col("_p") - F.col("page")).alias("d"), F.col("_n"))).alias(name))
        return best

    formulas = n.where("kind = 'formula'").select(F.col("node_id").alias("formula_id"), "page")
    out = hop(formulas, "formula_id", "worked_example", ["USES_FORMULA", "REFERENCES", "EXPLAINS"], True, "example_id")
    out = hop(out, "formula_id", "question", ["USES_FORMULA", "REFERENCES", "EXPLAINS"], True, "question_id")
    return hop(out, "question_id", "solution", ["ANSWER_OF", "REFERENCES", "EXPLAINS"], True, "solution_id").select("formula_id", "example_id", "question_id", "solution_id")


def canonical_formulas(formulas: DataFrame) -> DataFrame:
    """Earliest formula (page, y0, id) of each book, chapter and key; the others point to it."""
    w = Window.partitionBy("book_id", "chapter_number", "canonical_formula_key").orderBy("page_start", "y0", "segment_id")
    first = F.first("segment_id").over(w)
    return formulas.withColumn("canonical_id", first).select("segment_id", "canonical_id", (F.col("segment_id") != F.col("canonical_id")).alias("is_duplicate"))


def chapters(segments: DataFrame) -> DataFrame:
    """Per book and chapter: title, size, whether solutions are present; sorted by natural number outside."""
    valid = F.col("chapter_number").rlike(r"^\d+(\.\d+)*$")
    return segments.where(valid).groupBy("book_id", "chapter_number").agg(
        F.min("chapter_title").alias("chapter_title"), F.count("*").alias("n_segments"), F.bool_or(F.col("segment_type") == "solution").alias("solutions_present"), F.min("page_start").alias("first_page"),
        F.first(F.size(F.split("chapter_number", r"\."))).cast("int").alias("level"),
    )


#: Hops of a chain: name, kind of the node, edge types, and the column that the edge points to.
HOPS = [
    ("example_id", "worked_example", ["USES_FORMULA", "REFERENCES", "EXPLAINS"], "formula_id"), ("question_id", "question", ["USES_FORMULA", "REFERENCES", "EXPLAINS"], "formula_id"),
    ("solution_id", "solution", ["ANSWER_OF", "REFERENCES", "EXPLAINS"], "question_id"), ("derivation_id", "derivation", ["USES_FORMULA", "REFERENCES", "EXPLAINS"], "formula_id"),
]


def partial_chains(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Chains of every formula to example, question, solution and derivation, with nulls where a hop has no neighbour.

    At each hop the neighbour nearest in pages is taken, the smallest id of equals; ``n_hops`` counts the hops there are.
    Each hop is one join of edges with the nodes of its kind and one aggregate on the node before it.
    """
    n = nodes.select("node_id", "kind", "page")
    out = n.where("kind = 'formula'").select(F.col("node_id").alias("formula_id"))
    pages = n.select(F.col("node_id").alias("_at"), F.col("page").alias("_from"))
    for name, kind, types, at in HOPS:
        to = n.where(F.col("kind") == kind).select(F.col("node_id").alias("_n"), F.col("page").alias("_p"))
        e = edges.where(F.col("edge_type").isin(types)).select(F.col("target_id").alias("_at"), F.col("source_id").alias("_n")).distinct()
        near = F.min(F.struct(F.abs(F.col("_p") - F.col("_from")).alias("d"), F.col("_n")))
        hop = e.join(to, "_n").join(pages, "_at").groupBy(F.col("_at").alias(at)).agg(near.alias("b")).select(at, F.col("b._n").alias(name))
        out = out.join(hop, at, "left")
    n_hops = sum((F.col(name).isNotNull().cast("int") for name, *_ in HOPS), F.lit(0))
    return out.select("formula_id", *[name for name, *_ in HOPS], n_hops.alias("n_hops"))


def fullest_chains(chains_: DataFrame, most: int = 8) -> DataFrame:
    """The ``most`` chains with most hops for a report, by formula id where equal."""
    return chains_.where("n_hops > 0").orderBy(F.desc("n_hops"), "formula_id").limit(most)


def graph_checks(segments: DataFrame, edges: DataFrame) -> DataFrame:
    """(check, n_bad) of a graph as delivered: ids, repeated ids, edge fields and ends that name no node."""
    ids = segments.groupBy("segment_id").agg(F.count("*").alias("n"))
    nodes = ids.agg(F.coalesce(F.sum(F.when(F.col("segment_id").isNull(), F.col("n"))), F.lit(0)).alias("a"), F.count_if(F.col("segment_id").isNotNull() & (F.col("n") > 1)).alias("b"))
    known = ids.where("segment_id is not null").select(F.col("segment_id").alias("_id"), F.lit(True).alias("_k"))
    gaps = edges.agg(F.count_if(F.col("source_id").isNull() | F.col("target_id").isNull() | F.col("edge_type").isNull() | F.col("strength").isNull() | F.col("anchor_metadata").isNull()).alias("n"))
    ends = edges.groupBy("source_id", "target_id").agg(F.count("*").alias("n"))
    for c in ("source_id", "target_id"):
        ends = ends.join(known.withColumnsRenamed({"_id": c, "_k": f"_{c}"}), c, "left")
    loose = ends.where("_source_id is null or _target_id is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    rows = [nodes.select(F.lit("missing_id").alias("check"), F.col("a").alias("n_bad")), nodes.select(F.lit("repeated_id"), "b"), gaps.select(F.lit("edge_fields"), "n"), loose.select(F.lit("dangling_edge"), "n")]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


def of_types(segments: DataFrame, allowed: list[str]) -> DataFrame:
    """Segments of the allowed types, in any case."""
    return segments.where(F.lower("segment_type").isin([t.lower() for t in allowed]))
