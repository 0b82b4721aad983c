"""Queries and SQL of the core data-quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.operators import orphans, quantities
from quire.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """References that name no present segment or concept."""
    edges, segments, concepts = (table(spark, d, t) for t in ("edges", "segments", "concepts"))
    refs = orphans.references(edges, "edges.target_id", "edge_id", "target_id")
    for c in ("solution_for_question_id", "derived_to_formula_id"):
        refs = refs.unionByName(orphans.references(segments, f"segments.{c}", "segment_id", c))
    parent = orphans.parents(segments, "segment_id", "loaded_at", "deleted_at").unionByName(orphans.parents(concepts, "concept_id"))
    return orphans.orphan_references(refs, parent)


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per field and month."""
    return orphans.orphan_report(p1_found(spark, d))


def p6_converted(spark: SparkSession, d: str) -> DataFrame:
    """Every quantity cell in the common unit."""
    return quantities.common_units(table(spark, d, "cell_meta"), table(spark, d, "table_segments"), table(spark, d, "unit_catalogue"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Cells whose stored value disagrees with the stated quantity."""
    return quantities.disagreeing(p6_converted(spark, d)).select("cell_id").distinct()


QUERIES = {"p1_found": p1_found, "p1_report": p1_report, "p6_found": p6_found, "p6_converted": p6_converted}

_P1 = """
WITH refs AS (
  SELECT 'edges.target_id' AS ref_field, edge_id AS record_id, lower(trim(target_id)) AS k, created_at FROM edges
  UNION ALL SELECT 'segments.solution_for_question_id', segment_id, lower(trim(solution_for_question_id)), created_at FROM segments
  UNION ALL SELECT 'segments.derived_to_formula_id', segment_id, lower(trim(derived_to_formula_id)), created_at FROM segments),
parent AS (SELECT lower(trim(segment_id)) AS k, min(loaded_at) AS loaded, bool_or(deleted_at IS NOT NULL) AS gone FROM segments GROUP BY 1),
concept AS (SELECT DISTINCT lower(trim(concept_id)) AS k FROM concepts),
found AS (
  SELECT DISTINCT ref_field, record_id, strftime(created_at, '%Y-%m') AS ref_period
  FROM refs LEFT JOIN parent USING (k)
  WHERE k IS NOT NULL AND k <> '' AND k NOT IN (SELECT k FROM concept WHERE k IS NOT NULL)
    AND (parent.loaded IS NULL OR gone OR date_trunc('month', loaded) > date_trunc('month', created_at)))
"""
SQL = {
    "p1_found": _P1 + "SELECT * FROM found",
    "p1_report": _P1 + "SELECT ref_field, ref_period, count(*) AS n_orphans FROM found GROUP BY 1, 2",
}
