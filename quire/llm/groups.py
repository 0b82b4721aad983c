"""Pairwise matches consolidated into groups by low-diameter decomposition.

Each level grows clusters from exponentially shifted start times: every vertex draws a shift from an
exponential distribution, and joins the cluster whose centre reaches it first (distance minus shift).
Growth goes on until no vertex changes its cluster; the largest shift, about ``ln(vertices) / RATE``
steps, bounds it. Clusters contract to super-vertices, the edges between clusters form the next level,
and the assignments of all levels are composed from the last back to the first. A level keeps only
vertices that still have an edge to another cluster, so small groups leave after one level.

Edges lie in blocks of bounded size, whatever vertices they touch, so a hub is in many blocks and in no
task as a whole. Clusters grow inside each block as far as they can; then every vertex takes its first
cluster over all blocks, and blocks that did not agree on a vertex grow again. One block needs one round.

Ids are numbered once in their order, so all levels work on integers, and the smallest number of a
group is its smallest id. Every level writes its tables, so no plan grows with the number of levels.

Defined results: null or blank ids and pairs of equal ids match nothing; repeated pairs and both
directions of a pair count once; an empty input gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.orphans import clean_key
from quire.operators.skew import fair_share, salted_join
from quire.session import cut

#: Rate of the exponential shifts: a level cuts at most about so large a share of the edges (measured: half of it on a path).
RATE = 0.1
#: Edges of a block, which is what one task grows clusters in.
BLOCK_EDGES = 500_000
#: No input needs as many levels; each cuts a small share of the edges in expectation.
MOST_LEVELS = 64


def edge_kind(c: Column) -> Column:
    """Edge type after trimming, upper-casing and reading hyphens and blanks as underscores."""
    return F.regexp_replace(F.upper(F.regexp_replace(c, r"^\s+|\s+$", "")), r"[\s-]", "_")


def matched_pairs(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Distinct pairs (a < b) of different normalised ids."""
    pairs = edges.select(clean_key(F.col(source)).alias("s"), clean_key(F.col(target)).alias("t")).where("s is not null and t is not null and s <> t")
    return pairs.select(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).distinct()


def _shift(vertex: Column, level: int) -> Column:
    """An exponential draw that depends on vertex and level only, so a lost task repeats it."""
    unit = (F.pmod(F.xxhash64(vertex, F.lit(level)), F.lit(1 << 52)).cast("double") + 1) / float(1 << 52)
    return -F.log(unit) / RATE


def _hot(counts: DataFrame, key: str, total: int) -> DataFrame | None:
    """Keys of a written table with one row a key whose ``n`` is above a task's fair share, with their salts."""
    share = fair_share(counts.sparkSession, total)
    if total <= share:
        return None
    hot = counts.where(F.col("n") > share).select(key, F.ceil(F.col("n") / F.lit(share)).cast("int").alias("_salts"))
    return None if hot.isEmpty() else hot


def grown(a: np.ndarray, b: np.ndarray, at: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and centre of each vertex 0.. once no edge (a, b) leads to an earlier one; a step takes one unit."""
    src, dst = np.concatenate([a, b]), np.concatenate([b, a])
    at, centre, front = at.copy(), centre.copy(), np.ones(len(at), bool)
    while True:
        here = np.flatnonzero(front[src])
        s, d = src[here], dst[here]
        reach = at[s] + 1
        better = np.flatnonzero(reach < at[d])
        if not len(better):
            return at, centre
        s, d, reach = s[better], d[better], reach[better]
        order = np.lexsort((reach, d))
        first = order[np.flatnonzero(np.diff(d[order], prepend=-1))]
        at[d[first]], centre[d[first]] = reach[first], centre[s[first]]
        front[:] = False
        front[d[first]] = True


def _grow_block(edges: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
    ends = ends.sort_values("v", kind="stable")
    v = ends["v"].to_numpy()
    at, centre = grown(np.searchsorted(v, edges["a"].to_numpy()), np.searchsorted(v, edges["b"].to_numpy()), ends["at"].to_numpy(), ends["centre"].to_numpy())
    return pd.DataFrame({"v": v, "at": at, "centre": centre})


def _contract_block(edges: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
    ends = ends.sort_values("v", kind="stable")
    v, centre = ends["v"].to_numpy(), ends["centre"].to_numpy()
    c, d = centre[np.searchsorted(v, edges["a"].to_numpy())], centre[np.searchsorted(v, edges["b"].to_numpy())]
    low, high = np.minimum(c, d)[c != d], np.maximum(c, d)[c != d]
    return pd.DataFrame({"a": low, "b": high}).drop_duplicates()


def _clusters(edges: DataFrame, ends: DataFrame, blocks: int, level: int) -> DataFrame:
    """Cluster (v, centre) of each vertex: of the centre whose start, moved by the distance, is first."""
    here = ends.select("part", "v", (-_shift(F.col("v"), level)).alias("at"), F.col("v").alias("centre"))
    while True:
        out = edges.groupBy("blk").cogroup(here.groupBy("part")).applyInPandas(lambda e, v: _grow_block(e, v), "v long, at double, centre long")
        label = out.groupBy("v").agg(F.min("at").alias("first"), F.min_by("centre", "at").alias("centre"), F.max("at").alias("last"))
        label = cut(label.select("v", F.col("first").alias("at"), "centre", (F.col("first") < F.col("last")).alias("open")), "clusters")
        if blocks == 1 or label.where("open").isEmpty():
            return label.select("v", "centre")
        here = ends.join(label.select("v", "at", "centre"), "v")


def _numbered(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names (name, v, n) numbered in their order, with their degree, and edges (a, b) of numbers."""
    pairs = cut(pairs.select("a", "b"), "pairs")
    names = pairs.select(F.explode(F.array("a", "b")).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    names = cut(names.orderBy("name").select("name", F.monotonically_increasing_id().alias("v"), "n"), "names")
    hot = _hot(names.select("name", "n"), "name", 2 * pairs.count())
    edges = pairs
    for end, other in (("a", "b"), ("b", "a")):
        many = edges.withColumnRenamed(end, "name")
        edges = salted_join(many, names.select("name", "v"), ["name"], hot, "name", F.col(other)).select(F.col("v").alias(end), other)
    return names, edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def connected_groups(pairs: DataFrame, sizes: list[int] | None = None) -> DataFrame:
    """(node_id, group_id) for every id in ``pairs``(a, b); group_id is the smallest id of the group.

    ``sizes``, where given, takes the number of edges of every level.
    """
    names, edges = _numbered(pairs)
    edges = cut(edges, "edges")
    least: DataFrame | None = None
    levels: list[tuple[DataFrame, DataFrame]] = []
    while n := edges.count():
        if sizes is not None:
            sizes.append(n)
        if len(levels) == MOST_LEVELS:
            raise RuntimeError("the decomposition does not end")
        blocks = -(-n // BLOCK_EDGES)
        edges = edges.withColumn("blk", F.pmod(F.xxhash64("a", "b"), F.lit(blocks)).cast("int"))
        ends = edges.select(F.col("blk").alias("part"), F.explode(F.array("a", "b")).alias("v")).distinct()
        cluster = _clusters(edges, ends, blocks, len(levels))
        # the smallest id of each cluster; that of a cluster without outer edges is its group
        own = cluster.withColumn("least", F.col("v")) if least is None else cluster.join(least, "v")
        least = cut(own.groupBy(F.col("centre").alias("v")).agg(F.min("least").alias("least"), F.count("*").alias("n")), "least")
        levels.append((cluster, least))
        least = least.select("v", "least")
        inner = edges.groupBy("blk").cogroup(ends.join(cluster, "v").groupBy("part")).applyInPandas(lambda e, v: _contract_block(e, v), "a long, b long")
        edges = cut(inner.distinct(), "edges")
    done: DataFrame | None = None
    for cluster, least in reversed(levels):
        groups = least.select(F.col("v").alias("centre"), F.col("least").alias("group"))
        if done is not None:
            later = done.select(F.col("v").alias("centre"), F.col("group").alias("later"))
            groups = groups.join(later, "centre", "left").select("centre", F.coalesce("later", "group").alias("group"))
        hot = _hot(least.select(F.col("v").alias("centre"), "n"), "centre", cluster.count())
        done = cut(salted_join(cluster, groups, ["centre"], hot, "centre", F.col("v")).select("v", "group"), "groups")
    if done is None:
        return pairs.select(F.col("a").alias("node_id"), F.col("b").alias("group_id")).limit(0)
    members = cut(done.groupBy("group").agg(F.count("*").alias("n")), "sizes")
    named = done.join(names.select("v", F.col("name").alias("node_id")), "v").select("node_id", "group")
    heads = members.join(names.select(F.col("v").alias("group"), F.col("name").alias("group_id")), "group").select("group", "group_id")
    return salted_join(named, heads, ["group"], _hot(members, "group", done.count()), "group", F.col("node_id")).select("node_id", "group_id")
