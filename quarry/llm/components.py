"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is one node of
    its component, the same for all its nodes.

    Each round shuffles the order of the nodes anew, joins every node to the
    first of its neighbours and itself, takes one step of pointer jumping, and
    replaces the ends of all edges by what they point to. Edges inside one part
    vanish; with random orders the rest shrinks by a constant factor a round,
    whatever the shape. Then the rounds are played back, last first. All state
    is in files, and joins are between files, so that hubs are split by the
    skew join."""
    def ranked(node: str, k: int):
        return F.struct(F.xxhash64(F.lit(k), node).alias("h"), F.col(node).alias("v"))

    rounds = []
    edges = materialise(edges.where("a <> b").distinct(), "edges")
    while not edges.isEmpty():
        k = len(rounds)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.least(F.min(ranked("b", k)), ranked("a", k))
        parent = materialise(both.groupBy("a").agg(first["v"].alias("up"))
                             .withColumnRenamed("a", "node"), "parents")
        up = parent.select(F.col("node").alias("up"), F.col("up").alias("root"))
        jumped = materialise(parent.join(up, "up").select("node", "root"), "jumped")
        rounds.append(jumped)
        ra = jumped.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = jumped.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        half = materialise(edges.join(ra, "a").select("ra", "b"), "relabelled")
        edges = materialise(half.join(rb, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
                            .where("a <> b").distinct(), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    known = rounds[-1]
    for earlier in reversed(rounds[:-1]):
        later = known.select(F.col("node").alias("root"), F.col("root").alias("last"))
        known = materialise(earlier.join(later, "root", "left").select(
            "node", F.coalesce("last", "root").alias("root")), "played-back")
    return known
