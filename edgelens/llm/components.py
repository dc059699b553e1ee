"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgelens.llm.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its smallest node.

    Each round hooks every node to its smallest neighbour, follows these pointers to their
    roots and replaces the nodes of the edges by their roots, which at least halves the nodes
    that still have edges. Minima are taken with partial aggregation and joins run between two
    plain exchanges, so a node with a third of all edges is neither gathered in one task nor
    beyond adaptive execution's skew split. An empty table gives an empty result.
    """
    edges = scratch.keep(_between(edges), "edges")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.col("a")).alias("root")
        )
        parents = _to_roots(scratch.keep(parents, "parents"), scratch)
        labels = parents if labels is None else scratch.keep(_follow(labels, parents), "labels")
        edges = scratch.keep(_between(_rename(edges, parents)), "edges")
        if edges.isEmpty():
            return labels.select("node", F.col("root").alias("component"))


def _between(edges: DataFrame) -> DataFrame:
    """Distinct edges between different nodes, the smaller one first."""
    return (
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _follow(pointers: DataFrame, steps: DataFrame) -> DataFrame:
    """``pointers`` (node, root) with each root replaced by where ``steps`` takes it."""
    steps = steps.select(F.col("node").alias("_from"), F.col("root").alias("_to"))
    return pointers.join(steps, F.col("root") == F.col("_from"), "left").select(
        "node", F.coalesce("_to", "root").alias("root")
    )


def _to_roots(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """Doubles the pointers until each ends at a node that points to itself."""
    while True:
        further = scratch.keep(
            _follow(parents, parents.where("node <> root"))
            .join(parents.select(F.col("node").alias("_n"), F.col("root").alias("_was")),
                  F.col("node") == F.col("_n"))
            .select("node", "root", (F.col("root") != F.col("_was")).alias("_moved")),
            "parents",
        )
        parents = further.select("node", "root")
        if further.where("_moved").isEmpty():
            return parents


def _rename(edges: DataFrame, parents: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        roots = parents.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        other = "b" if side == "a" else "a"
        edges = edges.join(roots, F.col(side) == F.col("_n"), "left").select(
            F.coalesce("_r", side).alias(side), other
        )
    return edges
