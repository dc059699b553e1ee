"""Criteria on enriched edges, and the part of them one end decides alone."""

from __future__ import annotations

from pyspark.sql import DataFrame

from edgelens.functions import Bounds
from edgelens.operators.edges import EDGE_TYPE_CONDITION, SCORE_FIELDS
from edgelens.operators.skew import HotKeys, lookup
from edgelens.parameters import NEUROPIL, EdgeCriteria

# Attribute column of each threshold family besides the scores.
FAMILIES = ("body_tbars", "sv_tbars", "body_size", "sv_size")


def within(edges: DataFrame, attribute: str, bounds: Bounds) -> DataFrame:
    """Apply all four bounds of one family to ``<attribute>_a`` and ``<attribute>_b``."""
    return edges.where(bounds.condition(f"{attribute}_a", f"{attribute}_b"))


def within_scores(edges: DataFrame, bounds: Bounds) -> DataFrame:
    return edges.where(bounds.condition("score_ab", "score_ba"))


def stored_within_scores(rsg: DataFrame, bounds: Bounds) -> DataFrame:
    """``within_scores`` on stored contacts, where it can be pushed into the file scan.

    NaN compares above every number here and fails the upper bound, as NULL does.
    """
    return rsg.where(bounds.condition(*SCORE_FIELDS.values()))


_IN_NEUROPIL = f"sv_mask_a = {NEUROPIL} AND sv_mask_b = {NEUROPIL}"
_NOT_BOTH_SEPARATE = "NOT (is_separate_a AND is_separate_b)"


def in_neuropil(edges: DataFrame) -> DataFrame:
    return edges.where(_IN_NEUROPIL)


def exclude_isolated(
    edges: DataFrame, isolated: DataFrame, hot: HotKeys = HotKeys()
) -> DataFrame:
    """Drop edges with an end that must never be merged to anything."""
    listed = isolated.selectExpr("sv AS _key").distinct()
    for side in ("a", "b"):
        edges = lookup(edges, listed, f"sv_{side}", hot, "left_anti")
    return edges


def exclude_mutual(edges: DataFrame, separate: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """Drop edges whose bodies both belong to the mutually exclusive set.

    ``hot`` are hot bodies.
    """
    listed = separate.select("body").distinct()
    for side in ("a", "b"):
        flagged = listed.selectExpr("body AS _key", f"true AS is_separate_{side}")
        edges = lookup(edges, flagged, f"body_{side}", hot, "left")
    allowed = edges.where("is_separate_a IS NULL OR is_separate_b IS NULL")
    return allowed.drop("is_separate_a", "is_separate_b")


def eligible_endpoint(criteria: EdgeCriteria) -> str:
    """Condition on a supervoxel that can be an end of an edge at all.

    Legal only before steps that look at one pair at a time. A ranking over many pairs
    must see the edges this would remove.
    """
    alone = [getattr(criteria, name).endpoint(name) for name in FAMILIES]
    return " AND ".join([f"sv_mask = {NEUROPIL}", "NOT is_isolated", *alone])


def across_endpoints(criteria: EdgeCriteria) -> str:
    """What ``eligible_endpoint`` leaves to test: the kind of edge, and clauses that need
    both ends."""
    clauses = [EDGE_TYPE_CONDITION[criteria.edge_type], _NOT_BOTH_SEPARATE]
    for name in FAMILIES:
        clauses += getattr(criteria, name).across(f"{name}_a", f"{name}_b")
    return " AND ".join(clauses)


def all_criteria(criteria: EdgeCriteria) -> str:
    """Every criterion but the kind of edge, on edges enriched from the whole dimension."""
    clauses = [
        _IN_NEUROPIL,
        "NOT is_isolated_a AND NOT is_isolated_b",
        _NOT_BOTH_SEPARATE,
        criteria.scores.condition("score_ab", "score_ba"),
    ]
    clauses += [getattr(criteria, n).condition(f"{n}_a", f"{n}_b") for n in FAMILIES]
    return " AND ".join(clauses)
