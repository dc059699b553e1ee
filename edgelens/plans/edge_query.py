"""Inter-body and intra-body edges that meet a set of criteria."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from edgelens.functions import Resolution, ScoreFn
from edgelens.operators.dimensions import (
    BODY_BOX,
    SV_BOX,
    boxes_within_bodies,
    enrich_edges,
    looked_up_in,
    sv_ends,
)
from edgelens.operators.edges import (
    COORDINATE_FIELDS,
    Coordinates,
    drop_self_edges,
    flatten_edges,
    union_resolutions,
    with_score,
)
from edgelens.operators.filters import across_endpoints, eligible_endpoint, stored_within_scores
from edgelens.operators.ordering import Order, ordered
from edgelens.operators.ranking import best_contact_per_pair
from edgelens.operators.skew import deal_rows
from edgelens.parameters import EdgeCriteria, EdgeType
from edgelens.plans.skew_profile import SkewProfile
from edgelens.sources import TableSet


def _ends(*names: str) -> list[str]:
    return [f"{name}_{side}" for name in names for side in ("a", "b")]


def _boxes(kind: str) -> list[str]:
    return [
        f"{kind}_box_{axis}{corner}_{side}"
        for side in ("a", "b")
        for corner in (0, 1)
        for axis in ("x", "y", "z")
    ]


# Columns of an enriched edge, in output order.
EDGE_COLUMNS = (
    *_ends("sv", "body"),
    "score",
    "score_ab",
    "score_ba",
    *_ends("sv_mask", "body_tbars", "sv_tbars"),
    *COORDINATE_FIELDS,
    *_ends("body_size"),
    *_boxes("body"),
    *_ends("sv_size"),
    *_boxes("sv"),
)


def edge_query(
    tables: TableSet,
    res: Resolution | int,
    criteria: EdgeCriteria = EdgeCriteria(),
    order_by: str | Order | None = None,
    skew: SkewProfile = SkewProfile(),
) -> DataFrame:
    """The best qualifying contact of each supervoxel pair at one resolution.

    Criteria apply before the best contact is chosen, so a pair whose best contact fails
    is represented by the best one that passes.

    Few edges lie inside a body, and that shows only when both ends are known. Those edges
    are joined to the boxes last, after the best contact is chosen; inter-body edges, most
    of which stay, are joined once.
    """
    edges = flatten_edges(_scored_contacts(tables, res, criteria), res)
    return ordered(_best_qualifying(tables, edges, criteria, skew), order_by)


def edge_query_resolutions(
    tables: TableSet,
    criteria: EdgeCriteria = EdgeCriteria(),
    resolutions: Iterable[Resolution | int] = tuple(reversed(Resolution)),
    order_by: str | Order | None = None,
    skew: SkewProfile = SkewProfile(),
) -> DataFrame:
    """``edge_query`` at several resolutions, tagged with ``res``.

    Pairs are not merged across resolutions: the best contact is that of a pair and resolution.
    All edges go through the two joins together, so what is known about supervoxels is gathered
    once. Write the result with ``partition_by=["res"]`` to get one folder per resolution, or
    see ``edgelens.plans.batch`` for outputs that are committed one by one.
    """
    resolutions = [Resolution(r) for r in resolutions]
    contacts = {r: _scored_contacts(tables, r, criteria) for r in resolutions}
    edges = union_resolutions(contacts, resolutions, Coordinates.FLOAT)
    return ordered(_best_qualifying(tables, edges, criteria, skew), order_by)


def _scored_contacts(tables: TableSet, res: Resolution | int, criteria: EdgeCriteria) -> DataFrame:
    return stored_within_scores(tables.rsg[Resolution(res)], criteria.scores)


def _best_qualifying(
    tables: TableSet, edges: DataFrame, criteria: EdgeCriteria, skew: SkewProfile
) -> DataFrame:
    tag = [c for c in ("res",) if c in edges.columns]
    edges = drop_self_edges(edges)
    edges = with_score(deal_rows(edges, skew.supervoxels), ScoreFn.OPTIMISTIC)
    # Tests on one end depend on its supervoxel alone: apply them to the dimension, once.
    ends = sv_ends(tables, skew.bodies, eligible_endpoint(criteria))
    boxes_last = criteria.edge_type is EdgeType.INTRA_BODY
    first = ends.drop(*BODY_BOX, *SV_BOX) if boxes_last else ends
    first = looked_up_in(first, tables, skew.supervoxels)
    kept = enrich_edges(edges, first, skew.supervoxels).where(across_endpoints(criteria))
    best = best_contact_per_pair(kept)
    if boxes_last:
        best = boxes_within_bodies(best, tables, skew.supervoxels, skew.bodies)
    return best.select(*tag, *EDGE_COLUMNS, "rownum")
