"""The best edges of each body, then checked against the criteria.

The ranking comes first: where the best edge of a body fails, no other takes its place.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgelens.functions import Resolution, ScoreFn
from edgelens.operators.dimensions import enrich_edges, looked_up_in, sv_bodies, sv_ends
from edgelens.operators.edges import (
    Coordinates,
    edges_inter,
    flatten_edges,
    union_resolutions,
    valid_edges_with_bodies,
    with_both_scores,
    with_score,
)
from edgelens.operators.filters import all_criteria
from edgelens.operators.ordering import Order, by_body_tbars, ordered
from edgelens.operators.ranking import top_n_per_body, top_n_with_side_ranks
from edgelens.operators.skew import DEAL, HotKeys, deal_rows
from edgelens.parameters import EdgeCriteria
from edgelens.plans.edge_query import EDGE_COLUMNS
from edgelens.plans.skew_profile import SkewProfile
from edgelens.sources import TableSet

# Fixed value: a body needs this many tbars to be worth a review.
REVIEW_CRITERIA = EdgeCriteria(min_body_tbars_both=2)


def inter_body_candidates(
    tables: TableSet, edges: DataFrame, score_fn: ScoreFn, hot: HotKeys = HotKeys()
) -> DataFrame:
    """Scored edges between different bodies, both ends valid: the input of a ranking.

    With hot keys, ``edges`` must have been through ``deal_rows``.
    """
    bodies = looked_up_in(sv_bodies(tables), tables, hot, "objinfo", "agglo")
    valid = valid_edges_with_bodies(with_score(edges, score_fn), bodies, hot)
    return edges_inter(valid)


def _checked(
    tables: TableSet,
    best: DataFrame,
    criteria: EdgeCriteria,
    mask_b_from_a: bool,
    skew: SkewProfile,
) -> DataFrame:
    # Few rows are left, but one supervoxel may be the best partner of very many bodies:
    # the rows that end at it are told apart by the body they were ranked for.
    best = best.withColumn(DEAL, F.xxhash64("ranked_body", "rank")) if skew.supervoxels else best
    ends = looked_up_in(sv_ends(tables, skew.bodies), tables, skew.supervoxels)
    enriched = enrich_edges(best, ends, skew.supervoxels)
    if mask_b_from_a:
        enriched = enriched.withColumn("sv_mask_b", F.col("sv_mask_a"))
    return enriched.where(all_criteria(criteria))


def best_edges_all_res(
    tables: TableSet,
    n: int = 10,
    criteria: EdgeCriteria = REVIEW_CRITERIA,
    resolutions: Iterable[Resolution | int] = tuple(reversed(Resolution)),
    with_side_ranks: bool = True,
    mask_b_from_a: bool = False,
    order_by: str | Order | None = (),
    skew: SkewProfile = SkewProfile(),
) -> DataFrame:
    """The ``n`` best edges of each body over several resolutions, by the lower score.

    ``with_side_ranks`` adds ``rank_a`` and ``rank_b``, for which the edges of each body are put
    in order once more; leave them out where only ``rank`` is used. ``mask_b_from_a`` tests
    the tissue class of the A end twice instead of both ends.
    """
    resolutions = list(resolutions)
    # A contact without both scores ranks below all others and is rejected in the end.
    scored = {Resolution(r): with_both_scores(tables.rsg[Resolution(r)]) for r in resolutions}
    edges = union_resolutions(scored, resolutions, Coordinates.INTEGER)
    edges = deal_rows(edges, skew.supervoxels or skew.ends)
    candidates = inter_body_candidates(tables, edges, ScoreFn.PESSIMISTIC, skew.supervoxels)
    ranks = ["ranked_body", "rank"]
    if with_side_ranks:
        # The join that follows needs this shuffle of the few picked edges, or else broadcasts and
        # would leave the sampling of the final sort to put all edges in order again.
        best = top_n_with_side_ranks(candidates, n, skew.ends).repartition("sv_a")
        ranks += ["rank_a", "rank_b"]
    else:
        best = top_n_per_body(candidates.drop(DEAL), n)
    result = _checked(tables, best, criteria, mask_b_from_a, skew)
    return ordered(
        result.select("res", *ranks, *EDGE_COLUMNS),
        by_body_tbars() if order_by == () else order_by,
    )


def best_edges_one_res(
    tables: TableSet,
    res: Resolution | int = Resolution.NM32,
    n: int = 1,
    criteria: EdgeCriteria = REVIEW_CRITERIA,
    mask_b_from_a: bool = False,
    drop_ranked_body: bool = False,
    order_by: str | Order | None = (),
    skew: SkewProfile = SkewProfile(),
) -> DataFrame:
    """The best edge of each body at one resolution, by the higher score.

    An edge that is best for both of its bodies is returned for each; ``ranked_body``
    tells them apart unless ``drop_ranked_body``.
    """
    edges = flatten_edges(with_both_scores(tables.rsg[Resolution(res)]), res)
    edges = deal_rows(edges, skew.supervoxels)
    candidates = inter_body_candidates(tables, edges, ScoreFn.OPTIMISTIC, skew.supervoxels)
    best = top_n_per_body(candidates.drop(DEAL), n)
    result = _checked(tables, best, criteria, mask_b_from_a, skew)
    shown = EDGE_COLUMNS if drop_ranked_body else ("ranked_body", *EDGE_COLUMNS)
    return ordered(result.select(*shown), by_body_tbars() if order_by == () else order_by)
