"""What is known about a given list of supervoxel pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgelens.functions import Resolution, ScoreFn
from edgelens.operators.dimensions import enrich_edges, keyed_once, looked_up_in
from edgelens.operators.edges import COORDINATE_FIELDS, Coordinates, flatten_edges, with_score
from edgelens.operators.ordering import Order, by_ends_and_score, ordered
from edgelens.operators.pairs import best_contact_of_wanted, once_per_request
from edgelens.operators.skew import DEAL, HotKeys
from edgelens.parameters import NEUROPIL
from edgelens.sources import TableSet
from edgelens.sources.schema import PAIR_LIST, RSG, conform, quoted


# A stored contact, carried through the choice of the best one.
_STORED = "_stored"

# Fixed value: both supervoxels must have more voxels than this.
MORE_VOXELS_THAN = 1_000_000


def _ends(tables: TableSet, more_voxels_than: int) -> DataFrame:
    """Body, size and class of the neuropil supervoxels above a size: from the stored
    dimension if there is one, else from one scan of each table."""
    if tables.dimension is not None:
        known = tables.dimension.selectExpr("sv", "body", "sv_size AS sv_voxels", "sv_mask AS max_mask")
    else:
        sizes = tables.objinfo.selectExpr("id AS sv", "num_voxels AS sv_voxels")
        classes = tables.mask.selectExpr("obj_id AS sv", "max_mask")
        mapped = tables.agglo.selectExpr("id_a AS sv", "id_b")
        known = (
            sizes.join(classes, "sv")
            .join(mapped, "sv", "left")
            .selectExpr("sv", "coalesce(id_b, sv) AS body", "sv_voxels", "max_mask")
        )
    wanted = known.where(f"sv_voxels > {more_voxels_than} AND max_mask = {NEUROPIL}")
    return wanted if tables.dimension is not None else keyed_once(wanted)


# Columns of the result besides those of the contact.
_BEFORE = ("sv_a", "sv_b")
_AFTER = (
    "score",
    "rownum",
    "body_a",
    "body_b",
    "sv_voxels_a",
    "sv_voxels_b",
    "max_mask_a",
    "max_mask_b",
)


def _contact_columns(edges: DataFrame, all_columns: bool) -> list[str]:
    """The stored columns of a contact as expressions, nested ones as they are stored.

    A stored column that has the name of a result column is called ``stored_<name>``.
    """
    taken = {*_BEFORE, *_AFTER, "n_requests", "_chunk"}
    names = edges.columns if all_columns else RSG.names
    shown = [f"stored_{name}" if name in taken else name for name in names]
    if len(set(shown)) < len(shown):
        raise ValueError(f"edge columns clash: {sorted(n for n in set(shown) if shown.count(n) > 1)}")
    return [f"{_STORED}.{quoted(n)} AS {quoted(s)}" for n, s in zip(names, shown)]


def extract_pairs(
    tables: TableSet,
    pair_list: DataFrame,
    res: Resolution | int = Resolution.NM16,
    more_voxels_than: int = MORE_VOXELS_THAN,
    keep_structs: bool = False,
    all_columns: bool = False,
    order_by: str | Order | None = (),
    hot: HotKeys = HotKeys(),
    n_listed: int | None = None,
) -> DataFrame:
    """The best contact of each listed pair, in either orientation, between neuropil
    supervoxels above a size.

    Coordinates stay as stored. ``keep_structs`` returns the contact nested, as in the edge table,
    and ``all_columns`` every column that the edge table has, known or not; values are those
    stored, NaN included. ``n_listed`` is the length of the list, if known.
    """
    pair_list = conform(pair_list, PAIR_LIST, "pair_list")
    rsg = tables.rsg[Resolution(res)]
    nested = keep_structs or all_columns
    carried = [f"struct({', '.join(map(quoted, rsg.columns))}) AS {_STORED}"] if nested else []
    edges = flatten_edges(rsg, res, Coordinates.STORED, *carried)
    matched = best_contact_of_wanted(with_score(edges, ScoreFn.OPTIMISTIC), pair_list, n_listed)
    if hot:
        # Rows of a hot label differ in the other label or the chunk: that deals them out.
        matched = matched.withColumn(DEAL, F.xxhash64("sv_a", "sv_b", "_chunk"))
    ends = looked_up_in(_ends(tables, more_voxels_than), tables, hot, "objinfo", "mask", "agglo")
    known = enrich_edges(matched, ends, hot)
    if nested:
        contact = _contact_columns(rsg, all_columns)
    else:
        contact = ["sv_a AS label_a", "sv_b AS label_b", "score_ab", "score_ba", *COORDINATE_FIELDS]
    result = known.selectExpr(*_BEFORE, *contact, *_AFTER, "n_requests", "_chunk")
    order = by_ends_and_score() if order_by == () else order_by
    if order:
        # With the chunk last, a range of the sort may end among the requests for one pair.
        order = f"{order}, _chunk" if isinstance(order, str) else [*order, "_chunk"]
    return once_per_request(ordered(result, order))
