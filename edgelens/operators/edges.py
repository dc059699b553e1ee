"""Edges: flat columns, bodies of the two ends, and which edges to look at."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from enum import Enum
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgelens.functions import (
    Resolution,
    ScoreFn,
    nan_to_null,
    scale_to_float,
    scale_to_integer,
)
from edgelens.operators.skew import HotKeys, lookup
from edgelens.parameters import EdgeType

# Where each flat column lies in a stored edge.
SCORE_FIELDS = {
    "score_ab": "eval.from_a.segment_b_consistency",
    "score_ba": "eval.from_b.segment_a_consistency",
}
COORDINATE_FIELDS = {
    "xa": "eval.from_a.origin.x",
    "ya": "eval.from_a.origin.y",
    "za": "eval.from_a.origin.z",
    "xb": "eval.from_b.origin.x",
    "yb": "eval.from_b.origin.y",
    "zb": "eval.from_b.origin.z",
    "x_nearby": "point.x",
    "y_nearby": "point.y",
    "z_nearby": "point.z",
}


class Coordinates(Enum):
    """Form of the coordinates of a flat edge."""

    FLOAT = "full resolution, double"
    INTEGER = "full resolution, bigint"
    STORED = "as stored, on the grid of the edge table"

    def of(self, coordinate: str, res: Resolution | int) -> str:
        if self is Coordinates.FLOAT:
            return scale_to_float(coordinate, res)
        if self is Coordinates.INTEGER:
            return scale_to_integer(coordinate, res)
        return coordinate


def flatten_edges(
    rsg: DataFrame,
    res: Resolution | int,
    coordinates: Coordinates = Coordinates.FLOAT,
    *more: str,
) -> DataFrame:
    """One flat row per stored contact; ``more`` are further expressions to select."""
    return rsg.selectExpr(
        "label_a AS sv_a",
        "label_b AS sv_b",
        *(f"{nan_to_null(f'double({field})')} AS {c}" for c, field in SCORE_FIELDS.items()),
        *(f"{coordinates.of(field, res)} AS {c}" for c, field in COORDINATE_FIELDS.items()),
        *more,
    )


def union_resolutions(
    rsg: Mapping[Resolution, DataFrame],
    resolutions: Iterable[Resolution | int] = tuple(Resolution),
    coordinates: Coordinates = Coordinates.INTEGER,
) -> DataFrame:
    """The edges of several resolutions as one set, tagged with ``res``.

    A pair may occur at more than one resolution; every contact is kept. Edge tables are added up
    in the given order.
    """
    per_resolution = (
        flatten_edges(rsg[Resolution(r)], r, coordinates, f"{int(r)} AS res") for r in resolutions
    )
    return reduce(DataFrame.unionAll, per_resolution)


def with_score(edges: DataFrame, score_fn: ScoreFn) -> DataFrame:
    return edges.selectExpr("*", f"{score_fn.of('score_ab', 'score_ba')} AS score")


def with_both_scores(rsg: DataFrame) -> DataFrame:
    """Stored contacts scored in both directions; the test reaches the file scan."""
    return rsg.where(" AND ".join(f"{field} IS NOT NULL" for field in SCORE_FIELDS.values()))


_NO_SELF_EDGE = "sv_a <> sv_b"
EDGE_TYPE_CONDITION = {
    EdgeType.INTER_BODY: "body_a <> body_b",
    EdgeType.INTRA_BODY: f"body_a = body_b AND {_NO_SELF_EDGE}",
}


def drop_self_edges(edges: DataFrame) -> DataFrame:
    return edges.where(_NO_SELF_EDGE)


def edges_inter(edges: DataFrame) -> DataFrame:
    """Edges between different bodies."""
    return edges.where(EDGE_TYPE_CONDITION[EdgeType.INTER_BODY])


def edges_intra(edges: DataFrame) -> DataFrame:
    """Edges between different supervoxels of one body."""
    return edges.where(EDGE_TYPE_CONDITION[EdgeType.INTRA_BODY])


def map_bodies(edges: DataFrame, agglo: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """Add ``body_a`` and ``body_b``; a supervoxel that is not mapped is its own body."""
    for side in ("a", "b"):
        mapped = agglo.selectExpr("id_a AS _key", "id_b AS _body")
        edges = (
            lookup(edges, mapped, f"sv_{side}", hot, "left")
            .withColumn(f"body_{side}", F.coalesce("_body", f"sv_{side}"))
            .drop("_body")
        )
    return edges


def valid_edges(edges: DataFrame, objinfo: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """Keep edges whose two supervoxels both exist."""
    known = objinfo.selectExpr("id AS _key")
    for side in ("a", "b"):
        edges = lookup(edges, known, f"sv_{side}", hot, "left_semi")
    return edges


def valid_edges_with_bodies(
    edges: DataFrame, bodies: DataFrame, hot: HotKeys = HotKeys()
) -> DataFrame:
    """``valid_edges`` and ``map_bodies`` in one join per side.

    ``bodies`` holds ``sv`` and ``body`` for each supervoxel that exists.
    """
    for side in ("a", "b"):
        end = bodies.selectExpr("sv AS _key", f"body AS body_{side}")
        edges = lookup(edges, end, f"sv_{side}", hot)
    return edges
