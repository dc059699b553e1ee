"""What is known about a supervoxel and its body, gathered into one row per supervoxel.

An edge needs seven lookups at each end. Gathering them per supervoxel first leaves two
joins for the edge table, which is the large one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgelens.functions import box_end
from edgelens.operators.sizes import NODE_TABLES, by_shuffle, sent_if_small
from edgelens.operators.skew import DEAL, HotKeys, lookup
from edgelens.sources import TableSet

_AXES = ("x", "y", "z")
BODY_BOX = tuple(f"body_box_{axis}{corner}" for corner in (0, 1) for axis in _AXES)
SV_BOX = tuple(f"sv_box_{axis}{corner}" for corner in (0, 1) for axis in _AXES)

# Attributes that ``enrich_edges`` adds for each end of an edge.
ATTRIBUTES = (
    "sv_mask",
    "body_tbars",
    "sv_tbars",
    "body_size",
    *BODY_BOX,
    "sv_size",
    *SV_BOX,
)


def keyed_once(dimension: DataFrame) -> DataFrame:
    """``dimension`` with a check in the plan that no ``sv`` is there twice.

    A key repeated in any lookup table repeats a supervoxel here and would multiply edges. The
    check numbers the rows of each supervoxel: that needs them hashed and sorted by it, as the
    join to the edges does anyway, and gathers no column. Put it after filters, so that these
    reach the scans. ``TableSet.check_keys`` names the table. A stored dimension was checked when
    it was stored and needs none.
    """
    times = F.row_number().over(Window.partitionBy("sv").orderBy("sv"))
    message = F.concat(F.lit("a lookup table repeats a key, see check_keys; supervoxel "), "sv")
    once = F.when(F.col("_times") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    return dimension.withColumn("_times", times).where(once).drop("_times")


def sv_boxes(objinfo: DataFrame) -> DataFrame:
    """Size and box corners per supervoxel."""
    starts = {axis: f"bbox.start.{axis}" for axis in _AXES}
    ends = {axis: box_end(starts[axis], f"bbox.size.{axis}") for axis in _AXES}
    return objinfo.selectExpr(
        "id AS sv",
        "num_voxels AS sv_size",
        *(f"{start} AS sv_box_{axis}0" for axis, start in starts.items()),
        *(f"{end} AS sv_box_{axis}1" for axis, end in ends.items()),
    )


def sv_bodies(tables: TableSet) -> DataFrame:
    """Body of each supervoxel that exists, each of them once."""
    if tables.dimension is not None:
        return tables.dimension.select("sv", "body")
    mapped = tables.agglo.selectExpr("id_a AS id", "id_b")
    bodies = tables.objinfo.select("id").join(by_shuffle(mapped), "id", "left")
    return keyed_once(bodies.selectExpr("id AS sv", "coalesce(id_b, id) AS body"))


def body_boxes(body_sizes: DataFrame) -> DataFrame:
    """Size and box corners per body."""
    return body_sizes.selectExpr(
        "body", "body_size", *(f"{name.removeprefix('body_')} AS {name}" for name in BODY_BOX)
    )


def body_dimension(tables: TableSet) -> DataFrame:
    """Size, box, tbars and exclusion flag of every body that some table knows."""
    sizes = body_boxes(tables.body_sizes)
    tbars = tables.body_tbars.selectExpr("body", "tbar_count AS body_tbars")
    # The exclusion set is kept per supervoxel, so a body may be listed many times.
    separate = tables.separate.distinct().selectExpr("body", "true AS listed")
    known = sizes.join(by_shuffle(tbars), "body", "full").join(by_shuffle(separate), "body", "full")
    return known.selectExpr(
        "body", "body_size", *BODY_BOX, "body_tbars", "listed IS NOT NULL AS is_separate"
    )


def sv_dimension(tables: TableSet, hot_bodies: HotKeys = HotKeys()) -> DataFrame:
    """Every attribute of each supervoxel that exists, its body's included."""
    if tables.dimension is not None:
        return tables.dimension
    mask = tables.mask.selectExpr("obj_id AS sv", "max_mask AS sv_mask")
    tbars = tables.sv_tbars.selectExpr("sv", "tbar_count AS sv_tbars")
    mapped = tables.agglo.selectExpr("id_a AS sv", "id_b")
    isolated = tables.isolated.distinct().selectExpr("sv", "true AS listed")
    # All on the supervoxel: one shuffle per table, none between the joins.
    supervoxels = (
        sv_boxes(tables.objinfo)
        .join(by_shuffle(mask), "sv", "left")
        .join(by_shuffle(tbars), "sv", "left")
        .join(by_shuffle(mapped), "sv", "left")
        .join(by_shuffle(isolated), "sv", "left")
        .selectExpr("*", "coalesce(id_b, sv) AS body", "listed IS NOT NULL AS is_isolated")
    )
    if hot_bodies:  # each supervoxel is there once: its hash deals a hot body's rows out
        supervoxels = supervoxels.withColumn(DEAL, F.xxhash64("sv"))
    bodies = body_dimension(tables).withColumnRenamed("body", "_key")
    joined = lookup(supervoxels, by_shuffle(bodies), "body", hot_bodies, "left")
    separate = "coalesce(is_separate, false) AS is_separate"
    return joined.selectExpr("sv", "body", *ATTRIBUTES, "is_isolated", separate)


def sv_ends(tables: TableSet, hot_bodies: HotKeys = HotKeys(), where: str = "true") -> DataFrame:
    """``sv_dimension`` of the supervoxels that meet a condition, each of them once."""
    ends = sv_dimension(tables, hot_bodies).where(where)
    return ends if tables.dimension is not None else keyed_once(ends)


def looked_up_in(dimension: DataFrame, tables: TableSet, hot: HotKeys, *names: str) -> DataFrame:
    """``dimension`` as the side of a join that may be broadcast; not where its rows are repeated
    for the parts of hot keys."""
    return dimension if hot else sent_if_small(dimension, tables, *(names or NODE_TABLES))


def boxes_within_bodies(
    edges: DataFrame,
    tables: TableSet,
    hot: HotKeys = HotKeys(),
    hot_bodies: HotKeys = HotKeys(),
) -> DataFrame:
    """Add the boxes to edges that lie inside a body: those of both supervoxels, and the body's.

    Only two tables are read for them, or the stored dimension: the edges have shown already that
    both tables know each end once.
    """
    if tables.dimension is not None:
        return enrich_edges(edges, tables.dimension.select("sv", *SV_BOX, *BODY_BOX), hot)
    edges = enrich_edges(edges, by_shuffle(sv_boxes(tables.objinfo).select("sv", *SV_BOX)), hot)
    if hot_bodies:
        edges = edges.withColumn(DEAL, F.xxhash64("sv_a", "sv_b"))
    bodies = body_boxes(tables.body_sizes).drop("body_size").withColumnRenamed("body", "_key")
    found = lookup(edges, by_shuffle(bodies), "body_a", hot_bodies)
    both = (F.col(name).alias(f"{name}_{side}") for side in ("a", "b") for name in BODY_BOX)
    return found.select(*edges.columns, *both)


def enrich_edges(edges: DataFrame, dimension: DataFrame, hot: HotKeys = HotKeys()) -> DataFrame:
    """Add every column of a supervoxel dimension for both ends, suffixed ``_a`` and ``_b``.

    An inner join: edges with an end the dimension does not hold are dropped. Columns that
    the edges already have, such as the bodies, are not added again.
    """
    present = set(edges.columns)
    for side in ("a", "b"):
        new = [c for c in dimension.columns if c != "sv" and f"{c}_{side}" not in present]
        end = dimension.selectExpr("sv AS _key", *(f"{c} AS {c}_{side}" for c in new))
        edges = lookup(edges, end, f"sv_{side}", hot)
    return edges
