"""Best contact per pair, best edges per body, and exact positions in large orders.

Scores repeat often, so every order ends in a total tie-break: the same input gives the
same result, however it is partitioned. Rows equal in all of these columns are copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgelens.operators.skew import DEAL, HotKeys
from edgelens.operators.storage import freeze

TIE_BREAK = (
    "sv_a",
    "sv_b",
    "res",
    "xa",
    "ya",
    "za",
    "xb",
    "yb",
    "zb",
    "x_nearby",
    "y_nearby",
    "z_nearby",
    "score_ab",
    "score_ba",
)


def best_first(edges: DataFrame) -> list[Column | str]:
    """Highest score first, missing scores last, then the tie-break."""
    present = set(edges.columns)
    return [F.desc_nulls_last("score"), *(c for c in TIE_BREAK if c in present)]


def _numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str
) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window).cast("long"))


def best_contact_per_pair(edges: DataFrame) -> DataFrame:
    """The best contact of each ordered supervoxel pair, with ``rownum`` (always 1).

    Of edges tagged with ``res``, the best of each pair and resolution. Spark cuts each task to
    one row per pair before the shuffle.
    """
    pair = [c for c in ("sv_a", "sv_b", "res") if c in edges.columns]
    window = Window.partitionBy(*pair).orderBy(*best_first(edges))
    best = edges.withColumn("rownum", F.row_number().over(window)).where("rownum = 1")
    return best.withColumn("rownum", F.col("rownum").cast("long"))


def top_n_per_body(edges: DataFrame, n: int) -> DataFrame:
    """The ``n`` best edges of each body, whichever end the body is at.

    An edge counts for both of its bodies and may be returned once for each, with
    ``ranked_body`` and ``rank`` telling which. Ranking the two ends together in one
    window gives the same edges as ranking each side, cutting, and ranking again; Spark
    cuts each task to ``n`` rows per body before the only shuffle.
    """
    ends = edges.withColumn("ranked_body", F.explode(F.array("body_a", "body_b")))
    window = Window.partitionBy("ranked_body").orderBy(*best_first(edges))
    best = ends.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)
    return best.withColumn("rank", F.col("rank").cast("long"))


def side_ranks(edges: DataFrame) -> DataFrame:
    """Add ``rank_a`` and ``rank_b``: the rank of each edge among all edges with the same
    ``body_a``, and among all edges with the same ``body_b``."""
    order = best_first(edges)
    for side in ("a", "b"):
        edges = rank_within(edges, f"body_{side}", order, f"rank_{side}")
    return edges


def top_n_with_side_ranks(edges: DataFrame, n: int, hot: HotKeys = HotKeys()) -> DataFrame:
    """``top_n_per_body`` with ``rank_a`` and ``rank_b``, as ``side_ranks`` has them.

    Every edge ahead of a picked one at the body it was picked for is picked as well, so its rank
    on that side is a running count among the picked. Only its rank at the other body counts all
    edges: the picked edges are dealt among the edges of that body, in order, and each takes the
    number of edges before it. They bring their columns along, so that nothing is joined back.

    ``hot`` are bodies at the ends of too many edges for one task; ``edges`` then have been
    through ``deal_rows``. Their edges are dealt over parts whatever their scores are, each part
    counts for all picked edges, and the counts are added up.
    """
    keys = [c for c in TIE_BREAK if c in edges.columns]
    order = best_first(edges)
    columns = [c for c in edges.columns if c != DEAL]
    ends = F.array(*(F.struct(F.col(f"body_{s}").alias("_body"), F.lit(s).alias("_side")) for s in ("a", "b")))

    picked = edges.select(*columns, F.explode(ends).alias("_end")).select(
        *columns, F.col("_end._body").alias("ranked_body"), F.col("_end._side").alias("_own_side")
    )
    at_body = Window.partitionBy("ranked_body").orderBy(*order, "_own_side")
    upto = at_body.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = picked.withColumns(
        {
            "rank": F.row_number().over(at_body).cast("long"),
            # copies of one edge follow on each other
            "_copy": F.row_number().over(at_body) - F.rank().over(at_body),
            "_own_a": F.sum(F.expr("if(_own_side = 'a', 1L, 0L)")).over(upto),
            "_own_b": F.sum(F.expr("if(_own_side = 'b', 1L, 0L)")).over(upto),
        }
    ).where(F.col("rank") <= n)
    is_a = F.col("_own_side") == "a"
    asked = picked.withColumns(
        {
            "_body": F.when(is_a, F.col("body_b")).otherwise(F.col("body_a")),
            "_side": F.when(is_a, "b").otherwise("a"),
            "_own": F.when(is_a, F.col("_own_a")).otherwise(F.col("_own_b")),
            "_edge": F.lit(0),
        }
    ).drop("_own_a", "_own_b")

    dealt = [DEAL] if hot else []
    rows = edges.select("score", *keys, *dealt, F.explode(ends).alias("_end"))
    rows = rows.select("score", *keys, *dealt, "_end._body", "_end._side", F.lit(1).alias("_edge"))
    group = ["_body", "_side"]
    if hot:
        parts = F.broadcast(hot.table(edges))
        rows = (
            rows.join(parts, F.col("_body") == F.col("_hot_key"), "left")
            .withColumn("_part", F.coalesce(F.pmod(DEAL, "_parts"), F.lit(0)))
            .drop("_hot_key", "_parts", DEAL)
        )
        asked = (
            asked.join(parts, F.col("_body") == F.col("_hot_key"), "left")
            .withColumn("_part", F.explode(F.expr("sequence(0L, coalesce(_parts, 1L) - 1L)")))
            .drop("_hot_key", "_parts")
        )
        group = [*group, "_part"]
    among = Window.partitionBy(*group).orderBy(*order, "_edge")
    before = F.sum("_edge").over(among.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = asked.unionByName(rows, allowMissingColumns=True).withColumn("_before", before).where("_edge = 0")
    if hot:  # each part has counted for each picked edge, which its body and rank there tell apart
        kept = [c for c in counted.columns if c not in ("_before", "_part")]
        counted = (
            counted.groupBy(F.col("ranked_body").alias("_at"), F.col("rank").alias("_rank"))
            .agg(F.first(F.struct(*kept)).alias("_row"), F.sum("_before").alias("_before"))
            .select("_row.*", "_before")
        )
    other = F.col("_before") + 1 + F.col("_copy")
    is_a = F.col("_own_side") == "a"
    return counted.select(
        *columns,
        "ranked_body",
        "rank",
        F.when(is_a, F.col("_own")).otherwise(other).cast("long").alias("rank_a"),
        F.when(is_a, other).otherwise(F.col("_own")).cast("long").alias("rank_b"),
    )


def rank_within(
    df: DataFrame,
    group: str,
    order: Sequence[Column | str],
    name: str,
) -> DataFrame:
    """Exact rank of every row within its group, for groups of any size.

    A window would sort a whole group in one task. The rows are range-partitioned on group
    *and* order instead, so a large group spans several slices. A row's rank is its rank
    within the slice plus the rows of its group in earlier slices. At most one group per slice
    began in an earlier one, so that correction has no more rows than there are slices and is
    safe to broadcast.

    Where one group may hold very many copies, number the rows with ``deal_rows`` at the
    scan, so that a slice can end among them.
    """
    copies = [DEAL] if DEAL in df.columns else []
    ranged = df.repartitionByRange(group, *order, *copies)
    sliced = freeze(ranged.withColumn("_slice", F.spark_partition_id()))

    sizes = sliced.groupBy(group, "_slice").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sizes.withColumn("_before", F.sum("_n").over(earlier))
        .where(F.col("_before").isNotNull())
        .select(F.col(group).alias("_group"), F.col("_slice").alias("_at"), "_before")
    )
    local = _numbered(sliced, ["_slice", group], order, name)
    return (
        local.join(
            F.broadcast(carried),
            local[group].eqNullSafe(F.col("_group")) & (local["_slice"] == F.col("_at")),
            "left",
        )
        .withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0)))
        .drop("_group", "_at", "_before", "_slice")
    )


def with_position(
    df: DataFrame, order: Sequence[Column | str], name: str = "position"
) -> DataFrame:
    """Add the 1-based position of every row in a global order, without one task seeing
    all rows: sort in ranges, number each range, and shift it by the sizes before it."""
    # The identifier holds the range in its upper bits and the row within it in the lower 33.
    ordered = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    stored = freeze(ordered)
    in_range, at = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(in_range.alias("_range")).agg(F.count("*").alias("_n"))
    # One row per range: few enough for a window without partitions, and for a broadcast.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    return (
        stored.join(F.broadcast(shifts), in_range == F.col("_range"))
        .withColumn(name, F.col("_shift") + at + 1)
        .drop("_id", "_range", "_shift")
    )
