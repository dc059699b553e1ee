"""Whether what is known about supervoxels is small enough to be sent to every task.

Spark multiplies sizes over joins, so it takes even a tiny supervoxel dimension for a large table;
where the edges are few, it would then broadcast those. The check here is Spark's own, against the
session's threshold, on the stored tables that a dimension is made of. A dimension has a row per
supervoxel and less columns than those tables together, so it is no larger. Beyond the threshold
there is no such hint, and the joins shuffle. What a dimension is made of is never broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgelens.sources import TableSet

# The tables that a supervoxel dimension is made of.
NODE_TABLES = (
    "objinfo",
    "mask",
    "sv_tbars",
    "agglo",
    "body_sizes",
    "body_tbars",
    "separate",
    "isolated",
)


def size_in_bytes(df: DataFrame) -> int:
    """Spark's estimate, for a stored table the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(tables: TableSet, *names: str) -> bool:
    """Whether the stored dimension, or else these tables together, are below the threshold."""
    threshold = tables.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if tables.dimension is not None:
        return size_in_bytes(tables.dimension) <= threshold
    return sum(size_in_bytes(getattr(tables, name)) for name in names) <= threshold


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is sorted on both sides and never broadcast.

    Spark goes by the size of the stored files, a few bytes a row. In memory a node table is many
    times that, and a query joins a dozen of them, all of which would pass through the driver.
    """
    return df.hint("merge")


def sent_if_small(dimension: DataFrame, tables: TableSet, *names: str) -> DataFrame:
    """``dimension``, made of these tables, with a hint to broadcast it if they are small."""
    return F.broadcast(dimension) if fits_broadcast(tables, *names) else dimension
