"""Storing the supervoxel dimension, so that repeated queries need fewer shuffles.

A stored dimension spares each query the seven lookups per supervoxel. Bucketed by
supervoxel it also joins the edges without being shuffled itself; its keys are unique, so
the buckets are even. Edges are not bucketed: the bucket of a hot label would hold all of
its rows and be read by one task.
"""

from __future__ import annotations

import dataclasses

from edgelens.operators.dimensions import sv_dimension
from edgelens.operators.skew import HotKeys
from edgelens.sources import TableSet
from edgelens.sources.tables import mark_unique_keys


def store_dimension(
    tables: TableSet,
    name: str,
    buckets: int,
    hot_bodies: HotKeys = HotKeys(),
    overwrite: bool = False,
) -> TableSet:
    """Save the supervoxel dimension as a catalog table of so many buckets, and bind it.

    As many buckets as there are shuffle partitions fit the shuffles of the edges. Keys are
    checked here, once: a lookup table that repeats one is named in the error. The table is
    marked as checked after it is complete, so queries over it need no check of their own.
    """
    tables.check_keys()
    dimension = sv_dimension(dataclasses.replace(tables, dimension=None), hot_bodies)
    # One task per bucket, so that each bucket is one sorted file.
    placed = dimension.repartition(buckets, "sv")
    writer = placed.write.format("parquet").mode("overwrite" if overwrite else "errorifexists")
    writer.bucketBy(buckets, "sv").sortBy("sv").saveAsTable(name)
    mark_unique_keys(tables.spark, name)
    return dataclasses.replace(tables, dimension=tables.spark.table(name))
