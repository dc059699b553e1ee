"""Joins in which one key may hold a large part of all rows.

A supervoxel that touches everything, or a body that owns a third of all supervoxels,
would send its rows to one task. Such keys are found up front, their rows are dealt out
over several parts, and the matching lookup row is repeated once per part. Nothing is
dropped or sampled: the parts together are the whole key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys that the frequent-items summary can track at most.
MAX_TRACKED = 1_000_000

# Position of a row in its scan, added before any shuffle: it deals the rows of a hot key
# out evenly, also when they are copies of each other, and is the same when a task reruns.
DEAL = "_deal"


@dataclass(frozen=True)
class HotKeys:
    """Keys too frequent for one task, each with the number of parts it is split into."""

    parts: Mapping[int, int] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.parts)

    def table(self, df: DataFrame) -> DataFrame:
        """As a table for a broadcast; its size is bounded, see ``find_hot_keys``."""
        rows = [(int(key), int(n)) for key, n in self.parts.items()]
        return df.sparkSession.createDataFrame(rows, "_hot_key long, _parts long")


def find_hot_keys(df: DataFrame, *columns: str, tasks: int | None = None) -> HotKeys:
    """Keys that hold more rows of some column than two of ``tasks`` equal tasks would get.

    One pass over the key columns with a mergeable frequent-items summary. Fewer than half
    as many keys as ``tasks`` can hold that share of a column, which bounds both what comes
    back here and what the joins broadcast. The summary may err on a count: that changes
    how many parts a key gets, never the result.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = tasks // 2 + 1
    tracked = max(10_000, 16 * kept)
    if tracked > MAX_TRACKED:
        raise ValueError(f"{tasks} tasks need more tracked keys than Spark allows: pass fewer tasks")
    found = df.agg(
        F.count("*").alias("n"),
        *(F.expr(f"approx_top_k({c}, {kept}, {tracked})").alias(c) for c in columns),
    ).first()
    parts: dict[int, int] = {}
    for column in columns:
        for entry in found[column] or []:
            share = entry["count"] / found["n"]
            if entry["item"] is not None and share * tasks > 2:
                n = math.ceil(share * tasks)
                parts[entry["item"]] = max(n, parts.get(entry["item"], 1))
    return HotKeys(parts)


def deal_rows(df: DataFrame, wanted: HotKeys | bool) -> DataFrame:
    """Number the rows of a scan, if ``wanted``, so that later steps can split hot groups."""
    return df.withColumn(DEAL, F.monotonically_increasing_id()) if wanted else df


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot: HotKeys,
    how: str = "inner",
) -> DataFrame:
    """Join ``left`` on ``key`` to a lookup table that holds each ``_key`` once.

    With hot keys, ``left`` must have been through ``deal_rows``.
    """
    match = F.col(key) == F.col("_key")
    if hot:
        parts = F.broadcast(hot.table(left))
        left = (
            left.join(parts, F.col(key) == F.col("_hot_key"), "left")
            .withColumn("_part", F.coalesce(F.pmod(DEAL, "_parts"), F.lit(0)))
            .drop("_hot_key", "_parts")
        )
        every_part = F.expr("explode(sequence(0L, coalesce(_parts, 1L) - 1L))")
        right = (
            right.join(parts, F.col("_key") == F.col("_hot_key"), "left")
            .withColumn("_key_part", every_part)
            .drop("_hot_key", "_parts")
        )
        match = match & (F.col("_part") == F.col("_key_part"))
    joined = left.join(right, match, how)
    return joined.drop("_key", "_part", "_key_part") if hot else joined.drop("_key")
