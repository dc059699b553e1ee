"""Hot supervoxels and bodies of a dataset, measured once and shared by its queries."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from edgelens.functions import Resolution
from edgelens.operators.edges import map_bodies
from edgelens.operators.skew import HotKeys, deal_rows, find_hot_keys
from edgelens.sources import TableSet


@dataclass(frozen=True)
class SkewProfile:
    """``SkewProfile()`` says that no key is hot.

    ``supervoxels`` are at the end of many edges, ``bodies`` own many supervoxels, and ``ends``
    are bodies at the end of many edges, through one supervoxel or many.
    """

    supervoxels: HotKeys = HotKeys()
    bodies: HotKeys = HotKeys()
    ends: HotKeys = HotKeys()


def measure_skew(
    tables: TableSet,
    resolutions: Iterable[Resolution | int] = tuple(Resolution),
    tasks: int | None = None,
    with_ends: bool = False,
) -> SkewProfile:
    """One pass over the label columns of the edges, and one over the body map unless the
    dimension is stored.

    No query does this by itself: pass the result to those that should split hot keys.
    ``tasks`` is the number of equal tasks that a hot key is compared with. ``with_ends`` looks
    up the bodies of all labels as well, which side ranks are counted by.
    """
    labels = reduce(
        DataFrame.unionAll,
        (tables.rsg[Resolution(r)].select("label_a", "label_b") for r in resolutions),
    )
    supervoxels = find_hot_keys(labels, "label_a", "label_b", tasks=tasks)
    bodies = ends = HotKeys()
    if tables.dimension is None:
        bodies = find_hot_keys(tables.agglo, "id_b", tasks=tasks)
    if with_ends:
        edges = labels.selectExpr("label_a AS sv_a", "label_b AS sv_b")
        mapped = map_bodies(deal_rows(edges, supervoxels), tables.agglo, supervoxels)
        ends = find_hot_keys(mapped, "body_a", "body_b", tasks=tasks)
    return SkewProfile(supervoxels, bodies, ends)


_SKEW = "kind string, key long, parts int"


def store_skew(spark: SparkSession, profile: SkewProfile, name: str, overwrite: bool = False) -> None:
    """Save a profile as a catalog table, a row per hot key."""
    rows = [
        (field.name, key, parts)
        for field in dataclasses.fields(profile)
        for key, parts in getattr(profile, field.name).parts.items()
    ]
    stored = spark.createDataFrame(rows, _SKEW).coalesce(1)
    stored.write.mode("overwrite" if overwrite else "errorifexists").saveAsTable(name)


def load_skew(spark: SparkSession, name: str) -> SkewProfile:
    """A stored profile; its size is bounded, see ``find_hot_keys``."""
    parts: dict[str, dict[int, int]] = {field.name: {} for field in dataclasses.fields(SkewProfile)}
    for row in spark.table(name).collect():
        parts[row.kind][row.key] = row.parts
    return SkewProfile(**{kind: HotKeys(found) for kind, found in parts.items()})
