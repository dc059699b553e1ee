"""The same criteria over several resolutions, one output each, that can be taken up again."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from edgelens.functions import Resolution
from edgelens.operators.ordering import Order
from edgelens.parameters import EdgeCriteria
from edgelens.plans.edge_query import edge_query
from edgelens.plans.skew_profile import SkewProfile
from edgelens.sources import TableSet
from edgelens.sources.export import (
    Run,
    current_run,
    input_digest,
    input_identity,
    write_results,
)


@dataclass(frozen=True)
class Output:
    """The output of one resolution; ``skipped`` if an earlier batch had completed it."""

    folder: str
    run: Run
    skipped: bool


def output_folder(folder: str, res: Resolution | int) -> str:
    return f"{folder.rstrip('/')}/rsg{int(res)}"


def export_batch(
    tables: TableSet,
    folder: str,
    criteria: EdgeCriteria = EdgeCriteria(),
    resolutions: Iterable[Resolution | int] = tuple(reversed(Resolution)),
    order_by: str | Order | None = None,
    format: str = "parquet",
    overwrite: bool = False,
    skew: SkewProfile = SkewProfile(),
    parameters: Mapping[str, Any] | None = None,
) -> dict[Resolution, Output]:
    """Write ``edge_query`` at each resolution to a folder of its own, ``<folder>/rsg<res>``.

    Each is committed by itself as soon as it is complete. Called again after a failure, the batch
    skips what is there of the same parameters and input files, and runs the rest; without
    ``overwrite`` it refuses an output of others, before anything is run. ``parameters`` are
    recorded beside the criteria; an order given as columns is not text and has to be named there.
    """
    spark = tables.spark
    wanted = {}
    for res in map(Resolution, resolutions):
        told = {**criteria.as_parameters(), "res": int(res), "format": format, **(parameters or {})}
        told["order_by"] = order_by if isinstance(order_by, str) else told.get("order_by", "")
        told["inputs"] = input_digest(tables, [res])
        done = current_run(spark, output_folder(folder, res))
        same = done is not None and done.parameters == told
        if done is not None and not same and not overwrite:
            raise FileExistsError(f"{output_folder(folder, res)!r} holds results of other parameters or inputs")
        wanted[res] = told, done if same else None

    outputs = {}
    for res, (told, done) in wanted.items():
        target = output_folder(folder, res)
        run = done or write_results(
            edge_query(tables, res, criteria, order_by, skew),
            target,
            format,
            overwrite,
            parameters=told,
            inputs=input_identity(tables, [res]),
            in_order=bool(order_by) and format == "parquet",
        )
        outputs[res] = Output(target, run, done is not None)
    return outputs
