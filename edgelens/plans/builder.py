"""A query described by table names, criteria and an order, ready to run or export."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from edgelens.functions import Resolution
from edgelens.parameters import EdgeCriteria, TableNames
from edgelens.plans.batch import Output, export_batch
from edgelens.plans.edge_query import edge_query
from edgelens.plans.skew_profile import SkewProfile, load_skew
from edgelens.sources import TableSet
from edgelens.sources.export import (
    Summary,
    input_identity,
    preview,
    read_results,
    summarize,
    write_results,
)

_TABLE_PARAMETERS = frozenset(f.name for f in dataclasses.fields(TableNames))


@dataclass(frozen=True)
class EdgeQuery:
    """An edge query over catalog tables. Every change returns a new object."""

    names: TableNames
    criteria: EdgeCriteria = EdgeCriteria()
    order_by: str = ""

    def set(self, **parameters: Any) -> EdgeQuery:
        """Change table names and criteria, as ``min_sv_size_both`` or ``__MIN_SV_SIZE_BOTH__``.

        ``scale`` follows the edge table and is accepted only where it agrees with it.
        """
        renamed = {k.strip("_").lower(): v for k, v in parameters.items()}
        scale = renamed.pop("scale", None)
        tables = {k: v for k, v in renamed.items() if k in _TABLE_PARAMETERS}
        rest = {k: v for k, v in renamed.items() if k not in _TABLE_PARAMETERS}
        changed = dataclasses.replace(
            self, names=self.names.replace(**tables), criteria=self.criteria.replace(**rest)
        )
        if scale is not None and scale != changed.names.res.scale:
            raise ValueError(f"scale {scale} does not fit {changed.names.rsg_table}")
        return changed

    def sorted_by(self, order_by: str) -> EdgeQuery:
        """Order the result by the text of an ``ORDER BY`` clause."""
        return dataclasses.replace(self, order_by=order_by)

    def parameters(self) -> dict[str, Any]:
        return {
            **self.names.as_parameters(),
            **self.criteria.as_parameters(),
            "order_by": self.order_by,
        }

    def tables(
        self, spark: SparkSession, resolutions: Iterable[Resolution | int] | None = None
    ) -> TableSet:
        """The named tables, and the stored dimension if one is named."""
        wanted = None if resolutions is None else tuple(Resolution(r) for r in resolutions)
        return TableSet.from_catalog(spark, self.names, wanted)

    def skew(self, spark: SparkSession) -> SkewProfile:
        """The stored skew profile if one is named."""
        if not self.names.skew_table:
            return SkewProfile()
        return load_skew(spark, f"{self.names.base_seg}.{self.names.skew_table}")

    def query(self, spark: SparkSession) -> DataFrame:
        return edge_query(
            self.tables(spark), self.names.res, self.criteria, self.order_by, self.skew(spark)
        )

    def query_and_export(
        self, spark: SparkSession, folder: str, overwrite: bool = False, format: str = "parquet"
    ) -> Summary:
        """Run the query, write results, provenance and the identity of its inputs as a new run of
        ``folder``, and sum up what was written. Parquet files keep the order of the query."""
        df = self.query(spark)
        kept = bool(self.order_by) and format == "parquet"
        run = write_results(
            df,
            folder,
            format,
            overwrite,
            parameters=self.parameters(),
            inputs=input_identity(self.tables(spark)),
            in_order=kept,
        )
        if kept:
            return Summary(run.n_rows, preview(spark, folder, df))
        return summarize(read_results(spark, folder, df), self.order_by)

    def batch_and_export(
        self,
        spark: SparkSession,
        folder: str,
        resolutions: Iterable[Resolution | int] = tuple(reversed(Resolution)),
        overwrite: bool = False,
        format: str = "parquet",
    ) -> dict[Resolution, Output]:
        """The query at several resolutions, each committed to a folder of its own; outputs that
        an earlier call completed are skipped. See ``export_batch``."""
        resolutions = tuple(Resolution(r) for r in resolutions)
        return export_batch(
            self.tables(spark, resolutions),
            folder,
            self.criteria,
            resolutions,
            self.order_by,
            format,
            overwrite,
            self.skew(spark),
            {k: v for k, v in self.parameters().items() if k not in ("rsg_table", "scale")},
        )
