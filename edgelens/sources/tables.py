"""The bound input tables, and ad-hoc SQL over them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgelens.functions import Resolution
from edgelens.parameters import TableNames
from edgelens.sources import schema


@dataclass(frozen=True)
class TableSet:
    """One dataset and agglomeration: the edge tables by resolution, and the node tables.

    ``dimension`` is a stored supervoxel dimension of the same tables, if there is one; see
    ``edgelens.operators.layout``.
    """

    rsg: Mapping[Resolution, DataFrame]
    objinfo: DataFrame
    mask: DataFrame
    sv_tbars: DataFrame
    agglo: DataFrame
    body_sizes: DataFrame
    body_tbars: DataFrame
    separate: DataFrame
    isolated: DataFrame
    dimension: DataFrame | None = None

    def __post_init__(self) -> None:
        edges = {
            # queries prune what they do not use; ``extract_pairs`` may pass all columns on
            Resolution(res): schema.conform(df, schema.RSG, f"rsg{int(res)}", more=True)
            for res, df in self.rsg.items()
        }
        object.__setattr__(self, "rsg", edges)
        for name, expected in _NODE_SCHEMAS.items():
            object.__setattr__(self, name, schema.conform(getattr(self, name), expected, name))
        if self.dimension is not None:
            checked = schema.conform(self.dimension, schema.SV_DIMENSION, "dimension")
            object.__setattr__(self, "dimension", checked)

    @property
    def spark(self) -> SparkSession:
        return self.objinfo.sparkSession

    @classmethod
    def from_catalog(
        cls,
        spark: SparkSession,
        names: TableNames,
        resolutions: tuple[Resolution | int, ...] | None = None,
    ) -> TableSet:
        """Bind catalog tables.

        Without ``resolutions`` only the edge table of one query in ``names`` is bound; with
        them, the edge table of each. A stored dimension is bound if it is named, and must be
        one that ``store_dimension`` has checked.
        """

        def table(name: str) -> DataFrame:
            return spark.table(f"{names.base_seg}.{name}")

        if resolutions is None:
            edges = {names.res: table(names.rsg_table)}
        else:
            edges = {Resolution(r): table(names.at(r)) for r in resolutions}
        dimension = None
        if names.sv_dimension_table:
            stored = f"{names.base_seg}.{names.sv_dimension_table}"
            if not has_unique_keys(spark, stored):
                raise ValueError(f"table {stored!r} is not a checked supervoxel dimension")
            dimension = spark.table(stored)
        return cls(
            rsg=edges,
            objinfo=table(names.sv_objinfo_table),
            mask=table(names.sv_mask_class_table),
            sv_tbars=table(names.sv_tbar_count_table),
            agglo=table(names.agglo_table),
            body_sizes=table(names.agglo_body_size_table),
            body_tbars=table(names.body_tbar_count_table),
            separate=table(names.sv_mut_excl_table),
            isolated=table(names.sv_excl_table),
            dimension=dimension,
        )

    @classmethod
    def from_parquet(
        cls,
        spark: SparkSession,
        folder: str,
        resolutions: tuple[Resolution | int, ...] = tuple(Resolution),
    ) -> TableSet:
        """Bind one Parquet directory per table, named as the fields of this class."""

        def table(name: str) -> DataFrame:
            return spark.read.parquet(f"{folder}/{name}")

        return cls(
            rsg={Resolution(r): table(f"rsg{int(r)}") for r in resolutions},
            **{name: table(name) for name in _NODE_SCHEMAS},
        )

    def named(self, resolutions: Iterable[Resolution | int] | None = None) -> dict[str, DataFrame]:
        """The tables by name; of the edge tables, those of ``resolutions``."""
        wanted = self.rsg if resolutions is None else [Resolution(r) for r in resolutions]
        tables = {f"rsg{int(r)}": self.rsg[r] for r in wanted}
        tables |= {name: getattr(self, name) for name in _NODE_SCHEMAS}
        return tables if self.dimension is None else tables | {"dimension": self.dimension}

    def write_parquet(self, folder: str) -> None:
        """Store every table in the layout that ``from_parquet`` reads."""
        for res, df in self.rsg.items():
            df.write.parquet(f"{folder}/rsg{int(res)}")
        for name in _NODE_SCHEMAS:
            getattr(self, name).write.parquet(f"{folder}/{name}")

    def check_keys(self) -> None:
        """Raise if a lookup table holds a key twice, which would multiply edges.

        Runs one aggregation over each lookup table. The exclusion sets may repeat
        keys and are left out.
        """
        lookups = {
            "objinfo": "id",
            "mask": "obj_id",
            "sv_tbars": "sv",
            "agglo": "id_a",
            "body_sizes": "body",
            "body_tbars": "body",
        }
        per_table = [
            schema.repeated_keys(getattr(self, name), key).agg(
                F.lit(name).alias("table"), F.count("*").alias("n_keys")
            )
            for name, key in lookups.items()
        ]
        counts = reduce(DataFrame.unionByName, per_table).where("n_keys > 0").collect()
        if counts:
            found = ", ".join(f"{row['table']} ({row.n_keys})" for row in counts)
            raise ValueError(f"lookup tables with repeated keys: {found}")


_NODE_SCHEMAS = {
    "objinfo": schema.OBJINFO,
    "mask": schema.MASK,
    "sv_tbars": schema.SV_TBARS,
    "agglo": schema.AGGLO,
    "body_sizes": schema.BODY_SIZES,
    "body_tbars": schema.BODY_TBARS,
    "separate": schema.SEPARATE,
    "isolated": schema.ISOLATED,
}


# Property of a stored table that says that its keys were found to be unique.
UNIQUE_KEYS = "edgelens.unique.keys"


def mark_unique_keys(spark: SparkSession, table: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{UNIQUE_KEYS}' = 'true')")


def has_unique_keys(spark: SparkSession, table: str) -> bool:
    found = spark.sql(f"SHOW TBLPROPERTIES {table} ('{UNIQUE_KEYS}')").first()
    return found is not None and found["value"] == "true"


def run_sql(tables: TableSet, text: str, **frames: DataFrame) -> DataFrame:
    """Run SQL that names the tables in braces: ``select * from {rsg8} join {objinfo} ...``.

    Keyword arguments add further frames. The result is lazy; ``toPandas()`` on it
    gives a local frame when it is known to be small.
    """
    named = tables.named() | frames
    used = {name: df for name, df in named.items() if "{" + name + "}" in text}
    return tables.spark.sql(text, **used)
