"""Edge and node tables derived from ``lineitem`` and ``part``; see FIXTURES.md.

The rules use whole numbers and exact division only, so that any engine derives the same
values. Some rows are absent from each node table on purpose, as in real data: ids that do
not exist, supervoxels without a class, tbars or a mapping row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgelens.functions import Resolution
from edgelens.operators.sizes import by_shuffle
from edgelens.sources import TableSet

# Line numbers that make up the edge table of each resolution.
_LINES = {Resolution.NM32: (1, 2), Resolution.NM16: (3, 4), Resolution.NM8: (5, 2**31 - 1)}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hundredths(number: Column) -> Column:
    return (number % 101).cast("double") / F.lit(100.0)


def _point(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def rsg(spark: SparkSession, sf_dir: str, res: Resolution) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").where(F.col("l_linenumber").between(*_LINES[res]))
    line, quantity = F.col("l_linenumber").cast("long"), F.col("l_quantity").cast("long")
    h = F.col("l_orderkey") * 7 + line * 31 + quantity * 13 + F.col("l_partkey") * 3
    odd = line % 2 == 1
    x, y, z = F.col("l_orderkey") % 1000, quantity, line * 10
    from_a = F.struct(
        F.when(h % 41 != 0, _hundredths(h)).alias("segment_b_consistency"),
        _point(x, y, z).alias("origin"),
    )
    from_b = F.struct(
        F.when(h % 43 != 0, _hundredths(h * 3 + 17)).alias("segment_a_consistency"),
        _point(x + 1, y + 2, z + 3).alias("origin"),
    )
    return lines.select(
        F.when(odd, F.col("l_partkey")).otherwise(F.col("l_suppkey")).alias("label_a"),
        F.when(odd, F.col("l_suppkey")).otherwise(F.col("l_partkey")).alias("label_b"),
        F.struct(from_a.alias("from_a"), from_b.alias("from_b")).alias("eval"),
        _point(x + 5, y + 6, z + 7).alias("point"),
    )


def fixture_tables(spark: SparkSession, sf_dir: str) -> TableSet:
    part = _read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sv"), F.col("p_size").cast("long").alias("n")
    )
    sv, n = F.col("sv"), F.col("n")

    objinfo = part.where(sv % 97 != 96).select(
        sv.alias("id"),
        ((sv * 104729 + n * 65537) % 20_000_000 + 1).alias("num_voxels"),
        F.struct(
            _point(sv % 500, n * 10, sv % 37).alias("start"),
            _point(n + 1, n + 2, n + 3).alias("size"),
        ).alias("bbox"),
    )
    mask = part.where(sv % 89 != 88).select(
        sv.alias("obj_id"),
        F.when(n % 5 == 0, sv % 4 + 1).otherwise(5).cast("int").alias("max_mask"),
    )
    agglo = part.where(~(sv % 8).isin(0, 7)).select(
        sv.alias("id_a"), (sv - sv % 8).alias("id_b")
    )
    sv_tbars = part.where(sv % 13 != 12).select("sv", (n % 20).alias("tbar_count"))

    def with_body(df: DataFrame) -> DataFrame:
        mapped = df.join(by_shuffle(agglo), df.sv == agglo.id_a, "left")
        return mapped.withColumn("body", F.coalesce("id_b", "sv"))

    starts = {axis: F.col(f"bbox.start.{axis}") for axis in ("x", "y", "z")}
    ends = {axis: starts[axis] + F.col(f"bbox.size.{axis}") for axis in starts}
    body_sizes = (
        with_body(objinfo.withColumnRenamed("id", "sv"))
        .groupBy("body")
        .agg(
            F.sum("num_voxels").alias("body_size"),
            *(F.min(start).alias(f"box_{axis}0") for axis, start in starts.items()),
            *(F.max(end).alias(f"box_{axis}1") for axis, end in ends.items()),
        )
    )
    return TableSet(
        rsg={res: rsg(spark, sf_dir, res) for res in Resolution},
        objinfo=objinfo,
        mask=mask,
        sv_tbars=sv_tbars,
        agglo=agglo,
        body_sizes=body_sizes,
        body_tbars=with_body(sv_tbars).groupBy("body").agg(F.sum("tbar_count").alias("tbar_count")),
        separate=with_body(part).where(F.col("body") % 24 == 0).select("body"),
        isolated=part.where((sv % 101).isin(50, 6)).select("sv"),
    )


def pair_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of pairs somebody asks for: those with an edge at the coarsest resolution."""
    edges = rsg(spark, sf_dir, Resolution.NM32)
    return edges.select(F.col("label_a").alias("sv_a"), F.col("label_b").alias("sv_b")).distinct()
