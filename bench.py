"""Time the headline queries; prints one JSON line.

Edge and node tables are derived from the driver's Parquet and stored once, as they are in
production, before anything is timed. Each query is then run to completion into Spark's
no-op sink: one warm-up and ``BENCH_RUNS`` timed runs, of which the median counts.
"""

from __future__ import annotations

import dataclasses
import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from edgelens import (
    EdgeCriteria,
    TableSet,
    best_edges_all_res,
    best_edges_one_res,
    edge_query,
    edge_query_resolutions,
    extract_pairs,
)
from edgelens.fixtures.registry import INTRA_CRITERIA
from edgelens.fixtures.tables import fixture_tables, pair_list


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("edgelens-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def store_tables(spark: SparkSession, sf_dir: str) -> tuple[TableSet, DataFrame]:
    folder = tempfile.mkdtemp(prefix="edgelens-bench-")
    derived = fixture_tables(spark, sf_dir)
    # As many files per edge table as there are cores, so that scans run in parallel.
    files = spark.sparkContext.defaultParallelism
    edges = {res: df.repartition(files) for res, df in derived.rsg.items()}
    dataclasses.replace(derived, rsg=edges).write_parquet(folder)
    pair_list(spark, sf_dir).write.parquet(f"{folder}/pair_list")
    return TableSet.from_parquet(spark, folder), spark.read.parquet(f"{folder}/pair_list")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(build, runs: int) -> float:
    run(build())
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        run(build())
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = session(cpus)
    start = time.perf_counter()
    tables, listed = store_tables(spark, sf_dir)
    stored = time.perf_counter() - start

    queries = {
        "edge_query_inter": lambda: edge_query(tables, 8, EdgeCriteria()),
        "edge_query_intra": lambda: edge_query(tables, 8, INTRA_CRITERIA),
        "intra_all_res": lambda: edge_query_resolutions(tables, INTRA_CRITERIA),
        "best_edges_all_res": lambda: best_edges_all_res(tables),
        "best_edges_all_res_without_side_ranks": lambda: best_edges_all_res(
            tables, with_side_ranks=False
        ),
        "best_edges_one_res": lambda: best_edges_one_res(tables),
        "extract_pairs": lambda: extract_pairs(tables, listed),
    }
    seconds = {name: round(median_seconds(build, runs), 3) for name, build in queries.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
                "runs": runs,
                "cpus": int(cpus),
                "shuffle_partitions": int(cpus),
                "spark": spark.version,
                "store_tables_seconds": round(stored, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
