"""Writing results with their provenance, and summing up what was written.

A target folder holds one folder per run, below ``runs``, and a numbered manifest for each run
that was completed, below ``manifests``. The manifest is written last: until it is there, readers
see the run before, and a run that ends early leaves them alone.
"""

from __future__ import annotations

import contextlib
import hashlib
import io
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from edgelens.functions import Resolution
from edgelens.operators.ordering import Order, ordered
from edgelens.sources.tables import TableSet

RUNS, MANIFESTS = "runs", "manifests"
RESULTS, PROVENANCE, INPUTS, RANGES = "results", "provenance", "inputs", "ranges"


def plan_text(df: DataFrame) -> str:
    """The formatted plan of a query."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def provenance(df: DataFrame, parameters: Mapping[str, Any]) -> DataFrame:
    """One row that records the parameters of a query, one field each, and its plan."""
    return df.sparkSession.createDataFrame(
        [Row(parameters=Row(**parameters), plan=plan_text(df))]
    )


def input_identity(
    tables: TableSet, resolutions: Sequence[Resolution | int] | None = None
) -> DataFrame:
    """What was read: for each table its name, number of rows, and files with their modification
    times, from which a later reader can tell whether it is still the same.

    Of the edge tables, those of ``resolutions``. Row counts come from file footers where the
    tables are stored files.
    """
    named = tables.named(resolutions)
    counts = reduce(
        DataFrame.unionAll,
        (df.agg(F.lit(name).alias("table"), F.count("*").alias("n_rows")) for name, df in named.items()),
    )
    spark = tables.spark
    files = [(name, _file_identity(spark, df)) for name, df in named.items()]
    kind = "table string, files array<struct<path: string, bytes: long, modified: long>>"
    return counts.join(spark.createDataFrame(files, kind), "table")


def input_digest(
    tables: TableSet, resolutions: Sequence[Resolution | int] | None = None
) -> str:
    """A hash of the files of all tables, which changes when one of them does."""
    told = [(name, _file_identity(tables.spark, df)) for name, df in tables.named(resolutions).items()]
    return hashlib.sha256(json.dumps(told).encode()).hexdigest()


def _file_identity(spark: SparkSession, df: DataFrame) -> list[tuple[str, int, int]]:
    found = []
    for path in sorted(df.inputFiles()):
        target, files = _hadoop(spark, path)
        status = files.getFileStatus(target)
        found.append((path, status.getLen(), status.getModificationTime()))
    return found


@dataclass(frozen=True)
class Run:
    """A completed run, as its manifest has it."""

    number: int
    path: str
    format: str
    parameters: Mapping[str, Any] | None
    n_rows: int

    @property
    def results(self) -> str:
        return f"{self.path}/{RESULTS}"


def runs(spark: SparkSession, folder: str) -> list[Run]:
    """The completed runs of a target folder, first to last.

    A manifest that is not whole, as an interrupted writer leaves it, does not count.
    """
    root, files = _hadoop(spark, f"{folder.rstrip('/')}/{MANIFESTS}")
    if not files.exists(root):
        return []
    found = []
    for status in files.listStatus(root):
        name = status.getPath().getName()
        if not name.removesuffix(".json").isdigit():
            continue
        with contextlib.suppress(json.JSONDecodeError):
            told = json.loads(_read_text(files, status.getPath()))
            path = f"{folder.rstrip('/')}/{RUNS}/{told['run']}"
            found.append(
                Run(int(name.removesuffix(".json")), path, told["format"], told["parameters"], told["n_rows"])
            )
    return sorted(found, key=lambda run: run.number)


def current_run(spark: SparkSession, folder: str) -> Run | None:
    """The run that readers of a target folder see."""
    return next(reversed(runs(spark, folder)), None)


def write_results(
    df: DataFrame,
    folder: str,
    format: str = "parquet",
    overwrite: bool = False,
    partition_by: Sequence[str] = (),
    parameters: Mapping[str, Any] | None = None,
    inputs: DataFrame | None = None,
    in_order: bool = False,
) -> Run:
    """Write ``df`` as a new run of the target ``folder``, with a provenance record and the
    identity of the ``inputs`` beside it.

    A folder that has a run, or holds anything else, is refused unless ``overwrite``. The new run
    becomes the current one by its manifest, after all of it is stored; a query that fails
    leaves the former run in place. The run before is kept for those who still read it, and
    earlier ones are removed. CSV gets a header line in each part file.

    ``in_order`` says that ``df`` has a global order, to be kept: its ranges are stored one per
    file, in the order of the files' names, and which positions a file holds is recorded. Parquet
    only, and not with ``partition_by``. See ``read_in_order`` and ``preview``.
    """
    if in_order and (format != "parquet" or partition_by):
        raise ValueError("an order is kept in Parquet files without partitions only")
    spark = df.sparkSession
    folder = folder.rstrip("/")
    before = runs(spark, folder)
    if not overwrite and (before or _foreign(spark, folder)):
        raise FileExistsError(f"{folder!r} already exists and overwrite is not set")

    name = uuid.uuid4().hex
    path = f"{folder}/{RUNS}/{name}"
    writer = df.write.format(format)
    if format == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(f"{path}/{RESULTS}")
        if parameters is not None:
            # One row by construction.
            provenance(df, parameters).coalesce(1).write.json(f"{path}/{PROVENANCE}")
        if inputs is not None:
            # One row per table.
            inputs.coalesce(1).write.json(f"{path}/{INPUTS}")
        stored = _reader(spark, df, format).load(f"{path}/{RESULTS}")
        if in_order:
            ranges = _positions(stored)
            # A row per file.
            spark.createDataFrame(ranges, _RANGE).coalesce(1).write.json(f"{path}/{RANGES}")
            n_rows = sum(n for _, _, n in ranges)
        else:
            n_rows = stored.count()
    except Exception:
        _delete(spark, path)
        raise
    number = before[-1].number + 1 if before else 1
    run = Run(number, path, format, None if parameters is None else dict(parameters), n_rows)
    _commit(spark, folder, run)
    for old in before[:-1]:
        _delete(spark, f"{folder}/{MANIFESTS}/{old.number:010d}.json")
        _delete(spark, old.path)
    return run


_RANGE = "file string, before long, n_rows long"


def _positions(stored: DataFrame) -> list[tuple[str, int, int]]:
    """For each file the rows in files before it and its own, from the files' row counts.

    Spark names the files of a sorted frame by the number of their range.
    """
    counted = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))
    found, before = [], 0
    for file, n in sorted(tuple(row) for row in counted.collect()):
        found.append((file, before, n))
        before += n
    return found


def _commit(spark: SparkSession, folder: str, run: Run) -> None:
    """Write the manifest of a run. Its name must be new, so of two writers at once one fails."""
    told = {
        "run": run.path.rsplit("/", 1)[1],
        "format": run.format,
        "parameters": run.parameters,
        "n_rows": run.n_rows,
    }
    target, files = _hadoop(spark, f"{folder}/{MANIFESTS}/{run.number:010d}.json")
    out = files.create(target, False)
    try:
        out.write(bytearray(json.dumps(told).encode()))
    finally:
        out.close()


def _reader(spark: SparkSession, like: DataFrame, format: str):
    reader = spark.read.format(format).schema(like.schema)
    return reader.option("header", True) if format == "csv" else reader


def read_results(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """The current results, with the schema of the query that produced them."""
    run = _required(spark, folder)
    return _reader(spark, like, run.format).load(run.results).select(*like.columns)


def read_in_order(
    spark: SparkSession, folder: str, like: DataFrame, name: str = "position"
) -> DataFrame:
    """The current results, written ``in_order``, with the 1-based position of each row: where its
    file begins, and its place in the file. Nothing is sorted or shuffled."""
    run = _required(spark, folder)
    stored = spark.read.schema(like.schema).parquet(run.results)
    place = F.col("_metadata.row_index")
    rows = stored.select(*like.columns, F.col("_metadata.file_name").alias("_file"), place.alias("_place"))
    ranges = spark.read.schema(_RANGE).json(f"{run.path}/{RANGES}").selectExpr("file AS _file", "before")
    # a row per file
    placed = rows.join(F.broadcast(ranges), "_file")
    return placed.select(*like.columns, (F.col("before") + F.col("_place") + 1).alias(name))


def preview(spark: SparkSession, folder: str, like: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows of the current results, written ``in_order``. Only the files that hold
    them are read, as a rule the first one."""
    run = _required(spark, folder)
    ranges = spark.read.schema(_RANGE).json(f"{run.path}/{RANGES}").where(f"before < {n}").collect()
    if not ranges:
        return like.limit(0)
    files = [f"{run.results}/{row.file}" for row in ranges]
    stored = spark.read.schema(like.schema).parquet(*files)
    before = F.create_map(*(F.lit(x) for row in ranges for x in (row.file, row.before)))
    position = before[F.col("_metadata.file_name")] + F.col("_metadata.row_index")
    first = stored.select(*like.columns, position.alias("_position")).where(F.col("_position") < n)
    return first.orderBy("_position").drop("_position")


def read_provenance(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.json(f"{_required(spark, folder).path}/{PROVENANCE}")


def read_inputs(spark: SparkSession, folder: str) -> DataFrame:
    kind = "table string, n_rows long, files array<struct<path: string, bytes: long, modified: long>>"
    return spark.read.schema(kind).json(f"{_required(spark, folder).path}/{INPUTS}")


def _required(spark: SparkSession, folder: str) -> Run:
    run = current_run(spark, folder)
    if run is None:
        raise FileNotFoundError(f"{folder!r} holds no completed run")
    return run


@dataclass(frozen=True)
class Summary:
    n_rows: int
    first_rows: DataFrame


def summarize(
    written: DataFrame, order_by: str | Order | None = None, n: int = 5
) -> Summary:
    """Row count and first rows of written results; the query itself is not run again.

    Files are not read in the order of their rows, so the first rows need ``order_by``; results
    written ``in_order`` have ``preview`` instead.
    """
    return Summary(written.count(), ordered(written, order_by).limit(n))


def _hadoop(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _foreign(spark: SparkSession, folder: str) -> bool:
    """Whether a folder holds anything but runs that were never completed."""
    target, files = _hadoop(spark, folder)
    if not files.exists(target):
        return False
    return any(s.getPath().getName() not in (RUNS, MANIFESTS) for s in files.listStatus(target))


def _delete(spark: SparkSession, path: str) -> None:
    target, files = _hadoop(spark, path)
    files.delete(target, True)


def _read_text(files, path) -> str:
    stream = files.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
