"""Shared scratch storage: where a plan is cut so that executors may be lost."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the one the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to storage that all executors share; "
                "this step has to write an intermediate table"
            )
        root = tempfile.mkdtemp(prefix="edgelens-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/edgelens-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    Whatever depended on the physical layout, such as a partition number, is a plain
    stored value from here on and cannot change when a task is run again.
    """
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
