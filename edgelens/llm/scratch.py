"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode a temporary one if unset."""
    folder = spark.sparkContext.getConf().get(SETTING) or spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="edgelens-")
    spark.conf.set(SETTING, folder)
    return folder


class Scratch:
    """Writes tables under one new folder of the shared folder and reads them back.

    A table read back has no lineage: nothing before it runs again when executors are lost,
    and whatever a task decided (its partition number, say) is fixed.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._count = 0

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:02d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Removes tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(conf).delete(path, True)
