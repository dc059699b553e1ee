import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("edgelens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """The derived tables, stored as they are in production."""
    from edgelens import TableSet
    from edgelens.fixtures.tables import fixture_tables

    folder = str(tmp_path_factory.mktemp("tables"))
    fixture_tables(spark, SF_DIR).write_parquet(folder)
    return TableSet.from_parquet(spark, folder)


@pytest.fixture
def shuffled(spark):
    """As on tables too large for any broadcast."""
    names = [f"spark.sql.{kind}autoBroadcastJoinThreshold" for kind in ("", "adaptive.")]
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
