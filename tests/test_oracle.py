"""Every registered query against DuckDB SQL over the same files."""

import pytest
from compare import difference, duckdb_tables
from conftest import SF_DIR

import __spark_entry__

from edgelens.fixtures import oracle, registry

QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()

# No body of the smallest data is large enough for the batch criteria.
LARGER = {"edge_query_intra", "intra_all_res", "export_provenance", "batch_export"}


def test_every_query_has_an_expected_result():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(name, spark):
    sf_dir = "/root/testdata/sf0.01" if name in LARGER else SF_DIR
    expected = duckdb_tables(sf_dir).sql(ORACLE[name])
    assert difference(QUERIES[name](spark, sf_dir), expected) is None


def test_entry_returns_rows(spark):
    assert __spark_entry__.entry(spark).count() == 849
