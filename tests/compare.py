"""Comparison of a Spark result with DuckDB SQL over the same files."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
import pandas as pd


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _canonical(df: pd.DataFrame) -> list[tuple]:
    rows = df[sorted(df.columns)].astype(object)
    rows = rows.where(rows.notna(), None)
    return sorted(rows.itertuples(index=False, name=None), key=repr)


_DUCKDB_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
}


def difference(spark_df, relation: duckdb.DuckDBPyRelation) -> str | None:
    """What differs between the two results, or None."""
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    types = {c: _DUCKDB_TYPES[t] for c, t in spark_df.dtypes}
    if types != expected_types:
        return f"schema {sorted(set(types.items()) ^ set(expected_types.items()))}"
    expected = relation.df()
    got = spark_df.toPandas()
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    if not len(got):
        return "both results are empty"
    a, b = _canonical(got), _canonical(expected)
    for left, right in zip(a, b):
        if left != right:
            cols = sorted(got.columns)
            return str({c: (x, y) for c, x, y in zip(cols, left, right) if x != y})
    return None


def difference_between(a, b) -> str | None:
    """What differs between two Spark results, counting repeated rows, or None."""
    if a.dtypes != b.dtypes:
        return f"schema {a.dtypes} {b.dtypes}"
    rows_a, rows_b = Counter(map(tuple, a.collect())), Counter(map(tuple, b.collect()))
    if not rows_a:
        return "both results are empty" if not rows_b else "the first result is empty"
    extra, missing = rows_a - rows_b, rows_b - rows_a
    return f"extra {extra}, missing {missing}" if extra or missing else None
