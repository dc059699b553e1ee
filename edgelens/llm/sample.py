"""A bounded sample of rows to train on, the same at every partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hashed_sample(df: DataFrame, id_col: str, value: Column, n: int) -> list:
    """``value`` of ``n`` rows: those whose ids (null: empty) have the smallest MD5 hashes.

    Rows of one id count once, with the smallest value; null values are left out. The hashes alone
    are put in order; only the rows chosen by them come to the driver. An empty table gives none.
    """
    turn = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    keyed = df.select(turn.alias("turn"), value.alias("value")).where("value IS NOT NULL")
    chosen = keyed.select("turn").distinct().orderBy("turn").limit(n).agg(F.max("turn")).first()[0]
    if chosen is None:
        return []
    rows = keyed.where(F.col("turn") <= chosen).groupBy("turn").agg(F.min("value").alias("value"))
    return [row["value"] for row in rows.orderBy("turn").collect()]
