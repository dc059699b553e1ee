"""Orders in which results are reviewed. NULLs come first ascending, last descending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgelens.functions import strict_greatest, strict_least

Order = list[Column | str]

_ENDS = ("body_a", "body_b", "sv_a", "sv_b")


def by_min_sv_tbars() -> Order:
    """Edges whose weaker supervoxel has most tbars first, then by ends."""
    return [F.expr(strict_least("sv_tbars_a", "sv_tbars_b")).desc(), *_ENDS]


def by_body_tbars() -> Order:
    """Edges whose weaker body has most tbars first; among those, the smaller of the
    stronger bodies first, then by ends."""
    weaker = F.expr(strict_least("body_tbars_a", "body_tbars_b"))
    stronger = F.expr(strict_greatest("body_tbars_a", "body_tbars_b"))
    return [weaker.desc(), stronger, *_ENDS]


def by_ends_and_score() -> Order:
    """By ends, best score first."""
    return [*_ENDS, F.desc("score")]


def ordered(df: DataFrame, order: str | Order | None) -> DataFrame:
    """Sort by columns, or by the text of an ``ORDER BY`` clause; nothing means no sort."""
    if not order:
        return df
    if isinstance(order, str):
        return df.sparkSession.sql(f"SELECT * FROM {{rows}} ORDER BY {order}", rows=df)
    return df.orderBy(*order)
