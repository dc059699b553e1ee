"""Expected schemas of the input tables, and the check done when one is bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINT = T.StructType([T.StructField(axis, T.LongType()) for axis in ("x", "y", "z")])


def _side(score: str) -> T.StructType:
    return T.StructType([T.StructField(score, T.DoubleType()), T.StructField("origin", _POINT)])


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_ID = _COUNT = _CORNER = T.LongType()

# The column names under which the tables are stored.
RSG = _table(
    label_a=_ID,
    label_b=_ID,
    eval=_table(from_a=_side("segment_b_consistency"), from_b=_side("segment_a_consistency")),
    point=_POINT,
)
OBJINFO = _table(id=_ID, num_voxels=_COUNT, bbox=_table(start=_POINT, size=_POINT))
MASK = _table(obj_id=_ID, max_mask=T.IntegerType())
SV_TBARS = _table(sv=_ID, tbar_count=_COUNT)
AGGLO = _table(id_a=_ID, id_b=_ID)
BODY_SIZES = _table(
    body=_ID,
    body_size=_COUNT,
    box_x0=_CORNER,
    box_y0=_CORNER,
    box_z0=_CORNER,
    box_x1=_CORNER,
    box_y1=_CORNER,
    box_z1=_CORNER,
)
BODY_TBARS = _table(body=_ID, tbar_count=_COUNT)
SEPARATE = _table(body=_ID)
ISOLATED = _table(sv=_ID)
PAIR_LIST = _table(sv_a=_ID, sv_b=_ID)

# What ``edgelens.operators.dimensions.sv_dimension`` gathers.
_CORNERS = [f"{axis}{corner}" for corner in (0, 1) for axis in ("x", "y", "z")]
SV_DIMENSION = _table(
    sv=_ID,
    body=_ID,
    sv_mask=T.IntegerType(),
    body_tbars=_COUNT,
    sv_tbars=_COUNT,
    body_size=_COUNT,
    **{f"body_box_{c}": _CORNER for c in _CORNERS},
    sv_size=_COUNT,
    **{f"sv_box_{c}": _CORNER for c in _CORNERS},
    is_isolated=T.BooleanType(),
    is_separate=T.BooleanType(),
)


def _missing(have: T.DataType, want: T.DataType, path: str) -> list[str]:
    if not isinstance(want, T.StructType):
        fits = isinstance(have, T.BooleanType if want == T.BooleanType() else T.NumericType)
        return [] if fits else [f"{path} is {have.simpleString()}"]
    if not isinstance(have, T.StructType):
        return [f"{path} is {have.simpleString()}"]
    fields = {f.name: f.dataType for f in have}
    problems = []
    for f in want:
        inner = f"{path}.{f.name}" if path else f.name
        if f.name in fields:
            problems += _missing(fields[f.name], f.dataType, inner)
        else:
            problems.append(f"{inner} is missing")
    return problems


def conform(df: DataFrame, schema: T.StructType, table: str, more: bool = False) -> DataFrame:
    """Check that ``df`` has the columns of ``schema`` and keep just those, or with ``more`` put
    the others behind them as they are.

    Top-level numbers are cast once here, so that a decimal label cannot turn each
    later join key into a decimal. Nested columns stay as they are stored: a cast
    would hide them from column pruning and filter pushdown.
    """
    if problems := _missing(df.schema, schema, ""):
        raise ValueError(f"table {table!r} does not fit: {', '.join(problems)}")
    have = {f.name: f.dataType for f in df.schema}
    others = [name for name in have if more and name not in schema.names]
    return df.select(
        *(
            F.col(f.name)
            if isinstance(f.dataType, T.StructType) or have[f.name] == f.dataType
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema
        ),
        *(F.col(quoted(name)) for name in others),
    )


def quoted(name: str) -> str:
    """A column name that may hold dots or blanks, as an identifier."""
    return "`" + name.replace("`", "``") + "`"


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
