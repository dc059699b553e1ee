"""Hand-made tables of a few rows. Everything qualifies unless a test says otherwise."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from edgelens import TableSet
from edgelens.sources import schema

GOOD = 0.5


def contact(a, b, ab=GOOD, ba=GOOD, at=0):
    """One stored contact between supervoxels ``a`` and ``b``; ``at`` moves it."""
    here = (at, at, at)
    return (a, b, ((ab, here), (ba, here)), here)


def _named(value, kind):
    if not isinstance(kind, T.StructType):
        return value
    return {f.name: _named(v, f.dataType) for f, v in zip(kind, value)}


def frame(spark, rows, kind):
    """A local relation, whose size Spark knows."""
    named = [_named(row, kind) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(named, schema=to_arrow_schema(kind)))


def tiny_tables(
    spark,
    contacts,
    bodies=None,
    classes=None,
    sizes=None,
    sv_tbars=None,
    body_tbars=None,
    body_sizes=None,
    separate=(),
    isolated=(),
    svs=range(1, 10),
):
    """``contacts`` is a list, or a list per resolution.

    ``bodies`` maps supervoxels to bodies; the other dictionaries replace defaults, and a
    value of None removes the row.
    """
    if not isinstance(contacts, dict):
        contacts = {8: contacts}
    bodies = bodies or {}
    all_bodies = {bodies.get(sv, sv) for sv in svs}

    def rows(keys, default, changes):
        values = {key: default for key in keys} | (changes or {})
        return [(key, value) for key, value in values.items() if value is not None]

    box = ((0, 0, 0), (1, 2, 3))
    return TableSet(
        rsg={res: frame(spark, rows_, schema.RSG) for res, rows_ in contacts.items()},
        objinfo=frame(
            spark,
            [(sv, n, box) for sv, n in rows(svs, 2_000_000, sizes)], schema.OBJINFO
        ),
        mask=frame(spark, rows(svs, 5, classes), schema.MASK),
        sv_tbars=frame(spark, rows(svs, 10, sv_tbars), schema.SV_TBARS),
        agglo=frame(spark, bodies.items(), schema.AGGLO),
        body_sizes=frame(
            spark,
            [(b, n, 0, 0, 0, 9, 9, 9) for b, n in rows(all_bodies, 10**7, body_sizes)],
            schema.BODY_SIZES,
        ),
        body_tbars=frame(spark, rows(all_bodies, 10, body_tbars), schema.BODY_TBARS),
        separate=frame(spark, [(b,) for b in separate], schema.SEPARATE),
        isolated=frame(spark, [(sv,) for sv in isolated], schema.ISOLATED),
    )


def pairs_of(df):
    return sorted((r.sv_a, r.sv_b) for r in df.select("sv_a", "sv_b").collect())
