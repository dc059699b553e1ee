"""Exact deduplication of texts up to white space.

Method: a Golomb-coded exchange of fingerprints. Every block of documents sends the sorted
64-bit fingerprints of its texts, cut by hash range and Golomb-coded, to the owners of the
ranges. An owner answers with one bit for each fingerprint: whether it is there more than once.
Only the texts so marked (and the few that share a filter bit with one) are shuffled, grouped by
their bytes, and compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgelens.llm import golomb
from edgelens.llm.filters import bits_for, build_filter
from edgelens.llm.scratch import Scratch

#: Documents of a block, the unit that sends fingerprints and receives answers.
BLOCK = 100_000
_SPACE = b" \t\n\x0b\x0c\r"


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Which row of each group of equal texts stays.

    Texts are equal when identical without the characters 0x20 and 0x09-0x0D; null counts as
    empty, so null, empty and blank texts form one group. The row with the most code points in
    its original text stays, then the one with the smallest id (a null id comes last); of rows
    that are alike in both, exactly one. Returns one row per row of ``docs``: the id,
    ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` (hex, of the normalised text).
    Further columns are ignored; an empty table gives an empty result. Two different texts
    with one SHA-256 would raise an error.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sent = scratch.keep(_send(docs), "fingerprints")
    rows = scratch.keep(_suspects(sent), "rows")

    marked = rows.where("suspect")
    groups = marked.groupBy("sha").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct((-F.col("points")).alias("p"), F.col("id").isNull().alias("none"), "id", "block", "row")).alias("best"),
    )
    groups = scratch.keep(groups.join(_texts(docs, marked), "sha"), "groups")
    found = marked.join(groups, "sha", "left").withColumn(
        "stays", (F.col("best.block") == F.col("block")) & (F.col("best.row") == F.col("row"))
    )
    alone = rows.where("NOT suspect")
    columns = lambda keep, size, kept: [
        F.col("id").alias(id_col), keep.alias("keep_id"), size.cast("long").alias("group_size"),
        kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    ]
    return found.select(columns(F.col("best.id"), F.col("group_size"), F.col("stays"))).unionByName(
        alone.select(columns(F.col("id"), F.lit(1), F.lit(True)))
    )


def _normalised(texts: pa.Array) -> Iterator[bytes]:
    for text in texts.cast(pa.binary()):
        yield (text.as_py() or b"").translate(None, _SPACE)


def _send(docs: DataFrame) -> DataFrame:
    """Rows of all documents (block, row, id, fingerprint, sha, points), and the coded
    fingerprints of each block for each owner (block, owner, sent)."""
    owners = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("row", T.LongType()), T.StructField("id", docs.schema["id"].dataType),
        T.StructField("fingerprint", T.LongType()), T.StructField("sha", T.BinaryType()), T.StructField("points", T.LongType()),
        T.StructField("owner", T.IntegerType()), T.StructField("sent", T.BinaryType()),
    ])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, row, kept = TaskContext.get().partitionId() << 24, 0, []

        def flush(id_type: pa.DataType) -> pa.RecordBatch:
            prints = np.sort(np.concatenate(kept))
            bounds = np.searchsorted(prints, [(o << 63) // owners for o in range(owners)] + [2**63])
            coded = [golomb.encode(prints[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            n = len(coded)
            return pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, id_type), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(coded, pa.binary())],
                schema.names)

        for batch in batches:
            n = len(batch)
            shas = [hashlib.sha256(x).digest() for x in _normalised(batch.column("text"))]
            prints = np.frombuffer(b"".join(x[:8] for x in shas), np.uint64) >> np.uint64(1)
            points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.array(range(row, row + n), pa.int64()), batch.column("id"), pa.array(prints.astype(np.int64)),
                 pa.array(shas, pa.binary()), points, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema.names)
            kept.append(prints)
            row += n
            if row >= BLOCK:
                yield flush(batch.column("id").type)
                block, row, kept = block + 1, 0, []
        if row:
            yield flush(batch.column("id").type)

    return docs.mapInArrow(send, schema)


def _suspects(sent: DataFrame) -> DataFrame:
    """The rows of the documents, each marked where its fingerprint is there more than once."""
    owners = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        received: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for block, owner, coded in zip(*(batch.column(c).to_pylist() for c in ("block", "owner", "sent")), strict=True):
                received.setdefault(owner, []).append((block, coded))
        while received:
            owner, messages = received.popitem()
            all_prints = np.sort(np.concatenate([golomb.decode(x) for _, x in messages]))
            repeated = np.unique(all_prints[1:][all_prints[1:] == all_prints[:-1]])
            bits = [np.packbits(np.isin(golomb.decode(x), repeated)).tobytes() for _, x in messages]
            n = len(bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in messages], pa.int64()), pa.array([owner] * n, pa.int32()), pa.array(bits, pa.binary()),
                 pa.array([len(golomb.decode(x)) for _, x in messages], pa.int64())], ["block", "owner", "bits", "count"])

    answers = (
        sent.where("sent IS NOT NULL").select("block", "owner", "sent").repartition(owners, "owner")
        .mapInArrow(answer, "block long, owner int, bits binary, count long")
    )

    def mark(rows: pa.Table, bits: pa.Table) -> pa.Table:
        bits = bits.sort_by("owner")
        flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(bits.column("bits").to_pylist(), bits.column("count").to_pylist(), strict=True)]
        marks = np.zeros(len(rows), bool)
        marks[np.argsort(rows.column("fingerprint").to_numpy(), kind="stable")] = np.concatenate(flags)
        return rows.append_column("suspect", pa.array(marks))

    rows = sent.where("sent IS NULL").drop("owner", "sent")
    schema = T.StructType([*rows.schema.fields, T.StructField("suspect", T.BooleanType())])
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(mark, schema)


def _texts(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """(sha) of the marked texts, after comparing their bytes; equal texts of a task are
    shuffled once."""
    prints = marked.select("fingerprint").distinct()
    wanted = docs.sparkSession.sparkContext.broadcast(build_filter(prints, "fingerprint", bits_for(prints.count())))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wants = wanted.value
        for batch in batches:
            texts = list(_normalised(batch.column("text")))
            shas = [hashlib.sha256(x).digest() for x in texts]
            prints = np.frombuffer(b"".join(x[:8] for x in shas), np.uint64) >> np.uint64(1)
            at = np.flatnonzero(wants(prints))
            yield pa.RecordBatch.from_arrays(
                [pa.array([shas[i] for i in at], pa.binary()), pa.array([texts[i] for i in at], pa.binary())], ["sha", "bytes"]
            )

    texts = docs.select("text").mapInArrow(collect, "sha binary, bytes binary").distinct()
    counted = texts.groupBy("sha").agg(F.count("*").alias("texts"))
    return counted.where(
        F.when(F.col("texts") > 1, F.raise_error(F.lit("different texts with one SHA-256")).cast("boolean")).otherwise(True)
    ).select("sha")


#: DuckDB SQL with the rows of ``exact_dedup``.
ORACLE_SQL = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY points DESC, doc_id) = 1 AS kept,
       sha256(body) AS text_sha256
FROM d
"""
