"""Language identification by compression with per-language dictionaries."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled documents of a language that make its dictionary, and code points of each.
SAMPLE_DOCS, SAMPLE_CHARS = 400, 300
#: Compression levels, and the bytes of letters up to which a text is compressed at each; longer
#: texts say enough at a fast one. Levels above 12 parse so freely that they tell languages less.
LEVELS, UP_TO = (9, 5, 3), (1024, 4096)
#: A text is rejected if its margin is narrower than this, and if it has this many bytes at
#: least; in shorter ones equal sizes are common and say nothing.
MIN_MARGIN, JUDGED = 0.002, 200
UNKNOWN = "und"


class _Letters(dict):
    """Translates a code point to itself if it is a letter, else to a space."""

    def __missing__(self, point: int) -> str:
        sign = chr(point)
        sign = self[point] = sign if sign.isalnum() and not sign.isdecimal() else " "
        return sign


_LETTERS = _Letters()


def held_out(id_col: str = "doc_id") -> Column:
    """True for the documents that training leaves out: crc32 of the id modulo 3 is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def letters(text: str) -> str:
    """Lower-case letters of a text, with one space for whatever stands between."""
    return " ".join(text.lower().translate(_LETTERS).split())


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """A raw-content dictionary for each value of ``lang``.

    It is made from the ``SAMPLE_DOCS`` labelled documents with the smallest hash of their id,
    ``SAMPLE_CHARS`` code points of each, so its size does not depend on the table's. Rows
    without id, text or language, and held-out ones, are not used.
    """
    piece = F.substring(text_col, 1, SAMPLE_CHARS)
    turn = Window.partitionBy("lang").orderBy("turn", "piece")
    rows = (
        docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col))
        .select(F.col(lang_col).cast("string").alias("lang"), F.md5(F.col(id_col).cast("string").cast("binary")).alias("turn"), piece.alias("piece"))
        .withColumn("at", F.row_number().over(turn)).where(F.col("at") <= SAMPLE_DOCS)
        .select("lang", "at", "piece").collect()
    )
    pieces: dict[str, list[str]] = {}
    for row in sorted(rows):
        pieces.setdefault(row.lang, []).append(letters(row.piece))
    return {lang: " ".join(x).encode() for lang, x in sorted(pieces.items()) if any(x)}


class Classifier:
    """Compresses a text once with each dictionary; the smallest result names the language."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = list(dictionaries)
        self.compressors = []
        for level in LEVELS:
            own = []
            for content in dictionaries.values():
                data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(level=level)
                own.append(zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False))
            self.compressors.append(own)

    def __call__(self, text: str | None) -> tuple[str, float]:
        """Language and margin, 0 to 1: by how much the second smallest result is larger.
        Equal sizes go to the first language by name."""
        if not self.languages or not any(map(str.isalpha, text or "")):
            return UNKNOWN, 0.0
        data = letters(text).encode()
        sizes = np.array([len(c.compress(data)) for c in self.compressors[bisect_left(UP_TO, len(data))]])
        best = int(sizes.argmin())
        if len(sizes) == 1:
            return self.languages[0], 1.0
        second = int(np.partition(sizes, 1)[1])
        return self.languages[best], float(1 - sizes[best] / second)


def identify_languages(
    docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", min_margin: float = MIN_MARGIN
) -> DataFrame:
    """The rows of ``docs`` with ``lang_pred``, ``score`` and ``rejected``.

    ``lang_pred`` is ``und`` where the text is null or has no letter; ``score`` is the margin of
    ``Classifier``. Rejected are ``und``, and margins below ``min_margin`` in texts of ``JUDGED``
    bytes or more. Only the text decides.
    Columns of ``docs`` with these names are replaced. Without dictionaries all is ``und``.
    """
    added = ("lang_pred", "score", "rejected")
    kept = [f for f in docs.schema.fields if f.name not in added]
    rows = docs.select(*(F.col(f"`{f.name}`").alias(f"_c{i}") for i, f in enumerate(kept)), F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([
        *(T.StructField(f"_c{i}", f.dataType) for i, f in enumerate(kept)),
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("_bytes", T.LongType()),
    ])
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(shared.value)
        for batch in batches:
            found = [classify(x.as_py()) for x in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.drop_columns(["_text"]).columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64()),
                 pc.binary_length(batch.column("_text")).cast(pa.int64())],
                schema.names,
            )

    found = rows.mapInArrow(predict, schema)
    return found.select(
        *(F.col(f"_c{i}").alias(f.name) for i, f in enumerate(kept)), "lang_pred", "score",
        ((F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_margin) & (F.col("_bytes") >= JUDGED)).alias("rejected"),
    )
