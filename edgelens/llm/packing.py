"""Packing tokenised documents into windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import json
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgelens.llm.scratch import Scratch

CAPACITY = 4096
#: Ends every document.
END_ID = 2
#: Windows of a block of pieces that are packed together.
BLOCK_WINDOWS = 128
#: Short pieces are bundled up to this many tokens before they are packed.
BUNDLE = 64
#: Distinct chunks of text whose ids a worker remembers; beyond it starts afresh.
REMEMBER = 1_000_000
#: Texts encoded together.
TOGETHER = 128


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """Deals the tokens of all documents to sequences of at most ``capacity`` tokens.

    A document is its ids (no special tokens added; null text: empty) and then ``END_ID``. It is
    cut at every multiple of ``capacity``. Full pieces are sequences of their own. The others are
    dealt to blocks by a hash of the row and place; in a block, largest differencing makes partial partitions into m
    windows of near-equal sums, where m is the least number that could hold them and rises by
    one while a window exceeds the capacity. What a window lacks is padding.

    Returns one row per piece: the id, ``start``, ``length``, ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id`` and ``offset``.
    Repeated rows and null ids are documents like any other; further columns are ignored. An
    empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    # numbered, so that repeated rows go to different blocks; the table that is written fixes the numbers
    docs = docs.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text")
    )
    pieces = scratch.keep(_pieces(docs, tokenizer_path or default_tokenizer(), capacity), "pieces")
    partial = pieces.where(F.col("length") < capacity).agg(F.sum("length")).first()[0] or 0
    blocks = max(1, partial // (capacity * BLOCK_WINDOWS))
    key = F.pmod(F.xxhash64("row", "start"), F.lit(blocks))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("row", "start")])
        lengths = table.column("length").to_numpy()
        sequence, offset, count = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
        full = lengths == capacity
        for window in windows(np.where(full, 0, lengths), capacity):
            sequence[window] = count
            offset[window] = np.cumsum(lengths[window]) - lengths[window]
            count += 1
        sequence[full] = count + np.arange(int(full.sum()))
        first = table.column("block")[0].as_py() << 32
        return (
            table.drop_columns(["block", "row"])
            .append_column("sequence_id", pa.array(sequence + first))
            .append_column("offset", pa.array(offset))
        )

    kept = [f for f in pieces.schema.fields if f.name != "row"]
    schema = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return pieces.withColumn("block", key).groupBy("block").applyInArrow(pack, schema).withColumnRenamed("id", id_col)


# ------------------------------------------------------------------------------- tokenisation

_SPACES = bytes(32 if 9 <= i <= 13 else i for i in range(256))
_LOWER = bytes(i + 32 if 65 <= i <= 90 else _SPACES[i] for i in range(256))
#: Small letters up to the Cyrillic ones that normalising leaves as they are, whatever their neighbours.
_LETTERS = "".join(
    c for c in map(chr, range(ord("a"), 0x530)) if c.isalpha() and c.lower() == c and unicodedata.is_normalized("NFC", c)
)
#: Chunks of these letters and of ASCII digits and marks are cut here as ``_SPLIT`` cuts them.
_CUTTABLE = re.compile(f"[!-@\\[-`{{-~{_LETTERS}]+")
_CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")
#: Without the apostrophe, which may begin a suffix.
_MARKS = bytes(i for i in range(33, 127) if not chr(i).isalnum() and chr(i) != "'")
#: The characters that stand for bytes in the model, by the characters of those code points.
_BYTES = {i: 256 + n for n, i in enumerate([*range(33), *range(127, 161), 173])}
_ENCODERS: dict[str, Callable[[list[str]], list[bytes]]] = {}

#: How a tokenizer is set up whose chunks may be encoded one by one. It lower-cases,
#: drops white space and never joins letters with what is no letter.
_LOWERED = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_SPLIT = {
    "type": "Split",
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}


def in_chunks(path: str) -> bool:
    """Whether texts may be encoded chunk by chunk between white space, A-Z as a-z."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    steps = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
    marks = all(x["special"] and x["content"].startswith("<|") and not x["normalized"] for x in told["added_tokens"])
    return told["normalizer"] == _LOWERED and steps[:1] == [_SPLIT] and told["post_processor"] is None and marks


def encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Encodes texts to their ids, without special tokens added, as little-endian 32-bit numbers.

    With a tokenizer that is set up for it (``in_chunks``), each chunk between ASCII white space,
    with A-Z as a-z, is encoded once and remembered. A chunk that needs no normalising is cut into
    words, digits and marks, which are remembered too; the tokenizer takes any other whole. With
    any other tokenizer, texts are encoded as they are.
    """
    if path in _ENCODERS:
        return _ENCODERS[path]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def plainly(texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    if not in_chunks(path):
        _ENCODERS[path] = plainly
        return plainly
    tokenize = tokenizer.model.tokenize  # each look-up of the model copies it

    def encode_word(word: bytes) -> bytes:
        """A word, digit or run of marks, as the tokenizer cuts and normalises them."""
        told = tokenize(word.decode() if word.isascii() else word.decode("latin-1").translate(_BYTES))
        return array("I", [x.id for x in told]).tobytes()

    class Known(dict):
        """Ids by chunk, encoded when first asked for; long chunks are not remembered."""

        def __missing__(self, chunk: bytes) -> bytes:
            word = chunk.rstrip(_MARKS)
            if word.isalpha() and word.islower():  # ASCII letters, and the marks that end most chunks
                ids = self[word] + self[chunk[len(word) :]] if len(word) < len(chunk) else encode_word(word)
            elif "<|" not in (text := chunk.decode()) and _CUTTABLE.fullmatch(text):
                words = [x.encode() for x in _CUT.findall(text)]
                ids = b"".join([self[x] if len(words) > 1 else encode_word(x) for x in words])
            else:
                ids = plainly([text])[0]
            if len(chunk) <= 64:
                self[chunk] = ids
            return ids

    known = Known()

    def encode(texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if len(known) > REMEMBER:
                known.clear()
            # a special token is written in lower case; nothing else may become one
            chunks = text.encode().translate(_SPACES if "<|" in text else _LOWER).split(b" ")
            out.append(b"".join(map(known.__getitem__, chunks)))
        return out

    _ENCODERS[path] = encode
    return encode


def _encoded(texts: pa.Array, encode: Callable[[list[str]], list[bytes]]) -> Iterator[bytes]:
    """The ids of each text, a few texts at a time: their chunks are held together."""
    for at in range(0, len(texts), TOGETHER):
        yield from encode([x or "" for x in texts.slice(at, TOGETHER).to_pylist()])


def _pieces(docs: DataFrame, path: str, capacity: int) -> DataFrame:
    """Rows (id, row, start, length, ids_crc32, doc_tokens)."""
    schema = T.StructType([
        T.StructField("id", docs.schema["id"].dataType),
        *(T.StructField(x, T.LongType()) for x in ("row", "start", "length", "ids_crc32", "doc_tokens")),
    ])
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            at, starts, lengths, sums, totals = [], [], [], [], []
            for i, found in enumerate(_encoded(batch.column("text"), encode)):
                ids = memoryview(found + end)
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    at.append(i)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(total)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(at, pa.int64())) for c in ("id", "row")), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))], schema.names
            )

    return docs.mapInArrow(cut, schema)


# ------------------------------------------------------------------------------- differencing


def windows(lengths: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Indices of ``lengths`` by window; lengths of 0 are left out."""
    order = [int(i) for i in np.argsort(-lengths, kind="stable") if lengths[i]]
    if not order:
        return []
    bundles: list[list[int]] = []
    size = BUNDLE
    for i in order:
        if lengths[i] >= BUNDLE or size + lengths[i] > BUNDLE:
            bundles.append([])
            size = 0
        bundles[-1].append(i)
        size = size + int(lengths[i]) if lengths[i] < BUNDLE else BUNDLE
    sizes = [int(lengths[x].sum()) for x in bundles]
    count = -(-sum(sizes) // capacity)
    while True:
        parts = differencing(sizes, count)
        if all(sum(sizes[i] for i in x) <= capacity for x in parts):
            return [np.array(sorted(j for i in x for j in bundles[i])) for x in parts if x]
        count += 1


def differencing(sizes: list[int], count: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``count`` parts of near-equal sums.

    Every number starts as a partial partition with one part filled. The two partial partitions
    with the largest differences between their parts are merged, the largest part of one with the
    smallest of the other, until one is left. Ties go by age.
    """
    heap = [(-size, i, None) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    age = len(sizes)

    def opened(entry: tuple) -> tuple[np.ndarray, list[list[int]]]:
        if entry[2] is not None:
            return entry[2]
        sums, parts = np.zeros(count, np.int64), [[] for _ in range(count)]
        sums[-1], parts[-1] = -entry[0], [entry[1]]
        return sums, parts

    while len(heap) > 1:
        (a, in_a), (b, in_b) = opened(heapq.heappop(heap)), opened(heapq.heappop(heap))
        sums = a + b[::-1]
        order = np.argsort(sums, kind="stable")
        joined = [x + y for x, y in zip(in_a, reversed(in_b), strict=True)]
        sums, parts = sums[order], [joined[i] for i in order]
        heapq.heappush(heap, (int(sums[0] - sums[-1]), age, (sums, parts)))
        age += 1
    return opened(heap[0])[1] if heap else [[] for _ in range(count)]
