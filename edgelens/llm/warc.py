"""Zstandard-compressed WARC archives with a dictionary: writer and reader.

An archive starts with a skippable frame that holds the dictionary; after it each record is one
frame compressed with that dictionary, so any record can be decoded on its own.
"""

from __future__ import annotations

import hashlib
import struct
import urllib.parse
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgelens.llm.scratch import Scratch

#: Fixed values of the format: magic numbers of the dictionary frame and of a Zstandard frame,
#: and the profile of a record that repeats a payload.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this size are always stored.
LEAST_REVISIT = 100
#: Bytes of payload from which a dictionary is trained, its size, and those of an archive.
SAMPLE, DICTIONARY, ARCHIVE = 2_000_000, 32_768, 64_000_000
LEVEL = 3
_END = b"\r\n\r\n"


class WarcError(ValueError):
    """An archive or record that is not well formed."""


# ------------------------------------------------------------------------------------- writing


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, payload, digest, refers_to): ``refers_to`` is the smallest id with the payload,
    null for the record that stores it and for payloads below ``LEAST_REVISIT`` bytes.

    Null html is an empty payload. Rows that repeat the smallest id all store the payload, as do
    all rows of a payload whose ids are all null.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    repeated = (
        rows.where(F.octet_length("payload") >= LEAST_REVISIT)
        .groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("times"))
        .where("times > 1").drop("times")
    )
    return rows.join(repeated, "digest", "left").select(
        "id", "url", "payload", "digest", F.expr("IF(id <=> first_id, NULL, first_id)").alias("refers_to")
    )


def _record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    head += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + _END + block + _END


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes the rows of ``mark_revisits`` to archives in ``folder``, a URI that all executors
    reach; returns a lazy DataFrame (path, records). A task names its archives after its
    attempt, so a repeated task leaves files that no row names."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        rows = (r for b in batches for r in zip(*(b.column(c) for c in ("id", "url", "payload", "digest", "refers_to")), strict=True))
        done = False
        number = 0
        while not done:
            first, size = [], 0
            while size < SAMPLE and not done:
                row = next(rows, None)
                done = row is None
                if row is not None:
                    first.append(_record(*(x.as_py() for x in row)))
                    size += len(first[-1])
            if not first:
                return
            path = f"{root}/part-{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}.warc.zst"
            with store.open_output_stream(path) as out:
                dictionary = train_dictionary(first)
                out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                compress = zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True, write_content_size=True
                ).compress
                count = len(first)
                for record in first:
                    out.write(compress(record))
                first = []
                while size < ARCHIVE and not done:
                    row = next(rows, None)
                    done = row is None
                    if row is not None:
                        record = _record(*(x.as_py() for x in row))
                        out.write(compress(record))
                        count, size = count + 1, size + len(record)
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64())], ["path", "records"])

    return records.mapInArrow(write, "path string, records long")


def train_dictionary(records: list[bytes]) -> bytes:
    """A dictionary for the records: trained, or their own first bytes where they are too few."""
    try:
        return zstandard.train_dictionary(DICTIONARY, records, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(x[: max(64, DICTIONARY // len(records))] for x in records)[:DICTIONARY]


# ------------------------------------------------------------------------------------- reading


def read_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an archive, one frame at a time."""
    head = stream.read(8)
    magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    if magic != DICTIONARY_MAGIC:
        raise WarcError("no dictionary in the leading frame")
    data = stream.read(size)
    if len(data) < size:
        raise WarcError("truncated dictionary")
    if data[:4] == FRAME_MAGIC:
        data = zstandard.ZstdDecompressor().decompress(data)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data) if data else None)
    rest = b""
    while rest := rest or stream.read(1 << 20):
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not rest and not (rest := stream.read(1 << 20)):
                raise WarcError("truncated frame")
            try:
                parts.append(frame.decompress(rest))
            except zstandard.ZstdError as error:
                raise WarcError(f"damaged frame: {error}") from error
            rest = frame.unused_data
        yield parse_record(b"".join(parts))


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Checks a record's version, headers, length and end."""
    head, found, rest = data.partition(_END)
    lines = head.decode("utf-8", "strict").split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError("no record header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise WarcError(f"malformed header {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - headers.keys()
    if missing:
        raise WarcError(f"missing headers {sorted(missing)}")
    length = headers["content-length"]
    if not length.isdecimal() or len(rest) != int(length) + len(_END) or not rest.endswith(_END):
        raise WarcError("the block has another length than its header says")
    return headers, rest[: -len(_END)]


def _page(headers: dict[str, str], block: bytes) -> tuple:
    """id, url, type, digest, payload size, payload and the id referred to of a page's record."""
    http, found, payload = block.partition(_END)
    fields = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    size, digest = int(fields["Content-Length"]), headers["warc-payload-digest"].removeprefix("sha256:")
    name = lambda x: x.removeprefix("<urn:page:").removesuffix(">") or None
    if headers["warc-type"] == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise WarcError(f"payload of {headers['warc-record-id']} differs from its length or digest")
        refers_to = None
    elif headers["warc-type"] == "revisit" and not payload and headers.get("warc-profile") == REVISIT_PROFILE:
        refers_to, payload = name(headers["warc-refers-to"]), None
    else:
        raise WarcError(f"unexpected record {headers['warc-record-id']}")
    return name(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-type"], digest, size, payload, refers_to


def read_archives(archives: DataFrame, folder: str, id_type: T.DataType, payloads: bool = True) -> DataFrame:
    """Every page's record in the archives of ``archives`` (path, records): page_id, url,
    record_type, payload_digest, payload_bytes, payload (null for revisits, or if not asked for)
    and refers_to. A damaged archive, or another count than ``records``, raises an error."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                count, rows, size = 0, [], 0
                with store.open_input_stream(path) as stream:
                    for headers, block in read_records(stream):
                        *row, payload, refers_to = _page(headers, block)
                        rows.append((*row, payload if payloads else None, refers_to))
                        count, size = count + 1, size + len(block) * payloads + 200
                        if size > 8_000_000:
                            yield to_batch(rows)
                            rows, size = [], 0
                if count != records:
                    raise WarcError(f"{path}: {count} records instead of {records}")
                if rows:
                    yield to_batch(rows)

    types = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string())
    names = ("page_id", "url", "record_type", "payload_digest", "payload_bytes", "payload", "refers_to")
    to_batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], list(names))
    schema = "page_id string, url string, record_type string, payload_digest string, payload_bytes long, payload binary, refers_to string"
    n = max(1, archives.count())
    rows = archives.repartition(n, "path").mapInArrow(read, schema)
    return rows.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", payloads: bool = False) -> DataFrame:
    """Writes a record for every row of ``pages`` and reads the archives back (see
    ``mark_revisits``, ``write_archives`` and ``read_archives``). Further columns are ignored; an
    empty table gives no archive and an empty result."""
    scratch = Scratch(pages.sparkSession, "warc")
    folder = scratch.path("archives")
    marked = mark_revisits(pages, id_col, url_col, html_col)
    archives = scratch.keep(write_archives(marked, folder), "list")
    return read_archives(archives, folder, marked.schema["id"].dataType, payloads)


#: DuckDB SQL with the columns of the query: what the archives must hold.
ORACLE_SQL = f"""
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes < {LEAST_REVISIT} OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes < {LEAST_REVISIT} OR page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""
