"""Secrets in texts: fixed patterns, and character Markov models for what they miss."""

from __future__ import annotations

import hashlib
import importlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgelens.llm.sample import hashed_sample

#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "markov")
#: The base patterns and their least lengths.
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGNED = 12
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: What the models judge: runs of at least so many characters, with a digit and a letter.
LEAST_RUN = 20
_RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}")
#: A run is a secret if random strings explain it better by so many nats a character.
LEAST_RATIO = 0.7
#: Documents from which ordinary identifiers are learnt, code points of each, and random strings.
SAMPLE_DOCS, SAMPLE_CHARS, RANDOM_STRINGS, IDENTIFIERS = 1000, 4000, 4000, 8000
_MODULES = (
    "argparse", "asyncio", "builtins", "calendar", "codecs", "collections", "configparser", "datetime", "decimal", "email.message", "errno", "html.entities",
    "http", "http.client", "inspect", "io", "ipaddress", "json", "locale", "logging", "mimetypes", "os", "pathlib", "platform", "pydoc", "shutil", "signal",
    "socket", "sqlite3", "ssl", "stat", "statistics", "string", "subprocess", "tarfile", "threading", "token", "typing", "unicodedata", "unittest",
    "urllib.parse", "urllib.request", "xml.dom.minidom", "zipfile",
)
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{4,}")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, leftmost non-overlapping per kind."""
    found = []
    low = text.lower()
    if any(x in low for x in _KEYWORDS) or "K" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class MarkovModels:
    """Two chains of character transitions, of random strings and of ordinary identifiers."""

    def __init__(self, random_strings: Iterable[str], ordinary: Iterable[str]):
        self.ratio = self._chain(random_strings) - self._chain(ordinary)

    @staticmethod
    def _chain(strings: Iterable[str]) -> np.ndarray:
        """Log probabilities of the next ASCII character, with a small count for unseen pairs."""
        counts = np.full((128, 128), 0.05)
        for string in strings:
            codes = np.frombuffer(string.encode("ascii"), np.uint8)
            np.add.at(counts, (codes[:-1], codes[1:]), 1)
        return np.log(counts / counts.sum(1, keepdims=True))

    def __call__(self, run: str) -> float:
        """Log-likelihood ratio, random over ordinary, a transition."""
        codes = np.frombuffer(run.encode("ascii"), np.uint8)
        return float(self.ratio[codes[:-1], codes[1:]].mean())


def random_strings(count: int = RANDOM_STRINGS, seed: int = 11) -> list[str]:
    """Labelled samples of random strings in the alphabets that keys are written in."""
    rng = np.random.default_rng(seed)
    digits, lower = "0123456789", "abcdefghijklmnopqrstuvwxyz"
    base62 = digits + lower + lower.upper()
    alphabets = (base62, base62 + "+/", base62 + "-_", digits + lower, lower.upper() + digits)
    return ["".join(rng.choice(list(alphabets[i % len(alphabets)]), int(rng.integers(20, 64)))) for i in range(count)]


def library_words() -> list[str]:
    """The words in the names that modules of Python's library hold."""
    names = (name for module in _MODULES for name in dir(importlib.import_module(module)))
    found = {x.lower() for name in names for x in re.findall(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}", name)}
    return sorted(found)


def ordinary_identifiers(words: list[str], count: int = IDENTIFIERS, seed: int = 12) -> list[str]:
    """Labelled samples of ordinary identifiers, as programs, paths, links and logs write them:
    words, joined, with counters, versions, dates, and the numbers that machines
    append; half of the words are those of Python's own library, whose names are real ones."""
    rng = np.random.default_rng(seed)
    library = library_words()
    # as many of either origin
    plain = [x.lower() for x in words if x.isalpha()][: len(library)] + library

    def number(digits: int) -> str:
        return str(rng.integers(10 ** int(rng.integers(1, digits + 1))))

    def hexadecimal(n: int) -> str:
        return "".join(rng.choice(list("0123456789abcdef"), n))

    def word() -> str:
        return plain[int(rng.integers(len(plain)))]

    def some(join: str, least: int = 2) -> str:
        return join.join(word() for _ in range(int(rng.integers(least, 6))))

    def camel() -> str:
        return "".join(word().capitalize() for _ in range(int(rng.integers(2, 6))))

    def day(join: str = "-") -> str:
        return join.join((str(rng.integers(1990, 2040)), f"{rng.integers(1, 13):02d}", f"{rng.integers(1, 32):02d}"))

    def clock(join: str = "-") -> str:
        return join.join(f"{rng.integers(x):02d}" for x in (24, 60, 60))

    forms = (
        lambda: some("_") + number(4), lambda: some("-") + "-" + number(4), lambda: camel() + number(4),
        lambda: camel()[:1].lower() + camel() + number(2), lambda: some("/", 3) + number(3) + "/" + some("_", 1),
        lambda: some("/", 2) + "/" + some("-", 1) + "-" + number(2) + "/" + number(3),
        lambda: word() + "_" + word() + "=" + some("_", 1) + str(rng.integers(1990, 2040)) + "_" + word(),
        lambda: word() + "=" + number(5) + "-" + word() + "=" + some("-"), lambda: some("_", 1) + "_" + day() + "T" + clock(),
        lambda: day("") + "_" + clock("") + "_" + some("-", 1), lambda: day() + "/" + some("_"),
        lambda: "-".join(hexadecimal(n) for n in (8, 4, 4, 4, 12)), lambda: some("-") + "-" + hexadecimal(10) + "-" + hexadecimal(5),
        lambda: some("_").upper() + "_" + number(4), lambda: some("-", 1) + "-v" + number(2) + "-" + number(2) + "-" + number(3),
        lambda: word()[:3].upper() + "-" + number(8) + "-" + number(8), lambda: some("--", 2) + number(2),
    )
    return [forms[i % len(forms)]() for i in range(count)]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> MarkovModels:
    """Models from generated random strings and from the ordinary words and identifiers of a
    bounded sample: the ``SAMPLE_DOCS`` documents with the smallest hash of their id, up to
    ``SAMPLE_CHARS`` code points of each, without what the base patterns find. Null texts are left
    out, rows of one id count once; an empty table leaves the labelled identifiers alone."""
    ordinary = []
    for whole in hashed_sample(docs, id_col, F.substring(text_col, 1, SAMPLE_CHARS), SAMPLE_DOCS):
        text = list(whole)
        for start, _, end in base_spans(whole):
            text[start:end] = " " * (end - start)
        ordinary += _WORD.findall("".join(text))
    return MarkovModels(random_strings(), ordinary + ordinary_identifiers(ordinary))


def added_spans(text: str, models: MarkovModels, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of runs that the models call random and that touch no base span."""
    found = []
    for m in _RUN.finditer(text):
        run = m.group()
        if not any(map(str.isdigit, run)) or not any(map(str.isalpha, run)):
            continue
        if models(run) >= LEAST_RATIO and all(end <= m.start() or m.end() <= start for start, _, end in base):
            found.append((m.start(), 3, m.end()))
    return found


def scan_secrets(docs: DataFrame, models: MarkovModels, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and ``found``, an array of (kind, start, end) in code
    points, the end exclusive, by start and then kind.

    Null and empty texts have no spans. Repeated rows are scanned each; further columns are
    ignored. The base patterns are always kept; the models only add ``markov`` spans.
    """
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    id_type = docs.schema[id_col].dataType
    shared = docs.sparkSession.sparkContext.broadcast(models)
    arrow_span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                rows.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(base + added_spans(text, models, base))])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, arrow_span)], ["id", "found"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", id_type), T.StructField("found", span)])
    return rows.mapInArrow(scan, schema).withColumnRenamed("id", id_col)


def span_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, the SHA-256 of the base spans, and all spans as text."""
    joined = lambda array: f"array_join(transform({array}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    return found.select(
        id_col,
        *(F.expr(f"CAST(size(filter(found, x -> x.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS[:3]),
        F.expr(f"sha2({joined("filter(found, x -> x.kind <> 'markov')")}, 256)").alias("base_sha256"),
        F.expr(joined("found")).alias("spans"),
    )


def digest_of(spans: list[tuple[int, int, int]]) -> str:
    """The same SHA-256 for spans of ``base_spans``."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()
