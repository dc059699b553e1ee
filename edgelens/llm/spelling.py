"""Spelling variants: words one edit apart, found by products of letter-count blocks.

One inserted, deleted or replaced letter moves the letter counts of a word by a squared distance
of two at most. Words are put in blocks of equal counts over ``CLASSES`` groups of letters, so a
block holds words of one length, and a variant lies in its own block or in one of those next to
it, of this or an adjacent length. A NumPy product of two blocks' letter counts (their Gram
matrix) gives all squared distances at once; the pairs at two or less are verified letter by letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgelens.llm.crc32_sql import CRC_TABLE, crc32
from edgelens.llm.scratch import Scratch

#: What a word is, and which words are compared.
RUN = r"[A-Za-z\x{C0}-\x{FF}]+"
LEAST_LENGTH, LEAST_COUNT, DAMAGED = 5, 3, 97
#: A near word is a form if it is at least so many times as frequent.
TIMES = 2
#: Letters are counted in 32 columns, by code point; a column belongs to one of 8 classes.
COLUMNS, CLASSES = 32, 8
#: A class count is kept in 7 bits; a larger one counts as the largest, which only makes blocks larger.
BITS = 7
MOST = (1 << BITS) - 1
#: A tile is a part of a block, of so many words and letters about; products go by tiles.
TILE_WORDS, TILE_LETTERS = 1024, 1 << 18
#: Other words multiplied at once.
SLICE = 4096


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def corpus_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damaged: int = DAMAGED) -> DataFrame:
    """(word, n) of the runs of letters of all texts, A-Z lower-cased, with a few misspelt: a run
    loses one letter where ``damaged`` divides the CRC-32 of ``<id>:<run>`` (0: none do).

    A null text has no words, a null id counts as empty. Repeated rows count again.
    """
    runs = docs.select(
        F.coalesce(_named(id_col).cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(_named(text_col), F.lit(f"({RUN})"))).alias("_run"),
    )
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.when(F.col("_run").rlike(r"[\x{C0}-\x{DE}]"), F.translate("_run", letters, letters.lower()))
    runs = runs.withColumn("_run", plain.otherwise(F.lower("_run")))
    word = F.col("_run")
    if damaged:
        runs = runs.withColumn("_h", F.crc32(F.concat_ws(":", "_id", "_run").cast("binary")))
        place = (F.col("_h") % F.char_length("_run")).cast("int")
        rest = F.concat(F.substring("_run", F.lit(1), place), F.substring("_run", place + 2, F.char_length("_run")))
        word = F.when(F.col("_h") % damaged == 0, rest).otherwise(word)
    return runs.groupBy(word.alias("word")).agg(F.count("*").alias("n"))


def _codes(text: str) -> np.ndarray:
    """Code points of words of letters up to U+00FF, each followed by a space."""
    return np.frombuffer((text + " ").encode("latin-1"), np.uint8)


class Words:
    """Words as arrays: where each starts, its length, and its letter counts."""

    def __init__(self, text: str):
        self.codes = _codes(text)
        ends = np.flatnonzero(self.codes == 32)
        self.starts = np.concatenate([[0], ends[:-1] + 1])
        self.lengths = ends - self.starts
        letter = self.codes != 32
        owner = np.repeat(np.arange(len(ends)), self.lengths)
        cell = owner * COLUMNS + self.codes[letter] % COLUMNS
        # below 2**24 a float holds every product exactly
        kind = np.float32 if self.lengths.max(initial=0) < 4096 else np.float64
        self.counts = np.bincount(cell, minlength=len(ends) * COLUMNS).reshape(len(ends), COLUMNS).astype(kind)
        self.squares = (self.counts**2).sum(1)

    def __len__(self) -> int:
        return len(self.starts)

    def classes(self) -> np.ndarray:
        """The block key of each word: its class counts, 7 bits each."""
        counts = self.counts.reshape(len(self), COLUMNS // CLASSES, CLASSES).sum(1)
        counts = np.minimum(counts, MOST).astype(np.int64)
        return (counts << (BITS * np.arange(CLASSES))).sum(1)


def _one_edit(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether words ``i`` of ``a`` and ``j`` of ``b`` are exactly one edit apart."""
    swap = a.lengths[i] > b.lengths[j]
    at_a, at_b = a.starts[i], b.starts[j] + len(a.codes)
    codes = np.concatenate([a.codes, b.codes])
    short, long = np.where(swap, at_b, at_a), np.where(swap, at_a, at_b)
    n = np.minimum(a.lengths[i], b.lengths[j])
    gap = np.abs(a.lengths[i] - b.lengths[j])
    found = np.zeros(len(i), bool)
    for size in np.unique(n):
        rows = np.flatnonzero((n == size) & (gap <= 1))
        step = max(1, (1 << 22) // max(1, int(size)))
        for part in (rows[k : k + step] for k in range(0, len(rows), step)):
            reach = np.arange(size)
            x = codes[short[part, None] + reach]
            same = x == codes[long[part, None] + reach]
            prefix = np.cumprod(same, 1, dtype=bool).sum(1)
            tail = x == codes[long[part, None] + gap[part, None] + reach]
            suffix = np.cumprod(tail[:, ::-1], 1, dtype=bool).sum(1)
            replaced = (gap[part] == 0) & (prefix + suffix == size - 1)
            found[part] = replaced | ((gap[part] == 1) & (prefix + suffix >= size))
    return found


def near_pairs(home: Words, other: Words, itself: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words one edit apart; within ``itself`` each pair once."""
    left, right = [], []
    for at in range(0, len(other), SLICE):
        end = min(at + SLICE, len(other))
        distances = home.squares[:, None] + other.squares[None, at:end] - 2 * (home.counts @ other.counts[at:end].T)
        close = distances <= 2
        if itself:
            close &= np.arange(at, end) > np.arange(len(home))[:, None]
        i, j = np.nonzero(close)
        j += at
        keep = _one_edit(home, i, other, j)
        left.append(i[keep])
        right.append(j[keep])
    return np.concatenate(left), np.concatenate(right)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        if words:
            keys = Words(" ".join(words)).classes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], ["word", "n", "key"])


def _homes(key: str) -> str:
    """SQL for the blocks in which a block of ``key`` is compared: its own, one letter less in a
    class, or one less there and one more in a later class. Each two blocks meet in one of them."""
    count = [f"(shiftright({key}, {BITS * c}) & {MOST})" for c in range(CLASSES)]
    homes = [key]
    for c in range(CLASSES):
        less = f"{key} - {1 << BITS * c}L"
        homes.append(f"if({count[c]} > 0, {less}, NULL)")
        for d in range(c + 1, CLASSES):
            homes.append(f"if({count[c]} > 0 AND {count[d]} < {MOST}, {less} + {1 << BITS * d}L, NULL)")
    return f"filter(array({', '.join(homes)}), h -> h IS NOT NULL)"


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    at = column.offsets.to_numpy()
    values = column.values.to_numpy()
    return [values[start:end] for start, end in zip(at[:-1], at[1:], strict=True)]


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [batch.column(name).to_pylist() for name in ("words", "other_words", "itself")]
        counts = [_lists(batch.column(name)) for name in ("counts", "other_counts")]
        for words, other_words, itself, n, other_n in zip(*texts, *counts, strict=True):
            home = Words(words)
            if itself:
                other, other_words, other_n = home, words, n
            else:
                other = Words(other_words)
            i, j = near_pairs(home, other, itself)
            if len(i):
                mine, others = np.array(words.split(" "), object), np.array(other_words.split(" "), object)
                word, near = np.concatenate([mine[i], others[j]]), np.concatenate([others[j], mine[i]])
                near_n = np.concatenate([other_n[j], n[i]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(near_n)], ["word", "near", "near_n"]
                )


def variant_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, near, near_n): every two words of (word, n) exactly one edit apart, both ways round.

    ``words`` holds each word once. Every block is compared with the blocks next to it, tile by
    tile: no task holds more than a tile and as many tiles as there are neighbours.
    """
    keyed = scratch.keep(words.mapInArrow(_key_batches, "word string, n bigint, key bigint"), "keyed")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size"), F.max(F.char_length("word")).alias("length"))
    by_words = F.ceil(F.col("size") / TILE_WORDS)
    by_letters = F.ceil(F.col("size") * F.col("length") / TILE_LETTERS)
    sizes = sizes.select("key", F.greatest(by_words, by_letters).alias("tiles"))
    tile = F.pmod(F.xxhash64("word"), "tiles").alias("tile")
    # a tile's words, a few letters each, as one string
    tiles = keyed.join(sizes, "key").groupBy("key", tile).agg(
        F.sort_array(F.collect_list(F.struct("word", "n"))).alias("rows"), F.first("tiles").alias("tiles")
    )
    tiles = scratch.keep(
        tiles.select("key", "tile", "tiles", F.expr("array_join(rows.word, ' ')").alias("words"), F.expr("rows.n").alias("counts")),
        "tiles",
    )
    known = tiles.groupBy("key").agg(F.first("tiles").alias("home_tiles"))
    # which tiles meet: within a block, each two of them once
    meets = (
        tiles.select("key", "tile", F.expr(f"explode({_homes('key')})").alias("home"))
        .join(known.withColumnRenamed("key", "home"), "home")
        .withColumn("home_tile", F.expr("explode(sequence(0L, home_tiles - 1L))"))
        .where("home <> key OR home_tile < tile")
    )
    payload = tiles.select("key", "tile", "words", "counts")
    others = (
        meets.join(payload, ["key", "tile"])
        .groupBy("home", "home_tile", "tile")
        .agg(F.collect_list(F.struct("words", "counts")).alias("others"))
    )
    # one row compares a tile with itself, the rest with one tile of each neighbour
    alone = payload.selectExpr("key AS home", "tile AS home_tile", "-1L AS tile", "array() AS others")
    alone = alone.withColumn("others", F.col("others").cast(others.schema["others"].dataType))
    work = alone.unionByName(others).join(payload.selectExpr("key AS home", "tile AS home_tile", "words", "counts"), ["home", "home_tile"])
    work = work.select(
        "words", "counts", (F.col("tile") == -1).alias("itself"),
        F.expr("array_join(others.words, ' ')").alias("other_words"), F.expr("flatten(others.counts)").alias("other_counts"),
    )
    return work.mapInArrow(_pair_batches, "word string, near string, near_n bigint")


def spelling_variants(
    words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, scratch: Scratch | None = None
) -> DataFrame:
    """The variant group of each word: (word, form, root, n, n_near, form_n).

    ``words`` is (word, n), each word once, of letters up to U+00FF. Words of ``least_length``
    letters and ``least_count`` occurrences are compared and returned. ``n_near`` counts the
    words exactly one edit apart; ``form`` is the most frequent of them (ties: the first by code
    point) if at least twice as frequent as the word, else null; ``root`` is where the forms
    lead, the word itself if it has none. Counts at least double from form to form, so chains
    end. Null words go; an empty table gives an empty result.
    """
    scratch = scratch or Scratch(words.sparkSession, "spelling")
    kept = words.where((F.char_length("word") >= least_length) & (F.col("n") >= least_count))
    kept = scratch.keep(kept.select("word", F.col("n").cast("long")), "words")
    best = variant_pairs(kept, scratch).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    joined = kept.join(best, "word", "left")
    is_form = -F.col("best.less") >= TIMES * F.col("n")
    formed = scratch.keep(
        joined.select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    # words with a form jump to the form's own root so far: twice as far in each round
    jumps = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("_ahead"))
        moved = jumps.join(ahead, "root", "left").select("word", F.coalesce("_ahead", "root").alias("root"), F.col("_ahead").isNotNull().alias("moved"))
        moved = scratch.keep(moved, "roots")
        jumps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    found = formed.join(jumps, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _alphabet(first: int, last: int) -> str:
    return "".join(map(chr, range(first, last + 1)))


#: The query's rows: CRC-32 by a table made from its polynomial, near words by what deleting one
#: letter of each leaves.
ORACLE_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
           unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
    FROM documents
),
lowered AS (
    SELECT id, translate(run, '{_alphabet(65, 90)}', '{_alphabet(97, 122)}') AS run, count(*) AS n FROM runs GROUP BY ALL
),
hashed AS (
    SELECT run, n, {crc32("id || ':' || run")} AS h
    FROM lowered, crc_table
),
words AS (
    SELECT word, sum(n)::BIGINT AS n
    FROM (SELECT n, CASE WHEN h % {DAMAGED} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
    WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
),
holes AS (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i, word[:i - 1] || word[i + 1:] AS rest FROM words
),
pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word
),
best AS (
    SELECT word, count(*) AS n_near, max(near_n) AS form_n FROM pairs GROUP BY word
),
first_best AS (SELECT p.word, min(near) AS form FROM pairs p JOIN best b ON p.word = b.word AND near_n = form_n GROUP BY ALL),
formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN form_n >= {TIMES} * w.n THEN f.form END AS form,
           CASE WHEN form_n >= {TIMES} * w.n THEN form_n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word LEFT JOIN first_best f ON f.word = w.word
),
chains AS (
    SELECT word, word AS root FROM formed
    UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
),
roots AS (
    SELECT c.word, root FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""
