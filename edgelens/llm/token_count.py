"""Token counts of a unigram tokenizer without its tokens.

Method: an Aho-Corasick automaton enumerates the vocabulary pieces that end at each character,
and dynamic programming carries the best score and the number of tokens of the best path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the tokenizer: the sign for a space, and how much an unknown character scores
#: below the lowest piece.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Below every score: no path has reached a position yet.
NONE = float("-inf")
#: Distinct chunks whose counts a worker remembers; beyond it starts afresh.
REMEMBER = 400_000
_CHUNK = re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model in the order of their ids, the unknown piece
    first. Control pieces stay unreachable by text: they keep their place with a name that no
    text has."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [
        (f"\x00control{i}" if model.is_control(i) or model.is_unknown(i) else model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
    ]


class UnigramCounter:
    """Counts as a unigram tokenizer with byte fallback does that sees the text with a leading
    space sign and every space as that sign.

    The best path has the largest sum of scores. Of equal sums at a character, the piece that
    starts first wins; an unknown character is tried last, and only where no one-character piece
    ends. Unknown characters in a row count as one if their string is a piece, else as their
    UTF-8 bytes. No piece joins a letter to a following space sign, so that chunks between
    them are counted once and remembered.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        if any(re.search(rf"[^{SPACE}]{SPACE}", piece) for piece, _ in pieces):
            raise ValueError("a piece goes on after a space sign")
        self.pieces = {piece for piece, _ in pieces}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in reversed(pieces):  # of repeated pieces the first counts
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.known: dict[str, tuple[int, float]] = {}

    def chunk(self, text: str) -> tuple[int, float]:
        """Number of tokens and score of the best path through a chunk."""
        # at each position that is settled: score and tokens, and for a path that ends in unknown
        # characters where they start and the tokens before
        scores, counts, runs = [0.0], [0], {}
        settled, top, tokens = 0, NONE, 0
        # the automaton tells the pieces that end at a character longest first, so that a
        # one-character piece is the last of them and settles the position
        for end, (length, score) in self.automaton.iter(text):
            while settled < end:
                self._settle(text, scores, counts, runs, top, tokens)
                settled, top = settled + 1, NONE
            total = scores[-length] + score
            if total > top:
                top, tokens = total, counts[-length] + 1
            if length == 1:
                scores.append(top)
                counts.append(tokens)
                settled, top = end + 1, NONE
        while settled < len(text):
            self._settle(text, scores, counts, runs, top, tokens)
            settled, top = settled + 1, NONE
        return counts[-1], scores[-1]

    def _settle(
        self, text: str, scores: list[float], counts: list[int], runs: dict[int, tuple[int, int]], top: float, tokens: int
    ) -> None:
        """Settles a position where no one-character piece ends: the character before it may be
        unknown."""
        end = len(scores) - 1
        total = scores[-1] + self.unknown
        if total > top:
            run, before = runs[end + 1] = runs.get(end, (end, counts[-1]))
            unknown = text[run : end + 1]
            top, tokens = total, before + (1 if unknown in self.pieces else len(unknown.encode()))
        scores.append(top)
        counts.append(tokens)

    def __call__(self, text: str) -> tuple[int, float]:
        """Number of tokens and score of a text; none for an empty one."""
        if not text:
            return 0, 0.0
        count, score = 0, 0.0
        chunks = _CHUNK.findall(SPACE + text.replace(" ", SPACE))
        all_found = list(map(self.known.get, chunks))
        if None in all_found:
            all_found = map(self.counted, chunks)
        for tokens, found in all_found:
            count += tokens
            score += found
        return count, score

    def counted(self, chunk: str) -> tuple[int, float]:
        """As ``chunk``, remembered."""
        found = self.known.get(chunk)
        if found is None:
            found = self.chunk(chunk)
            if len(self.known) >= REMEMBER:
                self.known.clear()
            if len(chunk) <= 64:
                self.known[chunk] = found
        return found


_COUNTERS: dict[str, UnigramCounter] = {}


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_tokens`` and ``score`` (of the best path).

    Null and empty texts have no tokens and the score 0. Whole texts are counted. Repeated rows
    and null ids are counted each; further columns are ignored.
    """
    path = model_path or default_model()
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType()),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = UnigramCounter(vocabulary(path))
        counter = _COUNTERS[path]
        for batch in batches:
            found = [counter(x or "") for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())], schema.names
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, schema).withColumnRenamed("id", id_col)
