"""Bitmaps of hashes with a fixed largest size, safe to send to every executor."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest bitmap: 2**26 bits, 8 MB.
MAX_BITS = 26


class HashFilter:
    """One bit per hash value modulo the size. Says yes to every hash it was built from and to
    few others; a table too large for ``MAX_BITS`` only raises the share of these."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(64 * len(words) - 1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.astype(np.uint64) & self.mask
        word = self.words[(at >> np.uint64(6)).astype(np.int64)]
        return (word >> (at & np.uint64(63))) & np.uint64(1) != 0


def bits_for(count: int, per_item: int = 32) -> int:
    """log2 of the size that gives each item ``per_item`` bits, within the bound."""
    return min(MAX_BITS, max(10, (per_item * max(1, count) - 1).bit_length()))


def build_filter(hashes: DataFrame, column: str, bits: int) -> HashFilter:
    """The bitmap of a bigint column; at most 2**(bits - 6) partial sums reach the driver."""
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        hashes.where(F.col(column).isNotNull())
        .select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, CAST({column} & 63 AS INT))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return HashFilter(words)
