"""Golomb-Rice coding of sorted whole numbers, vectorised over numpy arrays."""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QB")


def encode(values: np.ndarray) -> bytes:
    """Codes sorted non-negative numbers below 2**63 (repeats allowed) as their differences.

    The quotient of each difference is written in unary and its ``k`` low bits as they are,
    with ``k`` from the mean difference: about ``k + 1.5`` bits a number for random values.
    """
    values = np.asarray(values, dtype=np.uint64)
    if not len(values):
        return _HEAD.pack(0, 0)
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = max(1, int(values[-1]) // len(values))
    k = max(0, mean.bit_length() - 1)
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + len(values), dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    low = np.zeros((len(values), k), dtype=np.uint8)
    for bit in range(k):
        low[:, bit] = (gaps >> np.uint64(bit)) & np.uint64(1)
    bits = np.packbits(unary, bitorder="little").tobytes()
    return _HEAD.pack(len(values), k) + bits + np.packbits(low, bitorder="little").tobytes()


def decode(data: bytes) -> np.ndarray:
    """The numbers that ``encode`` was given."""
    count, k = _HEAD.unpack_from(data)
    if not count:
        return np.empty(0, dtype=np.uint64)
    tail = (count * k + 7) // 8
    packed = np.frombuffer(data, dtype=np.uint8, offset=_HEAD.size)
    unary = np.unpackbits(packed[: len(packed) - tail], bitorder="little")
    ends = np.flatnonzero(unary)[:count]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        low = np.unpackbits(packed[len(packed) - tail :], bitorder="little", count=count * k)
        for bit in range(k):
            gaps |= low[bit::k].astype(np.uint64) << np.uint64(bit)
    return np.cumsum(gaps, dtype=np.uint64)
