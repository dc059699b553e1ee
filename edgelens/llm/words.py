"""Words and shingles of whole texts as 64-bit hashes, vectorised over Arrow's text buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; a longer word or document is still taken whole.
BLOCK = 1 << 20

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_CODES = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64)
_CODES[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 2**64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(BLOCK, 1 << max(1, n - 1).bit_length())
    if size not in _POWERS:
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _UNBASE, np.uint64)
        up[0] = down[0] = 1
        if size > BLOCK:
            return np.cumprod(up), np.cumprod(down)
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all the others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts_at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in UTF-8 bytes and where they start.

    Words are runs of bytes outside 0x20 and 0x09-0x0D; A-Z counts as a-z. A word also ends
    where a document starts (``starts_at``).
    """
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    word = ~_SEPARATOR[data]
    fresh = np.ones(len(data) + 1, dtype=bool)
    fresh[1:-1] = ~word[:-1]
    if starts_at is not None:
        fresh[starts_at[starts_at < len(data)]] = True
    starts = np.flatnonzero(word & fresh[:-1])
    ends = np.ones(len(data), dtype=bool)
    ends[:-1] = ~word[1:] | fresh[1:-1]
    ends = np.flatnonzero(word & ends)
    up, down = _powers(len(data))
    sums = np.cumsum(_CODES[data] * up[: len(data)], dtype=np.uint64)
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    return mix((sums[ends] - before) * down[starts]), starts


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """Cuts a long text at separators into pieces of about ``BLOCK`` bytes."""
    at = 0
    while len(data) - at > BLOCK:
        cut = np.flatnonzero(_SEPARATOR[data[at + BLOCK // 2 : at + BLOCK]])
        if len(cut):
            end = at + BLOCK // 2 + int(cut[-1])
        else:
            rest = np.flatnonzero(_SEPARATOR[data[at + BLOCK :]])
            end = at + BLOCK + int(rest[0]) if len(rest) else len(data)
        yield data[at:end]
        at = end
    yield data[at:]


def words_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order; none for null."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, count=len(texts) + 1, offset=8 * texts.offset)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK, "right")) - 1)
        if end == at + 1 and bounds[end] - bounds[at] > BLOCK:
            whole = data[bounds[at] : bounds[end]]
            yield np.concatenate([word_hashes(x)[0] for x in _pieces(whole)])
        else:
            cuts = bounds[at : end + 1] - bounds[at]
            hashes, starts = word_hashes(data[bounds[at] : bounds[end]], cuts)
            cuts = np.searchsorted(starts, cuts)
            yield from (hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))
        at = end


_STEPS = mix(np.arange(1, 6, dtype=np.uint64)) | np.uint64(1)


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct 48-bit hashes of the shingles of ``size`` words.

    Fewer words count as one shingle, none as no shingle. 48 bits keep the chance that two
    shingles of one pair of documents collide near n**2 / 2**49.
    """
    n = len(words)
    if not n:
        return words
    steps = _STEPS if size == 5 else mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    if n < size:
        return mix((words * steps[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n)) >> np.uint64(16)
    sums = words[: n - size + 1] * steps[0]
    for j in range(1, size):
        sums = sums + words[j : n - size + 1 + j] * steps[j]
    return np.unique(mix(sums) >> np.uint64(16))
