"""Word and shingle hashes of many texts at once, as numpy arrays.

A word is a run of bytes outside ASCII white space. Texts are
taken as the UTF-8 bytes of an Arrow array, in slices of bounded size, so that
memory follows one slice or one long text, never a whole partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PRIME = np.uint64(0x9E3779B97F4A7C13)
_seeded = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _seeded.integers(0, 1 << 64, 256, dtype=np.uint64)
_BYTE[_SPACE] = 0
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_PLACE = _seeded.integers(0, 1 << 64, 16, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 1024), _PRIME, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of its texts) of consecutive slices; null is empty."""
    if len(texts) == 0:
        return
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, raw[at[first]:at[last]], at[first:last + 1].astype(np.int64) - int(at[first])
        first = last


def in_words(raw: np.ndarray) -> np.ndarray:
    """Which bytes are outside white space."""
    return ~_SPACE[raw]


def byte_table(solid: np.ndarray, fold: bool = True) -> np.ndarray:
    """Value of every byte in a word's hash, 0 for bytes that part words."""
    return np.where(solid, _FOLDED if fold else _BYTE, np.uint64(0))


def word_starts(raw: np.ndarray, at: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """First byte of every word."""
    if len(raw) == 0:
        return np.zeros(0, np.int64)
    solid = in_words(raw) if table is None else table[raw] != 0
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = at[:-1][at[:-1] < at[1:]]
    begins[inner] = solid[inner]
    return np.flatnonzero(begins)


def word_hashes(raw: np.ndarray, at: np.ndarray, fold: bool = True,
                table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the index of each text's first word (one more at the end).

    ``fold``: A-Z count as a-z. A ``table`` of ``byte_table`` stands for other words
    than those between white space.
    """
    starts = word_starts(raw, at, table)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    # White space adds nothing, so a word may be summed up to the next word's start.
    spans = np.diff(starts, append=len(raw))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, spans)
    values = (_FOLDED if fold else _BYTE) if table is None else table
    terms = values[raw[starts[0]:]] * _power_table(int(spans.max()))[place]
    return mix(np.add.reduceat(terms, starts - starts[0])), np.searchsorted(starts, at)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive words, across texts too: callers cut at their bounds."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n] * _PLACE[0]
    for j in range(1, k):
        total = total + words[j:j + n] * _PLACE[j]
    return mix(total)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text.

    A text of fewer than ``k`` words, but not none, has one shingle: all its words.
    """
    for first, raw, at in slices(texts):
        words, bounds = word_hashes(raw, at)
        windows = window_hashes(words, k)
        for i in range(len(at) - 1):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if b - a >= k:
                yield first + i, np.unique(windows[a:b - k + 1])
            elif b > a:
                whole = window_hashes(words[a:b], b - a)
                yield first + i, mix(whole + np.uint64(b - a))
            else:
                yield first + i, np.zeros(0, np.uint64)
