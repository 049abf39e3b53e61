"""Word and shingle hashes of Arrow string columns, whole batches at a time.

Words are runs without ASCII white space, A-Z taken as a-z; a word's hash is a
polynomial over a table of random 64-bit numbers per byte. Nothing here makes a
Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_RANDOM = np.random.default_rng(20240229)
_BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = U(0x9E3779B97F4A7C15)
CHUNK_BYTES = 1 << 19


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    column = pa.concat_arrays([column.fill_null("").cast(pa.large_string())])
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `size` bytes; a longer text stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def word_parts(data: np.ndarray, offsets: np.ndarray,
               breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, bounds, starts, ends): row i has the words bounds[i]:bounds[i + 1],
    whose bytes lie between starts and ends counted from offsets[0]. `breaks`
    tells of each byte whether it parts words."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = data[lo:hi]
    inside = ~breaks[raw]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    edges = offsets[:-1] - lo
    edges = edges[edges < len(raw)]
    start[edges] |= inside[edges]
    at = np.flatnonzero(start)
    bounds = np.searchsorted(at, offsets - lo)
    if not len(at):
        return np.zeros(0, dtype=U), bounds, at, at
    first = (np.cumsum(inside) - 1)[at]  # of each word, among the bytes of words
    letters = _BYTES[raw[inside]]
    lens = np.diff(np.append(first, len(letters)))
    powers = np.cumprod(np.full(int(lens.max()), _BASE, dtype=U), dtype=U)
    where = np.arange(len(letters)) - np.repeat(first, lens)
    return mix64(np.add.reduceat(letters * powers[where], first) + lens.astype(U)), bounds, at, at + lens


def word_hashes(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of `word_parts`."""
    return word_parts(data, offsets, breaks)[:2]


def shingle_sets(words: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each row its sorted distinct shingle hashes; a row with fewer than
    `width` words has its whole sequence as one, a row without words none."""
    n = len(words)
    run = np.zeros(max(n - width + 1, 0), dtype=U)
    for k in range(width):
        run = run * _BASE + words[k:n - width + 1 + k] if len(run) else run
    run = mix64(run)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= width:
            yield np.unique(run[a:b - width + 1])
        elif b > a:
            short = U(b - a)
            for w in words[a:b]:
                short = U((int(short) * int(_BASE) + int(w)) & 0xFFFFFFFFFFFFFFFF)
            yield mix64(np.array([short], dtype=U))
        else:
            yield words[:0]
