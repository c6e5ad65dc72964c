"""Split and hash the words of many texts at once, on the UTF-8 bytes of an Arrow column.

A word is hashed eight bytes at a time, each block mixed into what came before; all words take a step together, so no loop
looks at single words but for those of over LONG bytes, which a cryptographic hash takes. A table of 256 letters
says which bytes compare as equal, and marks delimiters with 0.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
LONG = 64
_MASK = (1 << 64) - 1


def byte_codes(delimiters: bytes = b"", fold_case: bool = False) -> np.ndarray:
    """A letter for each byte, 0 for delimiters; ``fold_case`` gives A-Z the letters of a-z."""
    codes = np.arange(1, 257, dtype=np.uint16)
    if fold_case:
        codes[65:91] = codes[97:123]
    codes[list(delimiters)] = 0
    return codes


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row bounds of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of the spans ``data[starts[i]:ends[i]]``, which are in order and do not overlap."""
    if not len(starts):
        return np.empty(0, np.uint64)
    first, last = int(starts[0]), int(ends[-1])
    letters = np.zeros(last - first + 8, np.uint8)
    letters[: last - first] = codes.astype(np.uint8)[data[first:last]]  # 256 becomes 0: no byte of UTF-8 is 255
    blocks = np.ndarray((last - first + 1,), "<u8", letters, 0, (1,))  # the eight bytes from each place on
    at, left = starts - first, ends - starts
    out = mix(left.astype(np.uint64) * np.uint64(BASE) + np.uint64(0x632BE59BD9B4E019))
    for i in np.flatnonzero(left > LONG):
        word = letters[at[i] : at[i] + left[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    todo = np.flatnonzero(left <= LONG)
    at, left = at[todo], left[todo]
    while len(todo):
        block = blocks[at]
        short = left < 8
        block[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        out[todo] = mix(out[todo] ^ block)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return out


def word_spans(data: np.ndarray, bounds: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each row the number of words before it (rows + 1 values)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = (codes != 0)[data]
    filled = bounds[:-1] < bounds[1:]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[bounds[:-1][filled]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[bounds[1:][filled] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def rolling(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` neighbours, by start."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factor = np.uint64((BASE * (2 * seed + 1) + 2 * seed * 0x632BE59BD9B4E018) & _MASK | 1)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= factor
        out += hashes[k : k + n]
    return mix(out)


def inside_rows(words: np.ndarray, size: int) -> np.ndarray:
    """For each start of a run of ``size`` words over all rows: whether it stays in one row. ``words``: as of word_spans."""
    n = int(words[-1]) - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    ok = np.ones(n, bool)
    row_end = np.repeat(words[1:], np.diff(words))[:n]
    np.less_equal(np.arange(size, n + size), row_end, out=ok)
    return ok
