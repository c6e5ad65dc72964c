"""Encode texts through a cache of their distinct pieces.

Texts are cut where a character that is no white space meets ASCII white space. The pattern of these tokenizers never
matches across such a cut and never looks left of it, so a text's tokens are those of its pieces, one after another.
Each distinct piece is encoded once for a worker, as long as the bounded cache holds it; what the cache gives was compared byte
by byte with what was asked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from tagloom.llm.words import byte_codes, span_hashes

SEGMENT = 1 << 20
CACHE_ENTRIES = 500_000
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
# White space beyond ASCII ends in one of these pairs of bytes at most: second last byte as listed, last one over 127.
WIDE_SPACES = np.zeros(256, bool)
WIDE_SPACES[[0xC2, 0x9A, 0x80, 0x81]] = True


def unit_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte positions where a piece starts: at each row, and before white space that follows another character."""
    space = SPACES[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = space[1:] & ~space[:-1]
    cut[2:] &= ~((data[1:-1] > 127) & WIDE_SPACES[data[:-2]])
    cut[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    return np.flatnonzero(cut)


def _blocks(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``data`` on, for data with seven bytes to spare behind the last place."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", np.ascontiguousarray(data), 0, (1,))


def _same(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether ``sizes`` bytes from ``a_at`` and ``b_at`` on are equal; ``a`` and ``b`` as of :func:`_blocks`."""
    out = np.ones(len(sizes), bool)
    todo, left = np.arange(len(sizes)), sizes
    while len(todo):
        differ = a[a_at] ^ b[b_at]
        short = left < 8
        differ[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        equal = differ == 0
        out[todo[~equal]] = False
        more = equal & (left > 8)
        todo, a_at, b_at, left = todo[more], a_at[more] + 8, b_at[more] + 8, left[more] - 8
    return out


class _Generation:
    """Pieces with their token ids, found by hash in an open-addressing table and compared byte by byte."""

    def __init__(self, entries: int) -> None:
        self.mask = (1 << max(4, (2 * entries - 1).bit_length())) - 1
        self.table = np.full(self.mask + 1, -1, np.int32)  # number of the piece at a place, -1 for none
        self.n = self.n_bytes = self.n_ids = 0
        self.hashes = np.empty(entries, np.uint64)
        self.at, self.sizes = np.empty(entries, np.int64), np.empty(entries, np.int64)
        self.start = np.zeros(entries + 1, np.int64)
        self.bytes, self.ids = np.zeros(1 << 16, np.uint8), np.empty(1 << 14, np.uint32)

    def find(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 for those that are not there."""
        out = np.full(len(hashes), -1, np.int64)
        todo = np.arange(len(hashes))
        place = (hashes & np.uint64(self.mask)).astype(np.int64)
        pool = _blocks(self.bytes)
        while len(todo):
            held = self.table[place]
            there = held >= 0
            todo, place, held = todo[there], place[there], held[there]
            hit = (self.hashes[held] == hashes[todo]) & (self.sizes[held] == sizes[todo])
            some = np.flatnonzero(hit)
            hit[some] = _same(pool, self.at[held[some]], data, starts[todo[some]], sizes[todo[some]])
            out[todo[hit]] = held[hit]
            todo, place = todo[~hit], (place[~hit] + 1) & self.mask
        return out

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        out = np.zeros(max(size, 2 * len(array)), array.dtype)
        out[: len(array)] = array
        return out

    def add(self, hashes: np.ndarray, flat: np.ndarray, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Take up pieces that are not there, their bytes and their ids one after another; their numbers."""
        k, first = len(hashes), self.n
        numbers = np.arange(first, first + k)
        self.bytes = self._room(self.bytes, self.n_bytes + len(flat) + 8)
        self.bytes[self.n_bytes : self.n_bytes + len(flat)] = flat
        self.at[first : first + k] = self.n_bytes + np.cumsum(sizes) - sizes
        self.ids = self._room(self.ids, self.n_ids + len(ids))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.start[first + 1 : first + k + 1] = self.n_ids + np.cumsum(counts)
        self.hashes[first : first + k], self.sizes[first : first + k] = hashes, sizes
        self.n, self.n_bytes, self.n_ids = first + k, self.n_bytes + len(flat), self.n_ids + len(ids)
        todo, place = numbers, (hashes & np.uint64(self.mask)).astype(np.int64)
        while len(todo):  # of those that want one place, the last written has it; the others go on
            free = self.table[place] < 0
            self.table[place[free]] = todo[free]
            lost = self.table[place] != todo
            todo, place = todo[lost], (place[lost] + 1) & self.mask
        return numbers


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class PieceCache:
    """Token ids of pieces. ``encode`` takes the bytes of pieces, one after another, and their sizes; it gives ids and counts alike.

    Two generations are kept: when the young one is full it becomes the old one, and pieces still in use move from there to
    the next, so what is common is never encoded again. Pieces are equal if their bytes are.
    """

    def __init__(self, encode: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> None:
        self.encode = encode
        self.codes = byte_codes()
        self.clear()

    def clear(self) -> None:
        self.young, self.old = _Generation(CACHE_ENTRIES), None

    def _numbers(self, hashes: np.ndarray, data: np.ndarray, blocks: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each piece in the young generation, after taking up those that are new."""
        number = self.young.find(hashes, blocks, starts, sizes)
        missing = np.flatnonzero(number < 0)
        if not len(missing):
            return number
        _, first, kind = np.unique(hashes[missing], return_index=True, return_inverse=True)
        new = missing[first]
        if not _same(blocks, starts[new][kind], blocks, starts[missing], sizes[missing]).all() or (sizes[new][kind] != sizes[missing]).any():
            kinds: dict[bytes, int] = {}  # different pieces with one hash, one in ages
            kind = np.array([kinds.setdefault(data[starts[i] : starts[i] + sizes[i]].tobytes(), len(kinds)) for i in missing])
            new = missing[np.unique(kind, return_index=True)[1]]
        if self.young.n + len(new) > len(self.young.hashes):
            self.young, self.old = _Generation(max(CACHE_ENTRIES, len(hashes))), self.young
            return self._numbers(hashes, data, blocks, starts, sizes)
        flat, counts = data[spans(starts[new], sizes[new])], np.zeros(len(new), np.int64)
        known = self.old.find(hashes[new], blocks, starts[new], sizes[new]) if self.old is not None else np.full(len(new), -1)
        there = known >= 0
        unknown = np.repeat(~there, sizes[new])
        made, made_counts = self.encode(flat[unknown], sizes[new][~there])
        counts[~there] = made_counts
        if there.any():
            begin = self.old.start[known[there]]
            counts[there] = self.old.start[known[there] + 1] - begin
            ids = np.empty(int(counts.sum()), np.uint32)
            from_old = np.repeat(there, counts)
            ids[from_old], ids[~from_old] = self.old.ids[spans(begin, counts[there])], made
        else:
            ids = made
        number[missing] = self.young.add(hashes[new], flat, sizes[new], ids, counts)[kind]
        return number

    def tokens(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in order, and the number of ids of each piece."""
        if not len(starts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        base = int(starts[0])
        part = np.concatenate([data[base : int(ends[-1])], np.zeros(8, np.uint8)])
        starts, sizes = starts - base, ends - starts
        hashes = span_hashes(part, starts, starts + sizes, self.codes)
        number = self._numbers(hashes, part, _blocks(part), starts, sizes)
        begin, counts = self.young.start[number], self.young.start[number + 1] - self.young.start[number]
        return self.young.ids[spans(begin, counts)], counts


def encoded_segments(cache: PieceCache, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, row after the last, ids, ids of each row)`` for about SEGMENT bytes at a time.

    A row longer than that comes in several steps, each with its own part of the ids.
    """
    rows = len(bounds) - 1
    starts = unit_starts(data, bounds)
    ends = np.append(starts[1:], len(data))
    row = i = 0
    while row < rows or i < len(starts):
        stop = max(i + 1, int(np.searchsorted(ends, (starts[i] if i < len(starts) else len(data)) + SEGMENT, side="right")))
        stop = min(stop, len(starts))
        reach = int(ends[stop - 1]) if stop else 0
        last = rows if stop == len(starts) else int(np.searchsorted(bounds, reach, side="right")) - 1
        part = last if stop == len(starts) or bounds[last] == reach else last + 1  # the last row may go on
        if i < stop:
            ids, sizes = cache.tokens(data, starts[i:stop], ends[i:stop])
        else:
            ids, sizes = np.empty(0, np.uint32), np.empty(0, np.int64)
        owner = np.searchsorted(bounds[row : part + 1], starts[i:stop], side="right") - 1
        counts = np.bincount(owner, weights=sizes, minlength=part - row).astype(np.int64) if part > row else np.empty(0, np.int64)
        yield row, part, ids, counts
        row = last
        i = stop
        if i >= len(starts) and row >= rows:
            return
