"""Benchmark passages in training documents, found through suffix arrays of the documents.

A task takes the words of some documents (a shard), and sorts the places where a benchmark word pair, or a benchmark item
of one word, stands: a suffix array of the places that can matter. Every suffix of every benchmark item is then searched
in it by bisection: those suffixes of the shard that start with the item's next ten words are a range of the array. Ranges
give the places of verbatim matches, and neighbouring places on one diagonal give the longest ones, which :func:`matches`
returns with their locations. Words are compared by 64-bit hashes and, inside a shard, by their number in the benchmark's
word list.

The benchmark is taken in blocks of bounded size; a task searches one block after the other, so memory holds one block
and the documents are read once and never shuffled.

Defined cases: null and empty texts have no words and are clean; an item of fewer than ten words is one window; an item
without words never occurs; items that repeat an id count once; a null item id is written as nothing; rows that repeat are
judged each; an empty benchmark leaves all documents clean. Extra columns are kept by :func:`drop_contaminated`.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tagloom.llm.shared import row_slices, text_batches
from tagloom.llm.words import byte_codes, span_hashes, text_bytes, word_spans

WINDOW = 10
#: Benchmark text held in one broadcast.
BLOCK_BYTES = 32 << 20
SHARD_BYTES = 4 << 20
FOUND = [
    StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("n_items", LongType()),
    StructField("items_sha256", StringType()), StructField("contaminated", BooleanType()), StructField("longest", LongType()),
]
#: Bytes that are not part of words: all of ASCII but digits and letters.
_GAPS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_CODES = byte_codes(_GAPS, fold_case=True)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_bytes(column)
    starts, ends, words = word_spans(data, bounds, _CODES)
    return span_hashes(data, starts, ends, _CODES), words


class Probe:
    """The suffixes of some benchmark items, ready to be searched in shards."""

    def __init__(self, names: list[str], texts: pa.Array, window: int) -> None:
        self.names, self.window = names, window
        hashes, words = _words(texts)
        self.vocabulary, ids = np.unique(hashes, return_inverse=True)
        ids = ids.astype(np.int64) + 1  # 0: no benchmark word, or past the end
        sizes = np.diff(words)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(ids)) - np.repeat(words[:-1], sizes)
        left = np.repeat(sizes, sizes) - place
        use = (left >= window) | (place == 0)  # ten words ahead, or a short item as a whole
        self.owner, self.place, at = owner[use], place[use], np.flatnonzero(use)
        self.length = np.minimum(left[use], window)
        padded = np.append(ids, np.zeros(window, np.int64))
        grid = padded[at[:, None] + np.arange(window)]
        grid[np.arange(window) >= self.length[:, None]] = 0
        self.low = _keys(grid)
        grid[np.arange(window) >= self.length[:, None]] = 0xFFFFFFFF
        self.high = _keys(grid)
        self.pairs = np.unique(padded[at][self.length > 1] << 32 | padded[at + 1][self.length > 1])
        self.alone = np.unique(padded[at][self.length == 1])

    def search(self, hashes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(place in the shard, number of the suffix)`` of every occurrence."""
        if not len(hashes) or not len(self.vocabulary):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        rank = np.searchsorted(self.vocabulary, hashes)
        rank[rank == len(self.vocabulary)] = 0
        ids = np.where(self.vocabulary[rank] == hashes, rank + 1, 0)
        ahead = np.append(ids[1:], 0)
        last = words[1:][np.diff(words) > 0] - 1
        ahead[last] = 0
        pair = ids << 32 | ahead
        both = np.flatnonzero((ids > 0) & (ahead > 0))
        near = self.pairs[np.minimum(np.searchsorted(self.pairs, pair[both]), max(0, len(self.pairs) - 1))] if len(self.pairs) else np.zeros(len(both))
        at = both[near == pair[both]] if len(self.pairs) else both[:0]
        if len(self.alone):
            at = np.union1d(at, np.flatnonzero(np.isin(ids, self.alone)))
        if not len(at):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        end = np.repeat(words[1:], np.diff(words))[at]
        grid = np.append(ids, np.zeros(self.window, np.int64))[at[:, None] + np.arange(self.window)]
        grid[np.arange(self.window) >= (end - at)[:, None]] = 0
        order = np.lexsort(grid.T[::-1])  # the suffix array of the shard
        at, array = at[order], _keys(grid[order])
        low, high = np.searchsorted(array, self.low, "left"), np.searchsorted(array, self.high, "right")
        # a full window has equal bounds: its range ends behind the last equal key
        counts = np.maximum(high - low, 0)
        suffix = np.repeat(np.arange(len(low)), counts)
        total = np.cumsum(counts)
        places = np.repeat(low - total + counts, counts) + np.arange(total[-1] if len(total) else 0)
        return at[places], suffix


def _keys(grid: np.ndarray) -> np.ndarray:
    """Rows of numbers as byte strings that sort alike."""
    return np.ascontiguousarray(grid.astype(">u4")).view(f"S{4 * grid.shape[1]}").ravel()


def _longest(probe: Probe, at: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Longest matches, which are runs of places on one diagonal of one item: their place, words, item and place in it."""
    owner, diagonal = probe.owner[suffix], at - probe.place[suffix]
    order = np.lexsort((at, diagonal, owner))
    a, diagonal, item = at[order], diagonal[order], owner[order]
    fresh = np.append(True, (a[1:] != a[:-1] + 1) | (diagonal[1:] != diagonal[:-1]) | (item[1:] != item[:-1]))
    begin = np.flatnonzero(fresh)
    size = np.diff(np.append(begin, len(a))) - 1 + probe.length[suffix][order][begin]
    return a[begin], size, item[begin], a[begin] - diagonal[begin]


def _verdicts(probes: Iterator[Probe], column: pa.Array, window: int) -> pa.RecordBatch:
    hashes, words = _words(column)
    rows = len(words) - 1
    cover = np.zeros(len(hashes) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(rows)]
    longest = np.zeros(rows, np.int64)
    for probe in probes:
        at, suffix = probe.search(hashes, words)
        if not len(at):
            continue
        size = probe.length[suffix]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + size, -1)
        row = np.searchsorted(words, at, side="right") - 1
        for r, item in set(zip(row.tolist(), probe.owner[suffix].tolist())):
            items[r].add(probe.names[item])
        first, run, _, _ = _longest(probe, at, suffix)
        np.maximum.at(longest, np.searchsorted(words, first, side="right") - 1, run)
    hit = np.append(0, np.cumsum(np.cumsum(cover[:-1]) > 0))
    n_hit = hit[words[1:]] - hit[words[:-1]]
    joined = [",".join(sorted(x)) for x in items]
    arrays = [
        pa.array(np.diff(words).astype(np.int64)), pa.array(n_hit.astype(np.int64)), pa.array([len(x) for x in items], pa.int64()),
        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in joined], pa.string()), pa.array(n_hit > 0), pa.array(longest),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in FOUND])


def _broadcast_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> list:
    """Broadcast probes of at most about ``block_bytes`` of text each; the driver holds one block at a time."""
    context = benchmark.sparkSession.sparkContext
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // block_bytes)
    blocks = []
    for k in range(count):
        held = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k).collect() if count > 1 else rows.collect()
        probe = Probe([r.item or "" for r in held], pa.array([r.text for r in held], pa.string()), window)
        blocks.append(context.broadcast(pickle.dumps(probe)))
    return blocks


def _in_turn(blocks: list) -> Iterator[Probe]:
    for block in blocks:
        yield pickle.loads(block.value)
        vars(block).pop("_value", None)  # keeps one block in memory


def contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES, columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` (all of them by default) followed by those of FOUND, one row per row."""
    blocks = _broadcast_blocks(benchmark, item_col, item_text_col, window, block_bytes)
    columns = docs.columns if columns is None else columns
    found = [f.name for f in FOUND]
    inner = [f"c{i}" for i in range(len(columns))]  # clashing names do no harm
    sent = [F.col(c).alias(i) for c, i in zip(columns, inner)]
    place = columns.index(text_col) if text_col in columns else len(sent)  # the text goes to Python once
    source = docs.select(*sent, *([] if text_col in columns else [F.col(text_col).alias("searched")]))
    searched = source.columns[place]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = [pickle.loads(blocks[0].value)] if len(blocks) == 1 else None
        for batch in batches:
            for part in row_slices(batch, searched, SHARD_BYTES):
                verdict = _verdicts(iter(one) if one else _in_turn(blocks), part.column(searched), window)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in inner), *verdict.columns], names=[*inner, *found])

    result = text_batches(source).mapInArrow(run, StructType([*source.select(inner).schema.fields, *FOUND]))
    return result.select(*[F.col(i).alias(c) for i, c in zip(inner, columns)], *found)


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, item_id, start, end, item_start``: every longest verbatim match of ``window`` words or more, or of a whole shorter item.

    Words are numbered from 0, ``end`` is exclusive; item ids are text. An item that repeats gives each of its matches once.
    """
    blocks = _broadcast_blocks(benchmark, item_col, item_text_col, window, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = [pickle.loads(blocks[0].value)] if len(blocks) == 1 else None
        for part in (part for batch in batches for part in row_slices(batch, "text", SHARD_BYTES)):
            hashes, words = _words(part.column("text"))
            for probe in iter(one) if one else _in_turn(blocks):
                at, suffix = probe.search(hashes, words)
                if not len(at):
                    continue
                first, size, item, place = _longest(probe, at, suffix)
                row = np.searchsorted(words, first, side="right") - 1
                start = first - words[row]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array([probe.names[i] for i in item], pa.string()),
                     pa.array(start), pa.array(start + size), pa.array(place)], names=["doc_id", "item_id", "start", "end", "item_start"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return text_batches(rows).mapInArrow(run, "doc_id long, item_id string, start long, end long, item_start long")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The clean rows of ``docs`` with their columns."""
    names = docs.columns
    plain = docs.toDF(*[f"k{i}" for i in range(len(names))])  # clashing names do no harm
    marked = contamination(plain, benchmark, text_col=f"k{names.index('text')}")
    return marked.where("NOT contaminated").select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(names)])
