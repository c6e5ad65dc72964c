"""Passages that documents share: every word covered by a repeated run of words goes, but for its first document.

A window is a run of ``window`` words. Each document is cut into blocks of ``(window + 1) // 2`` words that do not overlap,
so every window holds one whole block.

1. *Index and probe.* Blocks are the index; every run of a block's length, at any word, is a probe. Both go to buckets of
   their hash, packed by shard (some documents): four bytes for each distinct hash of a shard. A bucket answers which
   blocks of a shard are met by a probe from another shard.
2. *Extend.* Around each block that was met, the windows that hold it are formed and sent by a hash of 96 bits and the
   smallest id in the shard. Only what such a bucket finds in a smaller document is answered.
3. *Remove.* Neighbouring repeated windows join to maximal repeats, whose words are taken out.

Hashes of four bytes only choose candidates; equality is decided on 96 bits and the bucket, and inside a shard on 64 bits.
A passage that is in very many documents is one entry for each shard. Texts move once, by shard, and that shuffle is used
again by each step. Nothing depends on the number of copies, and no pairs are formed.

Defined cases: null text has no words; documents of fewer words than a window stay whole; rows that repeat an id do not
count as smaller than each other; a null id counts as larger than all others; a run that repeats inside one document alone
stays; an empty table gives no rows. Columns beyond the two named ones are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.words import byte_codes, inside_rows, rolling, span_hashes, text_bytes, word_spans

WINDOW = 13
#: Bytes of text that a shard and a bucket stand for.
SHARD_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max
_CODES = byte_codes(b"\x20\x09\x0a\x0b\x0c\x0d")
_PACKED = pa.schema({"bucket": pa.int32(), "shard": pa.int32(), "codes": pa.binary()})
_WINDOWS = pa.schema({"bucket": pa.int32(), "shard": pa.int32(), "high": pa.binary(), "low": pa.binary(), "ids": pa.binary()})
_ANSWER = pa.schema({"shard": pa.int32(), "codes": pa.binary()})
_RESULT = pa.schema({"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept": pa.string()})


class Shard:
    """The words of some documents."""

    def __init__(self, table: pa.Table, window: int) -> None:
        self.window, self.block = window, (window + 1) // 2
        self.doc_ids = table["doc_id"].combine_chunks()
        self.data, self.bounds = text_bytes(table["text"])
        self.starts, self.ends, self.words = word_spans(self.data, self.bounds, _CODES)
        self.hashes = span_hashes(self.data, self.starts, self.ends, _CODES)
        ids = self.doc_ids.fill_null(NO_ID).to_numpy()
        sizes = np.diff(self.words)
        self.order_id = np.repeat(ids, sizes)
        self.in_doc = np.arange(len(self.hashes)) - np.repeat(self.words[:-1], sizes)

    def probes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the probe at each place where one fits, and those places."""
        found = rolling(self.hashes, self.block)
        at = np.flatnonzero(inside_rows(self.words, self.block))
        return found[at], at

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(inside_rows(self.words, self.window))
        return rolling(self.hashes, self.window)[at], at


def _place(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _group_cuts(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal keys, and the run of each row."""
    fresh = np.ones(len(sorted_keys), bool)
    fresh[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(fresh), np.cumsum(fresh) - 1


def _pack_probes(shard_no: int, shard: Shard, buckets: int) -> pa.Table:
    hashes, at = shard.probes()
    bucket = _place(hashes, buckets)
    # 31 bits of the hash; the last bit says that a block of the shard starts with it
    key = bucket << 32 | (hashes & np.uint64(0x7FFFFFFF)).astype(np.int64) << 1 | (shard.in_doc[at] % shard.block == 0)
    key = np.unique(key)
    if len(key):
        last = np.ones(len(key), bool)
        last[:-1] = key[1:] >> 1 != key[:-1] >> 1  # of the two forms of a hash, the one with the bit sorts last
        key = key[last]
    begin, _ = _group_cuts(key >> 32)
    codes = (key & 0xFFFFFFFF).astype("<u4")
    parts = np.split(codes, begin[1:]) if len(begin) else []
    return pa.table([(key[begin] >> 32).astype(np.int32), np.full(len(parts), shard_no, np.int32), pa.array([p.tobytes() for p in parts], pa.binary())], schema=_PACKED)


def _answer_probes(bucket: int, table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(b, "<u4") for b in table["codes"].to_pylist()]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    codes = np.concatenate(parts)
    order = np.argsort(codes >> 1, kind="stable")
    codes, owner = codes[order], owner[order]
    begin, run = _group_cuts(codes >> 1)
    shards = np.diff(np.append(begin, len(codes)))
    met = (shards[run] > 1) & (codes & 1 == 1)  # a block whose hash another shard has as well
    return _by_owner(table["shard"].to_numpy(), owner[met], (codes[met] >> 1).astype(np.int64) | bucket << 32)


def _by_owner(shards: np.ndarray, owner: np.ndarray, values: np.ndarray) -> pa.Table:
    order = np.argsort(owner, kind="stable")
    begin, _ = _group_cuts(owner[order])
    parts = np.split(values[order], begin[1:]) if len(begin) else []
    return pa.table([shards[owner[order][begin]].astype(np.int32), pa.array([p.astype("<i8").tobytes() for p in parts], pa.binary())], schema=_ANSWER)


def _answers(table: pa.Table) -> np.ndarray:
    return np.sort(np.concatenate([np.empty(0, "<i8"), *(np.frombuffer(b, "<i8") for b in table["codes"].to_pylist())]))


def _contains(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == values


def _shared_in_shard(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the hash of a row stands under two ids, and the smallest id of its hash."""
    if not len(hashes):
        return np.zeros(0, bool), np.zeros(0, np.int64)
    order = np.lexsort((ids, hashes))
    begin, run = _group_cuts(hashes[order])
    least = ids[order][begin]
    most = ids[order][np.append(begin[1:], len(order)) - 1]
    shared, smallest = np.empty(len(order), bool), np.empty(len(order), np.int64)
    shared[order], smallest[order] = (most != least)[run], least[run]
    return shared, smallest


def _pack_windows(shard_no: int, shard: Shard, met: np.ndarray, probe_buckets: int, buckets: int) -> pa.Table:
    """Windows around the blocks that another document has too."""
    hashes, at = shard.probes()
    aligned = shard.in_doc[at] % shard.block == 0
    local, _ = _shared_in_shard(hashes, shard.order_id[at])
    code = _place(hashes, probe_buckets) << 32 | (hashes & np.uint64(0x7FFFFFFF)).astype(np.int64)
    blocks = at[aligned & (local | _contains(met, code))]
    wanted = np.zeros(len(shard.hashes) + 1, bool)
    for back in range(shard.block):
        wanted[np.maximum(blocks - back, 0)] = True
    high, starts = shard.windows()
    use = wanted[starts]
    high, starts = high[use], starts[use]
    low = (rolling(shard.hashes, shard.window, 1)[starts] & np.uint64(0xFFFFFFFF)).astype("<u4") if len(starts) else np.empty(0, "<u4")
    ids = shard.order_id[starts]
    order = np.lexsort((ids, low, high))
    high, low, ids = high[order], low[order], ids[order]
    fresh = np.ones(len(high), bool)
    fresh[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    high, low, ids = high[fresh], low[fresh], ids[fresh]  # the smallest id of each
    bucket = _place(high, buckets)
    order = np.argsort(bucket, kind="stable")
    begin, _ = _group_cuts(bucket[order])
    split = lambda x: pa.array([p.tobytes() for p in np.split(x[order], begin[1:])] if len(begin) else [], pa.binary())
    return pa.table([bucket[order][begin].astype(np.int32), np.full(len(begin), shard_no, np.int32), split(high.astype("<u8")), split(low), split(ids.astype("<i8"))], schema=_WINDOWS)


def _answer_windows(table: pa.Table) -> pa.Table:
    read = lambda name, kind: [np.frombuffer(b, kind) for b in table[name].to_pylist()]
    parts = read("high", "<u8")
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    high, low, ids = np.concatenate(parts), np.concatenate(read("low", "<u4")), np.concatenate(read("ids", "<i8"))
    order = np.lexsort((ids, low, high))
    high, low, ids, owner = high[order], low[order], ids[order], owner[order]
    fresh = np.ones(len(high), bool)
    fresh[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    least = ids[fresh][np.cumsum(fresh) - 1]
    late = least < ids
    return _by_owner(table["shard"].to_numpy(), owner[late], high[late].view(np.int64))


def _remove(shard: Shard, late: np.ndarray, with_text: bool) -> pa.Table:
    hashes, starts = shard.windows()
    _, smallest = _shared_in_shard(hashes, shard.order_id[starts])
    gone = (smallest < shard.order_id[starts]) | _contains(late, hashes.view(np.int64))
    cover = np.zeros(len(shard.hashes) + 1, np.int64)
    cover[starts[gone]] += 1
    cover[starts[gone] + shard.window] -= 1
    stays = np.cumsum(cover[:-1]) == 0
    kept = np.flatnonzero(stays)
    before = np.searchsorted(kept, shard.words)  # kept words before each row
    # the bytes of kept words, each followed by its own delimiter as a space, but for the last of a row
    out = shard.data.copy()
    change = np.zeros(len(out) + 1, np.int8)
    change[shard.starts[kept]] += 1
    change[shard.ends[kept]] -= 1
    mask = np.cumsum(change[:-1], dtype=np.int8) > 0
    follows = np.ones(len(kept), bool)
    follows[before[1:][np.diff(before) > 0] - 1] = False
    gaps = shard.ends[kept[follows]]
    out[gaps] = 0x20
    mask[gaps] = True
    text = out[mask].tobytes()
    cuts = np.append(0, np.cumsum(mask))[shard.bounds]
    rows = [text[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    n_words = np.diff(shard.words)
    return pa.table(
        [
            shard.doc_ids, pa.array(n_words.astype(np.int64)), pa.array((n_words - np.diff(before)).astype(np.int64)),
            pa.array([hashlib.sha256(r).hexdigest() for r in rows], pa.string()),
            pa.array([r.decode() for r in rows] if with_text else [None] * len(rows), pa.string()),
        ],
        schema=_RESULT,
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = True,
    shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for every row; ``kept`` is null unless ``with_text``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, buckets = -(-size // shard_bytes) or 1, -(-size // bucket_bytes) or 1
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))

    def probe(key, table):
        return _pack_probes(key[0].as_py(), Shard(table, window), buckets)

    def meet(key, table):
        return _answer_probes(key[0].as_py(), table)

    def extend(key, left, right):
        return _pack_windows(key[0].as_py(), Shard(left, window), _answers(right), buckets, buckets)

    def find(table):
        return _answer_windows(table)

    def remove(left, right):
        return _remove(Shard(left, window), _answers(right), with_text)

    by_shard = rows.groupBy("shard")
    probes = by_shard.applyInArrow(probe, "bucket int, shard int, codes binary")
    met = probes.groupBy("bucket").applyInArrow(meet, "shard int, codes binary")
    near = by_shard.cogroup(met.groupBy("shard")).applyInArrow(extend, "bucket int, shard int, high binary, low binary, ids binary")
    late = near.groupBy("bucket").applyInArrow(find, "shard int, codes binary")
    return by_shard.cogroup(late.groupBy("shard")).applyInArrow(remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
