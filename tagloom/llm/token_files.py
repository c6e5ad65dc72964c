"""Token ids in Parquet: one row per document, in document order, readable by column and by range.

Columns: ``doc_id``, ``part`` (number of the file), ``local_start`` (ids before the document in its file),
``n_tokens`` and ``ids``, a list column. Ids are dictionary encoded, or delta encoded where a dictionary grows too
large; the integers beside them are delta encoded. Row groups are small enough to be skipped as a whole, and pages carry
an index over ``doc_id``, so that a read of a range of documents, or of lengths alone, touches little of the file.

Defined cases: null and empty text give the end id alone; the string of an added token becomes that token, as the library does
without further settings; rows that repeat an id stay, ordered by a hash of
their text; a null id comes first; an empty table gives no rows. Columns beyond the two named ones are not looked at,
whatever they are called.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.llm.shared import row_slices, text_batches, work_folder
from tagloom.llm.units import SPACES, WIDE_SPACES, PieceCache, encoded_segments, spans
from tagloom.llm.words import text_bytes

FILE_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"
#: 16 MB row groups; pages of at most 64 KB and 500 rows; dictionaries up to 1 MB; version 2 writes deltas.
WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "500",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
}
SLICE_BYTES = 4 << 20
_CACHES: dict[str, PieceCache] = {}


def _can_follow(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which pieces encode alike behind another: those that start with white space and surely do not end with it."""
    last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
    return SPACES[data[starts]] & ~SPACES[last] & ~((last > 127) & WIDE_SPACES[before])


def piece_encoder(tokenizer_file: str):
    """Encode pieces with the tokenizers library, many in one call: the lengths of the tokens tell where a piece ends."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    added = tokenizer.get_added_tokens_decoder()
    width = np.zeros(max([*vocabulary.values(), *added]) + 1, np.int64)
    for token, i in vocabulary.items():
        width[i] = len(token)  # in this alphabet a character stands for a byte
    for i, token in added.items():  # their strings stand for them in a text, as the library has it
        if any(c.isspace() for c in token.content) or token.lstrip or token.rstrip or token.single_word:
            raise ValueError(f"texts cannot be cut at white space with the added token {token.content!r}")
        width[i] = len(token.content.encode())

    def encode(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(sizes)
        starts = ends - sizes
        follows = _can_follow(data, starts, ends) if len(sizes) else np.zeros(0, bool)
        counts, made = np.zeros(len(sizes), np.int64), [np.empty(0, np.uint32)]
        joined, alone = np.flatnonzero(follows), np.flatnonzero(~follows)
        for k in range(0, len(joined), 20_000):
            some = joined[k : k + 20_000]
            text = data[spans(starts[some], sizes[some])].tobytes().decode()
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            cuts = np.searchsorted(np.cumsum(width[ids]), np.cumsum(sizes[some]), side="right")
            counts[some] = np.diff(cuts, prepend=0)
            made.append(ids)
        for k in range(0, len(alone), 2_000):
            some = alone[k : k + 2_000]
            for i, e in zip(some, tokenizer.encode_batch_fast([data[starts[i] : ends[i]].tobytes().decode() for i in some], add_special_tokens=False)):
                counts[i] = len(e.ids)
                made.append(np.array(e.ids, np.uint32))
        # ids were made for those that follow, then for the others; bring them into the order of the pieces
        order = np.concatenate([joined, alone])
        begin = np.empty(len(sizes), np.int64)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate(made)[spans(begin, counts)], counts

    return encode


def _cache(tokenizer_file: str) -> PieceCache:
    if tokenizer_file not in _CACHES:
        _CACHES[tokenizer_file] = PieceCache(piece_encoder(tokenizer_file))
    return _CACHES[tokenizer_file]


def write_tokens(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every text and write the ids below ``path`` in ascending order of ``id_col``, ``end_id`` after each document.

    ``tokenizer_file`` is read by the tasks, so it lies at the same place on every machine.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, cache = TaskContext.get().partitionId(), 0, _cache(tokenizer_file)
        for batch in (piece for whole in batches for piece in row_slices(whole, "text", SLICE_BYTES)):
            data, bounds = text_bytes(batch.column("text"))
            held: list[np.ndarray] = []
            first = done = 0
            for row, stop, ids, counts in encoded_segments(cache, data, bounds):
                if len(counts) == 0:
                    continue
                parts = np.split(ids.astype(np.int32), np.cumsum(counts)[:-1])
                if held and row == done - 1:  # the last row of the step before goes on
                    held[-1] = np.append(held[-1], parts.pop(0))
                ready = held[:-1]
                if ready:
                    out = _block(batch, first, ready, part, before, end_id)
                    before += sum(len(x) + 1 for x in ready)
                    first += len(ready)
                    yield out
                held, done = held[-1:] + parts, stop
            if held:
                out = _block(batch, first, held, part, before, end_id)
                before += sum(len(x) + 1 for x in held)
                yield out

    text_batches(rows).mapInArrow(encode, FILE_SCHEMA).write.options(**WRITE_OPTIONS).parquet(path)


def _block(batch: pa.RecordBatch, first: int, parts: list[np.ndarray], part: int, before: int, end_id: int) -> pa.RecordBatch:
    sizes = np.array([len(x) + 1 for x in parts], np.int64)
    ends = np.cumsum(sizes)
    ids = np.empty(int(ends[-1]), np.int32)
    mask = np.ones(len(ids), bool)
    mask[ends - 1] = False
    ids[ends - 1] = end_id
    ids[mask] = np.concatenate(parts)
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))
    n = len(parts)
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").slice(first, n), pa.array(np.full(n, part, np.int32)), pa.array(before + ends - sizes), pa.array(sizes), lists],
        names=["doc_id", "part", "local_start", "n_tokens", "ids"],
    )


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The documents of a token folder with ``start``, the ids of all documents before; reads only what ``columns`` names.

    Filters on ``doc_id`` reach the page index. The totals of the files, one row each, are all that is broadcast.
    """
    columns = columns or ["doc_id", "start", "n_tokens", "ids"]
    table = spark.read.schema(FILE_SCHEMA).parquet(path)
    if "start" not in columns:
        return table.select(columns)
    totals = table.groupBy("part").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per file
    base = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    return table.join(F.broadcast(base), "part").withColumn("start", F.col("base") + F.col("local_start")).select(columns)


def token_digests(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of rows as :func:`read_tokens` gives them."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values, bounds = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            keep = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_digests(docs: DataFrame, tokenizer_file: str, end_id: int) -> DataFrame:
    """Write a token folder for ``docs``, read it back and give the digest of each document."""
    path = work_folder(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_file, end_id)
    return token_digests(read_tokens(docs.sparkSession, path))
