"""Near copies by min-max hashing.

1. *Signatures.* A document's set holds its distinct five-word shingles as 64-bit hashes. Under each permutation both the
   smallest and the largest value are kept: two values from one evaluation, each of which agrees for two sets with
   probability equal to their similarity. Four values make a band. There are as many bands as it takes that at the asked
   similarity no band agrees in 4 of 10 million cases: 20 (40 permutations) for 0.85, 28 (56) for 0.80. What is linked is
   always decided on full sets.
2. *Classes.* Documents with equal sets are one class, grouped before anything is compared.
3. *First round.* In each bucket of a band the smallest class is the pivot and all others are compared with it. Pairs that
   hold give components.
4. *Second round.* Buckets whose other members still lie in several components are compared member by member, on full sets
   again: a bucket is cut into parts of bounded size, and each pair of parts is one task's square. A task counts all
   intersections of its square by a product of matrices and returns one row at most for each member, its smallest partner in
   reach. After that every linked pair of a bucket was compared or lies in one component already.

A group of copies costs one comparison for each member and band. Groups of over a thousandth of all rows are joined by
broadcast (a thousand of them at most).

Defined cases: null and empty texts, and those without words, have an empty set, link with nothing and stand alone; fewer
than five words are one shingle; rows that repeat an id are documents of their own, each judged by its text (``kept`` marks all that have a
group's smallest id, :func:`drop_near_copies` leaves one row of it); rows with a null id stand alone, with a null component, and stay; an empty table gives
no rows. Extra columns are kept by :func:`drop_near_copies`, whatever they are called.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import hot_join, row_slices, stored, text_batches
from tagloom.llm.words import byte_codes, inside_rows, mix, rolling, span_hashes, text_bytes, word_spans
from tagloom.operators.ranking import with_rank

SHINGLE = 5
BAND = 4
#: Linked: percent * union size <= 100 * intersection size.
PERCENT = 85
#: Share of the pairs at the asked similarity that may meet in no band.
MISSED = 4e-7
#: Part of a bucket in the second round: members, and shingles of all of them.
PART_ROWS, PART_SHINGLES = 512, 1 << 20
_COLUMNS = 4096
SLICE_BYTES = 4 << 20
_CODES = byte_codes(b"\x20\x09\x0a\x0b\x0c\x0d", fold_case=True)
_SIGNED = pa.schema({"doc_id": pa.int64(), "n_shingles": pa.int64(), "set_hash": pa.binary(), "bands": pa.list_(pa.int64())})


def band_count(percent: int) -> int:
    """Bands that leave at most MISSED of the pairs at this similarity without a common one."""
    return max(1, math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** BAND)))) if percent < 100 else 1


def _factors(bands: int) -> np.ndarray:
    """An odd factor for each permutation; each makes two values."""
    return np.random.default_rng(7).integers(0, 1 << 63, bands * BAND // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows, repeats included, and the number of them before each row."""
    data, bounds = text_bytes(column)
    starts, ends, words = word_spans(data, bounds, _CODES)
    hashes = span_hashes(data, starts, ends, _CODES)
    sizes = np.diff(words)
    at = np.flatnonzero(inside_rows(words, SHINGLE))
    found, row = rolling(hashes, SHINGLE)[at], np.searchsorted(words, at, side="right") - 1
    for size in range(1, SHINGLE):  # a short document is one shingle
        short = np.flatnonzero(sizes == size)
        if len(short):
            found = np.append(found, rolling(hashes, size, size)[words[short]])
            row = np.append(row, short)
    order = np.argsort(row, kind="stable")
    return found[order], np.searchsorted(row[order], np.arange(len(words)))


def _sign(part: pa.RecordBatch, factors: np.ndarray) -> pa.RecordBatch:
    hashes, cuts = shingles(part.column("text"))
    rows = len(cuts) - 1
    filled = np.flatnonzero(np.diff(cuts) > 0)
    starts = cuts[filled]
    values = np.empty((len(filled), 2 * len(factors)), np.uint32)
    if len(filled):
        for k, factor in enumerate(factors):
            turned = hashes * factor
            values[:, 2 * k] = np.minimum.reduceat(turned, starts) >> np.uint64(32)
            values[:, 2 * k + 1] = np.maximum.reduceat(turned, starts) >> np.uint64(32)
    bands = np.zeros((len(filled), 2 * len(factors) // BAND), np.uint64)
    for k in range(bands.shape[1]):
        key = np.full(len(filled), k + 1, np.uint64)
        for j in range(BAND):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, BAND * k + j])
        bands[:, k] = key
    sizes, digests = np.zeros(rows, np.int64), [None] * rows
    for r in filled:
        unique = np.unique(hashes[cuts[r] : cuts[r + 1]])
        sizes[r], digests[r] = len(unique), hashlib.blake2b(unique.tobytes(), digest_size=16).digest()
    place = np.full(rows, -1)
    place[filled] = np.arange(len(filled))
    lists = [bands[p].view(np.int64) if p >= 0 else None for p in place]
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(sizes), pa.array(digests, pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
        schema=_SIGNED,
    )


def signed(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, set_hash, bands`` of ``doc_id, text``."""
    factors = _factors(band_count(percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text", SLICE_BYTES):
                yield _sign(part, factors)

    return text_batches(rows).mapInArrow(run, "doc_id long, n_shingles long, set_hash binary, bands array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``u, v`` whose full sets link; ``texts`` has ``doc_id, text`` of all that occur."""
    left = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            known: tuple = (None, None)
            sets, cuts = shingles(batch.column("text_v"))
            ids, texts_u = batch.column("u").to_pylist(), batch.column("text_u")
            for i, u in enumerate(ids):
                if u != known[0]:  # the join leaves pairs of one pivot together
                    known = (u, np.unique(shingles(texts_u.slice(i, 1))[0]))
                own = np.unique(sets[cuts[i] : cuts[i + 1]])
                both = len(np.intersect1d(known[1], own, assume_unique=True))
                keep.append(100 * both >= percent * (len(own) + len(known[1]) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    # the texts of candidates grow with the corpus: they are shuffled at every size, never broadcast
    both = pairs.join(right.hint("merge"), "v").join(left.hint("merge"), "u")
    return both.select("u", "v", "text_u", "text_v").mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every end of an edge ``u, v``: the smallest id that can be reached.

    Each step takes the smallest label among neighbours and then the label of that label, until nothing changes.
    """
    both = stored(edges.union(edges.select("v", "u")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("v")).select("id", F.least("id", "v").alias("component")), "labels")
    while True:
        near = both.join(labels, both["v"] == labels["id"]).groupBy(F.col("u").alias("id")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "id").select("id", F.col("component").alias("was"), F.least("component", "near").alias("to"))
        over = labels.select(F.col("id").alias("to"), F.col("component").alias("beyond"))
        new = stored(lower.join(over, "to").select("id", "was", F.least("to", "beyond").alias("component")), "labels")
        labels = new.select("id", "component")
        if new.where(F.col("component") != F.col("was")).isEmpty():
            return labels


def _linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the first one it reaches by links, as an index; sets are sorted and distinct."""
    m = len(sets)
    sizes = np.array([len(x) for x in sets])
    _, ids, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), sizes)
    shared = often[ids] > 1
    row, ids = row[shared], (np.cumsum(often > 1) - 1)[ids[shared]]
    both = np.zeros((m, m), np.float32)
    order = np.argsort(ids, kind="stable")
    row, ids = row[order], ids[order]
    for first in range(0, int(ids[-1]) + 1 if len(ids) else 0, _COLUMNS):
        a, b = np.searchsorted(ids, (first, first + _COLUMNS))
        grid = np.zeros((m, min(_COLUMNS, int(ids[-1]) + 1 - first)), np.float32)
        grid[row[a:b], ids[a:b] - first] = 1
        both += grid @ grid.T
    links = (both > 0) & (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both))
    np.fill_diagonal(links, True)
    label = np.arange(m)
    while True:
        lower = np.where(links, label[None, :], m).min(axis=1)
        if (lower == label).all():
            return label
        label = lower


def _across(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs ``u, v`` that are linked directly or by others, from ``band, doc_id, component, n_shingles``."""
    bulk = members.groupBy("band").agg(F.count("*").alias("rows"), F.sum("n_shingles").alias("bulk"))
    parts = F.greatest(F.ceil(F.col("rows") / PART_ROWS), F.ceil(F.col("bulk") / PART_SHINGLES)).cast("int")
    parts = bulk.select("band", parts.alias("parts"))
    cells = members.join(parts, "band").withColumn("own", F.pmod(F.xxhash64("doc_id"), "parts").cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = cells.withColumns({"a": F.least("own", "other"), "b": F.greatest("own", "other")})

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        ids, component = table["doc_id"].to_numpy(), table["component"].to_numpy()
        found, cuts = shingles(table["text"])
        label = _linked([np.unique(found[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], percent)
        new = component != component[label]
        return pa.table({"u": ids[label][new], "v": ids[new]})

    full = cells.select("band", "a", "b", "doc_id", "component").join(texts.hint("merge"), "doc_id")
    return full.groupBy("band", "a", "b").applyInArrow(compare, "u long, v long").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``; texts link from a similarity of ``percent`` on."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    named = rows.where(F.col("doc_id").isNotNull())
    if not _repeats(named):
        return _groups(rows, percent)
    placed = _placed(named, "doc_id", "text", "place")
    groups = _groups(placed.select(F.col("place").alias("doc_id"), "text"), percent).withColumnRenamed("doc_id", "place")
    ids = placed.select("place", "doc_id")
    found = groups.join(ids, "place").join(ids.toDF("component_id", "smallest"), "component_id")
    without = signed(rows.where(F.col("doc_id").isNull()), percent).select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    kept = F.col("doc_id") == F.col("smallest")
    return found.select("doc_id", "n_shingles", F.col("smallest").alias("component_id"), kept.alias("kept")).union(without)


def _repeats(named: DataFrame) -> bool:
    return not named.groupBy("doc_id").count().where("count > 1").isEmpty()


def _placed(docs: DataFrame, id_col: str, text_col: str, out: str) -> DataFrame:
    """``docs`` with the place of each row when they are sorted by id: numbers of their own for rows that share an id."""
    return with_rank(docs, [docs[id_col].cast("long"), F.xxhash64(docs[text_col])], out)


def _groups(rows: DataFrame, percent: int) -> DataFrame:
    """The groups of ``doc_id, text`` whose ids differ, or are null."""
    marked = stored(signed(rows, percent), "signatures")
    nodes = marked.where(F.col("doc_id").isNotNull() & F.col("set_hash").isNotNull())
    one = F.min(F.struct("doc_id", "n_shingles", "bands"))
    classes = stored(nodes.groupBy("set_hash").agg(one.alias("one"), F.count("*").alias("n")).select("set_hash", "n", "one.*"), "classes")
    bands = classes.select("doc_id", F.explode("bands").alias("band"))
    buckets = stored(bands.groupBy("band").agg(F.min("doc_id").alias("pivot"), F.count("*").alias("n")).where("n > 1"), "buckets")
    members = stored(hot_join(bands, buckets, "band", "n"), "members")  # band, doc_id, pivot, n

    first = stored(members.where("pivot < doc_id").select(F.col("pivot").alias("u"), F.col("doc_id").alias("v")).distinct(), "pairs")
    involved = members.select("doc_id").distinct()
    texts = stored(rows.hint("merge").join(involved, "doc_id", "left_semi"), "texts")
    links = stored(confirmed(first, texts, percent), "links")
    found = components(links)

    state = members.where("pivot < doc_id").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    state = stored(state.select("band", "doc_id", F.coalesce("component", "doc_id").alias("component")), "state")
    mixed = state.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band")
    rest = stored(state.join(mixed, "band").join(classes.select("doc_id", "n_shingles"), "doc_id"), "rest")
    second = _across(rest, texts, percent)
    final = components(links.union(second))
    labels = classes.join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "set_hash", "n", F.coalesce("component", "doc_id").alias("component_id")
    )
    grouped = hot_join(nodes.select("doc_id", "n_shingles", "set_hash"), stored(labels, "components"), "set_hash", "n")
    alone = marked.where(F.col("doc_id").isNull() | F.col("set_hash").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.select("doc_id", "n_shingles", "component_id").union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of each group, with all columns. The list of those that go grows with the corpus, so it is not broadcast."""
    own_id = docs[id_col].cast("long")
    if not _repeats(docs.select(own_id.alias("doc_id")).where("doc_id IS NOT NULL")):
        gone = near_groups(docs, id_col, text_col, percent).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"))
        return docs.hint("merge").join(gone, own_id == gone["gone_id"], "left_anti")
    place = max([*docs.columns, "place"], key=len) + "_"  # no column has this name
    placed = _placed(docs, id_col, text_col, place)
    rows = placed.where(placed[id_col].isNotNull()).select(placed[place].alias("doc_id"), placed[text_col].cast("string").alias("text"))
    gone = _groups(rows, percent).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"))
    return placed.hint("merge").join(gone, placed[place] == gone["gone_id"], "left_anti").select(*[placed[c] for c in docs.columns])
