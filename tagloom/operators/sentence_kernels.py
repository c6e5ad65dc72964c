"""Work on the token rows of whole sentences, taken from Arrow batches (runs inside tasks).

The rows of a sentence lie one after another and share the number in ``_seq``, which differs from the one before.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEQ = "_seq"
ROWS_AT_ONCE = 200_000  # rows a task holds at a time, in whole sentences


def first_rows(table: pa.Table) -> np.ndarray:
    """The places at which sentences begin."""
    seq = table[SEQ].to_numpy()
    return np.flatnonzero(np.append(True, seq[1:] != seq[:-1])) if len(seq) else np.zeros(0, np.int64)


def in_order(table: pa.Table, starts: np.ndarray, by: Sequence[str]) -> pa.Table:
    """Rows of a sentence in the order of ``by``; only sentences made of several texts are not in it already."""
    at = table[by[0]].to_numpy()
    ahead = at[1:] > at[:-1]
    ahead[starts[1:] - 1] = True
    if ahead.all():
        return table
    sentence = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(at))))
    keys = pa.table({"s": sentence, **{f"k{i}": table[c] for i, c in enumerate(by)}})
    return table.take(pc.sort_indices(keys, sort_keys=[(c, "ascending") for c in keys.column_names], null_placement="at_start")).combine_chunks()


def whole_runs(
    batches: Iterable[pa.RecordBatch], by: Sequence[str], limit: int = ROWS_AT_ONCE
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Regroup token rows into tables of whole sentences, with the places at which these begin.

    A table holds about ``limit`` rows, more only if one sentence does.
    """
    held, rows, wanted = [], 0, limit
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < wanted:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        starts = first_rows(table)
        cut = int(starts[-1])
        if cut:
            yield in_order(table.slice(0, cut).combine_chunks(), starts[:-1], by), starts[:-1]
            table = table.slice(cut)
        held, rows = table.to_batches(), table.num_rows
        wanted = max(limit, 2 * rows)
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        starts = first_rows(table)
        yield in_order(table, starts, by), starts


def only(column: pa.ChunkedArray) -> pa.Array:
    """A column of a combined table as one array."""
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def lists(table: pa.Table, starts: np.ndarray, keys: Sequence[str], cols: Sequence[str], out: str) -> pa.Table:
    """A row per sentence with its rows as an array of structs."""
    structs = pa.StructArray.from_arrays([only(table[c]) for c in cols], list(cols))
    offsets = pa.array(np.append(starts, table.num_rows), pa.int32())
    return table.select(list(keys)).take(pa.array(starts)).append_column(out, pa.ListArray.from_arrays(offsets, structs))


def words(
    table: pa.Table, starts: np.ndarray, keys: Sequence[str], tag: str, closers: Sequence[str], sep: str, packed: bool
) -> pa.Table:
    """Tokens joined up to each closing tag: a row per word, or per sentence with its words in one array."""
    n = table.num_rows
    closes = pc.fill_null(pc.is_in(table[tag], value_set=pa.array(list(closers))), False).to_numpy()
    ends = np.flatnonzero(closes)
    sentence = np.searchsorted(starts, ends, side="right") - 1
    begins = np.maximum(np.append(0, ends[:-1] + 1), starts[sentence]) if len(ends) else ends
    inside = np.zeros(n + 1, np.int64)  # words that begin less words that ended: the rows of an unclosed tail have none
    inside[begins] += 1
    inside[ends + 1] -= 1
    valid = (np.cumsum(inside)[:n] > 0) & only(table["token"]).is_valid().to_numpy(zero_copy_only=False)
    before = np.append(0, np.cumsum(valid))
    token = only(table["token"].filter(pa.array(valid)))
    offsets = pa.array(np.append(before[begins], before[-1]), pa.int32())
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, token), sep)
    first = np.searchsorted(sentence, np.arange(len(starts) + 1))
    if packed:
        arrays = pa.ListArray.from_arrays(pa.array(first, pa.int32()), joined)
        return table.select(list(keys)).take(pa.array(starts)).append_column("words", arrays)
    out = table.select(list(keys)).take(pa.array(begins))
    out = out.append_column("word_id", pa.array((np.arange(len(ends)) - first[sentence]).astype(np.int32)))
    return out.append_column("word", joined)


def entities(table: pa.Table, starts: np.ndarray, outside: str) -> pa.Table:
    """(is_truth, tag, found, n): how many entities the truth and the prediction have, by their first tag and whether both agree on all of it."""
    n = table.num_rows
    sentence = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    truth, pred = only(table["truth"]), only(table["pred"])
    same = pc.or_(pc.fill_null(pc.equal(truth, pred), False), pc.and_(pc.is_null(truth), pc.is_null(pred))).to_numpy(zero_copy_only=False)
    parts = []
    for tags in (truth, pred):
        at = np.flatnonzero(pc.fill_null(pc.not_equal(tags, outside), False).to_numpy(zero_copy_only=False))
        if not len(at):
            continue
        own = tags.take(pa.array(at))
        closes = pc.or_(pc.starts_with(own, "U"), pc.starts_with(own, "L")).to_numpy(zero_copy_only=False)
        ends = closes | np.append(np.diff(sentence[at]) != 0, True)
        first = np.append(0, np.flatnonzero(ends)[:-1] + 1)
        found = np.logical_and.reduceat(same[at], first)
        part = pa.table({"is_truth": np.full(len(first), tags is truth), "tag": own.take(pa.array(first)), "found": found})
        parts.append(part)
    if not parts:
        return pa.table({"is_truth": pa.array([], pa.bool_()), "tag": pa.array([], pa.string()), "found": pa.array([], pa.bool_()), "n": pa.array([], pa.int64())})
    counted = pa.concat_tables(parts).group_by(["is_truth", "tag", "found"]).aggregate([([], "count_all")])
    return counted.rename_columns(["n" if c == "count_all" else c for c in counted.column_names]).select(["is_truth", "tag", "found", "n"])


def with_ends(table: pa.Table, starts: np.ndarray, order: str, end: dict[str, str], cols: Sequence[str]) -> pa.Table:
    """The rows with an end row behind each sentence, which has the sentence's keys, the next ordinal and the values of ``end``."""
    n, ends = table.num_rows, np.append(starts[1:], table.num_rows)
    last = table.take(pa.array(ends - 1))
    place = pa.array(np.insert(np.arange(n), ends, n + np.arange(len(ends))))
    out = {}
    for c in cols:
        kind = table.schema.field(c).type
        if c == order:
            extra = pc.add(only(last[c]), pa.scalar(1, kind))
        else:
            extra = pa.array([end[c]] * len(ends), kind) if c in end else only(last[c])
        out[c] = pa.concat_arrays([only(table[c]), extra]).take(place)
    return pa.table(out)
