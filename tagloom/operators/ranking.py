"""Global order without a single-task window.

A total order is made by a range-partitioned sort. The sorted rows are written
to the checkpoint folder, so partition numbers and row positions stay the same
if a task runs again, and one row per partition is enough to turn positions
inside partitions into positions in the whole table. The order must end in a
unique column: equal values then spread over partitions like any others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.text import as_col
from tagloom.session import freeze

LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits
TOP_ROWS = 100_000


def _parts_before(parts: DataFrame) -> DataFrame:
    """Running total over one row per partition; its size is bound by the partition count."""
    by_part = Window.orderBy("_part")
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    return parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_before"),
        F.sum("_n").over(everything).cast("long").alias("_total"),
    )


def _sorted_parts(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    placed = df.orderBy(*[as_col(c) for c in order]).withColumn("_mid", F.monotonically_increasing_id())
    return freeze(placed).withColumn("_part", F.shiftright("_mid", LOCAL_BITS))


def with_rank(df: DataFrame, order: Sequence[Column | str], out: str = "rank", total: str | None = None) -> DataFrame:
    """Add the 0-based position in the given order, and the row count as ``total``."""
    placed = _sorted_parts(df, order)
    counts = _parts_before(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")))
    local = F.col("_mid").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    extra = [F.col("_total").alias(total)] if total else []
    return placed.join(F.broadcast(counts), "_part").select(
        *df.columns, (F.col("_before") + local).alias(out), *extra
    )


def with_position(df: DataFrame, out: str = "position", total: str | None = None) -> DataFrame:
    """Add the 0-based position of each row in the order the table is in now, and the row count as ``total``; nothing is sorted."""
    placed = freeze(df.withColumn("_mid", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_mid", LOCAL_BITS))
    counts = _parts_before(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")))
    local = F.col("_mid").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    extra = [F.col("_total").alias(total)] if total else []
    return placed.join(F.broadcast(counts), "_part").select(*df.columns, (F.col("_before") + local).alias(out), *extra)


def rank_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str = "rank") -> DataFrame:
    """Add the 0-based position inside each key; a hot key is spread over many tasks."""
    placed = _sorted_parts(df, [*keys, *order])
    pieces = placed.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *keys, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_before")
    )
    return placed.join(offsets, [*keys, "_part"]).select(
        *df.columns, (F.col("_before") + F.col("_mid") - F.col("_first")).alias(out)
    )


SKETCH_SIZES = (8, 65535)


def sketch_size(error: float) -> int:
    """The parameter of a KLL sketch whose ranks are off by at most ``error`` of all rows, in 99 of 100 cases."""
    return min(max(math.ceil((2.296 / error) ** (1 / 0.9723)), SKETCH_SIZES[0]), SKETCH_SIZES[1])


def quantile_sketches(df: DataFrame, col: str, error: float, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, sketch): a mergeable summary of a number column, one for the table or for each key.

    A sketch has a size that follows from ``error`` and not from the rows; partial ones are merged before the shuffle. Nulls
    do not count, and a key without a value has no row.
    """
    sketch = F.kll_sketch_agg_double(F.col(col).cast("double"), sketch_size(error))
    return df.where(F.col(col).isNotNull()).groupBy(*keys).agg(sketch.alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, sketch): summaries of several tables, or of days or parts of one, brought together."""
    return sketches.where("sketch IS NOT NULL").groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantiles(sketches: DataFrame, points: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, q0, q1, …): values whose rank is near the wanted one; null where nothing was counted."""
    at = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"q{i}") for i, p in enumerate(points)]
    full = F.when(F.kll_sketch_get_n_double("sketch") > 0, F.col("sketch"))
    return sketches.withColumn("sketch", full).select(*keys, *at)


def quantiles(df: DataFrame, col: str, points: Sequence[float], error: float | None = None) -> DataFrame:
    """One row with linearly interpolated quantiles ``q0``, ``q1``, ….

    They are exact without ``error``: equal values are counted first, so the sort sees each value once. With ``error``, a
    share of all rows, they are values of the column whose rank is off by at most that (see :func:`sketch_size`), and nothing
    is sorted.
    """
    if error is not None:
        return sketched_quantiles(quantile_sketches(df, col, error), points)
    placed = _sorted_parts(df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c")), [col])
    parts = _parts_before(placed.groupBy("_part").agg(F.sum("_c").alias("_n")))
    inside = Window.partitionBy("_part").orderBy("_mid")
    upto = placed.withColumn("_upto", F.sum("_c").over(inside)).join(F.broadcast(parts), "_part")
    last = F.col("_before") + F.col("_upto") - 1
    first = last - F.col("_c") + 1
    held = []
    for i, q in enumerate(points):
        at = F.lit(float(q)) * (F.col("_total") - 1)
        for side, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            held.append(F.max(F.when(pos.between(first, last), F.col(col).cast("double"))).alias(f"{side}{i}"))
        held.append(F.max(at - F.floor(at)).alias(f"part{i}"))
    row = upto.agg(*held)
    return row.select(
        *[
            (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"part{i}")).alias(f"q{i}")
            for i in range(len(points))
        ]
    )


def split_evenly(df: DataFrame, order: Sequence[Column | str], pieces: int = 5, out: str = "piece") -> DataFrame:
    """Add the 0-based piece of ``pieces`` near-equal ones in this order, longer pieces first."""
    n, r = F.col("_n_rows"), F.col("_rank")
    size, longer = F.floor(n / pieces), F.pmod(n, F.lit(pieces))
    head = longer * (size + 1)
    piece = F.when(r < head, F.floor(r / (size + 1))).otherwise(
        longer + F.floor((r - head) / F.greatest(size, F.lit(1)))
    )
    return with_rank(df, order, "_rank", "_n_rows").select(*df.columns, piece.cast("int").alias(out))


def top_fraction(df: DataFrame, order: Sequence[Column | str], cut: float = 0.1) -> DataFrame:
    """The first ⌊cut·n⌋ rows in this order."""
    ranked = with_rank(df, order, "_rank", "_n_rows")
    return ranked.where(F.col("_rank") < F.floor(F.col("_n_rows") * F.lit(cut))).select(*df.columns)


def slice_rows(df: DataFrame, order: Sequence[Column | str], start: int, end: int) -> DataFrame:
    """Rows ``start`` to ``end`` (not included) in this order."""
    return with_rank(df, order, "_rank").where(F.col("_rank").between(start, end - 1)).select(*df.columns)


def sample_rows(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """``k`` rows without replacement: the smallest salted hashes of a unique key."""
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")).cast("binary"))
    if k <= TOP_ROWS:
        return df.withColumn("_draw", draw).orderBy("_draw", key).limit(k).drop("_draw")
    return slice_rows(df.withColumn("_draw", draw), ["_draw", key], 0, k).drop("_draw")


def decile_points(df: DataFrame, value: str, order: Sequence[Column | str], out: str = "position") -> DataFrame:
    """(position, value): every ⌊n/10⌋-th row, then the maximum unless the last pick equals it.

    Fewer than eleven rows come back whole.
    """
    ranked = with_rank(df.select(*[as_col(c) for c in order], F.col(value).alias("_value")), order, "_rank", "_n_rows")
    n, r = F.col("_n_rows"), F.col("_rank")
    step = F.when(n < 11, F.lit(1)).otherwise(F.floor(n / 10))
    last_pick = F.floor((n - 1) / step) * step
    picked = ranked.where(F.pmod(r, step) == 0).select(r.alias(out), F.col("_value").alias("value"))
    top = ranked.agg(
        F.max("_n_rows").alias(out),
        F.max("_value").alias("value"),
        F.max(F.when(r == last_pick, F.col("_value"))).alias("_last"),
    )
    extra = top.where((F.col("value") != F.col("_last")) & (F.col(out) >= 11)).select(out, "value")
    return picked.unionByName(extra)


def group_to_list(
    df: DataFrame, key: str, value: str, order: Sequence[Column | str], chunk_rows: int = 10_000
) -> DataFrame:
    """(key, chunk, values): each key's values in order.

    A key with more than ``chunk_rows`` values gets several numbered rows, so no
    task ever gathers an unbounded list.
    """
    ranked = rank_in_key(df.select(key, value, *[c for c in order if c not in (key, value)]), [key], order, "_rank")
    pairs = F.sort_array(F.collect_list(F.struct("_rank", value)))
    return (
        ranked.withColumn("chunk", F.floor(F.col("_rank") / chunk_rows).cast("int"))
        .groupBy(key, "chunk")
        .agg(F.transform(pairs, lambda p: p[value]).alias("values"))
    )
