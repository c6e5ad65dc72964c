"""File sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.constants import ROWS_PER_FILE
from tagloom.operators.ranking import with_position, with_rank

WRITERS = 10_000


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_chunked(
    df: DataFrame,
    path: str,
    rows: int = ROWS_PER_FILE,
    mode: str = "errorifexists",
    order: Sequence[Column | str] | None = None,
) -> None:
    """CSV files of exactly ``rows`` rows each but the last, in ``order`` or else as the table stands.

    The names of the files follow the order. Rows get their place in the whole table without passing through one task; those of
    neighbouring files then meet in one task, which starts a new file at each border. At most WRITERS tasks write. Spark's commit
    protocol sees to lost tasks. A table without rows gives one file without any. ``_place`` and ``_rows`` are no names for columns.
    """
    placed = with_rank(df, order, "_place", "_rows") if order else with_position(df, "_place", "_rows")
    total = placed.agg(F.max("_rows")).first()[0] or 0
    files = max(1, -(-total // rows))
    each = -(-files // WRITERS)
    writer = F.floor(F.col("_place") / (rows * each)).cast("int")
    dealt = placed.repartitionById(-(-files // each), writer).sortWithinPartitions("_place").drop("_place", "_rows")
    dealt.write.mode(mode).option("header", True).option("maxRecordsPerFile", rows).csv(path)


def write_text(df: DataFrame, path: str, column: str, mode: str = "errorifexists") -> None:
    df.select(column).write.mode(mode).text(path)


def write_lines(lines: DataFrame, path: str, order: Sequence[str] = ("doc_id", "sent_id"), mode: str = "errorifexists") -> None:
    """Text files whose lines, file after file, follow ``order``."""
    write_text(lines.orderBy(*order), path, "value", mode)
