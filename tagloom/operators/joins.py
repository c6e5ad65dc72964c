"""Joins of tables and lexicon lookups.

No join carries a broadcast hint. Spark broadcasts a side while its size is
under ``spark.sql.autoBroadcastJoinThreshold``; beyond that it shuffles both
sides and adaptive execution splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING = "0"


def join_inner(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner equi-join without rows that hold a null."""
    return a.join(b, on, "inner").dropna()


def join_all(frames: Sequence[DataFrame], on: str | Sequence[str], how: str = "inner") -> DataFrame:
    return reduce(lambda left, right: left.join(right, on, how), frames)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate rows; a column missing in one frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def only_in(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return a.join(b.select(*([on] if isinstance(on, str) else on)), on, "left_anti")


def wide_lexicons(lexicons: DataFrame, names: Sequence[str]) -> DataFrame:
    """(token, one column per lexicon) from (lexicon, token, value)."""
    return lexicons.groupBy("token").pivot("lexicon", list(names)).agg(F.max("value"))


def add_lexicons(
    tokens: DataFrame, lexicons: DataFrame, names: Sequence[str], lower: bool = False, kind: str = "value"
) -> DataFrame:
    """Add one column per lexicon: the value found, or ``'0'``.

    ``kind`` picks what a hit shows: the stored ``value``, the ``token`` itself,
    or a ``flag`` '1'. ``lower`` looks up the lower-cased token. All lexicons
    share one join.
    """
    wide = wide_lexicons(lexicons, names).select(
        F.col("token").alias("_look"), *[F.col(n).alias(f"_{n}") for n in names]
    )
    look = F.lower("token") if lower else F.col("token")
    hit = {"value": lambda n: F.col(f"_{n}"), "token": lambda _: F.col("token"), "flag": lambda _: F.lit("1")}[kind]
    joined = tokens.join(wide, look == F.col("_look"), "left")
    return joined.select(
        *tokens.columns,
        *[F.when(F.col(f"_{n}").isNotNull(), hit(n)).otherwise(F.lit(MISSING)).alias(n) for n in names],
    )
