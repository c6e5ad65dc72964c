"""Projections, filters, casts, nested fields and small column arithmetic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.constants import OUTSIDE
from tagloom.functions.text import as_col, cut_pos, endswith_any, has_cjk, word_count, words_of


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def reorder(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep ``names`` in this order, for example to swap the tag and POS columns."""
    return df.select(*names)


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def filter_ne(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) != F.lit(value))


def filter_regex(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.where(F.col(col).rlike(pattern))


def filter_not_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(~F.col(col).isin(list(values)))


def filter_min_length(df: DataFrame, col: str, length: int = 2) -> DataFrame:
    return df.where(F.length(col) >= length)


def filter_above(df: DataFrame, col: str, bound: float = 1.0) -> DataFrame:
    return df.where(F.col(col) > bound)


def filter_words(df: DataFrame, col: str, multi: bool, collapse: bool = False) -> DataFrame:
    """Rows whose ``col`` holds one word, or more than one with ``multi``."""
    n = word_count(col, collapse)
    return df.where(n > 1 if multi else n == 1)


def remap_labels(col: Column | str, labels: Sequence[str], new: str, misc: str = "MISC") -> Column:
    """``new`` for a listed label, ``misc`` for any other and for null."""
    return F.when(as_col(col).isin(list(labels)), F.lit(new)).otherwise(F.lit(misc))


def case_contains(col: Column | str, cases: Sequence[tuple[str, str]], default: str) -> Column:
    """First case whose text occurs in ``col`` wins."""
    (text, label), *rest = cases
    out = F.when(as_col(col).contains(text), label)
    for text, label in rest:
        out = out.when(as_col(col).contains(text), label)
    return out.otherwise(default)


def cast_columns(df: DataFrame, names: Sequence[str], to: str, lenient: bool = False) -> DataFrame:
    """Cast several columns; ``lenient`` gives null for a value that does not fit."""
    return df.withColumns({n: F.col(n).try_cast(to) if lenient else F.col(n).cast(to) for n in names})


def map_literal(mapping: Mapping[str, str]) -> Column:
    """A fixed small mapping as a literal map column."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def map_or_null(col: Column | str, mapping: Mapping[str, str]) -> Column:
    return F.try_element_at(map_literal(mapping), as_col(col))


def map_tag_type(tag: Column | str, types: Mapping[str, str]) -> Column:
    """Replace the type behind a BILOU prefix; ``O`` stays and an unknown type gives null."""
    t = as_col(tag)
    return F.when(t == OUTSIDE, t).otherwise(
        F.concat(F.substring(t, 1, 2), map_or_null(F.substr(t, F.lit(3)), types))
    )


def pct_ratio(a: Column | str, b: Column | str, decimals: int = 2) -> Column:
    """100·a/b; null where b is zero."""
    return F.round(F.try_divide(F.lit(100.0) * as_col(a), as_col(b)), decimals)


def combine_columns(cols: Sequence[Column | str], text: bool = False) -> Column:
    """Fold columns with ``+``: a sum, or a concatenation with ``text``."""
    columns = [as_col(c) for c in cols]
    return F.concat(*columns) if text else reduce(lambda a, b: a + b, columns)


def explode_pairs(df: DataFrame, key: str, values: str, names: Sequence[str] = ("key", "value")) -> DataFrame:
    """{key: [v, …]} to one (key, v) row per value."""
    return df.select(F.col(key).alias(names[0]), F.explode(values).alias(names[1]))


def map_entries(df: DataFrame, col: str, names: Sequence[str] = ("key", "value")) -> DataFrame:
    return df.select(F.explode(col).alias(*names))


def zip_to_map(keys: Column, values: Column) -> Column:
    """Two arrays to a map, cut at the shorter one; the last value of a repeated key wins."""
    n = F.least(F.size(keys), F.size(values))
    latest = F.reverse(F.arrays_zip(F.slice(keys, 1, n).alias("k"), F.slice(values, 1, n).alias("v")))
    distinct = F.array_distinct(F.transform(latest, lambda p: p["k"]))
    firsts = F.transform(distinct, lambda k: F.get(F.filter(latest, lambda p: p["k"] == k), F.lit(0))["v"])
    return F.map_from_arrays(distinct, firsts)


def flatten_cells(df: DataFrame, names: Sequence[str], out: str = "value") -> DataFrame:
    """Every cell of the named columns as one column of text."""
    return df.select(F.explode(F.array(*[F.col(n).cast("string") for n in names])).alias(out))


def nested_words(df: DataFrame, path: str, is_array: bool, out: str = "name") -> DataFrame:
    """One-word values of a nested field, once each and in order."""
    value = F.explode(path) if is_array else F.col(path)
    return filter_words(df.select(value.alias(out)), out, multi=False, collapse=True).distinct().orderBy(out)


def lexical_words(col: Column | str, suffixes: Sequence[str]) -> Column:
    """Words of a ``word#POS`` sentence whose tag ends with one of ``suffixes``."""
    return F.transform(F.filter(words_of(col), lambda w: endswith_any(w, suffixes)), cut_pos)


def noun_words(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).contains("#N")).distinct()


def clean_pos_table(df: DataFrame, stop_words: DataFrame, word_pos: str = "word_pos", value: str = "value") -> DataFrame:
    """CJK nouns that are neither temporal nor stop words, highest value first.

    ``stop_words`` has one column ``word``. The anti join carries no hint:
    Spark broadcasts the list only while it is under its size threshold.
    """
    kept = df.where(has_cjk(word_pos) & F.col(word_pos).contains("#N") & ~F.col(word_pos).contains("#NT"))
    stops = stop_words.select(F.col("word").alias("_stop"))
    return (
        kept.join(stops, cut_pos(word_pos) == F.col("_stop"), "left_anti")
        .orderBy(F.col(value).desc(), F.col(word_pos))
    )
