"""Search for any of very many values at once.

A regular expression of all values, as :func:`tagloom.functions.text.any_of_pattern` makes, tries them one after another
at each place. Here the values are a table. They are cut into blocks of bounded size; a task makes an Aho–Corasick automaton
of a block and runs it over its texts, in time linear in the text, whatever the number of values. A table of several blocks
costs a pass over the texts for each, so that no task or driver holds more than one.

Defined cases: empty and null values match nothing; values that repeat are one; a null text has no hits; values
are compared letter by letter, upper and lower case differ; places are code points from 0; a row without a key is not matched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import freeze

#: Letters of the values of a block; an automaton needs some hundred bytes for each.
BLOCK_LETTERS = 2_000_000
_HITS = "doc_id {kind}, value string, start int"


def value_blocks(values: DataFrame, col: str = "value", letters: int = BLOCK_LETTERS) -> DataFrame:
    """(value, block): the distinct values, dealt by hash to blocks of about ``letters`` letters."""
    distinct = freeze(values.select(F.col(col).alias("value")).where("value <> ''").distinct())
    total = distinct.agg(F.sum(F.length("value"))).first()[0] or 0
    blocks = max(1, -(-total // letters))
    return distinct.withColumn("block", F.pmod(F.xxhash64("value"), F.lit(blocks)).cast("int"))


def _automaton(values: list[str]):
    import ahocorasick

    tree = ahocorasick.Automaton()
    for value in values:
        tree.add_word(value, value)
    tree.make_automaton()
    return tree


def find_values(docs: DataFrame, values: DataFrame, text: str = "text", key: str = "doc_id", col: str = "value", letters: int = BLOCK_LETTERS) -> DataFrame:
    """(doc_id, value, start): every place of every value in every text, overlapping ones too."""
    spark = docs.sparkSession
    blocks = freeze(value_blocks(values, col, letters))
    kind = dict(docs.dtypes)[key]
    numbers = sorted(r.block for r in blocks.select("block").distinct().collect())
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = spark.createDataFrame([], _HITS.format(kind=kind))
    for number in numbers:
        shared = spark.sparkContext.broadcast([r.value for r in blocks.where(F.col("block") == number).select("value").collect()])  # one block

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tree = _automaton(shared.value)
            for batch in batches:
                ids, found, starts = [], [], []
                for i, line in enumerate(batch.column("text").to_pylist()):
                    for end, value in tree.iter(line or ""):
                        ids.append(i), found.append(value), starts.append(end - len(value) + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(ids, pa.int64())), pa.array(found, pa.string()), pa.array(starts, pa.int32())],
                    names=["doc_id", "value", "start"],
                )

        out = out.union(rows.mapInArrow(run, _HITS.format(kind=kind)))
    return out


def value_counts(docs: DataFrame, values: DataFrame, text: str = "text", key: str = "doc_id", col: str = "value", letters: int = BLOCK_LETTERS) -> DataFrame:
    """(doc_id, value, n): how often each value stands in each text that holds it."""
    return find_values(docs, values, text, key, col, letters).groupBy("doc_id", "value").agg(F.count(F.lit(1)).alias("n"))


def matches_any_value(docs: DataFrame, values: DataFrame, text: str = "text", key: str = "doc_id", col: str = "value", letters: int = BLOCK_LETTERS) -> DataFrame:
    """``docs`` with ``matched``: whether the text holds any of the values."""
    hits = find_values(docs, values, text, key, col, letters).select(F.col("doc_id").alias("_hit")).distinct()
    joined = docs.join(hits, F.col(key) == F.col("_hit"), "left")
    return joined.select(*docs.columns, F.col("_hit").isNotNull().alias("matched"))
