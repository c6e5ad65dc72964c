"""Operators over ordered token rows.

``keys`` name one sequence and ``order`` its ordinal. A sequence that stems
from one text cell (document, sentence) is windowed as it is. A sequence that
may be a whole imported file is cut into blocks of its gap-free ordinal: a
prefix sum then needs one row per block, and a look-ahead copies the few rows
next to a block border, so that no task holds a whole file.

A *sentence table* is a token table whose sentences lie whole and in order
inside partitions, the rows of a sentence one after another; ``_seq`` tells it
from the one before. Texts are made into one by a shuffle of the texts, not of
their tokens. Narrow operators keep it one, and operators that need whole
sentences take either kind of table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.constants import END_TOKEN, OUTSIDE, WINDOW_SIZE
from tagloom.functions.text import format_pairs, startswith_any
from tagloom.operators import sentence_kernels
from tagloom.operators.sentence_kernels import SEQ

# Tasks get the kernels by value, so executors need not have this package.
cloudpickle.register_pickle_by_value(sentence_kernels)

BLOCK_ROWS = 1 << 16
SENTENCE = ("doc_id", "sent_id")
CLOSERS = ("L-", "U-")
BATCH_BYTES, NO_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch", str((1 << 31) - 1)


def ordered(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def is_packed(df: DataFrame) -> bool:
    """Whether ``df`` is a sentence table."""
    return SEQ in df.columns


def pack_texts(
    texts: DataFrame, text: str, spell: Callable[[DataFrame, Sequence[str]], DataFrame], keys: Sequence[str] = SENTENCE
) -> DataFrame:
    """(keys, _seq, …): the sentence table of (keys, text).

    ``spell`` turns a table of texts into token rows and keeps the named columns. Texts of one key are one sentence; its
    rows get their order where whole sentences are read. All texts of a document go to one partition. The number of
    partitions is fixed, as adaptive execution would join them by the size of the texts and not of what is made of them.
    """
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = texts.repartition(partitions, keys[0]).groupBy(*keys).agg(F.collect_list(text).alias("_texts"))
    numbered = grouped.withColumn(SEQ, F.monotonically_increasing_id())
    return spell(numbered.select(*keys, SEQ, F.explode("_texts").alias(text)), [*keys, SEQ])


def unpack(df: DataFrame) -> DataFrame:
    """The token rows of a sentence table; a token table as it is."""
    return df.drop(SEQ)


def count_rows(spark: SparkSession) -> None:
    """Have Arrow batches cut by rows alone in this session.

    Spark would measure the bytes of a batch at each row, which takes longer than to write a token row. The number of these
    bounds their bytes. Without a bound on rows the measuring stays.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 0:
        spark.conf.set(BATCH_BYTES, NO_LIMIT)


def by_sentence(
    df: DataFrame, by: Sequence[str], task: Callable[[pa.Table, np.ndarray], pa.Table], schema: str, limit: int = sentence_kernels.ROWS_AT_ONCE
) -> DataFrame:
    """What ``task`` makes of tables of whole sentences and the places at which these begin, their rows in the order of ``by``."""
    by = list(by)
    count_rows(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in sentence_kernels.whole_runs(batches, by, limit):
            yield from task(table, starts).combine_chunks().to_batches()

    return df.mapInArrow(run, schema)


def kinds(df: DataFrame, names: Sequence[str], sep: str = " ") -> str:
    """The named columns with their types, as in a schema."""
    return ", ".join(f"`{n}`{sep}{df.schema[n].dataType.simpleString()}" for n in names)


def with_fields(df: DataFrame, new: Mapping[str, Callable[[Callable[[str], Column]], Column]]) -> DataFrame:
    """Add or replace columns of the token rows; each function gets a function from a column's name to the column."""
    return df.withColumns({n: f(F.col) for n, f in new.items()})


def keep_fields(df: DataFrame, names: Sequence[str], keys: Sequence[str] = SENTENCE) -> DataFrame:
    """The token rows with only these columns behind the keys."""
    return df.select(*keys, *([SEQ] if is_packed(df) else []), *names)


def keep_rows(df: DataFrame, condition: Callable[[Callable[[str], Column]], Column]) -> DataFrame:
    """The token rows that fulfil ``condition``."""
    return df.where(condition(F.col))


def running_count(
    df: DataFrame, keys: Sequence[str], order: str, flag: Column, out: str, block_rows: int | None = None
) -> DataFrame:
    """Count the rows with ``flag`` strictly before each row of its sequence."""
    ones = flag.cast("int")
    if block_rows is None:
        w = ordered(keys, order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.coalesce(F.sum(ones).over(w), F.lit(0)))
    blocked = df.withColumn("_block", F.floor(F.col(order) / block_rows)).withColumn("_flag", ones)
    before = ordered(keys, "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy(*keys, "_block").agg(F.sum("_flag").alias("_n"))
        .select(*keys, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = ordered([*keys, "_block"], order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.withColumn("_inside", F.coalesce(F.sum("_flag").over(inside), F.lit(0)))
        .join(offsets, [*keys, "_block"])
        .select(*df.columns, (F.col("_before") + F.col("_inside")).alias(out))
    )


def next_value(
    df: DataFrame, keys: Sequence[str], order: str, col: str, default: str, out: str, block_rows: int | None = None
) -> DataFrame:
    """Value of ``col`` in the following row of the sequence."""
    if block_rows is None:
        return df.withColumn(out, F.lead(col, 1, default).over(ordered(keys, order)))
    at = F.col(order)
    block = F.floor(at / block_rows)
    homes = F.array_compact(
        F.array(
            F.struct(block.alias("b"), F.lit(True).alias("own")),
            F.when(at % block_rows == 0, F.struct((block - 1).alias("b"), F.lit(False).alias("own"))),
        )
    )
    copies = df.select(*df.columns, F.explode(homes).alias("_home")).withColumn("_block", F.col("_home.b"))
    return (
        copies.withColumn(out, F.lead(col, 1, default).over(ordered([*keys, "_block"], order)))
        .where("_home.own").select(*df.columns, out)
    )


def iob_to_bilou(
    df: DataFrame,
    tag: str = "ner",
    keys: Sequence[str] = SENTENCE,
    order: str = "tok_id",
    strict: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """``B-x`` before ``O`` turns to ``U-x`` and ``I-x`` before ``O`` to ``L-x``.

    The end of a sequence counts as ``O``. ``strict`` also closes a span in
    front of the next ``B-``.
    """
    closing = F.col("_next").startswith("O")
    if strict:
        closing = closing | F.col("_next").startswith("B-")
    t = F.col(tag)
    new = (
        F.when(closing & t.startswith("B-"), F.concat(F.lit("U-"), F.substr(t, F.lit(3))))
        .when(closing & t.startswith("I-"), F.concat(F.lit("L-"), F.substr(t, F.lit(3))))
        .otherwise(t)
    )
    ahead = next_value(df, keys, order, tag, OUTSIDE, "_next", block_rows)
    return ahead.withColumn(tag, new).select(*df.columns)


def sentence_ids(
    df: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    order: str = "tok_id",
    delim: str = END_TOKEN,
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Add ``sent_id``, the number of delimiter rows before a token, and drop the delimiters."""
    is_end = F.col("token") == delim
    return running_count(df, keys, order, is_end, "sent_id", block_rows).where(~is_end)


def delimiter_rows(df: DataFrame, keys: Sequence[str] = ("doc_id",), order: str = "tok_id", delim: str = END_TOKEN):
    """Positions of the delimiters."""
    return df.where(F.col("token") == delim).select(*keys, order)


def sentence_rows(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: str, out: str = "_rows") -> DataFrame:
    """(keys, _rows): the rows of each sentence as one array in order."""
    if not is_packed(df):
        return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, *cols))).alias(out))
    keys, inner = list(keys), [order, *cols]  # rows of one ordinal are in the order of their values
    schema = f"{kinds(df, keys)}, {out} array<struct<{kinds(df, inner, ': ')}>>"
    rows = df.select(*keys, SEQ, *inner)
    return by_sentence(rows, inner, lambda table, starts: sentence_kernels.lists(table, starts, keys, inner, out), schema)


def closed_runs(
    df: DataFrame, rows: str, closes: Callable[[Column], Column], out: str, keep_open: bool = False
) -> DataFrame:
    """Cut an array of rows behind every row that ``closes``.

    ``out`` is an array of runs; rows behind the last closing one make a run only
    with ``keep_open``.
    """
    ends = F.filter(F.transform(rows, lambda r, i: F.when(closes(r), i + 1)), lambda e: e.isNotNull())
    df = df.withColumn("_ends", ends)
    if keep_open:
        n = F.size(rows)
        open_tail = F.coalesce(F.try_element_at("_ends", F.lit(-1)), F.lit(0)) < n
        df = df.withColumn("_ends", F.when(open_tail, F.array_append("_ends", n)).otherwise(F.col("_ends")))

    def run(end: Column, k: Column) -> Column:
        start = F.coalesce(F.get("_ends", k - 1), F.lit(0))
        return F.slice(rows, start + 1, end - start)

    return df.withColumn(out, F.transform("_ends", run)).drop("_ends")


def joined(run: Column, sep: str) -> Column:
    return F.array_join(F.transform(run, lambda r: r["token"]), sep)


def rebuild_words(
    df: DataFrame,
    tag: str = "ner",
    closers: Sequence[str] = ("L-w", "U-w", "O"),
    keys: Sequence[str] = SENTENCE,
    order: str = "tok_id",
    sep: str = "",
    packed: bool = False,
) -> DataFrame:
    """(keys, word_id, word): join tokens until a closing tag; an unclosed tail is dropped.

    ``packed`` gives (keys, words), the words of each sentence in one array.
    """
    if is_packed(df):
        keys, closers = list(keys), list(closers)
        schema = f"{kinds(df, keys)}, " + ("words array<string>" if packed else "word_id int, word string")
        return by_sentence(
            df.select(*keys, SEQ, order, "token", tag), [order, "token", tag],
            lambda table, starts: sentence_kernels.words(table, starts, keys, tag, closers, sep, packed), schema,
        )
    rows = sentence_rows(df, ["token", tag], keys, order)
    runs = closed_runs(rows, "_rows", lambda r: r[tag].isin(list(closers)), "_runs")
    words = F.transform("_runs", lambda run: joined(run, sep))
    if packed:
        return runs.select(*keys, words.alias("words"))
    return runs.select(*keys, F.posexplode(words).alias("word_id", "word"))


def words_to_lines(words: DataFrame, keys: Sequence[str] = SENTENCE) -> DataFrame:
    """(keys, value): the words of each line, as rows or in one array, joined by one space."""
    if "words" in words.columns:
        # A filter would be pushed below the cuts and find the ends of words anew for each word; explode stays where it is.
        filled = words.select(*keys, F.explode(F.filter(F.array("words"), lambda w: F.size(w) > 0)).alias("words"))
        return filled.select(*keys, F.array_join("words", " ").alias("value"))
    parts = F.sort_array(F.collect_list(F.struct("word_id", "word")))
    return words.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["word"]), " ").alias("value"))


def typed_segments(
    df: DataFrame,
    tag: str = "ner",
    keys: Sequence[str] = SENTENCE,
    order: str = "tok_id",
    sep: str = " ",
    keep_open: bool = False,
) -> DataFrame:
    """(keys, seg_id, entity, ner): runs of tokens outside ``O`` up to an ``L-`` or ``U-`` tag.

    The type is the one of the first tag. An unclosed tail is dropped unless
    ``keep_open`` is set.
    """
    rows = sentence_rows(keep_rows(df, lambda get: get(tag) != OUTSIDE), ["token", tag], keys, order)
    runs = closed_runs(rows, "_rows", lambda r: startswith_any(r[tag], CLOSERS), "_runs", keep_open)
    entities = F.transform(
        "_runs",
        lambda run: F.struct(joined(run, sep).alias("entity"), F.substr(run[0][tag], F.lit(3)).alias("ner")),
    )
    return runs.select(*keys, F.posexplode(entities).alias("seg_id", "_e")).select(
        *keys, "seg_id", "_e.entity", "_e.ner"
    )


def context_features(
    df: DataFrame, window: int = WINDOW_SIZE, keys: Sequence[str] = SENTENCE, order: str = "tok_id"
) -> DataFrame:
    """Add ``previous{w}cur``, ``cur_next{w}`` for w ≤ window, ``BOS`` and ``EOS``.

    A joined run that would leave the sentence is null, and so is an edge mark
    away from the edge. All columns share one window, so one sort serves them,
    and each neighbour is looked up once.
    """
    reach = max(window, 1)
    near = neighbours(df, reach, keys, order)
    cols = {}
    for k in range(1, window + 1):
        cols[f"previous{k}cur"] = F.concat(*[F.col(f"_before{j}") for j in range(k, 0, -1)], F.col("token"))
        cols[f"cur_next{k}"] = F.concat(F.col("token"), *[F.col(f"_after{j}") for j in range(1, k + 1)])
    cols["BOS"] = F.when(F.col("_before1").isNull(), F.lit(True))
    cols["EOS"] = F.when(F.col("_after1").isNull(), F.lit(True))
    return near.select(*df.columns, *[c.alias(n) for n, c in cols.items()])


def neighbours(df: DataFrame, reach: int, keys: Sequence[str] = SENTENCE, order: str = "tok_id") -> DataFrame:
    """Add ``_before{k}`` and ``_after{k}``, the tokens up to ``reach`` places away, unless they are there."""
    places = range(1, reach + 1)
    if f"_before{reach}" in df.columns:
        return df
    w = ordered(keys, order)
    return df.withColumns(
        {f"_before{k}": F.lag("token", k).over(w) for k in places} | {f"_after{k}": F.lead("token", k).over(w) for k in places}
    )


def positional_zip(
    a: DataFrame, b: DataFrame, on: Sequence[str], pad: bool = False
) -> DataFrame:
    """Glue rows of equal ordinals; the shorter side ends the result unless ``pad`` is set."""
    return a.join(b, list(on), "full" if pad else "inner")


def zip_lines(a: DataFrame, b: DataFrame, sep: str = "\t") -> DataFrame:
    """(line_no, value): two numbered line tables joined side by side."""
    right = b.select("line_no", F.col("value").alias("_right"))
    return positional_zip(a.select("line_no", "value"), right, ["line_no"]).select(
        "line_no", F.concat("value", F.lit(sep), "_right").alias("value")
    )


def head_tail_words(scored: DataFrame, parts: int = 5, precision: int = 3) -> DataFrame:
    """(doc_id, head, tail) from (doc_id, word, score): the top ⌊n/parts⌋ distinct words and the rest.

    A document with fewer than ``parts`` words has all of them in ``head`` and a
    null ``tail``. A group is the vocabulary of one document cell.
    """
    by_score = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("o"), "word", "score")))
    pairs = F.transform("_w", lambda p: F.struct(p["word"].alias("word"), p["score"].alias("score")))
    n = F.size("_w")
    cut = F.floor(n / parts).cast("int")
    split = n > parts - 1
    head = F.when(split, F.slice(pairs, F.lit(1), cut)).otherwise(pairs)
    return (
        scored.groupBy("doc_id").agg(by_score.alias("_w"))
        .select(
            "doc_id",
            format_pairs(head, precision=precision).alias("head"),
            format_pairs(F.when(split, F.slice(pairs, cut + 1, n)), precision=precision).alias("tail"),
        )
    )
