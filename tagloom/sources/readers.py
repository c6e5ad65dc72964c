"""File sources. Row order inside a file is kept as an explicit line number."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.text import is_blank
from tagloom.operators.sequences import BLOCK_ROWS, running_count

TAGGED = ["token", "ner", "pos"]


def strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def number_lines(scan: DataFrame, out: str = "line_no") -> DataFrame:
    """Number the rows of every scanned file from 0, in file order.

    ``scan`` is a file scan that has not been shuffled. One task reads a split
    from front to back and its ids grow by one, so a row's place in its split is
    its id less the first one. Earlier splits of the same file are added up from
    one small row per split: lines are neither shuffled nor sorted, and no file
    has to fit into one task.
    """
    cols = scan.columns
    placed = scan.select(
        *cols,
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    before = Window.partitionBy("path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        placed.groupBy("path", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
        .select("path", "_split", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    )
    return placed.join(splits, ["path", "_split"]).select(
        "path", (F.col("_seq") + F.col("_shift")).alias(out), *cols
    )


def read_columns(
    spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",", quoted: bool = True
) -> DataFrame:
    """Named columns of a delimited file with a header; ``quoted=False`` keeps quotes as data."""
    reader = spark.read.option("sep", sep).option("header", True).option("quote", '"' if quoted else "")
    return reader.csv(path).select(*columns)


def read_tagged(spark: SparkSession, path: str, columns: Sequence[str] = ("token", "ner")) -> DataFrame:
    """Headerless token table: (path, tok_id, token, ner[, pos]) without rows that hold a null."""
    scan = spark.read.schema(strings(columns)).csv(path)
    return number_lines(scan, "tok_id").dropna()


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, columns: Sequence[str] | None = None):
    """JSON lines of one file or a folder of files, with the schema given up front."""
    df = spark.read.schema(schema).json(path)
    return df.select(*columns) if columns else df


read_json_folder = read_jsonl


def read_split_folder(spark: SparkSession, folder: str, columns: Sequence[str] = ("token", "ner")):
    """(train, test) token tables from the files with those words in their names."""
    df = read_tagged(spark, folder, columns).withColumn("_file", F.substring_index("path", "/", -1))
    return tuple(df.where(F.col("_file").contains(part)).drop("_file") for part in ("train", "test"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, value) for every line that is not blank; numbers count blank lines too."""
    return number_lines(spark.read.text(path)).where(~is_blank("value"))


def read_lexicon_lines(spark: SparkSession, path: str) -> DataFrame:
    """A line file as a set: distinct ``token``."""
    return spark.read.text(path).select(F.col("value").alias("token")).distinct()


def read_lexicon_pairs(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A ``token,value`` line file as (token, value); the last line of a token wins."""
    parts = F.split("value", F.lit(sep))
    pairs = number_lines(spark.read.text(path)).select(
        "path", "line_no", F.get(parts, F.lit(0)).alias("token"), F.get(parts, F.lit(1)).alias("value")
    )
    return pairs.groupBy("token").agg(F.max_by("value", F.struct("path", "line_no")).alias("value"))


def read_conll(spark: SparkSession, path: str, skip: int = 2) -> DataFrame:
    """(path, line_no, token, pos, pos1, ner); blank lines stay as rows of nulls.

    The first ``skip`` rows of each file and ``-DOCSTART-`` rows are left out;
    ``line_no`` numbers what remains without gaps.
    """
    lines = number_lines(spark.read.text(path)).where(F.col("line_no") >= skip)
    is_start = F.split("value", " ")[0] == "-DOCSTART-"
    kept = running_count(lines, ["path"], "line_no", is_start, "_starts", BLOCK_ROWS).where(~is_start)
    cells = F.split("value", " ")
    names = ["token", "pos", "pos1", "ner"]
    return kept.select(
        "path",
        (F.col("line_no") - skip - F.col("_starts")).alias("line_no"),
        *[F.when(F.get(cells, F.lit(i)) != "", F.get(cells, F.lit(i))).alias(n) for i, n in enumerate(names)],
    )


def frame_from_rows(spark: SparkSession, rows: Iterable[Sequence], columns: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(rows), list(columns))


def frame_from_items(spark: SparkSession, items: Mapping, columns: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(items.items()), list(columns))


def frame_from_dicts(spark: SparkSession, dicts: Sequence[Mapping], columns: Sequence[str]) -> DataFrame:
    """One column per dict and one row per key seen in any of them."""
    keys = list(dict.fromkeys(k for d in dicts for k in d))
    return spark.createDataFrame([(k, *[d.get(k) for d in dicts]) for k in keys], ["key", *columns])
