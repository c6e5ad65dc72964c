"""Operators over tags: types, votes, entities and corrections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.constants import DROPPED_TYPES, KEPT_TYPES, OUTSIDE
from tagloom.functions.text import as_col, endswith_any
from tagloom.operators.columns import map_tag_type
from tagloom.operators.sequences import typed_segments

TOKEN_KEY = ("doc_id", "sent_id", "tok_id")
GENERAL = "GEN"


def keep_tag_types(tag: Column | str, types: Sequence[str]) -> Column:
    """The tag if it ends with one of ``types``, else ``O``."""
    t = as_col(tag)
    return F.when(endswith_any(t, types), t).otherwise(OUTSIDE)


def collapse_tags(
    tag: Column | str, kept: Sequence[str] = KEPT_TYPES, dropped: Sequence[str] = DROPPED_TYPES
) -> Column:
    """Keep some types, turn others into ``O`` and any unlisted tag into null."""
    t = as_col(tag)
    return F.when(endswith_any(t, [f"-{d}" for d in dropped]), OUTSIDE).otherwise(
        map_tag_type(t, {k: k for k in kept})
    )


def vote(tags: Mapping[str, Column | str]) -> Column:
    """One tag from several models, each named after the type it owns.

    Models are taken by name. A model decides where its tag ends with its own
    type; elsewhere the last model fills in, except for types another model
    owns. A model named ``GEN`` owns no type and fills in wherever it is given.
    """
    names = sorted(n for n in tags if n != GENERAL)
    filler = GENERAL if GENERAL in tags else names[-1]
    owners = [n for n in names if n != filler]
    rest = as_col(tags[filler])
    out = F.when(endswith_any(rest, owners), OUTSIDE).otherwise(rest) if owners else rest
    for name in reversed(owners):
        own = as_col(tags[name])
        out = F.when(own.endswith(name), own).otherwise(out)
    return out


def vote_tables(predictions: Mapping[str, DataFrame], key: Sequence[str] = TOKEN_KEY, tag: str = "ner") -> DataFrame:
    """Vote over prediction tables that share token keys."""
    (first, df), *others = predictions.items()
    joined = df.withColumnRenamed(tag, f"_{first}")
    for name, other in others:
        joined = joined.join(other.select(*key, F.col(tag).alias(f"_{name}")), list(key))
    return joined.select(
        *[c for c in df.columns if c != tag], vote({n: f"_{n}" for n in predictions}).alias(tag)
    )


def tag_diff(bugged: DataFrame, fixed: DataFrame, key: Sequence[str] = TOKEN_KEY) -> DataFrame:
    """(key, token, bugged_ner, fixed_ner) where two taggings of the same tokens differ."""
    a = bugged.select(*key, "token", F.col("ner").alias("bugged_ner"))
    b = fixed.select(*key, F.col("ner").alias("fixed_ner"))
    return a.join(b, list(key)).where(~F.col("bugged_ner").eqNullSafe(F.col("fixed_ner")))


def save_token_table(
    df: DataFrame, name: str, path: str | None = None, buckets: int = 200, key: Sequence[str] = TOKEN_KEY, mode: str = "errorifexists",
    dealt: str | None = None,
) -> DataFrame:
    """Write a token table bucketed and sorted by its key, and return it.

    Tables with one number of buckets are joined by :func:`tag_diff`, :func:`vote_tables` and
    :func:`tagloom.operators.metrics.mismatches` bucket by bucket: no row moves, however often they are compared.
    Rows that were dealt out to ``buckets`` partitions by a column of the key, ``dealt``, are bucketed by that alone and not
    moved; such tables are joined without moving if ``spark.sql.requireAllClusterKeysForCoPartition`` is false.
    """
    by = [dealt] if dealt else list(key)
    rows = df if dealt else df.repartition(buckets, *by)  # else each task would write a file for each bucket
    writer = rows.write.mode(mode).bucketBy(buckets, *by).sortBy(*key)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def false_positives(diff: DataFrame) -> DataFrame:
    return diff.where(F.col("fixed_ner") == OUTSIDE)


def entity_phrases(tokens: DataFrame, tag: str = "ner", sep: str = " ") -> DataFrame:
    """(doc_id, entity, ner, cnt): closed entities of each document."""
    return (
        typed_segments(tokens, tag, sep=sep)
        .groupBy("doc_id", "entity", "ner").agg(F.count(F.lit(1)).alias("cnt"))
    )


def phrase_map(phrases: DataFrame) -> DataFrame:
    """(doc_id, ner_phrase): ``{"ENTITY##NER##COUNT": []}`` per document, keys in order."""
    key = F.concat_ws("##", "entity", "ner", F.col("cnt").cast("string"))
    keys = F.sort_array(F.collect_set(key))
    empty = F.array().cast("array<string>")
    return phrases.groupBy("doc_id").agg(
        F.map_from_arrays(keys, F.transform(keys, lambda _: empty)).alias("ner_phrase")
    )


def remap_entities(phrases: DataFrame, remap: DataFrame) -> DataFrame:
    """Correct entity types by a (wrong, correct) table of ``ENTITY##NER`` keys; others stay.

    The correction table joins without a hint: it is broadcast while small.
    """
    fixes = remap.groupBy("wrong").agg(F.max("correct").alias("correct"))
    key = F.concat_ws("##", "entity", "ner")
    joined = phrases.withColumn("_key", key).join(fixes, F.col("_key") == F.col("wrong"), "left")
    fixed = [F.split_part("correct", F.lit("##"), F.lit(i)) for i in (1, 2)]
    return joined.select(
        "doc_id", F.coalesce(fixed[0], "entity").alias("entity"), F.coalesce(fixed[1], "ner").alias("ner"), "cnt"
    )
