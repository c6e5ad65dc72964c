"""Exact copies: group by a 128-bit hash, compare the texts inside groups, keep one row of each.

Texts count as equal when they agree after white space is taken out. The grouping key is the hash and the text itself,
so Spark compares bytes wherever hashes meet, and each task sends one row for each of its distinct texts, however many
copies there are. Rows then learn their group by hash and SHA-256. Groups of more than a thousandth of all rows (a
thousand of them at most) are joined by broadcast, so no task gets all copies of a text.

Defined cases: null text counts as empty, and empty texts are copies of each other. Of equal texts the row with the most
code points stays, then the smallest id; a null id comes after all others. Rows that repeat an id and its text count each
and share their mark; :func:`drop_copies` keeps one of them. Extra columns are ignored by :func:`exact_groups` and kept by
:func:`drop_copies`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import stored

HOT_SHARE = 1000
SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def _hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("size"), normalised(F.col(text_col)).alias("same"))
    best = F.min(F.struct((-F.col("size")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    groups = rows.groupBy(_hash128(F.col("same")).alias("hash"), "same").agg(F.count("*").alias("group_size"), best.alias("best"))
    groups = stored(
        groups.select("hash", F.unhex(F.sha2("same", 256)).alias("sha"), "group_size", F.col("best.doc_id").alias("keep_id")), "groups"
    )
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    hot = groups.where(F.col("group_size") * HOT_SHARE > total).select(
        F.col("hash").alias("hot_hash"), F.col("sha").alias("hot_sha"), F.col("group_size").alias("hot_size"), F.col("keep_id").alias("hot_keep")
    )
    members = rows.select("doc_id", _hash128(F.col("same")).alias("own"), F.unhex(F.sha2("same", 256)).alias("own_sha"))
    members = members.join(F.broadcast(hot), (F.col("own") == F.col("hot_hash")) & (F.col("own_sha") == F.col("hot_sha")), "left")
    # rows of hot groups are done: a key of their own spreads them over the next join
    done = F.col("hot_hash").isNotNull()
    members = members.withColumn("key", F.when(done, F.unhex(F.md5(F.concat(F.hex("own"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))).otherwise(F.col("own")))
    found = members.join(groups, (F.col("key") == F.col("hash")) & (F.col("own_sha") == F.col("sha")), "left")
    keep = F.when(done, F.col("hot_keep")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.when(done, F.col("hot_size")).otherwise(F.col("group_size")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("own_sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns.

    Rows are matched by id and hash. Of rows that share both, one with the longest text stays. The list of those that go
    grows with the corpus, so it is not broadcast.
    """
    groups = stored(exact_groups(docs, id_col, text_col).select("doc_id", F.unhex("text_sha256").alias("sha"), "kept"), "marks")
    gone = groups.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("sha").alias("gone_sha"))
    own_id, sha = docs[id_col].cast("long"), F.unhex(F.sha2(normalised(docs[text_col]), 256))
    left = docs.hint("merge").join(gone, own_id.eqNullSafe(gone["gone_id"]) & (sha == gone["gone_sha"]), "left_anti")
    several = groups.where("kept").groupBy("doc_id", "sha").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "sha")
    if several.isEmpty():
        return left
    # names of our own beside all columns of the table, whatever these are called
    kept = left.select(F.struct(*[left[c] for c in left.columns]).alias("row"), left[id_col].cast("long").alias("id"), F.length(left[text_col]).alias("size"),
                       F.unhex(F.sha2(normalised(left[text_col]), 256)).alias("own"))
    same = F.col("id").eqNullSafe(several["doc_id"]) & (F.col("own") == several["sha"])
    single, repeated = kept.join(several, same, "left_anti"), kept.join(several, same, "left_semi")
    longest = repeated.groupBy(F.col("id").alias("of"), F.col("own").alias("sha")).agg(F.max("size").alias("most"))
    found = repeated.join(longest, F.col("id").eqNullSafe(F.col("of")) & (F.col("own") == F.col("sha")) & F.col("size").eqNullSafe(F.col("most")), "left_semi")
    return single.select("row.*").union(found.dropDuplicates(["id", "own"]).select("row.*"))
