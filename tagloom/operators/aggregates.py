"""Counts, term scores, entropies and corpus contrasts.

Whole-table figures (totals, means, quantiles) are one-row scalar subqueries.
The aggregate below them shares its shuffle with the main query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.constants import WORD
from tagloom.functions.text import as_col, is_alnum, title_case, tokens_of, words_of
from tagloom.operators.joins import only_in, union_all
from tagloom.operators.ranking import quantiles, with_rank
from tagloom.session import freeze


def count_values(df: DataFrame, col: str, out: str = "cnt") -> DataFrame:
    """Value counts, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out)).orderBy(F.col(out).desc(), F.col(col))


def tag_distribution(tokens: DataFrame, tag: str = "ner") -> DataFrame:
    """(ner, cnt, percentage), most frequent first."""
    counts = tokens.groupBy(tag).agg(F.count(F.lit(1)).alias("cnt"))
    total = counts.agg(F.sum("cnt").alias("n")).scalar()
    share = F.round(F.col("cnt") * F.lit(100.0) / total, 3)
    return counts.select(tag, "cnt", share.alias("percentage")).orderBy(F.col("cnt").desc(), F.col(tag))


def sum_counts(df: DataFrame, keys: Sequence[str] = ("token", "ner"), count: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(count).alias(count))


def term_frequencies(docs: DataFrame, text: Column | str = "text") -> DataFrame:
    """(word, tf, df): occurrences, and documents that hold the word.

    A document is one row, so its distinct words are known without a shuffle;
    both counts come from one partial aggregate by word.
    """
    words = words_of(text)
    both = F.array(F.col("_words"), F.array_distinct("_words"))
    return (
        docs.select(words.alias("_words"))
        .select(F.posexplode(both).alias("_kind", "_list"))
        .select("_kind", F.explode("_list").alias("word"))
        .groupBy("word")
        .agg(
            F.sum(F.when(F.col("_kind") == 0, 1).otherwise(0)).alias("tf"),
            F.sum(F.col("_kind")).cast("long").alias("df"),
        )
    )


def tf_over_df(terms: DataFrame) -> DataFrame:
    return terms.select("word", (F.col("tf").cast("double") / F.col("df")).alias("score"))


def tf_times_df(terms: DataFrame) -> DataFrame:
    return terms.select("word", (F.col("tf").cast("double") * F.col("df")).alias("score"))


def token_total(terms: DataFrame) -> DataFrame:
    return terms.agg(F.sum("tf").alias("n_tokens"))


def zscore_flag(scores: DataFrame, score: str = "score") -> DataFrame:
    """(word, flag): 0 below the mean of all scores, else 1.

    The z-score divides by the population deviation; where that is zero every
    flag is 1.
    """
    mean = scores.agg(F.avg(score)).scalar()
    deviation = scores.agg(F.stddev_pop(score)).scalar()
    z = F.try_divide(F.col(score) - mean, deviation)
    return scores.select("word", F.when(z < 0, 0).otherwise(1).alias("flag"))


def label_entropy(df: DataFrame, col: str, out: str = "entropy") -> DataFrame:
    """Base-2 entropy of the values of ``col``; each distinct value counts once."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    # -Σ p·log2 p with p = n/N is log2 N - Σ n·log2 n / N: one pass over the counts.
    n = F.sum("_n").cast("double")
    return counts.agg((F.log2(n) - F.sum(F.col("_n") * F.log2("_n")) / n).alias(out))


def grouped_entropy(
    df: DataFrame, keyword: Sequence[str], brand: str, weight: str, order: str, out: str = "entropy"
) -> DataFrame:
    """(keyword, total, entropy): natural-log entropy of the brand shares of each keyword.

    Of repeated (keyword, brand) rows all weights count in the total, while the
    last one is the share. A zero share adds nothing.
    """
    per_brand = df.groupBy(*keyword, brand).agg(
        F.sum(weight).alias("_sum"), F.max_by(weight, order).cast("double").alias("_last")
    )
    total = F.sum("_sum")
    w_log_w = F.sum(F.when(F.col("_last") > 0, F.col("_last") * F.log("_last")).otherwise(0.0))
    value = (F.log(total) * F.sum("_last") - w_log_w) / total
    return per_brand.groupBy(*keyword).agg(
        total.alias("total"), F.when(total > 0, value).otherwise(0.0).alias(out)
    )


def distinct_values(df: DataFrame, names: Sequence[str], title: bool = False, out: str = "value") -> DataFrame:
    """Distinct cells of the named columns."""
    cells = df.select(F.explode(F.array(*[F.col(n).cast("string") for n in names])).alias(out))
    return cells.select((title_case(out) if title else F.col(out)).alias(out)).distinct()


def last_per_key(df: DataFrame, key: str, value: str, order: Column | str) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(value, as_col(order)).alias(value))


def tfidf_l2(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, word, tfidf) over one-character words, with smoothed idf and rows of length one.

    The distinct words per document are single characters, so both the
    per-document and the per-word tables stay small next to the text.
    """
    chars = F.filter(tokens_of(F.lower(as_col(text)), rf"[{WORD}]+"), lambda w: F.length(w) == 1)
    counts = docs.select(F.col(key).alias("doc_id"), F.explode(chars).alias("word")).groupBy("doc_id", "word").agg(
        F.count(F.lit(1)).alias("tf")
    )
    n_docs = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    idf = counts.groupBy("word").agg(F.count(F.lit(1)).alias("df")).select(
        "word", (F.log((n_docs + F.lit(1.0)) / (F.col("df") + 1)) + 1).alias("idf")
    )
    weight = F.col("tf") * F.col("idf")
    length = F.sqrt(F.sum(weight * weight).over(Window.partitionBy("doc_id")))
    return counts.join(idf, "word").select("doc_id", "word", (weight / length).alias("tfidf"))


def bag_of_words(docs: DataFrame, vocabulary: Sequence[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, one count column per vocabulary word); a document without any has zeros.

    The columns are fixed, so each is one conditional sum, and a document's
    words meet in the task that reads it before anything is shuffled.
    """
    words = tokens_of(F.lower(as_col(text)), rf"[{WORD}]+")
    exploded = docs.select(F.col(key).alias("doc_id"), F.explode_outer(words).alias("_w"))
    return exploded.groupBy("doc_id").agg(
        *[F.sum(F.when(F.col("_w") == v, 1).otherwise(0)).alias(v) for v in vocabulary]
    )


def vocabulary(docs: DataFrame, text: str = "text", least: int = 1) -> DataFrame:
    """(word, id, n): lower-case words that occur at least so often, numbered from the commonest, ties by the word."""
    words = docs.select(F.explode(tokens_of(F.lower(as_col(text)), rf"[{WORD}]+")).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return with_rank(counts, [F.col("n").desc(), "word"], "id").select("word", F.col("id").cast("int").alias("id"), "n")


def word_entries(docs: DataFrame, words: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, id, n): how often each word of a vocabulary table occurs in each document, without zeros.

    The table has any size: it joins without a hint, so it is broadcast while small, and adaptive execution splits the
    commonest words when it is not. A document's words are counted in one place before they meet the table.
    """
    found = docs.select(F.col(key).alias("doc_id"), F.explode(tokens_of(F.lower(as_col(text)), rf"[{WORD}]+")).alias("word"))
    counts = found.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(words.select("word", "id"), "word").select("doc_id", "id", "n")


def sparse_vectors(entries: DataFrame, docs: DataFrame, value: str = "n", key: str = "doc_id") -> DataFrame:
    """(doc_id, indices, values) from (doc_id, id, value): a row per document, indices rising; no entries make empty arrays."""
    pairs = F.sort_array(F.collect_list(F.struct("id", F.col(value).cast("double").alias("value"))))
    rows = entries.groupBy("doc_id").agg(pairs.alias("_p"))
    vectors = rows.select(
        "doc_id", F.transform("_p", lambda p: p["id"]).alias("indices"), F.transform("_p", lambda p: p["value"]).alias("values")
    )
    ids = docs.select(F.col(key).alias("doc_id")).distinct()
    none = (F.coalesce("indices", F.array().cast("array<int>")), F.coalesce("values", F.array().cast("array<double>")))
    return ids.join(vectors, "doc_id", "left").select("doc_id", none[0].alias("indices"), none[1].alias("values"))


def sparse_bag_of_words(docs: DataFrame, words: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, indices, values): :func:`bag_of_words` for a vocabulary table of any size."""
    return sparse_vectors(word_entries(docs, words, text, key), docs, "n", key)


def sparse_tfidf(docs: DataFrame, words: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, id, tfidf): smoothed idf and rows of length one, as :func:`tfidf_l2`, over a vocabulary table."""
    entries = word_entries(docs, words, text, key)
    n_docs = docs.agg(F.count_distinct(key).alias("n")).scalar()
    idf = entries.groupBy("id").agg(F.count(F.lit(1)).alias("df")).select(
        "id", (F.log((n_docs + F.lit(1.0)) / (F.col("df") + 1)) + 1).alias("idf")
    )
    weighted = entries.join(idf, "id").select("doc_id", "id", (F.col("n") * F.col("idf")).alias("w"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return weighted.select("doc_id", "id", (F.col("w") / length).alias("tfidf"))


def scored_document_words(docs: DataFrame, scores: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, word, score): the distinct words of each document with their corpus score."""
    words = docs.select(F.col(key).alias("doc_id"), F.explode(F.array_distinct(words_of(text))).alias("word"))
    return words.join(scores, "word").select("doc_id", "word", "score")


# ---- contrast of two corpora ------------------------------------------------


def token_counts(df: DataFrame) -> DataFrame:
    """Alphanumeric (token, ner, cnt), summed."""
    return sum_counts(df.where(F.col("token").isNotNull() & is_alnum("token")))


def mutual_ratio(a: DataFrame, b: DataFrame) -> DataFrame:
    """Tokens of both corpora with count_x, count_y and their ratio; tags of each side are kept."""
    x = a.select("token", F.col("ner").alias("ner_x"), F.col("cnt").alias("count_x"))
    y = b.select("token", F.col("ner").alias("ner_y"), F.col("cnt").alias("count_y"))
    return x.join(y, "token").withColumn("ratio", F.try_divide(F.col("count_x").cast("double"), F.col("count_y")))


def contrast_keywords(a: DataFrame, b: DataFrame, first: bool = True, error: float | None = None) -> DataFrame:
    """Keywords (token) of corpus ``a``, or of ``b`` with ``first=False``.

    A token qualifies for ``a`` if its ratio is above the upper quartile or
    ``b`` lacks it, and its count is above the upper quartile of those; the list
    of ``b`` mirrors this. The counts are read several times, so they are
    written once instead of being drawn from the text again. With ``error`` the
    quartiles are off by at most that share of the rows and nothing is sorted.
    """
    a, b = freeze(a), freeze(b)
    mutual = mutual_ratio(a, b)
    cut = quantiles(mutual, "ratio", [0.75 if first else 0.25], error).scalar()
    if first:
        own, mine, other, count = mutual.where(F.col("ratio") > cut), a, b, "count_x"
    else:
        own, mine, other, count = mutual.where(F.col("ratio") < cut), b, a, "count_y"
    pool = union_all(
        [own.select("token", F.col(count).alias("cnt")), only_in(mine, other, "token").select("token", "cnt")]
    )
    top = quantiles(pool, "cnt", [0.75], error).scalar()
    return pool.where(F.col("cnt") > top).select("token")
