"""Plans: how often data is shuffled and what reaches the scan."""

import re

import pytest
from pyspark.sql import functions as F

from tagloom.operators import aggregates as ag
from tagloom.operators import crf
from tagloom.operators import joins as jo
from tagloom.operators import sequences as sq
from tagloom.operators import tokens as tk
from tagloom.operators.features import FeatureConfig
from tagloom.plans import recipes
from tagloom.sources.lexicons import stack_lexicons


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "docs.parquet")
    spark.createDataFrame(
        [(i, f"word{i} the a. B c\n", "en", "x" * 10) for i in range(50)], "doc_id long, text string, lang string, junk string"
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (?:hash|range|Round|Single)", plan(df)))


def test_tokenising_does_not_shuffle(docs):
    lines = tk.document_lines(docs)
    sentences = tk.document_sentences(docs)
    for df in (
        lines, tk.char_bilou(lines), sentences, tk.sentence_tokens(docs), tk.tokens_with_ends(docs),
        tk.ner_candidates(sentences), tk.markup_to_bilou(sentences),
    ):
        assert shuffles(df) == 0
        assert "junk" not in re.search(r"ReadSchema: (.*)", plan(df))[1]


def test_one_shuffle_per_sentence_operator(docs):
    chars = tk.char_bilou(tk.document_lines(docs))
    assert shuffles(sq.context_features(chars)) == 1
    assert shuffles(sq.rebuild_words(chars)) == 1
    assert shuffles(sq.words_to_lines(sq.rebuild_words(chars))) == 1
    rows = crf.sequence_rows(chars, FeatureConfig())
    assert shuffles(rows) == 1
    assert len(re.findall(r"Sort \[", plan(rows))) == 1


def test_one_shuffle_for_both_term_counts(docs):
    assert shuffles(ag.term_frequencies(docs)) == 1
    assert shuffles(ag.bag_of_words(docs, ["the"])) == 1


def test_filters_reach_the_scan(docs):
    df = recipes.typed_titles(docs.select("lang", "doc_id", "junk"), ("lang", "en"), "doc_id", "junk", [("x", "X")])
    assert "EqualTo(lang,en)" in plan(df)


def test_lexicons_share_one_join(spark, docs):
    words = spark.range(10).select(F.col("id").cast("string").alias("token"))
    lexicons = stack_lexicons({"a": words, "b": words, "c": words})
    df = jo.add_lexicons(tk.sentence_tokens(docs), lexicons, ["a", "b", "c"])
    assert len(re.findall(r"Join", plan(df))) == 1


def test_no_hint_forces_a_broadcast(spark, docs):
    """Beyond the threshold the same lookup becomes a shuffled join."""
    words = docs.select(F.col("lang").alias("token"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = jo.add_lexicons(tk.sentence_tokens(docs), stack_lexicons({"a": words}), ["a"])
        assert "BroadcastHashJoin" not in plan(df)
        assert df.count() == tk.sentence_tokens(docs).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
