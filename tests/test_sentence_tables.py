"""Sentence tables: the same results as token tables, with a shuffle of texts only."""

import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tagloom.constants import SENTENCE_END, SPACE
from tagloom.functions.text import words_of
from tagloom.operators import crf
from tagloom.operators import metrics as mt
from tagloom.operators import sequences as sq
from tagloom.operators import tags as tg
from tagloom.operators import tokens as tk
from tagloom.operators.features import FeatureConfig
from tagloom.plans import inputs as inp
from tagloom.plans import text_queries as tq
from tagloom.plans import training as tr

TEXTS = [(0, "Ab cd, e.\nMr X  went home"), (0, "Ab cd, e.\nMr X  went home"), (1, "\n \nA. Bc d! Efg"), (2, ""), (None, "x yz"), (3, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, f"word{i} the a. B c\nthird l") for i in range(50)], "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return path


def shuffled_columns(df):
    """The columns each shuffle moves."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", text)


def test_rows_come_back(docs):
    lines = tk.document_lines(docs)
    for mode in ("train", "test"):
        assert rows(sq.unpack(tk.char_bilou(lines, mode, packed=True))) == rows(tk.char_bilou(lines, mode))
    assert rows(sq.unpack(tk.sentence_tokens(docs, packed=True))) == rows(tk.sentence_tokens(docs))


def test_words_and_lines_are_rebuilt_alike(docs):
    lines = tk.document_lines(docs)
    plain, packed = (inp.perturbed_chars(tk.char_bilou(lines, packed=p)) for p in (False, True))
    assert rows(sq.rebuild_words(packed)) == rows(sq.rebuild_words(plain))
    want = rows(sq.words_to_lines(sq.rebuild_words(plain)))
    assert rows(sq.words_to_lines(sq.rebuild_words(packed, packed=True))) == want


def test_entities_alike(docs):
    plain, packed = (inp.with_prediction(tk.sentence_tokens(docs, packed=p)) for p in (False, True))
    assert rows(tg.entity_phrases(packed, "truth")) == rows(tg.entity_phrases(plain, "truth"))
    assert rows(mt.entity_metrics(packed)) == rows(mt.entity_metrics(plain))


@pytest.mark.parametrize("name", ["rebuild_words", "rebuild_lines"])
def test_characters_are_not_shuffled(spark, folder, name):
    moved = shuffled_columns(getattr(tq, name)(spark, folder))
    assert moved and not any("token" in columns or "tok_id" in columns for columns in moved)


def test_tagging_keeps_sentences_whole(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    chars = tk.char_bilou(tk.document_lines(docs))
    tagger = tr.train(chars, FeatureConfig(), buckets=1 << 10, max_iter=2)
    lines = tk.document_lines(docs.union(docs.limit(5)))  # texts that come twice are one sentence
    plain, packed = (tagger.tag(tk.char_bilou(lines, packed=p), label="ner") for p in (False, True))
    assert sq.is_packed(packed) and rows(sq.unpack(packed)) == rows(plain)
    assert rows(tr.segment_lines(lines, tagger)) == rows(sq.words_to_lines(sq.rebuild_words(plain, "pred")))
    assert not any("token" in columns for columns in shuffled_columns(tr.segment_lines(lines, tagger)))
    ended = crf.restore_ends(sq.unpack(packed).withColumnsRenamed({"pred": "ner", "truth": "pos"}))
    whole = crf.restore_ends(sq.keep_fields(sq.with_fields(packed, {"ner": lambda g: g("pred"), "pos": lambda g: g("truth")}), ["tok_id", "token", "ner", "pos"]))
    names = ["doc_id", "sent_id", "tok_id", "token", "ner", "pos"]
    assert rows(whole, *names) == rows(ended, *names)


def test_queries_on_dealt_texts_move_texts_only(spark, folder):
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting)
    try:
        for make in (tq.entity_phrases, tq.entity_metrics, tq.tag_diff, tq.remap_entities):
            if make is tq.remap_entities:
                spark.createDataFrame([(0, "word1 the")], "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
            moved = shuffled_columns(make(spark, folder))
            assert any("text#" in m for m in moved), make
            # Neither tokens nor sentences, which would be made before the shuffle.
            assert not any(c in m for m in moved for c in ("token#", "sentence#", "_texts#")), (make, moved)
    finally:
        spark.conf.set(setting, before)


def test_dealt_tokens_are_the_tokens(spark, folder):
    assert rows(inp.dealt_tokens(spark, folder)) == rows(inp.document_tokens(spark, folder))


def test_breaks_alike(spark):
    """Sentences and words end where the plain patterns, without the look-ahead, have them end."""
    odd = ["a. b", "a.  \n b", "\n\n.\n", "x\u3002\u3000y\u00a0z", ".\t!\x1f?\x85", "", " ", "a\u2028b. \u2009c", ".~ !\x7f ?\x7f"]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    plain = rf"(?<=[{SENTENCE_END}])[{SPACE}]+|\n"
    for got, want in ((F.split("t", tk.SENTENCE_BREAK), F.split("t", plain)), (words_of("t"), F.array_remove(F.split("t", rf"[{SPACE}]+"), ""))):
        assert df.where(~got.eqNullSafe(want)).count() == 0
