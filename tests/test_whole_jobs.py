"""Queries that train do all of it, and sentence tables are read by tasks without a shuffle or a lambda per token."""

import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tagloom.constants import CV_FOLDS, MAX_ITERATIONS, SEARCH_DRAWS
from tagloom.operators import crf, crf_search
from tagloom.operators import crf_kernels as k
from tagloom.operators import metrics as mt
from tagloom.operators import sequences as sq
from tagloom.operators import tags as tg
from tagloom.operators import tokens as tk
from tagloom.operators.features import FeatureConfig
from tagloom.plans import model_queries as mq
from tagloom.plans import text_queries as tq
from tagloom.plans import training as tr

TEXTS = [(0, "Ab cd, e.\nMr X  went home"), (0, "Ab cd, e.\nMr X  went hóme"), (1, "\n \nA. Bc d! Efg 𝒳y 漢字"), (2, ""), (None, "x yz"), (3, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, f"word{i} the a. B c\nthird l") for i in range(30)], "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    turns = [(i, i % 3, "user", f"Anna{i} likes a wonderful thing. B c\nthird l") for i in range(30)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string")


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_the_segmenter_takes_all_iterations(spark, folder, monkeypatch):
    asked = []
    monkeypatch.setattr(mq.tr, "train", lambda tokens, config, **options: asked.append(options.get("max_iter", MAX_ITERATIONS)))
    monkeypatch.setattr(mq, "_taggers", {})
    mq.segmenter(spark, folder)
    assert asked == [MAX_ITERATIONS]


def test_the_search_fits_every_draw_on_every_fold(spark, folder, monkeypatch):
    asked, passes = {}, []

    def search(rows_, folds, draws, max_iter, buckets, seed, halve=False):
        asked.update(folds=folds, draws=draws, max_iter=max_iter, halve=halve)
        return found(rows_, folds, draws, 3, buckets, seed, halve)

    def scores(self, models):
        passes.append(len(models))
        return scored(self, models)

    found, scored = crf_search.random_search, crf_search._Passes.scores
    monkeypatch.setattr(crf_search, "random_search", search)
    monkeypatch.setattr(crf_search._Passes, "scores", scores)
    assert mq.crf_search(spark, folder).count() == SEARCH_DRAWS
    assert asked == {"folds": CV_FOLDS, "draws": SEARCH_DRAWS, "max_iter": MAX_ITERATIONS, "halve": False}
    assert passes == [SEARCH_DRAWS * CV_FOLDS]


def test_hashes_are_those_of_spark(spark):
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abé漢𝒳 z"), size=n)) for n in [*range(40), 64, 100]]
    want = [r[0] for r in spark.createDataFrame([(f"p={t}",) for t in texts], "t string").select(F.pmod(F.xxhash64("t"), F.lit(1 << 18))).collect()]
    parts = [t.encode() for t in texts]
    ends = np.cumsum([len(p) for p in parts])
    got = k.feature_ids("p=", np.frombuffer(b"".join(parts), np.uint8), ends - [len(p) for p in parts], ends, 1 << 18)
    assert got.tolist() == want


@pytest.mark.parametrize("spans", [1, k.SPANS])
def test_features_made_in_tasks_are_those_of_the_token_rows(spark, docs, monkeypatch, spans):
    monkeypatch.setattr(k, "SPANS", spans)
    lines = tk.document_lines(docs.dropDuplicates(["doc_id"]))
    words = FeatureConfig(shapes=("original", "lower", "last3", "isupper", "istitle", "isdigit"))
    for config, make in ((FeatureConfig(), lambda p: tk.char_bilou(lines, packed=p)), (FeatureConfig(window=1), lambda p: tk.char_bilou(lines, "test", packed=p)),
                         (words, lambda p: sq.with_fields(tk.sentence_tokens(docs.dropDuplicates(["doc_id"]), packed=p), {"ner": lambda get: F.lit("O")}))):
        plain, packed = (crf.sequence_rows(make(p), config, buckets=1 << 10) for p in (False, True))
        assert rows(packed, *plain.columns) == rows(plain)


def test_sentences_of_several_texts_are_put_in_order(spark, docs):
    packed = tk.char_bilou(tk.document_lines(docs), packed=True)
    got = sq.sentence_rows(packed, ["token", "ner"], sq.SENTENCE, "tok_id")
    want = sq.sentence_rows(sq.unpack(packed), ["token", "ner"], sq.SENTENCE, "tok_id")
    assert rows(got) == rows(want)
    assert rows(sq.rebuild_words(packed, sep="-")) == rows(sq.rebuild_words(sq.unpack(packed), sep="-"))


def test_entities_with_null_and_open_tags(spark):
    tags = ["B-x", "I-x", "L-y", None, "O", "U-x", "B-z"]
    data = [(d, d % 2, i, tags[(i * 3 + d) % 7], tags[(i * 3 + d * (i % 2)) % 7]) for d in range(9) for i in range(d)]
    df = spark.createDataFrame(data, "doc_id long, sent_id int, tok_id int, truth string, pred string").coalesce(1).sortWithinPartitions("doc_id", "tok_id")
    packed = df.withColumn(sq.SEQ, F.col("doc_id"))
    assert rows(mt.entity_metrics(packed)) == rows(mt.entity_metrics(df))


def test_blocks_give_the_sums_of_their_tokens():
    rng = np.random.default_rng(2)
    lengths = np.array([3, 1, 5, 2, 5])
    n = lengths.sum()
    word = rng.integers(0, 4, n).astype(np.int32)
    slots = [np.zeros(n, np.int32), word + 3, np.where(word == 2, 9, -1).astype(np.int32), np.arange(n, dtype=np.int32) + 10]
    groups = k.joined_columns(slots)
    assert [0, 1, 2] in [sorted(g) for g in groups]  # they follow from the word, the last slot does not
    order, data = k.make_block(slots, lengths, groups)
    block = k.Block(data)
    state = np.vstack([rng.normal(size=(40, 3)), np.zeros(3)])
    assert np.allclose(block.scores(state[block.features]), k.emissions(slots, state)[order].T)
    values, total, want = rng.normal(size=(n, 3)), np.zeros((40, 3)), np.zeros((40, 3))
    total[block.features] = block.sums(np.ascontiguousarray(values[order].T))
    k.add_by_slot(want, slots, values)
    assert np.allclose(total, want)
    labels = rng.integers(0, 3, n)
    hot, moves = k.observed(labels, lengths, 3)
    sums, steps = block.observed(labels[order], 3)
    want = np.zeros((40, 3))
    k.add_by_slot(want, slots, hot)
    assert np.allclose(sums, want[block.features]) and np.allclose(steps, moves)
    names, known = k.coded(pa.chunked_array([pa.array([str(x) for x in labels])]), order)
    assert [int(names[i]) for i in np.frombuffer(known, np.int32)] == labels[order].tolist()


def test_no_lambda_runs_for_each_token(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    lines = tk.document_lines(docs)
    tagger = tr.train(tk.char_bilou(lines), FeatureConfig(), buckets=1 << 10, max_iter=2)
    tagged = tagger.tag(tk.char_bilou(lines, packed=True), label="ner")
    for df in (tq.rebuild_words(spark, folder), mt.label_report(tagged), mt.entity_metrics(tagged), tr.annotate_texts(docs, tagger)):
        assert not re.search(r"\b(transform|filter|sort_array)\(", plan(df))
    assert not any("_rows" in c for c in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", plan(tq.rebuild_lines(spark, folder))))


def test_stored_taggings_are_dealt_out_as_texts(spark, folder, monkeypatch):
    setting, saved = "spark.sql.requireAllClusterKeysForCoPartition", []
    before, save = spark.conf.get(setting), tg.save_token_table
    monkeypatch.setattr(tg, "save_token_table", lambda df, *a, **b: (saved.append(df), save(df, *a, **b))[1])
    try:
        diff = tq.tag_diff_tables(spark, folder)
        want = rows(tq.tag_diff(spark, folder))
        assert rows(diff) == want and want
        assert len(saved) == 2
        for df in saved:
            moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", plan(df))
            assert len(moved) == 1 and "text#" in moved[0] and "token#" not in moved[0]
        assert ") Exchange" not in plan(diff)
    finally:
        spark.conf.set(setting, before)


def test_sentences_of_one_token():
    lengths, scores = np.ones(3, np.int64), np.arange(6.0).reshape(3, 2)
    z, marginals, pairs = k.expectations(scores, np.ones((2, 2)), lengths)
    assert np.isclose(z, np.logaddexp(scores[:, 0], scores[:, 1]).sum()) and not pairs.any()
    assert np.allclose(marginals.sum(axis=1), 1) and k.best_paths(scores, np.ones((2, 2)), lengths).tolist() == [1, 1, 1]
    block = k.Block(k.make_block([np.arange(3, dtype=np.int32)], lengths, [[0]])[1])
    sums, moves = block.observed(np.array([0, 1, 1]), 2)
    assert sums.tolist() == [[1, 0], [0, 1], [0, 1]] and not moves.any()


def test_scaling_holds_for_steep_transitions():
    """Sums are scaled before they vanish, however far apart the weights of steps are."""
    rng = np.random.default_rng(5)
    for spread in (1.0, 30.0, 120.0):
        scores, trans, lengths = rng.normal(size=(60, 3)) * 5, rng.normal(size=(3, 3)) * spread, np.array([40, 1, 19])
        z, marginals, _ = k.expectations(scores, trans, lengths)
        assert np.isfinite(z) and np.isfinite(marginals).all()
        assert np.allclose(marginals.sum(axis=1), 1)
