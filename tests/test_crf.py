"""The CRF against enumeration of all paths, and training jobs end to end."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from helpers import rows, tokens
from pyspark.sql import functions as F

from tagloom.operators import crf
from tagloom.operators import crf_kernels as k
from tagloom.operators.features import ENGLISH, FeatureConfig, feature_columns, feature_names, feature_table
from tagloom.operators.tokens import char_bilou
from tagloom.plans import training as tr

LENGTHS = np.array([3, 1, 2])


def scores(seed=0, labels=3):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(LENGTHS.sum(), labels)), rng.normal(size=(labels, labels))


def paths_of(emit, trans):
    for path in itertools.product(range(emit.shape[1]), repeat=len(emit)):
        s = sum(emit[i, y] for i, y in enumerate(path)) + sum(trans[a, b] for a, b in itertools.pairwise(path))
        yield path, s


def test_expectations_by_enumeration():
    emit, trans = scores()
    z, marginals, pairs = k.expectations(emit, trans, LENGTHS)
    want_z, want_m, want_p = 0.0, np.zeros_like(emit), np.zeros_like(trans)
    for end, n in zip(np.cumsum(LENGTHS), LENGTHS, strict=True):
        part = list(paths_of(emit[end - n : end], trans))
        total = np.logaddexp.reduce([s for _, s in part])
        want_z += total
        for path, s in part:
            p = np.exp(s - total)
            for i, y in enumerate(path):
                want_m[end - n + i, y] += p
            for a, b in itertools.pairwise(path):
                want_p[a, b] += p
    assert np.isclose(z, want_z)
    assert np.allclose(marginals, want_m)
    assert np.allclose(pairs, want_p)


def test_best_paths_by_enumeration():
    for seed in range(5):
        emit, trans = scores(seed)
        got = k.best_paths(emit, trans, LENGTHS)
        for end, n in zip(np.cumsum(LENGTHS), LENGTHS, strict=True):
            best = max(paths_of(emit[end - n : end], trans), key=lambda t: t[1])[0]
            assert tuple(got[end - n : end]) == best


def test_observed_counts():
    labels = np.array([0, 1, 1, 2, 0, 0])
    hot, moves = k.observed(labels, LENGTHS, 3)
    assert (hot.argmax(axis=1) == labels).all()
    assert moves.tolist() == [[1, 1, 0], [0, 1, 0], [0, 0, 0]]


def test_sentences_are_regrouped_whole():
    starts = [True, False, True, False, False, False, True, True, False]
    table = pa.table({"starts": starts, "n": range(9)})
    for size in (1, 2, 4, 9):
        for limit in (1, 3, 5, 100):
            parts = list(k.whole_sentences(table.to_batches(max_chunksize=size), limit))
            assert [x for t, _ in parts for x in t["n"].to_pylist()] == list(range(9))
            assert [int(x) for _, lengths in parts for x in lengths] == [2, 4, 1, 2]
            assert all(t.num_rows == lengths.sum() for t, lengths in parts)


def test_minimiser_finds_the_lasso_solution():
    target = np.array([3.0, -2.0, 0.2])
    w, losses = crf.minimise(lambda v: (((v - target) ** 2).sum() / 2, v - target), np.zeros(3), c1=0.5, max_iter=50)
    assert np.allclose(w, [2.5, -1.5, 0.0], atol=1e-4)
    assert losses == sorted(losses, reverse=True)


@pytest.fixture(scope="module")
def corpus(spark):
    words = ["ab", "cde", "f", "gh", "ijk", "。"]
    rng = np.random.default_rng(3)
    data = [(d, 0, " ".join(rng.choice(words, size=8))) for d in range(120)]
    return spark.createDataFrame(data, "doc_id long, line_no int, value string")


@pytest.fixture(scope="module")
def tagger(spark, corpus):
    return tr.train(char_bilou(corpus.where("doc_id < 90")), FeatureConfig(), buckets=1 << 12, max_iter=25, c1=0.01, c2=0.01)


def test_spark_gradient_is_the_slope_of_the_loss(spark, corpus):
    packed = crf.sequence_rows(char_bilou(corpus.where("doc_id < 5")), FeatureConfig(window=1), buckets=64).persist()
    labels = sorted(r[0] for r in packed.select("label").distinct().collect())
    rng = np.random.default_rng(0)
    state, trans = rng.normal(size=(64, len(labels))), rng.normal(size=(len(labels), len(labels)))
    z, grad, pairs = crf._counts(packed, labels, 64, (state, trans))
    used = np.argwhere(grad > 0.5)[:2]
    for i, j in used:
        moved = state.copy()
        moved[i, j] += 1e-5
        assert np.isclose((crf._counts(packed, labels, 64, (moved, trans))[0] - z) / 1e-5, grad[i, j], rtol=1e-3)
    moved = trans.copy()
    moved[0, 1] += 1e-5
    assert np.isclose((crf._counts(packed, labels, 64, (state, moved))[0] - z) / 1e-5, pairs[0, 1], rtol=1e-3, atol=1e-4)
    packed.unpersist()


def test_training_lowers_the_loss_and_segments_unseen_lines(spark, corpus, tagger):
    model = tagger.models["model"]
    assert model.labels == ["B-w", "I-w", "L-w", "O", "U-w"]
    assert model.losses == sorted(model.losses, reverse=True)
    held = corpus.where("doc_id >= 90")
    got = rows(tr.segment_lines(held, tagger), "doc_id", "value")
    want = rows(held, "doc_id", "value")
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 0.9 * len(want)
    scores = {r["label"]: r["f1"] for r in tr.validate(char_bilou(held), tagger).collect()}
    assert scores["Total"] > 0.9


def test_model_files_round_trip(spark, tagger, corpus, tmp_path):
    path = str(tmp_path / "crf_words_COM.model")
    crf.save_model(spark, tagger.models["model"], path)
    models = crf.load_models(spark, [path])
    assert list(models) == ["COM"]
    assert np.allclose(models["COM"].state, tagger.models["model"].state)
    assert np.allclose(models["COM"].trans, tagger.models["model"].trans)
    chars = char_bilou(corpus.where("doc_id > 110"))
    again = tr.Tagger({"model": models["COM"]}, tagger.config)
    assert rows(again.tag(chars)) == rows(tagger.tag(chars))


def test_search_returns_a_draw_per_try(spark, corpus):
    found, draws = tr.train_with_search(
        char_bilou(corpus.where("doc_id < 40")), FeatureConfig(window=1), folds=2, draws=2, max_iter=4, buckets=1 << 10
    )
    assert len(draws) == 2 and all(0 <= d[2] <= 1 for d in draws)
    assert found.models["model"].labels


def test_training_from_a_folder(spark, tmp_path):
    text = "".join(f"{w},{t}\n" for w, t in [("Acme", "U-COM"), ("met", "O"), ("Ann", "U-PPL"), ("##END", "O")] * 30)
    for name in ("x_train.csv", "x_test.csv"):
        (tmp_path / name).write_text(text)
    _, scores = tr.train_folder(spark, str(tmp_path), FeatureConfig(), types=["COM"], buckets=1 << 10, max_iter=15)
    assert {r["label"]: r["f1"] for r in scores.collect()} == {"COM": 1.0, "Total": 1.0}


def test_training_from_text_files(spark, tmp_path):
    words = ["ab", "cde", "f", "。"]
    rng = np.random.default_rng(5)
    text = [" ".join(rng.choice(words, size=6)) for _ in range(60)]
    (tmp_path / "train.txt").write_text("\n".join(text), encoding="utf-8")
    (tmp_path / "test.txt").write_text("\n".join(text[:7]), encoding="utf-8")
    model, out = str(tmp_path / "m_words"), str(tmp_path / "out")
    _, scores = tr.train_files(
        spark, str(tmp_path / "train.txt"), str(tmp_path / "test.txt"), FeatureConfig(), model_path=model, out=out,
        buckets=1 << 12, max_iter=25, c1=0.01, c2=0.01,
    )
    assert {r["label"]: r["f1"] for r in scores.collect()}["Total"] > 0.95
    written = [x for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text(encoding="utf-8").splitlines()]
    assert written == text[:7]
    assert crf.load_model(spark, model).labels == ["B-w", "I-w", "L-w", "O", "U-w"]


def test_a_token_named_true_keeps_its_value(spark):
    df = tokens(spark, [[("True", "O")]])
    got = feature_table(feature_columns(df, FeatureConfig()), FeatureConfig()).first()
    assert "current_original=True" in got["features"]


def test_feature_text(spark):
    df = tokens(spark, [[("Ab", "U-COM"), ("1", "O")]]).withColumn("pos", F.lit("N"))
    table = feature_table(feature_columns(df, ENGLISH), ENGLISH).orderBy("tok_id").collect()
    assert table[0]["features"][:3] == ["bias", "current_original=Ab", "current_lower=ab"]
    assert "current_istitle" in table[0]["features"] and "BOS" in table[0]["features"]
    assert "cur_next1=Ab1" in table[0]["features"] and "current_pos=N" in table[0]["features"]
    assert "current_isdigit" in table[1]["features"] and "EOS" in table[1]["features"]
    assert len(feature_names(ENGLISH)) == 10 + 1 + 4 + 2


def test_feature_neighbours_and_custom_shapes(spark):
    config = FeatureConfig(shapes=("size",), custom={"size": lambda c: F.length(c)}, neighbour_shapes=("lower",), reach=1, window=0)
    df = tokens(spark, [[("Ab", "O"), ("C", "O")]])
    got = feature_table(feature_columns(df, config), config).orderBy("tok_id").collect()
    assert got[0]["features"] == ["bias", "current_size=2", "next1_lower=c", "BOS"]
    assert got[1]["features"] == ["bias", "current_size=1", "previous1_lower=ab", "EOS"]
