"""Exact features, and weights in a table: the same losses as with all weights on the driver."""

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tagloom.operators import crf, crf_sharded as sh
from tagloom.operators import feature_index as fi
from tagloom.operators.features import FeatureConfig, feature_columns, feature_table
from tagloom.operators.tokens import char_bilou
from tagloom.plans import inputs as inp, training as tr

CONFIG = FeatureConfig(window=1)


@pytest.fixture(scope="module")
def chars(spark):
    words = ["ab", "cde", "f", "gh", "ijk", "。", "abc", "d"]
    rng = np.random.default_rng(3)
    data = [(d, 0, " ".join(rng.choice(words, size=rng.integers(1, 8)))) for d in range(80)]
    return char_bilou(spark.createDataFrame(data, "doc_id long, line_no int, value string")).persist()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 500, 5000])
def test_bucket_is_a_minimal_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    seeds, checks = fi.build_bucket(keys)
    assert sorted(fi.find(keys, seeds, checks).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64), keys)
    assert (fi.find(others, seeds, checks) == -1).all()


def test_no_two_features_share_a_number(spark, monkeypatch):
    monkeypatch.setattr(fi, "KEYS", 50)
    names = [f"feature={i}" for i in range(3000)] + [None, "", "é"]
    df = spark.createDataFrame([(x,) for x in names * 2], "feature string").repartition(4)
    index = fi.build_index(df)
    assert index.size == 3002 and index.count == 61

    def numbers(values):
        asked = spark.createDataFrame([(v,) for v in values], "f string")
        return {r.f: r.id for r in index.number(asked.withColumn("h", index.hashed(F.col("f"))).where("h IS NOT NULL")).collect()}

    seen = numbers([x for x in names if x is not None])
    assert sorted(seen.values()) == list(range(3002))
    assert set(numbers([f"unseen={i}" for i in range(3000)]).values()) == {-1}
    empty = fi.build_index(df.limit(0))
    assert empty.size == 0 and empty.number(spark.createDataFrame([(5,)], "h long")).first()["id"] == -1


def test_features_that_share_a_hash_get_another(spark, monkeypatch):
    monkeypatch.setattr(fi, "hashed", lambda c, seed: F.when(c.isNotNull(), F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(5 if seed < 2 else 1 << 40))))
    index = fi.build_index(spark.createDataFrame([(f"{i}",) for i in range(40)], "feature string"))
    assert index.seed == 2 and index.size == 40


@pytest.mark.parametrize(("c1", "c2", "tokens"), [(0.1, 0.1, sh.TOKENS), (1.0, 0.0, 60)])
def test_losses_equal_those_of_the_driver(spark, chars, monkeypatch, c1, c2, tokens):
    monkeypatch.setattr(sh, "TOKENS", tokens)
    buckets, steps = 1 << 22, 8  # more steps than the memory holds
    packed = crf.sequence_rows(chars, CONFIG, buckets=buckets)
    want = crf.crf_fit(packed, buckets, c1, c2, steps)
    model = sh.fit(chars, CONFIG, c1=c1, c2=c2, max_iter=steps)
    assert np.allclose(model.losses, want.losses, rtol=1e-6)
    assert model.labels == want.labels and np.allclose(model.trans, want.trans, atol=1e-4)
    texts = feature_table(feature_columns(chars, CONFIG), CONFIG).select(F.explode("features").alias("f")).distinct()
    assert model.index.size == texts.count() == model.weights.count()
    got = {}
    for r in model.index.number(texts.withColumn("h", model.index.hashed(F.col("f")))).join(model.weights, "id").collect():
        got[r.f] = np.array(r.w)
    places = {r.f: r.b for r in texts.select("f", F.pmod(F.xxhash64("f"), F.lit(buckets)).alias("b")).collect()}
    assert len(set(places.values())) == len(places)  # no collision there, so both learn the same
    assert all(np.allclose(got[f], want.state[b], atol=1e-4) for f, b in places.items())


def test_nothing_of_feature_size_reaches_the_driver(spark, chars, monkeypatch):
    brought, kind = [], type(chars)
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: brought.append(collect(self)) or brought[-1])
    monkeypatch.setattr(kind, "toPandas", lambda self: pytest.fail("a table came to the driver"))
    model = sh.fit(chars, FeatureConfig(window=2), max_iter=4)
    n = len(model.labels)
    products = (2 * 4 + 2) ** 2
    assert model.index.size > 200 and max(map(len, brought)) <= max(n + 1, products)


def test_tags_equal_those_of_the_driver(spark, chars, tmp_path):
    model = sh.fit(chars, CONFIG, c1=0.01, c2=0.01, max_iter=12)
    tagger = tr.train(chars, CONFIG, buckets=1 << 22, c1=0.01, c2=0.01, max_iter=12)
    new = char_bilou(spark.createDataFrame([(1, 0, "ab ijk new cde"), (2, 0, "。 f f"), (3, 5, "ZZ")], "doc_id long, line_no int, value string"))
    want = rows(tagger.tag(new, label="ner"), "doc_id", "sent_id", "tok_id", "token", "truth", "pred")
    assert rows(sh.predict(new, model, CONFIG, label="ner")) == want
    sh.save(spark, model, str(tmp_path / "m"))
    again = sh.load(spark, str(tmp_path / "m"))
    assert rows(sh.predict(new, again, CONFIG)) == [(*w[:4], None, w[5]) for w in want]


def test_no_rows(spark, chars):
    model = sh.fit(chars.limit(0), CONFIG, max_iter=2)
    assert model.labels == [] and sh.predict(chars, model, CONFIG).count() == 0
    some = sh.fit(chars.where("doc_id = 1"), CONFIG, max_iter=2)
    assert sh.predict(chars.limit(0), some, CONFIG).count() == 0


def test_losses_equal_over_many_parts_and_blocks(spark, chars, monkeypatch):
    monkeypatch.setattr(sh, "TOKENS", 40)
    monkeypatch.setattr(sh, "WEIGHTS", 50)
    buckets, steps = 1 << 22, 4
    want = crf.crf_fit(crf.sequence_rows(chars, CONFIG, buckets=buckets), buckets, 0.1, 0.1, steps)
    model = sh.fit(chars, CONFIG, c1=0.1, c2=0.1, max_iter=steps)
    assert np.allclose(model.losses, want.losses, rtol=1e-6) and np.allclose(model.trans, want.trans, atol=1e-4)
    ids = sorted(r.id for r in model.weights.collect())
    assert ids == list(range(model.index.size)) and len(ids) > 100


def test_steps_keep_rows_of_parts_and_blocks(spark, chars, monkeypatch):
    kept, freeze = [], sh.freeze
    monkeypatch.setattr(sh, "freeze", lambda df: kept.append(freeze(df)) or kept[-1])
    model = sh.fit(chars, FeatureConfig(window=2), max_iter=3)
    assert len(kept) > 6 and max(df.count() for df in kept) <= 10 < model.index.size  # eight partitions


def test_turns_are_dealt_out_once(spark, tmp_path):
    turns = [(c, t, f"Ab cd {c}. Ef") for c in range(20) for t in (0, 1, 2, None)]
    spark.createDataFrame(turns, "conv_id long, turn int, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    tokens = inp.dealt_conversation_tokens(spark, str(tmp_path))
    assert rows(tokens) == rows(inp.conversation_tokens(spark, str(tmp_path)))
    texts = sh.sequence_texts(tokens.withColumn("ner", F.lit("O")), FeatureConfig(window=0))
    assert texts._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1  # of texts, not of tokens
