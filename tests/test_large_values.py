"""Dictionaries, vocabularies, sketches and stored taggings at sizes that single expressions cannot take."""

import math
import random
import re
from collections import Counter

import pytest
from helpers import rows, tokens

from tagloom.plans import text_queries as tq
from tagloom.operators import aggregates as ag
from tagloom.operators import dictionaries as dc
from tagloom.operators import ranking as rk
from tagloom.operators import tags as tg


def places(text, value):
    return [i for i in range(len(text) - len(value) + 1) if text.startswith(value, i)]


@pytest.mark.parametrize("letters", [dc.BLOCK_LETTERS, 40])
def test_hits_equal_brute_force(spark, letters):
    rng = random.Random(2)
    values = ["".join(rng.choice("abé日😀") for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["aaa", "aa", "a.c", "(", None, "", "aa"]
    texts = ["".join(rng.choice("abé日😀.c(") for _ in range(rng.randint(0, 80))) for _ in range(40)] + [None, "", "aaaaa", "A"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    table = spark.createDataFrame([(v,) for v in values], "value string")
    want = sorted((i, v, p) for i, t in enumerate(texts) for v in set(values) if v for p in places(t or "", v))
    assert rows(dc.find_values(docs, table, letters=letters)) == want and len(want) > 500
    counts = Counter((i, v) for i, v, _ in want)
    assert rows(dc.value_counts(docs, table, letters=letters)) == sorted((*k, n) for k, n in counts.items())
    hit = {i for i, _, _ in want}
    assert rows(dc.matches_any_value(docs, table, letters=letters), "doc_id", "matched") == [(i, i in hit) for i in range(len(texts))]


def test_blocks_of_values(spark):
    table = spark.createDataFrame([(f"value{i}",) for i in range(500)], "value string")
    sizes = rows(dc.value_blocks(table, letters=400).groupBy("block").count())
    assert len(sizes) > 5 and sum(n for _, n in sizes) == 500
    docs = spark.createDataFrame([(1, "value7 value499x")], "doc_id long, text string")
    assert rows(dc.find_values(docs, table.limit(0))) == [] and rows(dc.find_values(docs.limit(0), table)) == []
    assert ("1", "value499", 7) in [(str(r[0]), r[1], r[2]) for r in rows(dc.find_values(docs, table, letters=400))]


def test_a_hundred_thousand_values(spark):
    rng = random.Random(5)
    values = {f"{rng.randrange(16**7):07x}" for _ in range(100_000)}
    texts = [" ".join(rng.sample(sorted(values)[:500], 3)) + f" {rng.randrange(16**9):09x}" for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows(dc.find_values(docs, spark.createDataFrame([(v,) for v in values], "value string")))
    assert got == sorted((i, t[p : p + 7], p) for i, t in enumerate(texts) for p in range(len(t) - 6) if t[p : p + 7] in values)


TEXTS = ["The cat, the CAT and a dog", "dog dog é_1", None, "", "a b c d e f", "the the"]


def words_of(text):
    return re.findall(r"\w+", (text or "").lower())


def test_sparse_bag_of_words(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    counts = Counter(w for t in TEXTS for w in words_of(t))
    order = sorted((w for w, n in counts.items() if n >= 2), key=lambda w: (-counts[w], w))
    vocabulary = ag.vocabulary(docs, least=2)
    assert rows(vocabulary, "id", "word", "n") == [(i, w, counts[w]) for i, w in enumerate(order)]
    got = {r.doc_id: (r.indices, r["values"]) for r in ag.sparse_bag_of_words(docs, vocabulary).collect()}
    for i, t in enumerate(TEXTS):
        c = Counter(w for w in words_of(t) if w in order)
        pairs = sorted((order.index(w), float(n)) for w, n in c.items())
        assert got[i] == ([p[0] for p in pairs], [p[1] for p in pairs])
    dense = {r.doc_id: r for r in ag.bag_of_words(docs, order).collect()}
    assert all(dense[i][w] == dict(zip(*got[i])).get(k, 0) for i in got for k, w in enumerate(order))


def test_sparse_tfidf(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    vocabulary = ag.vocabulary(docs)
    names = {r.id: r.word for r in vocabulary.collect()}
    df = Counter(w for t in TEXTS for w in set(words_of(t)))
    got = {(r.doc_id, names[r.id]): r.tfidf for r in ag.sparse_tfidf(docs, vocabulary).collect()}
    for i, t in enumerate(TEXTS):
        weights = {w: n * (math.log((1 + len(TEXTS)) / (1 + df[w])) + 1) for w, n in Counter(words_of(t)).items()}
        length = math.sqrt(sum(x * x for x in weights.values()))
        for w, x in weights.items():
            assert got[i, w] == pytest.approx(x / length)


def test_sketches_keep_their_error(spark):
    rng = random.Random(1)
    values = [rng.gauss(0, 1) ** 3 for _ in range(20_000)] + [7.0] * 5_000
    df = spark.createDataFrame([(v, "ab"[i % 2]) for i, v in enumerate(values)] + [(None, "c")], "v double, k string").repartition(6)
    points, error = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0], 0.005
    found = rk.quantiles(df, "v", points, error).first()
    exact = sorted(values)
    for i, p in enumerate(points):
        low = sum(x < found[i] for x in values) / len(values)
        high = sum(x <= found[i] for x in values) / len(values)
        assert found[i] in exact and low - 2 * error <= p <= high + 2 * error
    plan = rk.quantiles(df, "v", points, error)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan.replace("SortAggregate", "") and "rangepartitioning" not in plan
    parts = rk.quantile_sketches(df.withColumn("part", (df.v > 0).cast("int")), "v", error, ["k", "part"])
    merged = rk.sketched_quantiles(rk.merge_sketches(parts, ["k"]), [0.5], ["k"])
    half = {k: sorted(v for i, v in enumerate(values) if "ab"[i % 2] == k) for k in "ab"}
    for k, q in rows(merged):
        assert abs(sum(x <= q for x in half[k]) / len(half[k]) - 0.5) < 2 * error + 0.2 * (q == 7.0)
    assert len(rows(merged)) == 2 and rk.sketch_size(0.01) > rk.sketch_size(0.1)
    assert rk.quantiles(df.where("k = 'c'"), "v", [0.5], 0.01).first()["q0"] is None


def test_keywords_with_approximate_quartiles(spark):
    rng = random.Random(4)
    a = spark.createDataFrame([(f"w{i}", "O", rng.randint(1, 200)) for i in range(400)], "token string, ner string, cnt long")
    b = spark.createDataFrame([(f"w{i}", "O", rng.randint(1, 200)) for i in range(200, 600)], "token string, ner string, cnt long")
    exact = {r[0] for r in rows(ag.contrast_keywords(a, b))}
    near = {r[0] for r in rows(ag.contrast_keywords(a, b, error=0.001))}
    assert len(exact ^ near) <= 0.1 * len(exact)


def test_stored_taggings_are_compared_in_place(spark, tmp_path):
    words = [[(f"w{i}{j}", "O" if (i + j) % 3 else "U-COM") for j in range(5)] for i in range(30)]
    one = tokens(spark, words)
    other = one.selectExpr("doc_id", "sent_id", "tok_id", "token", "CASE WHEN sent_id % 7 = 0 AND tok_id = 2 THEN 'U-PPL' WHEN sent_id = 3 THEN NULL ELSE ner END AS ner")
    saved = [tg.save_token_table(df, f"taggings_{k}", str(tmp_path / f"{k}"), buckets=4, mode="overwrite") for k, df in enumerate((one, other))]
    with_conf = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in with_conf}
    try:
        for k, v in with_conf.items():
            spark.conf.set(k, v)
        for compare in (tg.tag_diff, lambda a, b: tg.vote_tables({"COM": a, "PPL": b})):
            found = compare(*saved)
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            assert rows(found) == rows(compare(one, other))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        for k in range(2):
            spark.sql(f"DROP TABLE taggings_{k}")
    assert len(rows(tg.tag_diff(one, other))) > 5


def test_stored_taggings_get_buckets_by_splits(spark, tmp_path):
    """A bucket must not grow with the documents."""
    schema = "doc_id long, text string"
    texts = spark.createDataFrame([(i, f"word{i} the a. B c") for i in range(40)], schema).repartition(4)
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    settings = {"spark.sql.files.openCostInBytes": str(1 << 30), "spark.sql.autoBroadcastJoinThreshold": "-1"}  # a split for each file
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        diff = tq.tag_diff_tables(spark, str(tmp_path))
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        assert "SelectedBucketsCount: 64 out of 64" in diff._jdf.queryExecution().explainString(mode)
        assert rows(diff) == rows(tq.tag_diff(spark, str(tmp_path)))
    finally:
        for name in settings:
            spark.conf.unset(name)
