"""Operators that need a total order, with a hot key and tiny partitions."""

import random

import numpy as np
from helpers import rows
from pyspark.sql import functions as F

from tagloom.operators import ranking as rk
from tagloom.operators import sequences as sq


def numbers(spark, n, seed=1):
    values = list(range(n))
    random.Random(seed).shuffle(values)
    # a third of all rows share one value
    return spark.createDataFrame([(i, 5.0 if i % 3 == 0 else float(v)) for i, v in enumerate(values)], "id long, v double")


def test_rank_is_the_sorted_position(spark):
    df = numbers(spark, 500).repartition(7)
    want = {r[0]: i for i, r in enumerate(sorted(rows(df), key=lambda r: (-r[1], r[0])))}
    got = rk.with_rank(df, [F.col("v").desc(), "id"], total="n")
    assert {r["id"]: r["rank"] for r in got.collect()} == want
    assert {r["n"] for r in got.collect()} == {500}


def test_rank_in_a_hot_key(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7).alias("k")).repartition(5)
    seen = {}
    want = {}
    for i, k in sorted(rows(df)):
        want[i] = seen.setdefault(k, 0)
        seen[k] += 1
    assert {r["id"]: r["rank"] for r in rk.rank_in_key(df, ["k"], ["id"]).collect()} == want


def test_split_sizes(spark):
    for n, pieces in ((11, 4), (3, 5), (20, 5)):
        df = rk.split_evenly(spark.range(n), [F.col("id").desc()], pieces)
        got = {r["piece"]: r["count"] for r in df.groupBy("piece").count().collect()}
        want = [len(a) for a in np.array_split(np.arange(n), pieces)]
        assert [got.get(i, 0) for i in range(pieces)] == want


def test_quantiles_are_numpys(spark):
    df = numbers(spark, 301)
    values = [r[1] for r in rows(df)]
    points = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    assert np.allclose(list(rk.quantiles(df, "v", points).first()), np.quantile(values, points))
    few = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "v double")
    assert list(rk.quantiles(few, "v", [0.25, 0.75]).first()) == [1.75, 5.5]


def test_top_slice_sample(spark):
    df = spark.range(105)
    assert sorted(r[0] for r in rk.top_fraction(df, [F.col("id").desc()], 0.1).collect()) == list(range(95, 105))
    assert sorted(r[0] for r in rk.slice_rows(df, ["id"], 3, 6).collect()) == [3, 4, 5]
    one, two = (sorted(r[0] for r in rk.sample_rows(df, "id", 9, seed=4).collect()) for _ in range(2))
    assert one == two and len(set(one)) == 9
    assert rk.sample_rows(df, "id", 500).count() == 105


def test_deciles(spark):
    def points(values):
        df = spark.createDataFrame(list(enumerate(values)), "i long, v long")
        return [r["value"] for r in rk.decile_points(df, "v", ["i"]).orderBy("position").collect()]

    assert points([3, 1, 2]) == [3, 1, 2]
    values = [(7 * i) % 25 for i in range(25)]
    want = [values[i] for i in range(0, 25, 2)]
    assert points(values) == (want if want[-1] == max(values) else [*want, max(values)])
    assert points(list(range(21))) == list(range(0, 21, 2))


def test_group_to_list_is_chunked_and_whole(spark):
    df = spark.range(250).select(F.lit("k").alias("k"), F.col("id").alias("v"), F.col("id").alias("n")).repartition(6)
    got = rk.group_to_list(df, "k", "v", ["n"], chunk_rows=100).orderBy("chunk").collect()
    assert [len(r["values"]) for r in got] == [100, 100, 50]
    assert [v for r in got for v in r["values"]] == list(range(250))


def test_blocked_count_and_next_equal_plain_ones(spark):
    df = spark.range(100).select(
        (F.col("id") >= 30).cast("int").alias("k"),
        F.when(F.col("id") < 30, F.col("id")).otherwise(F.col("id") - 30).alias("n"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("t"), (F.col("id") % 4 == 0).alias("flag"),
    ).repartition(5)
    plain = sq.running_count(df, ["k"], "n", F.col("flag"), "c")
    assert rows(sq.running_count(df, ["k"], "n", F.col("flag"), "c", block_rows=7)) == rows(plain)
    ahead = sq.next_value(df, ["k"], "n", "t", "end", "x")
    assert rows(sq.next_value(df, ["k"], "n", "t", "end", "x", block_rows=7)) == rows(ahead)
