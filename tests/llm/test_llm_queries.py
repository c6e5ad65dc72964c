"""Registered queries against their SQL, and the pipeline against a plain version."""

import hashlib
from pathlib import Path

import numpy as np
import pytest
from helpers import canon
from llm_cases import plain_exact, plain_leaks, plain_near

import __spark_entry__ as entry
import corpus_pipeline
from tagloom.llm import bpe, queries, toxicity

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def test_all_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names and set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sql, name):
    got = canon(queries.QUERIES[name](spark, str(DATA)).toPandas())
    want = canon(sql.execute(queries.ORACLES[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def test_pipeline(spark):
    tiktoken = pytest.importorskip("tiktoken")
    public = pytest.importorskip("public_tokenizers")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    left = [(r.doc_id, r.text) for r in docs.join(toxicity.score(docs, model), "doc_id").where("predicted = 0").collect()]
    texts = dict(left)
    left = [(r[0], texts[r[0]]) for r in plain_exact(left) if r[3]]
    left = [(i, texts[i]) for i, (_, component) in plain_near(left, corpus_pipeline.NEAR_PERCENT).items() if i == component]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    left = [(r[0], texts[r[0]]) for r in plain_leaks(left, items) if not r[5]]
    encoding = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(public.path(corpus_pipeline.RANK_FILE)), special_tokens={})
    want = {}
    for i, t in left:
        ids = encoding.encode_ordinary(t)
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, str(DATA)).collect()}
    assert got == want and 0 < len(want) < docs.count()


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumnRenamed("lang", "row").withColumnRenamed("source", "score")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(DATA)).schema == docs.schema
