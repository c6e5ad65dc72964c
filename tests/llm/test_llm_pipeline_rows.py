"""The pipeline over a table with nulls, empty texts, repeated ids and rows without one, against a plain version by row."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from llm_cases import plain_leaks, plain_near, sentence
from pyspark.sql import functions as F

import corpus_pipeline
from tagloom.llm import bpe, toxicity

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


def odd_rows(docs):
    """Rows that share ids with others: equal ones, longer ones of the same letters, and other texts."""
    rng = random.Random(17)
    new = [sentence(rng, 80) for _ in range(4)]
    near = new[3].split()
    near[40] = "changed"
    first = sorted((r.doc_id, r.text) for r in docs if r.text)[:3]
    rows = [(i, t) for i, t in first] + [(first[0][0], new[0]), (first[1][0], new[1]), (900_001, new[1])]
    rows += [(900_002, new[2]), (900_002, new[2].replace(" ", "  ")), (900_002, new[2]), (900_003, new[3]), (900_004, " ".join(near))]
    return rows + [(None, new[0] + " of nobody"), (None, None), (900_005, None), (900_006, ""), (900_007, "  \n"), (None, new[2])]


def by_force(rows, items, toxic):
    rows = [r for r in rows if not toxic[r[1] or ""]]
    groups = {}
    for i, t in rows:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r"), []).append((-len(t or ""), i is None, i or 0, t))
    rows = [(None if g[1] else g[2], g[3]) for g in map(min, ([(a, b, c, d or "") for a, b, c, d in g] for g in groups.values()))]
    named = sorted(r for r in rows if r[0] is not None)
    near = plain_near(list(enumerate(t for _, t in named)), corpus_pipeline.NEAR_PERCENT)
    rows = [named[k] for k, (_, component) in near.items() if k == component] + [r for r in rows if r[0] is None]
    return [r for r, leak in zip(rows, plain_leaks(rows, items)) if not leak[5]]


def test_rows_are_judged_one_by_one(spark, tmp_path):
    public, tiktoken = pytest.importorskip("public_tokenizers"), pytest.importorskip("tiktoken")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    extra = odd_rows(docs.collect())
    more = spark.createDataFrame(extra, "doc_id long, text string").select("*", *[F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns[2:]])
    docs.unionByName(more).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    table, labels = spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")
    texts = sorted({t or "" for _, t in rows + extra})
    scored = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), toxicity.train(table, labels))
    toxic = {texts[r.doc_id]: bool(r.predicted) for r in scored.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()]
    encoding = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(public.path(corpus_pipeline.RANK_FILE)), special_tokens={})
    want = Counter()
    for i, t in by_force(rows + extra, items, toxic):
        ids = encoding.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()] += 1
    got = Counter(tuple(r)[:3] for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == want and sum(k[0] is None for k in got.elements()) >= 1


def test_no_rows(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
