"""Exact copies, near copies, repeated passages and benchmark passages against plain versions."""

import random
import re

import pytest
from llm_cases import WORD, fold, no_docs, odd_docs, odd_texts, plain_exact, plain_leaks, plain_near, plain_repeats, rows_of, sentence

from tagloom.llm import decontaminate, exact_dedup, minmax_dedup, substring_dedup


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_exact_groups(spark):
    docs = odd_docs(spark).union(spark.createDataFrame([(None, "one", None, None, None, None, None, None, None)], odd_docs(spark).schema))
    got = exact_dedup.exact_groups(docs)
    assert rows_of(got) == sorted(plain_exact(pairs(docs)), key=str)
    assert exact_dedup.exact_groups(no_docs(spark)).count() == 0


def test_exact_stays_right_with_one_hot_group(spark):
    texts = ["same text"] * 700 + [f"text {i // 2}" for i in range(800)]
    docs = odd_docs(spark, texts=texts)
    assert rows_of(exact_dedup.exact_groups(docs)) == sorted(plain_exact(pairs(docs)), key=str)


def test_exact_drop_keeps_columns(spark):
    docs = odd_docs(spark)
    left = exact_dedup.drop_copies(docs)
    assert left.schema == docs.schema
    kept = {r[0] for r in plain_exact(pairs(docs)) if r[3]}
    assert {r.doc_id for r in left.collect()} == kept
    assert exact_dedup.drop_copies(no_docs(spark)).count() == 0


def test_exact_runs_no_python(spark):
    plan = exact_dedup.exact_groups(odd_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("part", [512, 2])
def test_near_groups(spark, monkeypatch, part):
    monkeypatch.setattr(minmax_dedup, "PART_ROWS", part)
    rng = random.Random(4)
    texts = odd_texts()
    chain = sentence(rng, 150).split()
    for k in range(12):  # neighbours link, ends of the chain do not
        texts.append(" ".join(chain))
        chain[12 * k + 3] = f"n{k}"
    docs = odd_docs(spark, texts=texts)
    rows = dict(pairs(docs))
    want = plain_near(rows.items())
    got = minmax_dedup.near_groups(docs).collect()
    assert len(got) == len(texts) + 1
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minmax_dedup.drop_near_copies(docs).schema == docs.schema


def test_near_without_rows_or_ids(spark):
    assert minmax_dedup.near_groups(no_docs(spark)).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, None), (1, "a b c d e f"), (2, "A b c d e f"), (2, "other text of it")], "doc_id long, text string")
    got = sorted((tuple(r) for r in minmax_dedup.near_groups(docs).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (None, 0, None, True), (1, 2, 1, True), (2, 2, 1, False), (2, 1, 2, True)], key=str)


def test_near_finds_links_beside_the_pivot(spark):
    """Two texts that link with each other, but not with the smallest id of their buckets."""
    rng = random.Random(9)
    words = sentence(rng, 300).split()
    far = words.copy()
    for k in range(0, 300, 60):
        far[k] = f"a{k}"
    texts = []
    for n in range(30):
        own = far.copy()
        own[(7 * n) % 300] = f"b{n}"
        texts += [" ".join(own)]
    docs = spark.createDataFrame([(0, " ".join(words))] + [(i + 1, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minmax_dedup.near_groups(docs).collect()}
    assert got == plain_near([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("size", [8 << 20, 3000])
def test_repeats(spark, size):
    rng = random.Random(size)
    texts = odd_texts()
    passages = [sentence(rng, rng.randint(10, 30)) for _ in range(6)]
    texts += [" ".join(rng.choice([sentence(rng, 9), rng.choice(passages)]) for _ in range(8)) for _ in range(40)]
    docs = odd_docs(spark, texts=texts)
    got = substring_dedup.remove_repeats(docs, shard_bytes=size, bucket_bytes=size)
    assert rows_of(got.drop("kept")) == plain_repeats(pairs(docs))
    assert all(r.kept is not None for r in got.collect())


def test_repeats_edges(spark):
    assert substring_dedup.remove_repeats(no_docs(spark)).count() == 0
    line = " ".join(f"t{i}" for i in range(20))
    docs = spark.createDataFrame([(None, line), (5, line), (5, line + " end"), (2, None)], "doc_id long, text string")
    got = {(r.doc_id, r.n_words): r.n_removed for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == {(None, 20): 20, (5, 20): 0, (5, 21): 0, (2, 0): 0}


@pytest.mark.parametrize("block", [32 << 20, 300])
def test_leaks(spark, block):
    rng = random.Random(6)
    items = [(i, sentence(rng, rng.choice([1, 2, 5, 9, 10, 11, 30]), 60)) for i in range(25)] + [(3, "again other words"), (None, "a b c d"), (40, None), (41, " ,.")]
    texts = odd_texts() + [" ".join(rng.choice([sentence(rng, 6, 60), rng.choice(items)[1] or "", "Word!"]) for _ in range(12)) for _ in range(30)]
    docs = odd_docs(spark, texts=texts)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, benchmark, columns=["doc_id"], block_bytes=block)
    assert rows_of(got.drop("longest")) == sorted(plain_leaks(pairs(docs), items), key=str)
    clean = decontaminate.drop_contaminated(docs, benchmark)
    assert clean.schema == docs.schema
    assert clean.count() == sum(not r[5] for r in plain_leaks(pairs(docs), items))


def test_leaks_longest_match(spark):
    words = [f"q{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, "start " + " ".join(words[10:45]) + " end"), (2, " ".join(words[:9]))], "doc_id long, text string")
    found = {r.doc_id: (r.longest, r.n_hit) for r in decontaminate.contamination(docs, spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")).collect()}
    assert found == {1: (35, 35), 2: (0, 0)}


def test_leaks_empty(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(odd_docs(spark), items).collect())
    assert decontaminate.contamination(no_docs(spark), items).count() == 0


def repeated_ids(spark):
    rng = random.Random(3)
    a, b, c = (sentence(rng, 120) for _ in range(3))
    near = a.split()
    near[5] = "other"
    rows = [(1, a, 1), (1, " ".join(near), 2), (1, b, 3), (2, b, 4), (3, c, 5), (3, c, 6), (3, "  " + c, 7), (None, c, 8), (None, c, 9), (None, None, 10), (4, None, 11), (5, "", 12), (6, a + " end", 13)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, place int").repartition(3)


def test_near_copies_of_repeated_ids(spark):
    """Each row is judged by its own text, and one row of each group stays."""
    rows, docs = repeated_ids(spark)
    found = {r.place: r for r in minmax_dedup.drop_near_copies(docs).collect()}
    assert {8, 9, 10, 11, 12} <= set(found) and minmax_dedup.drop_near_copies(docs).schema == docs.schema
    groups = [{1, 2, 13}, {3, 4}, {5, 6, 7}]
    assert [len(g & set(found)) for g in groups] == [1, 1, 1] and len(found) == 8
    got = minmax_dedup.near_groups(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [
        (1, 1), (1, 1), (1, 1), (2, 1), (3, 3), (3, 3), (3, 3), (4, 4), (5, 5), (6, 1)]
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def test_exact_copies_of_repeated_ids(spark):
    rows, docs = repeated_ids(spark)
    left = sorted(r.place for r in exact_dedup.drop_copies(docs).collect())
    assert exact_dedup.drop_copies(docs).schema == docs.schema
    # of b one row, of c the longest, of the empty texts the smallest id
    assert left == [1, 2, 3, 7, 11, 13]


def test_exact_copies_with_null_ids_alone(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "ab"), (None, "ab ")], "doc_id long, text string")
    assert [len(r.text) for r in exact_dedup.drop_copies(docs).collect()] == [3]


def plain_matches(rows, items, window=10):
    """Every longest run of equal words of a text and an item, of ``window`` words or of the whole item."""
    out = []
    for i, t in rows:
        w = re.findall(WORD, fold(t))
        for name, text in items:
            v = re.findall(WORD, fold(text))
            least = min(window, len(v))
            for a in range(len(w)):
                for b in range(len(v)):
                    if w[a] != v[b] or (a and b and w[a - 1] == v[b - 1]):
                        continue
                    n = 0
                    while a + n < len(w) and b + n < len(v) and w[a + n] == v[b + n]:
                        n += 1
                    if n >= least:
                        out.append((i, str(name), a, a + n, b))
    return sorted(out)


@pytest.mark.parametrize("block", [32 << 20, 300])
def test_locations_of_matches(spark, block):
    rng = random.Random(7)
    items = [(i, sentence(rng, rng.choice([1, 2, 9, 10, 11, 30, 60]), 40)) for i in range(20)] + [(50, None), (51, " ,."), (52, "same " * 14)]
    texts = [" ".join(rng.choice([sentence(rng, 6, 40), " ".join((rng.choice(items)[1] or "").split()[rng.randint(0, 9):])]) for _ in range(8)) for _ in range(25)]
    rows = list(enumerate([*texts, None, "", "same " * 25, items[0][1].upper()]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = decontaminate.matches(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block)
    assert rows_of(found) == sorted(plain_matches(rows, items), key=str) and found.count() > 30
    assert decontaminate.matches(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
