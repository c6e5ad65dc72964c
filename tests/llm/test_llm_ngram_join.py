"""The n-gram join against brute force, and its bound, blocks and tree by themselves."""

import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import no_docs, odd_docs, odd_texts, plain_near, rows_of, sentence

from tagloom.llm import ngram_join as nj


def varied(rng, base, changes, words=400):
    words_of = base.split()
    for _ in range(changes):
        words_of[rng.randrange(len(words_of))] = f"v{rng.randint(0, words)}"
    return " ".join(words_of)


def families(seed, bases=8, copies=12):
    rng = random.Random(seed)
    out = []
    for _ in range(bases):
        base = sentence(rng, rng.choice([4, 9, 12, 14, 21, 40, 150, 700]))
        n = len(base.split())
        out += [base] + [varied(rng, base, rng.randint(0, 1 + n // 40)) for _ in range(copies)]
        chain = base
        for _ in range(6):  # each links with the one before it, the ends do not link
            chain = varied(rng, chain, max(1, n // 75))
            out.append(chain)
    rng.shuffle(out)
    return out


def expected(rows, percent):
    found = plain_near(rows, percent, nj.SHINGLE)
    return sorted(((i, *found[i]) for i, _ in rows), key=str)


@pytest.mark.parametrize(("seed", "percent"), [(1, 90), (2, 90), (3, 80), (4, 60)])
def test_components_equal_brute_force(spark, seed, percent):
    rows = list(enumerate(families(seed)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = rows_of(nj.ngram_components(df, percent=percent))
    assert got == expected(rows, percent)
    assert 1 < len({g[2] for g in got}) < len(rows)


def test_small_cells_and_pivots(spark, monkeypatch):
    """The same with cells of three members, so that buckets are cut, and a pivot in many copies."""
    monkeypatch.setattr(nj, "CELL_ROWS", 3)
    monkeypatch.setattr(nj, "PIVOT_ROWS", 2)
    rng = random.Random(9)
    base = sentence(rng, 60)
    texts = [varied(rng, base, rng.randint(1, 3)) for _ in range(60)] + families(5, 3, 20)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(nj.ngram_components(df)) == expected(rows, 90)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = rows_of(nj.ngram_components(docs))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    named = {i: t for i, t in rows}  # the repeated row repeats its text
    found = plain_near(sorted(named.items()), 90, 3)
    assert got == sorted(((i, *found[i]) for i, _ in rows), key=str)
    assert nj.ngram_components(no_docs(spark)).columns == ["doc_id", "n_shingles", "component_id"] and nj.ngram_components(no_docs(spark)).count() == 0


def test_repeated_and_missing_ids(spark):
    a, b = sentence(random.Random(1), 30), sentence(random.Random(2), 30)
    rows = [(1, a), (1, b), (2, b), (3, a + " end"), (None, a), (None, None), (1, a), (4, None)]
    got = rows_of(nj.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == sorted([(1, 28, 1), (1, 28, 1), (2, 28, 1), (3, 29, 1), (None, 28, None), (None, 0, None), (1, 28, 1), (4, 0, 4)], key=str)


def test_a_huge_bucket_repeats_few_texts(spark, monkeypatch):
    """Near copies beside one odd member: each copy stands in one cell, the odd one in all."""
    monkeypatch.setattr(nj, "CELL_ROWS", 10)
    members = spark.createDataFrame([(7, i, 1 if i < 1000 else 5000, 50) for i in range(1001)], "key long, node long, component long, n_shingles long")
    cells = nj._cells(members)
    assert cells.where("node < 1000").count() == 1000 and cells.where("outer").count() == 101  # 100 cells and its own square


def test_linked_sets_share_a_block():
    rng = np.random.default_rng(3)
    for percent in (50, 75, 90, 95, 100):
        for n in (1, 2, 5, 9, 10, 11, 19, 40, 333):
            base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            for _ in range(30):
                gone = rng.integers(0, n * (100 - percent) // 100 + 1)
                added = rng.integers(0, n * (100 - percent) // percent + 1)
                other = np.sort(np.append(rng.permutation(base)[gone:], rng.integers(0, 1 << 63, added, dtype=np.uint64) * np.uint64(2) + np.uint64(1)))
                if len(other) and nj.linked(base, other, percent):
                    cuts = np.array([0, len(base), len(base) + len(other)])
                    row, key = nj._block_keys(np.append(base, other), cuts, percent)
                    assert np.intersect1d(key[row == 0], key[row == 1]).size


def test_tree_finds_all_that_pass_the_bound():
    rng = np.random.default_rng(4)
    for m in (1, 2, 15, 16, 17, 33, 300):
        grid = rng.poisson(rng.choice([1, 4, 9], (m, 1)), (m, nj.GROUPS)).astype(np.uint8)
        grid[m // 2 :] = grid[0]
        sizes = grid.sum(axis=1).astype(np.int64) + rng.integers(0, 5, m)
        tree = nj.CountTree(grid, sizes)
        assert sorted(tree.order.tolist()) == list(range(m))
        for q in range(0, m, 7):
            wanted = rng.random(m) < 0.7
            both = np.minimum(grid, grid[q]).sum(axis=1) + np.minimum(tree.over, tree.over[q])
            want = np.flatnonzero(wanted & nj.may_link(both, sizes + sizes[q], 90))
            found = tree.search(q, wanted, 90)
            assert sorted(found.tolist()) == want.tolist()
            assert (np.diff(both[found]) <= 0).all()


def test_points_bound_the_overlap(monkeypatch):
    rng = random.Random(6)
    column = pa.array(odd_texts() + families(7))
    tokens, cuts = nj.token_sets(column)
    sizes = np.diff(cuts)
    for most in (nj.MOST, 2, 0):
        monkeypatch.setattr(nj, "MOST", most)
        grid = nj.points(tokens, cuts)
        over = nj.excess(grid, sizes)
        assert (over >= 0).all() and (most < 255 or over.max() < 100)
        for _ in range(300):
            a, b = rng.randrange(len(column)), rng.randrange(len(column))
            both = np.intersect1d(tokens[cuts[a] : cuts[a + 1]], tokens[cuts[b] : cuts[b + 1]])
            assert len(both) <= nj.most_shared(grid[a], over[a], grid[b], over[b])
