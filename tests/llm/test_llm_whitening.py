"""Whitening against a plain version with NumPy's own eigenvalues."""

import math
from pathlib import Path

import numpy as np
import pytest

from tagloom.llm import queries, whitening

DATA = Path("/root/testdata/sf0.001")
SCHEMA = "vec_id long, embedding array<float>, label int, component int, n long, x string"


def plain(rows, components=4):
    """``vec_id, embedding`` to (kept rows as (id, x)), n, sums, eigenvalues and vectors of the fit list."""
    kept = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({x for _, x in kept}), float)
    mean = fit.mean(axis=0)
    cov = (fit - mean).T @ (fit - mean) / len(fit)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    sums = [sum(int(c) for c in column) for column in fit.T]
    return kept, len(fit), sums, values[order], vectors[:, order].T, np.trace(cov)


def check(got, rows):
    kept, n, sums, values, vectors, trace = plain(rows)
    ids = sorted((i, k) for i, _ in kept for k in range(1, len(values) + 1))
    assert sorted((r.vec_id, r.component) for r in got) == ids and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-8
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    signs = [0.0] * len(values)
    for i, x in kept:
        for k, value in enumerate(values):
            r = by_id[i][k + 1]
            assert r.deviation == sum((n * c - s) ** 2 for c, s in zip(x, sums))
            assert r.explained == pytest.approx(value / trace, rel=1e-9)
            want = (np.array(x) - np.array(sums) / n) @ vectors[k] / math.sqrt(value)
            if not signs[k] and abs(want) > 1e-3:
                signs[k] = np.sign(want * r.whitened)
            assert r.whitened == pytest.approx((signs[k] or 1) * want, abs=1e-7)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 7)) @ np.diag([3, 2, 1.2, 0.7, 0.2, 0.1, 0.05])
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(100 + i, rows[3][1]) for i in range(80)]  # one vector holds over half of the rows
    rows += [(300, None), (301, [None] * 7), (302, [1.0] * 6 + [float("nan")]), (303, [float("inf")] + [0.0] * 6), (304, [-0.0] * 7)]
    df = spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], SCHEMA).repartition(5)
    check(whitening.whitened(df).collect(), rows)


def test_small_tables(spark):
    def run(rows):
        return whitening.whitened(spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], SCHEMA)).collect()

    assert run([]) == [] and run([(1, None), (2, [])]) == [] and run([(1, [0.5, 1.0]), (2, [0.5, 1.0])]) == []
    two = run([(1, [0.0, 1.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.0])])
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component, r.n, r.deviation, abs(round(r.whitened, 9))) for r in two) == [
        (False, 1, 1, 2, 2 * 256**2, 1.0), (False, 2, 1, 2, 2 * 256**2, 1.0), (False, 2, 1, 2, 2 * 256**2, 1.0), (True, 0, 1, 2, 2 * 256**2, 1.0)]
    mixed = run([(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [1.0]), (4, [])])
    assert {r.vec_id for r in mixed} == {1, 2}


def test_deviation_beyond_a_long_is_an_error(spark):
    rows = spark.createDataFrame([(i, [float(2**40 * i)], 1, 2, 3, "x") for i in range(3)], SCHEMA)
    with pytest.raises(Exception, match="beyond the range"):
        whitening.whitened(rows).collect()


def test_counts_follow_the_spectrum():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 9, 40):
        a = rng.normal(size=(size, size))
        a = a + a.T
        np.fill_diagonal(a, 0.0)  # so that pivots of two rows are needed
        values = np.linalg.eigvalsh(a)
        for shift in [*(values[1:] + values[:-1]) / 2, values[0] - 1, values[-1] + 1]:
            assert whitening.count_above(a, shift) == (values > shift).sum()


@pytest.mark.parametrize("spectrum", [
    [5, 4, 3, 2, 1], [1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.1], [2, 2, 2, 2, 1], [1e6, 1, 1e-3, 1e-6, 0], [3, 0, 0, 0, 0], [1e-200, 5e-201, 0, 0, 0],
])
def test_components(spectrum):
    q, _ = np.linalg.qr(np.random.default_rng(2).normal(size=(5, 5)))
    v = q @ np.diag(np.array(spectrum, float)) @ q.T
    v = (v + v.T) / 2
    values, vectors = whitening.leading_components(v)
    want = [x for x in spectrum[:4] if x > 0]
    assert values == pytest.approx(want, rel=1e-7, abs=1e-14 * max(spectrum))
    assert np.abs(vectors @ vectors.T - np.eye(len(want))).max() < 1e-10
    assert np.abs(v @ vectors.T - vectors.T * values).max() < 1e-13 * max(spectrum)


def test_exact_far_from_zero(spark):
    """Entries of some 10**9 with small differences keep their digits."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(1e7 + a), float(-1e7 + b)]) for i, (a, b) in enumerate(rng.integers(0, 4, (30, 2)))]
    check(whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), rows)


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    check(queries.QUERIES["op11_whitening"](spark, str(DATA)).collect(), rows)
