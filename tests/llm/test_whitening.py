"""Eigenvalues by slicing against a full decomposition, the query against plain numpy, and awkward tables."""

import numpy as np
import pytest

from thermopanel.llm import whitening
from thermopanel.llm.queries import QUERIES


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


SPECTRA = [
    [3.0], [1.0, 2.0], [5, 5, 5, 1, 0.0], np.random.default_rng(1).random(64) * 100, np.r_[np.ones(30) * 7, np.ones(34)],
    10.0 ** -np.arange(40), 1 + np.arange(100) * 1e-9, [0.0, 0.0, 0.0], [1e12, 1e-3, 1e-3, 5.0],
]


@pytest.mark.parametrize("values", SPECTRA, ids=range(len(SPECTRA)))
def test_leading_pairs(values):
    a = symmetric(np.asarray(values, float))
    got, axes, sure = whitening.leading(a, 8)
    true, reach = np.linalg.eigvalsh(a)[::-1], np.abs(a).sum(axis=1).max()
    assert len(got) == min(8, int((true > 8 * len(a) * 2e-16 * reach).sum())) and sure.all()
    assert np.abs(got - true[:len(got)]).max(initial=0) <= 1e-13 * reach
    assert np.abs(a @ axes - axes * got).max(initial=0) <= 1e-12 * reach
    assert np.abs(axes.T @ axes - np.eye(len(got))).max(initial=0) < 1e-12


def test_counts_are_those_of_the_spectrum():
    rng = np.random.default_rng(4)
    for d in (1, 2, 3, 10, 40):
        a = rng.standard_normal((d, d))
        a += a.T
        a[np.abs(a) < 0.5] = 0  # zeros on the diagonal need pivots of two rows
        values = np.linalg.eigvalsh(a)
        for s in [*(values[:-1] + np.diff(values) / 2), -100, 100]:
            assert whitening.below(a, s) == (values < s).sum()


def plain(rows, d):
    """x per usable row, in order."""
    usable = [(i, v) for i, v in rows if v is not None and len(v) == d and all(c is not None and np.isfinite(c) for c in v)]
    return [i for i, _ in usable], np.floor(1024 * np.array([v for _, v in usable], float)).astype(np.int64) + 100_000


def check(out, ids, x, most=8):
    n, s = len(x), x.sum(axis=0)
    gaps = (n * x - s).astype(object)
    centred = x - s / n
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    m = min(most, int((values > 1e-12 * values[0]).sum()))
    assert len(out) == n * m
    z = np.array([r.whitened for r in out]).reshape(n, m) if m else np.zeros((n, 0))
    mine = centred @ axes[:, :m] / np.sqrt(values[:m])
    order = np.lexsort((np.round(z[:, 0], 6), [r.vec_id if r.vec_id is not None else -1 for r in out[::m]]))
    z, other = z[order], mine[np.lexsort((np.round(mine[:, 0] * np.sign((z[:, 0] * mine[:, 0]).sum() or 1), 6), [i if i is not None else -1 for i in ids]))]
    for k in range(m):
        sign = np.sign((z[:, k] * other[:, k]).sum())
        assert np.abs(z[:, k] - sign * other[:, k]).max() < 1e-7
    assert [r.component for r in out] == list(range(1, m + 1)) * n and {r.n for r in out} == {n}
    assert sorted(r.deviation for r in out[::m]) == sorted((gaps ** 2).sum(axis=1).tolist())
    assert np.allclose([r.explained for r in out[:m]], values[:m] / np.trace(cov), rtol=1e-9)
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-9 and all(r.certified for r in out)


def test_the_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(QUERIES["op13_embedding_whitening"](spark, sf_dir).collect(), *plain(rows, 64))


@pytest.mark.parametrize("kind", ["float", "double"])
def test_awkward_rows(spark, kind):
    rng = np.random.default_rng(2)
    good = [(i, [float(v) for v in rng.integers(-4096, 4096, 3) / 1024]) for i in range(50)]
    bad = [(60, None), (61, [1.0, None, 2.0]), (62, [float("nan"), 0.0, 0.0]), (63, [float("inf"), 0.0, 0.0]), (64, []), (65, [1.0, 2.0]),
           (66, [1e30, 0.0, 0.0])]
    rows = good + [good[0], (7, good[3][1]), (None, good[4][1])] + bad
    df = spark.createDataFrame([(i, v, 0.5) for i, v in rows], f"vec_id long, embedding array<{kind}>, n double").repartition(1)
    out = whitening.whiten(df).collect()
    check(out, *plain([r for r in rows if r[0] not in (64, 65, 66)], 3), most=3)


def test_tables_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    flat = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], schema)).collect()
    assert [(r.vec_id, r.component, r.explained, abs(r.whitened)) for r in flat] == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]


def test_deviations_beyond_a_long_are_null():
    model = whitening.Whitening(2 ** 21, (2 ** 21 * 100_000,), np.ones(1), np.eye(1), 1.0, np.ones(1, bool))
    x = np.array([[100_000], [100_001], [100_000 + 1447], [100_000 + 1448], [10 ** 9]])
    whole = [(2 ** 21 * (int(v) - 100_000)) ** 2 for v in x[:, 0]]
    assert whitening.deviations(x, model) == [w if w < 2 ** 63 else None for w in whole]
