"""Whitening against a dense eigensolver, inertia and intervals on hard spectra, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from harmonia.llm import whitening as W

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("component", T.StringType()), T.StructField("vector", T.StringType()), T.StructField("n", T.StringType())])


def spectra():
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(48, 48)))
    yield np.diag([3.0])
    yield rng.normal(size=(6, 2)) @ np.eye(2, 6)                   # not symmetric: replaced below
    for values in (rng.uniform(0, 1, 48), 10.0 ** np.linspace(-9, 3, 48), np.repeat([5.0, 3.0, 1.0, 0.5], 12), np.r_[np.zeros(40), 1 + 1e-9 * np.arange(8)]):
        yield (q * values) @ q.T


@pytest.mark.parametrize("k", range(6))
def test_eigenpairs_of_hard_spectra(spark, k):
    v = list(spectra())[k]
    v = (v + v.T) / 2
    want = np.linalg.eigvalsh(v)[::-1]
    for shift in (0.25, 0.7, float(want.mean())):
        assert W.above(v, shift) == (want > shift).sum()
    parts = W.intervals(v, 32)
    assert sum(n for *_, n in parts) >= min(32, len(v))
    values, vectors = W.eigenpairs(spark, v, 32)
    assert len(values) == min(32, len(v))
    assert np.abs(values - want[:32]).max() <= 1e-12 * np.abs(want).max()
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-10
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-11 * np.abs(want).max()


def test_a_lost_eigenvalue_is_seen():
    v = np.diag([1.0, 2.0, 3.0])
    with pytest.raises(ValueError, match="were not found"):
        W.in_interval(v, 1.5, 3.5, 3)


def brute(vectors):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    return x, n, s, centred, v, e[::-1][:32], u[:, ::-1][:, :32]


def test_whitening_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(6)
    good = (rng.normal(size=(400, 40)) @ np.diag(np.linspace(0.2, 3, 40))).tolist()
    good[7] = good[8]   # repeated
    bad = [None, [1.0] * 39 + [None], [1.0] * 39 + [math.nan], [math.inf] * 40, [1e300] * 40, []]
    rows = [(i, g, "a", "b", "c") for i, g in enumerate(good)] + [(1000 + i, b, "a", "b", "c") for i, b in enumerate(bad)]
    rows[3] = (None, *rows[3][1:])
    got = W.whiten(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.toPandas()
    x, n, s, centred, v, e, u = brute(good)
    assert len(got) == 400 * 32 and set(got["n"]) == {400} and got["identity_error"].max() <= 1e-9
    got = got.assign(vec_id=got["vec_id"].fillna(3).astype(int)).pivot(index="vec_id", columns="component")
    want, have = centred @ u / np.sqrt(e), got["whitened"].loc[range(400)].to_numpy()
    assert np.abs(have - want * np.sign((have * want).sum(axis=0))).max() <= 1e-8
    assert np.allclose(got["explained"].iloc[0], e / np.trace(v), rtol=1e-9)
    assert (got["deviation"].loc[range(400)].iloc[:, 0].to_numpy() == ((n * x - s) ** 2).sum(axis=1)).all()


def test_odd_tables(spark):
    def run(vectors):
        return W.whiten(spark.createDataFrame([(i, v, "a", "b", "c") for i, v in enumerate(vectors)], SCHEMA)).collect()
    assert run([]) == [] and run([None, []]) == [] and run([[1.0, 2.0]]) == [] and run([[1.0, 2.0]] * 5) == []
    one = run([[0.0, 5.0], [1.0, 5.0], [2.0, 5.0]])     # the second dimension has no variance
    assert {r.component for r in one} == {1} and one[0].explained == pytest.approx(1.0)
    two = run([[0.0], [1.0], [0.0, 1.0], [1.0, 0.0], [1.0, 1.0]])   # two lengths, two fit lists
    assert {r.n for r in two if r.vec_id < 2} == {2} and {r.n for r in two if r.vec_id >= 2} == {3}
