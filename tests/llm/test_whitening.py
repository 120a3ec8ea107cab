"""Whitening against numpy's symmetric eigenvalues and exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from odgraph.llm import whitening
from odgraph.llm.catalog import QUERIES
from tests.llm.helpers import SF001


def _covariance(spectrum, d, seed):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]
    full = np.zeros(d)
    full[:min(d, len(spectrum))] = spectrum[:d]
    v = (q * full) @ q.T
    return (v + v.T) / 2


def test_inertia_equals_signs_of_eigenvalues():
    rng = np.random.default_rng(1)
    for t in range(200):
        d = int(rng.integers(1, 25))
        a = rng.normal(size=(d, d))
        a = a + a.T
        if t % 3 == 0:
            a[np.abs(a) < 1] = 0
        if t % 4 == 0:
            a -= np.diag(np.diag(a))
        w = np.linalg.eigvalsh(a)
        positive, zero, negative = whitening.inertia(a)
        assert positive + zero + negative == d
        assert (w > 1e-9).sum() <= positive <= (w > -1e-9).sum() and (w < -1e-9).sum() <= negative <= (w < 1e-9).sum()


@pytest.mark.parametrize("spectrum", [
    (9, 5, 3, 2, 1), (5, 5, 5, 1), (5, 5 * (1 - 1e-13), 2, 2), (3, 1, 1e-16), (1, 1 - 1e-9, 1 - 2e-9, 0.5),
    (7,) * 40, (1e9, 1, 1e-2), (2,), (4, 4, 4, 4, 4 - 1e-12)])
@pytest.mark.parametrize("d", [1, 2, 3, 8, 40])
def test_leading_pairs(spectrum, d):
    v = _covariance(spectrum, d, len(spectrum) + d)
    e, x = whitening.leading(v)
    want = np.linalg.eigvalsh(v)[::-1][:4]
    assert np.allclose(e, np.maximum(want, 0), rtol=1e-12, atol=4e-13 * want[0])
    live = e > 0
    assert np.abs(x[:, live].T @ x[:, live] - np.eye(live.sum())).max() < 1e-9
    assert np.abs(v @ x - x * e).max() < 1e-12 * want[0]


def _check(rows, vectors, got):
    """The rows of :func:`whitening.whiten` against direct arithmetic."""
    kept = {k: [math.floor(256 * float(c)) for c in v] for k, v in vectors.items()
            if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted({tuple(x) for x in kept.values()})
    n, d = len(fit), len(fit[0])
    sums = [sum(col) for col in zip(*fit)]
    centred = np.array(fit) - np.array(sums) / n
    v = centred.T @ centred / n
    w, q = np.linalg.eigh(v)
    w, q = w[::-1], q[:, ::-1]
    assert len(got) == len(kept) * min(4, d)
    for r in got:
        x = kept[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x, sums))
        k = r["component"] - 1
        want = float((np.array(x) - np.array(sums) / n) @ q[:, k]) / w[k] ** 0.5
        assert abs(abs(r["whitened"]) - abs(want)) < 1e-7
        assert r["explained"] == pytest.approx(w[k] / np.trace(v), rel=1e-9)
        assert r["identity_error"] < 1e-9


def test_query_equals_direct_computation(spark):
    vectors = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()}
    _check(None, vectors, QUERIES["op12_whitening"](spark, SF001).collect())


def test_nulls_repeats_and_clashing_columns(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [9, 3, 2, 1, 0.5]]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]
    bad = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0]), (203, [float("nan")] * 5), (204, [float("-inf")] * 5), (205, [1.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("whitened", F.lit("x")).withColumn("n", F.lit(0))
    model = whitening.fit(df)
    got = whitening.whiten(df, model).collect()
    _check(None, dict(rows), got)
    twice = whitening.whiten(df.unionAll(df), model)
    assert twice.count() == 2 * len(got)
    named = df.withColumn("vec_id", F.lit(None).cast("long"))
    assert whitening.whiten(named, model).where("vec_id is null").count() == len(got)


def test_vectors_without_spread(spark):
    schema = "vec_id long, embedding array<float>"
    empty = spark.createDataFrame([], schema)
    assert whitening.whiten(empty, whitening.fit(empty)).collect() == []
    same = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)
    got = whitening.whiten(same, whitening.fit(same)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, None, None, None)] * 4
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], schema)
    got = whitening.whiten(line, whitening.fit(line)).where("vec_id = 8").orderBy("component").collect()
    assert [r.whitened is None for r in got] == [False, True, True]
    assert [r.explained for r in got] == pytest.approx([1, 0, 0])


def test_very_large_entries_stay_exact(spark):
    rows = [(i, [float(3 ** i) * 1e11, float(i)]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(df)
    xs = [[math.floor(256 * c) for c in v] for _, v in rows]
    assert model.sums == [sum(c) for c in zip(*xs)]
    assert model.deviations(np.array(xs, dtype=np.int64)) == [sum((9 * c - s) ** 2 for c, s in zip(x, model.sums)) for x in xs]
    got = whitening.whiten(df, model).collect()
    assert len(got) == 18 and {r.deviation for r in got if r.vec_id == 8} == {None}
