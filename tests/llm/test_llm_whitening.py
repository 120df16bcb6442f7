"""Whitening against a dense computation of the same."""

import math
import random

import numpy as np
import pytest

from ledgerlens.llm import whitening
from ledgerlens.llm.queries import QUERIES


def dense(rows, k=8):
    good = [(i, [math.floor(1024 * float(c)) + 100000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in good], dtype=object)
    n, s = len(good), x.sum(axis=0)
    dev = n * x - s
    y = dev.astype(float) / n
    e, w = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-e)[:k]
    return [i for i, _ in good], n, [int(v) for v in (dev * dev).sum(axis=1)], e[order], w[:, order], y, e.sum()


def check(rows, got, k=8):
    ids, n, dev, e, w, y, trace = dense(rows, k)
    e = e[e > 1e-12 * e[0]]
    assert sorted((r.vec_id, r.component, r.n, r.deviation) for r in got) == sorted((i, c + 1, n, d) for i, d in zip(ids, dev) for c in range(len(e)))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-9
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(len(e)):
        want = y @ w[:, c] / math.sqrt(e[c])
        have = np.array([by[i, c + 1].whitened for i in ids])
        sign = np.sign(have @ want)
        assert np.abs(sign * have - want).max() < 1e-6
        assert abs(by[ids[0], c + 1].explained / (e[c] / trace) - 1) < 1e-9


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, x string, n int").repartition(3)


def test_whitening(spark):
    rnd = random.Random(5)
    base = [[rnd.gauss(0, 1) for _ in range(12)] for _ in range(12)]
    rows = [(i, [float(np.float32(sum(rnd.gauss(0, 0.9**j) * base[j][d] for j in range(12)))) for d in range(12)]) for i in range(400)]
    bad = [(900, None), (901, []), (902, [None] * 12), (903, [float("nan")] * 12), (904, [float("inf")] + [0.0] * 11), (905, [1.0])]
    got = whitening.whiten(frame(spark, rows + bad)).collect()
    check(rows, got)


def test_deficient_and_badly_scaled(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.gauss(0, 1), 0.25, a := rnd.gauss(0, 30), 2 * a, rnd.gauss(0, 1000)]) for i in range(200)]
    rows = [(i, [float(math.floor(1024 * c)) / 1024 for c in v]) for i, v in rows]
    got = whitening.whiten(frame(spark, rows, "double")).collect()
    assert {r.component for r in got} == {1, 2, 3}
    check(rows, got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5])
def test_no_spread(spark, rows):
    assert whitening.whiten(frame(spark, rows)).collect() == []


def test_null_and_repeated_ids_and_large_numbers(spark):
    rows = [(None, [1e9, 2e8]), (None, [1e9, 2e8]), (3, [-1e9, 5e8]), (3, [0.0, 5.5])]
    got = whitening.whiten(frame(spark, rows, "double")).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 1), (0, 2), (0, 2), (3, 1), (3, 1), (3, 2), (3, 2)]
    assert {r.deviation for r in got} == {None}  # beyond a long


def test_solve_and_factor():
    rnd = np.random.default_rng(1)
    r = np.triu(rnd.normal(size=(6, 6))) + 4 * np.eye(6)
    a = rnd.normal(size=(9, 6))
    assert np.allclose(whitening.solve(a, [r, r]), a @ np.linalg.inv(r) @ np.linalg.inv(r))
    assert np.isfinite(whitening.cholesky(np.zeros((3, 3)), 0.0)).all()


def test_registered_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(rows, QUERIES["op12_whitening"](spark, sf).collect())
