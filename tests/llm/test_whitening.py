"""Whitening against numpy's eigenvectors, and its parts on matrices with known eigenvalues."""

import math

import numpy as np
import pytest

from rillflow.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<float>, `Component` int, x string, n int"


def with_eigenvalues(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize("values", [
    list(range(1, 13)), [5, 5, 5, 1, 0, 0], [1, 1, 1, 1, 1], [1e6, 1, 1e-3, 1e-6, 0, 0, 0], [3, 3 - 1e-9, 2, 2 - 1e-6, 1, 0.5],
    [0, 0, 7], [2], np.random.default_rng(0).gamma(20, 1, 64).tolist()])
def test_leading_eigenpairs(values):
    m = with_eigenvalues(values)
    m = (m + m.T) / 2
    got, vectors = W.leading(m, 4)
    want = sorted((v for v in values if v > 0), reverse=True)[:4]
    assert len(got) >= len([v for v in want if v > 1e-9 * max(values)])
    assert np.allclose(got, want[:len(got)], rtol=0, atol=1e-11 * max(values))
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-10)
    assert np.abs(m @ vectors - vectors * got).max() <= 1e-11 * max(values)


def test_inertia_counts():
    r = np.random.default_rng(3)
    for n in (1, 2, 3, 10, 40):
        for _ in range(20):
            m = r.standard_normal((n, n)) * (r.random((n, n)) < 0.5)
            m = m + m.T
            e = np.linalg.eigvalsh(m)
            for shift in (0.123, *((e[1:] + e[:-1]) / 2)):
                if np.abs(e - shift).min() > 1e-9:
                    assert W.above(m, shift) == (e > shift).sum()
    assert W.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def brute(rows, components=4):
    """vec_id -> (deviation, whitened) and (n, explained), by numpy."""
    sound = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
             if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(x) for _, x in sound]
    d = max(lengths, key=lambda n: (lengths.count(n), n))
    sound = [(i, x) for i, x in sound if len(x) == d]
    fit = sorted({tuple(x) for _, x in sound})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array(fit, float) - np.array(sums) / n
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return n, e / np.trace(cov), [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums)), (np.array(x) - np.array(sums) / n) @ u / np.sqrt(e))
                                  for i, x in sound]


def agree(got, rows, components=4):
    n, explained, want = brute(rows, components)
    k = min(components, len(explained))
    assert {r.component for r in got} == set(range(1, k + 1)) and len(got) == k * len(want)
    assert all(r.n == n and r.identity_error <= 1e-9 for r in got)
    for c in range(k):
        own = sorted((-1 if r.vec_id is None else r.vec_id, r.deviation, r.whitened) for r in got if r.component == c + 1)
        theirs = sorted((-1 if i is None else i, dev, float(z[c])) for i, dev, z in want)
        assert [x[:2] for x in own] == [x[:2] for x in theirs]
        a, b = np.array([x[2] for x in own]), np.array([x[2] for x in theirs])
        sign = np.sign(a @ b)
        assert np.abs(a - sign * b).max() < 1e-8
        assert all(abs(r.explained / explained[c] - 1) < 1e-9 for r in got if r.component == c + 1)


def test_odd_rows(spark):
    r = np.random.default_rng(4)
    base = r.standard_normal((60, 6)) * [5, 4, 3, 2, 1, 0.5]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [rows[3], rows[3], (None, rows[5][1]), (7, rows[8][1])]
    rows += [(90, None), (91, []), (92, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (93, [math.nan] * 6), (94, [math.inf] + [0.0] * 5), (95, [1.0] * 9),
             (96, [-0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "a", 2) for i, v in rows], SCHEMA)
    agree(W.whiten(df.repartition(3)).collect(), rows)
    assert W.whiten(df.limit(0)).collect() == []
    assert W.whiten(df.filter("vec_id = 3")).collect() == []  # no variance
    flat = spark.createDataFrame([(i, [float(i), 2.0, 3.0], 1, "a", 2) for i in range(5)], SCHEMA)
    assert {x.component for x in W.whiten(flat).collect()} == {1}


def test_large_numbers(spark):
    rows = [(i, [float(1 << 20) * (i * i % 7), float(i) * 1e5, 3.0 * i]) for i in range(40)]
    got = W.whiten(spark.createDataFrame([(i, v, 1, "a", 2) for i, v in rows], SCHEMA)).collect()
    n, _, want = brute(rows)
    devs = {i: dev if dev < 1 << 63 else None for i, dev, _ in want}
    assert {r.vec_id: r.deviation for r in got} == devs
    c = W.Centre(3, [1 << 62, 5])
    assert c.deviations(np.array([[1, 2]])) == [None]
    assert W.Centre(10 ** 9, [10 ** 11]).deviations(np.array([[101], [100]])) == [10 ** 18, 0]


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    agree(W.op13_whitening(spark, sf).collect(), rows)
