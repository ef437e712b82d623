"""Whitening vectors by the leading principal components, found by FEAST contour integration.

Vectors are made whole numbers; Spark keeps each distinct one once, sums them up per dimension
and, centred by those sums, adds up the covariance. Only that matrix, its size given by the
number of dimensions d and by no number of rows, reaches the driver (d * d numbers).

There, inertia counts (how many pivots of a symmetric factorisation of the matrix less a shift
are positive: so many eigenvalues lie above the shift) close in on the leading eigenvalues, until
cuts in the gaps between them are known. For each interval between two cuts, a contour around it
in the complex plane is gone along by Gauss-Legendre quadrature: the solutions of the shifted
systems at its points, weighed and added, project a few vectors onto the interval's eigenvectors;
Rayleigh-Ritz takes the eigenpairs out of what they span, and these are projected again until
they hold to double precision. An interval must give as many as its inertia counts say.

Rows: a vector that is null, or holds null or an entry that is not finite (or beyond 2^62 / 256,
which no long holds), takes no part, nor does one of another length than the most frequent
(of lengths with the same count, the largest); an empty vector takes no part either. Repeated
vectors are fitted on once and each gets its rows; a null or repeated id is carried. A component
without variance is left out, so vectors that are all equal give no rows, nor does an empty table.
``deviation`` is null where a long can't hold it. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import stored

#: Points of the quadrature on the upper half of a contour.
POINTS = 8
#: Projections of one interval before its subspace is made larger.
ROUNDS = 30


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are larger than ``shift``: by Sylvester's law as
    many as there are positive pivots in a Bunch-Kaufman factorisation of ``matrix - shift``."""
    m = matrix - shift * np.eye(len(matrix))
    n, k, positive = len(m), 0, 0
    alpha = (1 + np.sqrt(17)) / 8
    while k < n:
        diagonal, most, r = abs(m[k, k]), 0.0, k
        if k + 1 < n:
            r = k + 1 + int(np.argmax(np.abs(m[k + 1:, k])))
            most = abs(m[r, k])
        if max(diagonal, most) == 0:
            k += 1
            continue
        two = False
        if diagonal < alpha * most:
            row = np.abs(m[r, k:])
            row[r - k] = 0
            other = row.max()
            if diagonal * other < alpha * most * most:
                two = abs(m[r, r]) < alpha * other
                at = k + 1 if two else k
                m[[at, r]] = m[[r, at]]
                m[:, [at, r]] = m[:, [r, at]]
        if two:
            block, rest = m[k:k + 2, k:k + 2].copy(), m[k + 2:, k:k + 2].copy()
            det, trace = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0], block[0, 0] + block[1, 1]
            positive += 1 if det < 0 else 2 * (trace > 0)
            m[k + 2:, k + 2:] -= rest @ np.linalg.solve(block, rest.T)
            k += 2
        else:
            positive += m[k, k] > 0
            rest = m[k + 1:, k].copy()
            m[k + 1:, k + 1:] -= np.outer(rest, rest / m[k, k])
            k += 1
    return int(positive)


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(from, to, eigenvalues inside), the highest first, that hold the ``wanted`` largest ones and
    end in gaps. Eigenvalues too close to tell apart are in one interval."""
    n = len(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9)
    near = 64 * n * np.finfo(float).eps * bound
    known: dict[float, int] = {}

    def count(x: float) -> int:
        if x not in known:
            known[x] = n if x <= -bound else 0 if x >= bound else above(matrix, x)
        return known[x]

    count(-bound), count(bound)

    def bracket(k: int) -> tuple[float, float]:
        """The closest known shifts around the k-th largest eigenvalue."""
        return max(x for x, c in known.items() if c >= k), min(x for x, c in known.items() if c < k)

    out, top, k, done = [], bound, 1, 0
    while done < wanted:
        # is there a gap between the k-th largest eigenvalue and the next?
        if k == n:
            cut = -bound
        else:
            while True:
                (a, b), (c, d) = bracket(k), bracket(k + 1)
                width = max(b - a, d - c)
                if a > d and a - d >= width or width <= near:
                    break
                lo, hi = (a, b) if b - a >= d - c else (c, d)
                count((lo + hi) / 2)  # for what it adds to the known shifts
            cut = (a + d) / 2 if a - d > near else None
        if cut is not None:
            out.append((cut, top, k - done))
            top, done = cut, k
        k += 1
    return out


def feast(matrix: np.ndarray, low: float, high: float, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``inside`` eigenvalues between ``low`` and ``high``, falling, and their unit eigenvectors."""
    n = len(matrix)
    scale = np.abs(matrix).sum(axis=1).max()
    x, w = np.polynomial.legendre.leggauss(POINTS)
    middle, radius = (low + high) / 2, (high - low) / 2
    turn = radius * np.exp(0.5j * np.pi * (x + 1))
    size = min(n, max(2 * inside, inside + 4))
    while True:
        span = np.random.default_rng(n).standard_normal((n, size))
        best = np.inf
        for _ in range(ROUNDS):
            projected = np.zeros((n, size))
            for step, weight in zip(turn, w / 2):
                solved = np.linalg.solve((middle + step) * np.eye(n) - matrix, span.astype(complex))
                projected += (weight * step * solved).real
            basis = np.linalg.qr(projected)[0]
            values, vectors = np.linalg.eigh(basis.T @ matrix @ basis)
            span = basis @ vectors
            own = np.flatnonzero((values > low) & (values < high))[::-1]
            if len(own) != inside:
                continue
            rest = np.linalg.norm(matrix @ span[:, own] - span[:, own] * values[own], axis=0).max() / scale
            if rest < 1e-12 and rest >= best / 2:  # as near as double numbers get
                return values[own], span[:, own]
            best = min(best, rest)
        if size == n:
            raise ArithmeticError(f"no {inside} eigenvalues found between {low} and {high}")
        size = min(n, 2 * size)


def leading(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues with variance, falling, at most ``components``, and as columns their
    unit eigenvectors, with the largest entry positive."""
    n = len(matrix)
    scale = np.trace(matrix)
    if not scale > 0:
        return np.zeros(0), np.zeros((n, 0))
    matrix = matrix / scale
    wanted = min(components, above(matrix, 8 * n * np.finfo(float).eps))
    if not wanted:
        return np.zeros(0), np.zeros((n, 0))
    found = [feast(matrix, *x)[1] for x in intervals(matrix, wanted)]
    # once more over all intervals, which makes their eigenvectors orthogonal to each other
    basis = np.linalg.qr(np.concatenate(found, axis=1))[0]
    values, vectors = np.linalg.eigh(basis.T @ matrix @ basis)
    values, vectors = values[::-1][:wanted], (basis @ vectors)[:, ::-1][:, :wanted]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)]
    return values * scale, vectors * np.where(largest < 0, -1.0, 1.0)


def whole_vectors(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """``rows`` with ``x``, floor(256 * entry) of each entry as a long, where the vector takes part;
    and its length."""
    v = F.col(vector).cast("array<double>")
    sound = F.coalesce(F.forall(v, lambda c: F.coalesce(F.abs(c * 256.0) < float(1 << 62), F.lit(False))), F.lit(False))
    given = rows.filter(sound & (F.size(v) > 0))
    length = given.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = length["d"] if length else 0
    return given.filter(F.size(v) == d).withColumn("x", F.transform(v, lambda c: F.floor(c * 256.0))), d


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _fits(*factors: float) -> bool:
    return float(np.prod([float(f) for f in factors])) < 2.0 ** 62


class Centre:
    """n vectors with the sums ``sums``: what is left of a vector without their mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.largest = max(map(abs, sums), default=0)

    def less(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, from whole numbers where these fit a long."""
        most = int(np.abs(x).max(initial=0))
        if _fits(self.n, most + self.largest / self.n + 1):
            return (self.n * x - np.array(self.sums, np.int64)) / self.n
        return x - np.array([s / self.n for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n * x - sums)^2, exact; None beyond a long."""
        d, most = x.shape[1], int(np.abs(x).max(initial=0))
        side = float(self.n) * most + self.largest
        if _fits(d, side, side):
            y = self.n * x - np.array(self.sums, np.int64)
            return (y * y).sum(axis=1).tolist()
        if not _fits(d, most, max(most, self.largest)):
            x = x.astype(object)
        squares = (x * x).sum(axis=1).astype(object)
        across = (x * np.array(self.sums, x.dtype)).sum(axis=1).astype(object)
        out = self.n * self.n * squares - 2 * self.n * across + sum(s * s for s in self.sums)
        return [v if v < 1 << 63 else None for v in out.tolist()]


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """How many vectors, and their sum per dimension."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n += len(x)
            if not _fits(len(x), np.abs(x).max(initial=0)):
                x = x.astype(object)
            total = [a + b for a, b in zip(total, x.sum(axis=0).tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()),
                                          pa.array([Decimal(v) for v in (n, *total)], pa.decimal128(38, 0))], names=["i", "v"])

    got = {r.i: int(r.v) for r in fit.select("x").mapInArrow(partial, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return got.get(-1, 0), [got.get(i, 0) for i in range(d)]


def _products(fit: DataFrame, d: int, width: int, of) -> np.ndarray:
    """The sum of y^T y over all vectors' ``of(x)``, numbers of ``width`` dimensions."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = of(_matrix(batch.column(0), d))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                         names=["i", "row"])

    rows = fit.select("x").mapInArrow(partial, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    got = rows.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((width, width))
    out[got.column("i").to_numpy(), got.column("j").to_numpy()] = got.column("v").to_numpy()
    return (out + out.T) / 2


def whiten(rows: DataFrame, components: int = 4, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``rows`` (key, vector) -> a row for each vector and component: the key, ``component`` (from 1),
    ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Fitted on each distinct vector once; divisor n. ``whitened`` is the centred vector projected on
    the component, over the root of its eigenvalue.
    """
    given, d = whole_vectors(rows.select(F.col(key).alias("vec_id"), F.col(vector).alias("v")), "v")
    schema = f"{key} {dict(rows.dtypes)[key]}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    fit = stored(given.select("x").distinct(), "whitening_fit") if d else None
    n, sums = _sums(fit, d) if d else (0, [])
    centre = Centre(n, sums)
    covariance = _products(fit, d, d, centre.less) / n if n else np.zeros((0, 0))
    values, vectors = leading(covariance, components)
    k = len(values)
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    project = vectors / np.sqrt(values)
    explained = values / np.trace(covariance)
    error = float(np.abs(_products(fit, d, k, lambda x: centre.less(x) @ project) / n - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), pa.array(centre.deviations(x), pa.int64()).take(each),
                 pa.array((centre.less(x) @ project).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return given.select(F.col("vec_id").alias(key), "x").mapInArrow(run, schema)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """The whitened leading four components of every vector."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
