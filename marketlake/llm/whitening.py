"""Whitened embeddings from the leading components, found by spectral divide and conquer on polar decompositions."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import query, table
from .steps import Steps

EPS = np.finfo(float).eps
EXACT = 1 << 53  # sums of whole numbers below this are exact in doubles
LONG = 1 << 63
FARTHEST = float(1 << 52)  # scaled entries beyond it count as it


def polar(a: np.ndarray, most_rounds: int = 30) -> np.ndarray:
    """Orthogonal factor of a symmetric matrix by QR-based dynamically weighted Halley steps."""
    n = len(a)
    scale = np.linalg.norm(a)
    x, low = a / scale, EPS  # a lower bound of the singular values; smaller ones take more rounds
    for _ in range(most_rounds):
        d = (4 * (1 - low**2) / low**4) ** (1 / 3)
        h = sqrt(1 + d)
        h += 0.5 * sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low**2) / (low**2 * h)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q, _ = np.linalg.qr(np.vstack([sqrt(c) * x, np.eye(n)]))
        new = (b / c) * x + (h - b / c) / sqrt(c) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (h + b * low**2) / (1 + c * low**2))
        if moved < 10 * EPS * sqrt(n) and 1 - low < 10 * EPS:
            break
    return x


def _halves(a: np.ndarray, rng: np.random.Generator, noise: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces, that of the larger eigenvalues first; None if all are equal.

    The polar factor of the matrix shifted by s has the eigenvalues 1 and -1 for those above and below s. A shift
    that hits an eigenvalue, or has all on one side, gives no such split, and another one is taken.
    """
    n = len(a)
    diagonal = np.sort(np.diag(a))
    middle = float(diagonal.mean())
    spread = np.linalg.norm(a - middle * np.eye(n))
    if spread <= noise:
        return None
    shifts = [float(np.median(diagonal)), middle]
    while True:
        shift = shifts.pop(0) if shifts else middle + spread / sqrt(n) * rng.uniform(-1, 1)
        shifted = a - shift * np.eye(n)
        if not np.linalg.norm(shifted):
            continue
        projector = (polar(shifted) + np.eye(n)) / 2
        rank = int(round(float(np.trace(projector))))
        if not 0 < rank < n or np.linalg.norm(projector @ projector - projector) > 1e-10:
            continue
        basis = rng.standard_normal((n, rank))
        for _ in range(2):  # a second time against an unlucky draw
            basis = np.linalg.qr(projector @ basis)[0]
        whole = np.linalg.qr(np.hstack([basis, rng.standard_normal((n, n - rank))]))[0]
        upper, lower = whole[:, :rank], whole[:, rank:]
        if np.linalg.norm(lower.T @ a @ upper) <= max(noise, 1e-12 * spread):
            return upper, lower


def leading(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows.

    Invariant subspaces are split in two until they have one dimension, or one eigenvalue to rounding; subspaces
    below the components asked for are left whole.
    """
    rng = np.random.default_rng(0)
    noise = 4 * EPS * sqrt(max(1, len(a))) * np.linalg.norm(a)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    waiting = [np.eye(len(a))] if len(a) else []
    while waiting and len(values) < most:
        basis = waiting.pop()
        part = basis.T @ a @ basis
        part = (part + part.T) / 2
        halves = _halves(part, rng, noise) if len(part) > 1 else None
        if halves is not None:
            waiting += [basis @ halves[1], basis @ halves[0]]
            continue
        values += list(np.diag(part))
        vectors += list(basis.T)
    order = np.argsort(-np.array(values), kind="stable")[:most]
    return np.array(values)[order], np.array(vectors).reshape(len(values), len(a))[order]


def integers(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """``floor(scale * c) + shift`` per component; null if the vector or a component is null or not finite.

    Products beyond 2^52 count as 2^52, with their sign.
    """
    number = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    bounded = lambda c: F.greatest(F.least(c.cast("double") * scale, F.lit(FARTHEST)), F.lit(-FARTHEST))
    return F.when(F.forall(vector, number), F.transform(vector, lambda c: F.floor(bounded(c)) + F.lit(shift)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width)


def _cells(values, *places) -> pa.RecordBatch:
    """A cell of a sum per row, as decimals: exact whatever the number of tasks."""
    arrays = [pa.array(p, pa.int32()) for p in places]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))], [*"ij"[: len(places)], "value"])


def _sums(df: DataFrame, make, places: str, value: str) -> list:
    """Sums of the cells that each task makes of its rows."""
    schema = ", ".join(f"{p} int" for p in places) + f", value {value}"
    return df.mapInArrow(make, schema).groupBy(*places).agg(F.sum("value").alias("value")).collect()


class Statistics:
    """Exact moments of a table of integer vectors ``x`` of one width; what the driver holds is width x width.

    ``centre`` is the mean rounded to whole numbers, ``rest`` n times what was rounded away.
    """

    def __init__(self, vectors: DataFrame, width: int) -> None:
        def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, n = np.zeros(width, object), 0
            for batch in batches:
                x = _matrix(batch.column(0), width)
                sums = sums + (x.sum(0) if float(np.abs(x).max(initial=0)) * len(x) < LONG / 2 else x.astype(object).sum(0))
                n += len(x)
            yield _cells([*sums, n], np.arange(width + 1))

        found = {r.i: int(r.value) for r in _sums(vectors, totals, "i", "decimal(38,0)")}
        self.n = found.get(width, 0)
        self.width = width
        if not self.n:
            return
        sums = [found[i] for i in range(width)]
        self.centre = np.array([(2 * s + self.n) // (2 * self.n) for s in sums], np.int64)
        self.rest = [s - self.n * int(c) for s, c in zip(sums, self.centre)]
        self.mean_rest = np.array([r / self.n for r in self.rest])

    def covariance(self, vectors: DataFrame) -> np.ndarray:
        """Divisor n. The vectors are centred first, at ``centre``; sums are of whole numbers and so exact."""
        centre, width = self.centre, self.width
        upper = np.triu_indices(width)

        def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width, width), object)
            for batch in batches:
                y = _matrix(batch.column(0), width) - centre
                far = int(np.abs(y).max(initial=0))
                block = EXACT // max(1, far * far)
                for i in range(0, len(y), max(1, block)):
                    part = y[i : i + max(1, block)].astype(float if block else object)
                    made = part.T @ part
                    total = total + (made.astype(np.int64) if block else made)
            if width:
                yield _cells(total[upper], *upper)

        out = np.zeros((width, width))
        for r in _sums(vectors, products, "ij", "decimal(38,0)"):
            out[r.i, r.j] = out[r.j, r.i] = (self.n * int(r.value) - self.rest[r.i] * self.rest[r.j]) / self.n**2
        return out


def _projected(y: np.ndarray, mean_rest: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return (y - mean_rest) @ axes.T


def _identity_error(vectors: DataFrame, stats: Statistics, axes: np.ndarray) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    centre, mean_rest, width, k = stats.centre, stats.mean_rest, stats.width, len(axes)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            z = _projected(_matrix(batch.column(0), width) - centre, mean_rest, axes)
            total += np.vstack([z.T @ z, z.sum(0)])
        i, j = (p.ravel() for p in np.indices(total.shape, np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "value"])

    found = np.zeros((k + 1, k))
    for r in _sums(vectors, products, "ij", "double"):
        found[r.i, r.j] = r.value / stats.n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max(initial=0))


def _deviation(y: np.ndarray, n: int, rest: list[int]) -> pa.Array:
    """Sum of (n x - S)^2 over the dimensions, exact."""
    farthest = n * int(np.abs(y).max(initial=0)) + max(map(abs, rest), default=0)
    if farthest * farthest * max(1, y.shape[1]) < LONG:
        far = n * y - np.array(rest, np.int64)
        return pa.array((far * far).sum(1)).cast(pa.decimal128(38, 0))
    far = n * y.astype(object) - np.array(rest, object)
    return pa.array([Decimal(int(v)) for v in (far * far).sum(1)], pa.decimal128(38, 0))


def whiten(df: DataFrame, key: str, vector: Column, components: int = 16) -> DataFrame:
    """Each row's share in the leading components of the covariance of ``vector``, over their deviation.

    ``vector`` is an array of longs, as by ``integers``; rows without one are dropped. Mean and covariance are over
    the distinct vectors, each once, with their number as divisor. Returns per row and component: ``key,
    component`` (from 1, by falling eigenvalue), ``n`` (distinct vectors), ``deviation`` (decimal; the sum of
    (n x - S)^2 over the dimensions, S the sums of the distinct vectors), ``whitened``, ``explained`` (the
    eigenvalue's share of the trace) and ``identity_error`` (how far the covariance of ``whitened`` over the
    distinct vectors is from the identity at most; one value).

    Shorter vectors are filled up with the scaled zero, 1,000,000. Components whose eigenvalue is 0 to rounding have no
    unit variance and are left out, so a table of equal vectors, and an empty one, gives no rows. Repeated rows
    are repeated. All that leaves the cluster or is broadcast has the size of the covariance matrix.
    """
    steps = Steps(df.sparkSession)
    rows = df.select(F.col(key).alias("key"), vector.alias("x")).where("x is not null")
    width = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    zeros = F.array_repeat(F.lit(1_000_000).cast("long"), F.lit(width) - F.size("x"))
    rows = rows.select("key", F.when(F.size("x") < width, F.concat("x", zeros)).otherwise(F.col("x")).alias("x"))
    schema = "key %s, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    schema %= rows.schema["key"].dataType.simpleString()
    fitted = steps.keep(rows.select("x").distinct())
    stats = Statistics(fitted, width)
    if not stats.n:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    covariance = stats.covariance(fitted)
    trace = float(np.trace(covariance))
    values, vectors = leading(covariance, min(components, width))
    real = values > 64 * EPS * max(1, width) * trace
    values, axes = values[real], vectors[real] / np.sqrt(values[real])[:, None]
    k, n, centre, rest, mean_rest = len(values), stats.n, stats.centre, stats.rest, stats.mean_rest
    error = _identity_error(fitted, stats, axes) if k else 0.0
    steps.drop_from(0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            y = _matrix(batch.column(1), width) - centre
            each = np.repeat(np.arange(len(y)), k)
            number = np.tile(np.arange(k), len(y))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(number + 1, pa.int32()),
                    pa.array(np.full(len(each), n)),
                    _deviation(y, n, rest).take(pa.array(each)),
                    pa.array(_projected(y, mean_rest, axes).ravel()),
                    pa.array((values / trace)[number]),
                    pa.array(np.full(len(each), error)),
                ],
                ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project, schema).withColumnRenamed("key", key)


@query("op12_qdwh_whitening")
def op12(spark, sf_dir):
    """The 16 leading components of all embeddings."""
    vectors = table(spark, sf_dir, "embeddings")
    found = whiten(vectors, "vec_id", integers(F.col("embedding")), 16)
    return found.withColumn("deviation", F.col("deviation").cast("long"))
