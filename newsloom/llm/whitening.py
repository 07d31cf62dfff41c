"""Whitening of vectors by the principal components of their covariance."""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import added_columns, store, unused_names

COMPONENTS = 8
_EPS = np.finfo(float).eps


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley steps.

    Each step is a QR factorisation; the weights follow a lower bound of the smallest
    singular value, so that six steps do at double precision.
    """
    n = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(max(low, _EPS) if np.isfinite(low) else _EPS, 1.0)
    for _ in range(20):
        l2 = low * low
        d = np.cbrt(4 * max(1 - l2, 0.0) / l2**2)
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(8 - 4 * d + 8 * (2 - l2) / (l2 * root), 0.0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))[0]
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(low * (wa + wb * l2) / (1 + wc * l2), 1.0)
        if moved <= np.cbrt(_EPS) / 10 and 1 - low <= 10 * _EPS:
            break
    return x


def _projector(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """A spectral projector of `a` on the eigenvalues above a shift, and its rank.

    The shift is the median of the diagonal, else the mean of the eigenvalues or near it.
    A shift that has no eigenvalue on one side, or one too near to tell its side, is no
    good. None if no shift is: all eigenvalues are equal up to rounding.
    """
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    if spread <= 4 * _EPS * abs(mean):
        return None
    steps = [s / 4**k for k in range(1, 8) for s in (1, -1)]
    for shift in [np.median(np.diag(a)), mean, *[mean + s * spread for s in steps]]:
        moved = a - shift * np.eye(n)
        if not moved.any():
            continue
        p = (polar_factor(moved) + np.eye(n)) / 2
        rank = round(float(np.trace(p)))
        if 0 < rank < n and np.linalg.norm(p @ p - p) < 1e-11 * n:
            return p, rank
    return None


def top_components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors
    as rows, by spectral divide and conquer.

    A projector splits the space in two invariant ones. Both are split on, the one of the
    larger eigenvalues first, the other only as far as it is wanted, down to lines. The
    entry of largest size of a vector is positive.
    """
    draw = np.random.default_rng(12)

    def split(basis: np.ndarray, wanted: int) -> list[tuple[float, np.ndarray]]:
        a = basis.T @ v @ basis
        a = (a + a.T) / 2
        found = _projector(a) if len(a) > 1 else None
        if found is None:
            order = np.argsort(-np.diag(a), kind="stable")[:wanted]
            return [(float(a[i, i]), basis[:, i]) for i in order]
        p, rank = found
        n = len(a)
        upper = np.linalg.qr(p @ draw.standard_normal((n, rank)))[0]
        upper = np.linalg.qr(p @ upper)[0]
        lower = np.linalg.qr(draw.standard_normal((n, n - rank)) - p @ draw.standard_normal((n, n - rank)))[0]
        lower = lower - upper @ (upper.T @ lower)
        lower = np.linalg.qr(lower - p @ lower)[0]
        lower = np.linalg.qr(lower - upper @ (upper.T @ lower))[0]
        pairs = split(basis @ upper, min(wanted, rank))
        if wanted > rank:
            pairs += split(basis @ lower, wanted - rank)
        return pairs

    pairs = split(np.eye(len(v)), min(wanted, len(v)))
    values = np.array([e for e, _ in pairs])
    vectors = np.array([x / np.linalg.norm(x) for _, x in pairs])
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    order = np.argsort(-values, kind="stable")
    return values[order], (vectors * signs[:, None])[order]


@dataclass(frozen=True)
class Whitening:
    """What `fit` finds: the length of the vectors fitted, their number, the sum of each dimension
    (exact for whole numbers), eigenvalues and unit eigenvectors (rows) of the covariance,
    and its trace. A component without variance is in `values` and cannot be whitened."""

    dims: int
    n: int
    sums: tuple
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s) / self.n) for s in self.sums])

    @property
    def has_variance(self) -> np.ndarray:
        return self.values > self.dims * _EPS * self.trace


def _matrices(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, rows, matrix) for each length of vectors in each batch; null ones are in none."""
    for batch in batches:
        column = batch.column(at)
        lengths = np.array([-1 if x is None else x for x in column.value_lengths().to_pylist()], np.int64)
        for length in np.unique(lengths[lengths > 0]).tolist():
            rows = np.flatnonzero(lengths == length)
            flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
            yield batch, rows, flat.reshape(-1, length)


def fit(vectors: DataFrame, vector: str = "vector", components: int = COMPONENTS) -> Whitening | None:
    """The components of all vectors of the commonest length (of equals the shorter); None if
    there is no vector.

    Vectors are null or hold finite numbers; null and empty ones are left out; repeated rows
    count as often as they come. Tasks add up their sums, then, with the means known, the
    products of what is left. To the driver come the sums and the covariance, whose
    size is that of a vector, squared.
    """
    slim = vectors.select(F.col(vector).alias("v"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for _, _, x in _matrices(batches, 0):
            whole = np.issubdtype(x.dtype, np.integer)
            if whole and int(np.abs(x).max()) * len(x) < 1 << 62:
                sums = [int(s) for s in x.sum(axis=0)]
            else:
                sums = list((x.astype(object) if whole else x.astype(float)).sum(axis=0))
            held = totals.setdefault(x.shape[1], [0, [0] * x.shape[1]])
            held[0] += len(x)
            held[1] = [a + b for a, b in zip(held[1], sums, strict=True)]
        rows = [(d, i, n, s) for d, (n, sums) in totals.items() for i, s in enumerate(sums)]
        dims, dim, n, sums = zip(*rows, strict=True) if rows else ((), (), (), ())
        total = pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)) if exact else pa.array(map(float, sums), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(dims, pa.int32()), pa.array(dim, pa.int32()), pa.array(n, pa.int64()), total],
            ["dims", "dim", "n", "total"],
        )

    exact = slim.schema["v"].dataType.elementType.typeName() in ("byte", "short", "integer", "long")
    per_task = slim.mapInArrow(add, f"dims int, dim int, n bigint, total {'decimal(38, 0)' if exact else 'double'}")
    sums = per_task.groupBy("dims", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    # All lengths have a line; only the lines of the commonest come to the driver.
    sums = store(sums, "sums")
    first = sums.where("dim = 0").orderBy(F.desc("n"), "dims").select("dims", "n").first()
    if first is None:
        return None
    dims, n = first
    lines = sums.where(F.col("dims") == dims).orderBy("dim").collect()
    totals = tuple(int(r.total) if exact else r.total for r in lines)
    mean = np.array([float(Fraction(s) / n) for s in totals])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((dims, dims))
        for _, _, x in _matrices(batches, 0):
            if x.shape[1] == dims:
                centred = x.astype(float) - mean
                gram += centred.T @ centred
        yield _lines(dict(enumerate(gram)))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(-1, dims)
            for i, line in zip(batch.column(0).to_pylist(), values, strict=True):
                held[i] = held[i] + line if i in held else line
        yield _lines(held)

    lines = slim.mapInArrow(multiply, "line int, products array<double>").repartition("line")
    products = lines.mapInArrow(join, "line int, products array<double>").orderBy("line").collect()
    covariance = np.array([r.products for r in products]) / n
    values, directions = top_components(covariance, components)
    return Whitening(dims, n, totals, values, directions, float(np.trace(covariance)))


def _lines(held: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.int32()), pa.array([list(x) for x in held.values()], pa.list_(pa.float64()))],
        ["line", "products"],
    )


def whiten(vectors: DataFrame, fitted: Whitening | None, vector: str = "vector") -> DataFrame:
    """The rows whose vector has the length of the fitted ones, with `whitened`: for each
    component the vector less the mean, projected on it, over the root of its eigenvalue;
    null for a component without variance.

    Without anything fitted there are no rows. The new column has another name, with
    underscores in front, where the table has one of that name. The means and components
    go to every task: nine vectors.
    """
    (name,) = unused_names(vectors, "whitened")
    schema = added_columns(vectors, f"`{name}` array<double>")
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    at = vectors.columns.index(vector)
    scale = np.sqrt(np.where(fitted.has_variance, fitted.values, 1.0))
    model = vectors.sparkSession.sparkContext.broadcast(
        (fitted.mean, fitted.vectors / scale[:, None], fitted.has_variance)
    )
    dims = fitted.dims

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, directions, known = model.value
        for batch, rows, x in _matrices(batches, at):
            if x.shape[1] != dims:
                continue
            y = (x.astype(float) - mean) @ directions.T
            flat = pa.array(y.ravel(), pa.float64(), mask=~np.tile(known, len(y)))
            lists = pa.ListArray.from_arrays(np.arange(0, y.size + 1, y.shape[1], dtype=np.int32), flat)
            own = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*own.columns, lists], [*own.schema.names, name])

    return vectors.mapInArrow(project, schema)


def identity_error(whitened: DataFrame, fitted: Whitening | None, column: str = "whitened") -> float | None:
    """The largest entry, by size, of the covariance of whitened vectors less the identity,
    over the components with variance; None if there are none.

    First the means, then the centred products are added up in tasks; numbers come to the
    driver, one per pair of components.
    """
    known = [] if fitted is None else np.flatnonzero(fitted.has_variance).tolist()
    if not known:
        return None
    means = whitened.agg(*[F.avg(F.get(column, F.lit(i))).alias(f"m{i}") for i in known]).first()
    centred = {i: F.get(column, F.lit(i)) - F.lit(means[f"m{i}"]) for i in known}
    pairs = [(i, j) for i in known for j in known if i <= j]
    products = whitened.agg(*[F.avg(centred[i] * centred[j]).alias(f"p{i}_{j}") for i, j in pairs]).first()
    return max(abs(p - (i == j)) for (i, j), p in zip(pairs, products, strict=True))
