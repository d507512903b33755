"""Embeddings whitened: centred, projected on the eigenvectors of their covariance, scaled.

Entries are taken on a grid, as whole numbers, so sums and products over all vectors are
exact and do not depend on the order in which tasks add them. The covariance is a matrix of
the dimension, however many vectors there are; its eigenvectors are found on the driver, in
mixed precision: a solution in 32 bits is corrected by iterations that only multiply
matrices, in extended precision, each of which doubles the number of right digits (Ogita and
Aishima). Eigenvalues closer than the remaining error cannot be told apart by such a step:
they form a cluster, whose vectors are first separated by solving the small problem that the
cluster spans, shifted by its eigenvalue so that the differences within it count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

COMPONENTS = 32
# An entry c becomes floor(GRID * c) + OFFSET.
GRID, OFFSET = 64, 1_000_000
# Entries of vectors that are worked on at a time.
PART_ENTRIES = 2_000_000
# A variance of a smaller part of the largest one is none.
NO_VARIANCE = 1e-14
# The iterations double the right digits; a few steps reach the last one.
MOST_STEPS = 40
# Eigenvalues closer than so many times the error are a cluster.
CLUSTER = 16


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` found: n vectors, ``sums`` by dimension, unit eigenvectors as columns."""

    n: int
    sums: tuple[int, ...]
    variances: np.ndarray
    vectors: np.ndarray
    total_variance: float

    @property
    def base(self) -> np.ndarray:
        """The mean of each dimension, rounded down."""
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the sums hold beyond n times ``base``."""
        return np.array([s % self.n for s in self.sums], dtype=np.int64)

    @property
    def scales(self) -> np.ndarray:
        """Standard deviations by component; NaN where there is no variance."""
        some = self.variances > NO_VARIANCE * self.variances.max(initial=0)
        return np.sqrt(np.where(some, self.variances, np.nan))

    @property
    def explained(self) -> np.ndarray:
        if not self.total_variance:
            return np.full(len(self.variances), np.nan)
        return self.variances / self.total_variance


def usable(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector is not null, not empty, and holds finite entries only.

    Vectors must agree in length: of several lengths the most frequent one stays, of equally
    frequent ones the shortest.
    """
    finite = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    # a null vector or entry makes the condition null or false
    found = rows.filter(F.col(column).isNotNull() & (F.size(column) > 0)).filter(finite)
    sizes = found.groupBy(F.size(column).alias("size")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), "size").first()
    return found.filter(F.size(column) == (first["size"] if first else 0))


def _matrices(lists: pa.Array) -> Iterator[np.ndarray]:
    """The vectors of an Arrow column on the grid, a bounded number of rows at a time."""
    if not len(lists):
        return
    flat = np.asarray(lists.flatten().cast(pa.float64()))
    grid = np.clip(np.floor(GRID * flat), -(2.0**62), 2.0**62).astype(np.int64) + OFFSET
    grid = grid.reshape(len(lists), -1)
    step = max(1, PART_ENTRIES // grid.shape[1])
    for start in range(0, len(grid), step):
        yield grid[start : start + step]


def _products(values: np.ndarray) -> np.ndarray:
    """Sums of products of all pairs of columns, exact, as Python integers.

    A floating matrix product is exact while all its sums stay below 2^53.
    """
    top = int(np.abs(values).max(initial=0))
    step = 2**53 // max(1, top * top)
    if not step:
        values = values.astype(object)
        return values.T @ values
    total = np.zeros((values.shape[1],) * 2, dtype=object)
    for start in range(0, len(values), step):
        part = values[start : start + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _sums(rows: DataFrame, column: str) -> tuple[int, tuple[int, ...]]:
    """How many vectors there are, and the sum of each dimension."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            for values in _matrices(batch.column(0)):
                n += len(values)
                part = values.sum(axis=0).astype(object)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(total)), pa.int32()),
                    pa.array([n] * len(total), pa.int64()),
                    pa.array([Decimal(int(s)) for s in total], pa.decimal128(28, 0)),
                ],
                ["dimension", "n", "s"],
            )

    parts = rows.select(column).mapInArrow(added, "dimension int, n long, s decimal(28,0)")
    found = parts.groupBy("dimension").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    by_dimension = {r["dimension"]: (r["n"], int(r["s"])) for r in found.collect()}
    n = by_dimension[0][0] if by_dimension else 0
    return n, tuple(by_dimension[i][1] for i in range(len(by_dimension)))


def _covariance(rows: DataFrame, column: str, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """The covariance in extended precision, from exact sums of products.

    Every task sends one number for each pair of dimensions. Entries are centred at the
    whole part of the mean first; what that leaves is taken off exactly.
    """
    base = np.array([s // n for s in sums], dtype=np.int64)
    size = len(sums)
    upper = np.triu_indices(size)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for values in _matrices(batch.column(0)):
                part = _products(values - base)[upper]
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(total)), pa.int32()),
                    pa.array([Decimal(int(s)) for s in total], pa.decimal128(38, 0)),
                ],
                ["pair", "s"],
            )

    parts = rows.select(column).mapInArrow(multiplied, "pair int, s decimal(38,0)")
    found = {r["pair"]: int(r["s"]) for r in parts.groupBy("pair").agg(F.sum("s").alias("s")).collect()}
    rest = [s % n for s in sums]
    out = np.zeros((size, size), dtype=np.longdouble)
    for pair, (i, j) in enumerate(zip(*map(np.ndarray.tolist, upper))):
        whole, part = divmod(n * found[pair] - rest[i] * rest[j], n * n)
        out[i, j] = out[j, i] = np.longdouble(whole) + np.longdouble(part) / np.longdouble(n * n)
    return out


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of a symmetric matrix.

    Both are in extended precision. Vectors of equal eigenvalues are some orthonormal basis;
    the largest entry of each vector is positive.
    """
    matrix = matrix.astype(np.longdouble)
    size = len(matrix)
    scale = np.abs(matrix).max(initial=0)
    if not scale:
        return np.zeros(size, dtype=np.longdouble), np.eye(size, dtype=np.longdouble)
    scaled = matrix / scale
    vectors = np.linalg.eigh(scaled.astype(np.float32))[1].astype(np.longdouble)
    norm = np.linalg.norm(scaled.astype(np.float64))
    least, before = size * norm * np.finfo(np.longdouble).eps, np.inf
    for _ in range(MOST_STEPS):
        vectors, values, error = _corrected(scaled, vectors, norm)
        if error <= least or (error < 1e-12 * norm and error > before / 2):
            break
        before = error
        vectors = _separated(scaled, vectors, values, error)
    for _ in range(2):  # the last steps may have bent vectors of a cluster by very little
        vectors = vectors + vectors @ (np.eye(size, dtype=np.longdouble) - vectors.T @ vectors) / 2
    values = np.einsum("ij,ij->j", vectors, scaled @ vectors) / np.einsum("ij,ij->j", vectors, vectors)
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    vectors *= np.where(vectors[np.argmax(np.abs(vectors), axis=0), range(size)] < 0, -1, 1)
    return values[order] * scale, vectors


def _corrected(matrix: np.ndarray, vectors: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One step: better vectors, the eigenvalues before it, and the error they had at most."""
    bent = np.eye(len(matrix), dtype=np.longdouble) - vectors.T @ vectors
    turned = vectors.T @ matrix @ vectors
    values = np.diag(turned) / (1 - np.diag(bent))
    off = turned - np.diag(values)
    error = 2 * float(np.sqrt((off * off).sum()) + norm * np.sqrt((bent * bent).sum()))
    gaps = values[None, :] - values[:, None]
    far = np.abs(gaps) > CLUSTER * error
    with np.errstate(divide="ignore", invalid="ignore"):
        change = np.where(far, (turned + values[None, :] * bent) / gaps, bent / 2)
    return vectors + vectors @ change, values, error


def _separated(matrix: np.ndarray, vectors: np.ndarray, values: np.ndarray, error: float) -> np.ndarray:
    """The vectors of each cluster turned to those of the problem that the cluster spans."""
    order = np.argsort(values, kind="stable")
    breaks = np.flatnonzero(np.diff(values[order]) > CLUSTER * error) + 1
    for cluster in np.split(order, breaks):
        if len(cluster) == 1:
            continue
        spanned = vectors[:, cluster]
        middle = values[cluster].mean()
        small = spanned.T @ (matrix @ spanned - middle * spanned)
        size = np.abs(small).max()
        if size:
            turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))[1]
            vectors = vectors.copy()
            vectors[:, cluster] = spanned @ turn.astype(np.longdouble)
    return vectors


def fit(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``usable`` rows; None without rows."""
    n, sums = _sums(rows, column)
    if not n:
        return None
    values, vectors = eigenvectors(_covariance(rows, column, n, sums))
    values = np.maximum(values, 0)
    return Whitening(
        n, sums, values[:components].astype(float), vectors[:, :components].astype(float), float(values.sum())
    )


def _whitened(values: np.ndarray, fitted: Whitening) -> np.ndarray:
    centred = (values - fitted.base).astype(np.float64) - fitted.rest / fitted.n
    return centred @ fitted.vectors / fitted.scales


def _deviations(values: np.ndarray, fitted: Whitening) -> list[int | None]:
    """The sum of (n * x - S)^2 of each vector; None where it is beyond a long."""
    apart = values - fitted.base
    top = int(np.abs(apart).max(initial=0)) + 1
    if values.shape[1] * (fitted.n * top) ** 2 < 2**63:
        apart = fitted.n * apart - fitted.rest
        return (apart * apart).sum(axis=1).tolist()
    apart = fitted.n * apart.astype(object) - fitted.rest.astype(object)
    return [d if d < 2**63 else None for d in (apart * apart).sum(axis=1)]


def transform(rows: DataFrame, fitted: Whitening, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per vector: the key, deviation long, whitened array<double>.

    Components without variance are NaN. Repeated rows are transformed each.
    """

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for values in _matrices(batch.column(1)):
                flat = pa.array(_whitened(values, fitted).ravel())
                offsets = np.arange(0, len(flat) + 1, len(fitted.variances), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(values)),
                        pa.array(_deviations(values, fitted), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), flat),
                    ],
                    [key, "deviation", "whitened"],
                )
                at += len(values)

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, column).mapInArrow(applied, f"{key} {kind}, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, fitted: Whitening, column: str = "embedding") -> float:
    """The largest entry of the whitened vectors' covariance minus the identity.

    Only components with variance count; without any it is 0.
    """
    some = np.flatnonzero(~np.isnan(fitted.scales))
    if not len(some):
        return 0.0

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(some), len(some) + 1))
        for batch in batches:
            for values in _matrices(batch.column(0)):
                white = _whitened(values, fitted)[:, some]
                total += white.T @ np.column_stack([white, np.ones(len(white))])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["pair", "s"]
        )

    parts = rows.select(column).mapInArrow(multiplied, "pair int, s double").groupBy("pair").agg(F.sum("s").alias("s"))
    found = np.zeros(len(some) * (len(some) + 1))
    for r in parts.collect():
        found[r["pair"]] = r["s"]
    found = found.reshape(len(some), -1) / fitted.n
    means = found[:, -1]
    return float(np.abs(found[:, :-1] - np.outer(means, means) - np.eye(len(some))).max())


def whitened_components(
    rows: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per usable vector and component: the key, component, n, deviation, whitened,
    explained, identity_error.

    Rows whose vector is null, empty, of another length than most or not finite are left out.
    A component without variance has a null ``whitened``; ``explained`` is null where no
    component has any. ``deviation`` is null where it is beyond a long. Repeated rows count
    each, in the fit as well; an empty table gives an empty result. Null keys are kept.
    """
    found = usable(rows.select(key, column), column)
    fitted = fit(found, column, components)
    kind = rows.schema[key].dataType
    if fitted is None:
        return found.select(
            key, *[F.lit(0).cast(t).alias(c) for c, t in zip(_COLUMNS, ("int", "long", "long", *["double"] * 3))]
        ).limit(0)
    error = identity_error(found, fitted, column)
    shares = F.array(*[F.lit(float(x)) for x in fitted.explained])
    each = transform(found, fitted, key, column).select(
        F.col(key).cast(kind), "deviation", F.posexplode("whitened").alias("_at", "_value")
    )
    number = lambda c: F.when(~F.isnan(c), c)
    return each.select(
        key,
        (F.col("_at") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        number(F.col("_value")).alias("whitened"),
        number(F.get(shares, F.col("_at"))).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


_COLUMNS = ("component", "n", "deviation", "whitened", "explained", "identity_error")
