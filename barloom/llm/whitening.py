"""Embedding whitening by polarisation covariance.

1. Each finite vector becomes whole numbers x; their sums per dimension are exact.
2. Values are centred at the whole part of the mean, which keeps them small, and for every
   dimension and every sum of two dimensions the squares are added up, exact. What the mean
   has beside its whole part is taken off these sums afterwards, in unbounded integers, so they
   are the sums of squares of ``n * x - S``.
3. The variance of a sum of two dimensions less both variances is twice their covariance.
   The covariances are assembled on the driver (dimensions squared, whatever the rows) for ``eigh``.
4. Rows are projected in tasks, without a shuffle; the covariance of what comes out is measured
   in one more pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
ROWS = 2048  # vectors that a task works on at once
LIMIT = 1 << 62  # whole numbers beyond count as this
_WIDE = pa.decimal128(38, 0)


def _usable(vector) -> F.Column:
    def finite(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    return vector.isNotNull() & F.forall(vector, lambda c: F.coalesce(finite(c), F.lit(False)))


def whole_numbers(lists: pa.Array) -> np.ndarray:
    """Rows of x = floor(1024 * c) + 100000, as 64-bit integers."""
    flat = pc.list_flatten(lists).cast(pa.float64()).to_numpy(zero_copy_only=False)
    scaled = np.floor(flat * SCALE)
    inside = np.clip(scaled, -float(1 << 61), float(1 << 61)).astype(np.int64)
    inside[scaled >= LIMIT] = LIMIT
    inside[scaled <= -LIMIT] = -LIMIT
    between = np.flatnonzero((np.abs(scaled) > 1 << 61) & (np.abs(scaled) < LIMIT))
    inside[between] = scaled[between].astype(np.int64)
    return inside.reshape(len(lists), -1) + SHIFT


def _exact(values: np.ndarray, most: int) -> np.ndarray:
    """The integers in 64 bits if what is made of them stays below ``most`` times their size, else unbounded."""
    size = max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))
    return values if size * most < 1 << 62 else values.astype(object)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            rows = batch.slice(at, ROWS)
            yield rows, whole_numbers(rows.column("vector"))


def _wide(values) -> pa.Array:
    """Exact decimals; null for what has more than 38 digits."""
    if isinstance(values, np.ndarray) and values.dtype != object:
        return pa.array(values, pa.int64()).cast(_WIDE)
    return pa.array([Decimal(int(v)) if abs(int(v)) < 10**38 else None for v in values], _WIDE)


def _sums(vectors: DataFrame) -> DataFrame:
    """length, dim, n, total: exact sums per dimension of the vectors of each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
            for length in np.unique(sizes[sizes > 0]):
                same = batch.filter(pa.array(sizes == length))
                total = sum(_exact(x, ROWS).sum(axis=0).astype(object) for _, x in _parts([same]))
                yield pa.RecordBatch.from_pydict({
                    "length": pa.array(np.full(length, length, np.int32)),
                    "dim": pa.array(np.arange(length, dtype=np.int32)),
                    "n": pa.array(np.full(length, same.num_rows)),
                    "total": _wide(total),
                })

    partial = vectors.select("vector").mapInArrow(run, "length int, dim int, n bigint, total decimal(38,0)")
    return partial.groupBy("length", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def _moved(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """x less the centre; unbounded integers where 64 bits might not do."""
    if np.abs(x).max(initial=0) > 1 << 60 or any(abs(c) > 1 << 60 for c in centre):
        return x.astype(object) - centre
    return x - centre.astype(np.int64)


def _squares(vectors: DataFrame, centre: np.ndarray) -> DataFrame:
    """i, j, high, low: sums over all rows of squares of the centred x_i + x_j for i < j, and of x_i where i = j.

    A sum is ``high * 2^64 + low``, so that any 64-bit entries can be squared and added.
    """
    d = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((d, d), object)
        for _, x in _parts(batches):
            u = _moved(x, centre)
            size = int(np.abs(u).max(initial=0))
            u = u.astype(np.int64 if 4 * size * size * ROWS < 1 << 62 else object)
            for i in range(d):
                pair = u[:, i:] + u[:, i : i + 1]
                pair[:, 0] = u[:, i]
                held[i, i:] += (pair * pair).sum(axis=0).astype(object)
        i, j = np.triu_indices(d)
        sums = held[i, j]
        columns = {"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32))}
        yield pa.RecordBatch.from_pydict(columns | {"high": _wide(sums >> 64), "low": _wide(sums & (1 << 64) - 1)})

    partial = vectors.select("vector").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    return partial.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: np.ndarray  # S, Python integers
    centre: np.ndarray  # whole part of S / n
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors in columns
    trace: float

    @property
    def rest(self) -> np.ndarray:
        return self.sums - self.n * self.centre

    def project(self, x: np.ndarray, k: int) -> np.ndarray:
        """Whitened rows; NaN for a component without variance."""
        mean = (self.rest / self.n).astype(np.float64)
        with np.errstate(invalid="ignore"):
            flat = self.vectors[:, :k] / np.sqrt(np.where(self.values[:k] > 0, self.values[:k], np.nan))
        return (_moved(x, self.centre).astype(np.float64) - mean) @ flat

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Exact sums over dimensions of (n * x - S) squared."""
        u, d = _moved(x, self.centre), len(self.sums)
        size = int(np.abs(u).max(initial=0)) + 1
        if (self.n * size) ** 2 * d < 1 << 62:
            y = u * self.n - self.rest.astype(np.int64)
            return (y * y).sum(axis=1)
        if size * max(size, self.n) * d < 1 << 62:
            squares, mixed = (u * u).sum(axis=1).astype(object), (u * self.rest.astype(np.int64)).sum(axis=1).astype(object)
            return self.n * self.n * squares - 2 * self.n * mixed + int((self.rest**2).sum())
        y = u.astype(object) * self.n - self.rest
        return (y * y).sum(axis=1)


def fit(vectors: DataFrame) -> Whitening | None:
    """The whitening of a column ``vector`` of usable vectors; None without a vector that has entries."""
    sums = stored(_sums(vectors))
    # Of several lengths the one with most vectors, and of these the longest.
    best = sums.where("dim = 0").orderBy(F.desc("n"), F.desc("length")).first()
    if best is None:
        return None
    n, d = best.n, best.length
    total = np.empty(d, object)
    for row in sums.where(F.col("length") == d).collect():
        total[row.dim] = int(row.total)
    centre = np.array([s // n for s in total], object)
    rest = total - n * centre
    same = vectors.where(F.size("vector") == d)
    square = np.zeros((d, d), object)
    for row in _squares(same, centre).collect():
        square[row.i, row.j] = square[row.j, row.i] = (int(row.high) << 64) + int(row.low)
    # n * n times the sums of squares around the mean itself.
    own = np.array([n * n * square[i, i] - n * rest[i] ** 2 for i in range(d)], object)
    covariance = np.zeros((d, d))
    for i in range(d):
        covariance[i, i] = own[i] / (n * n * n)
        for j in range(i):
            both = n * n * square[i, j] - n * (rest[i] + rest[j]) ** 2
            covariance[i, j] = covariance[j, i] = (both - own[i] - own[j]) / (2 * n * n * n)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    # Where a component has no variance, only rounding is left.
    values = np.where(values > d * np.finfo(float).eps * values[0], values, 0.0)
    return Whitening(n, total, centre, values, axes, float(np.trace(covariance)))


def _projected(vectors: DataFrame, found: Whitening, k: int, kind: str) -> DataFrame:
    """vec_id, deviation, whitened (array): one row per vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _parts(batches):
            flat = found.project(x, k)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(flat.ravel(), from_pandas=True))
            yield pa.RecordBatch.from_pydict({"vec_id": rows.column("vec_id"), "deviation": _wide(found.deviations(x)), "whitened": lists})

    return vectors.mapInArrow(run, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def _identity_error(rows: DataFrame, k: int, n: int) -> float | None:
    """Largest absolute entry of the covariance of ``whitened`` less the identity, over all rows."""
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            y = pc.list_flatten(batch.column("whitened")).to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)[:, :k]
            first += y.sum(axis=0)
            second += y.T @ y
        yield pa.RecordBatch.from_pydict({"part": pa.array([[*first, *second.ravel()]], pa.list_(pa.float64()))})

    parts = rows.select("whitened").mapInArrow(run, "part array<double>")
    sums = parts.select(F.posexplode("part")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
    flat = np.zeros(k + k * k)
    for row in sums:
        flat[row.pos] = row.s
    mean = flat[:k] / n
    return float(np.abs(flat[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation, whitened, explained, identity_error: one row per usable vector.

    ``whitened`` and ``explained`` have an entry per component, as many as ``components`` or
    dimensions; ``deviation`` is an exact decimal, null beyond 38 digits. Vectors that are null,
    empty or hold null or non-finite entries are left out, and so are those of another length than
    most (of equally many the longest stay). Whole numbers beyond 2^62 count as 2^62. A component
    without variance has null ``whitened`` and plays no part in ``identity_error``; ``explained``
    is null where nothing varies. Repeated rows count and come back each; null ids are ids like any
    other; no vector gives no row. Columns of other names play no part.
    """
    kind = embeddings.schema[vec_id].dataType.simpleString()
    vectors = embeddings.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").alias("vector"))
    vectors = vectors.where(_usable(F.col("vector")))
    found = fit(vectors)
    k = min(components, len(found.values)) if found else 0
    names = ("n", "explained", "identity_error")
    if not found:
        none = [F.lit(None).cast(t).alias(c) for c, t in zip(names, ("bigint", "array<double>", "double"))]
        return vectors.where("false").select(
            "vec_id", none[0], F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"), *none[1:]
        )
    rows = _projected(vectors.where(F.size("vector") == len(found.values)), found, k, kind)
    error = _identity_error(rows, int((found.values[:k] > 0).sum()), found.n)
    shares = [float(v) / found.trace if found.trace > 0 else None for v in found.values[:k]]
    return rows.select(
        "vec_id",
        F.lit(found.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(s).cast("double") for s in shares]).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def by_component(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1; a deviation beyond 64 bits is null."""
    rows = whitened.select("*", F.posexplode("whitened").alias("at", "value"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        F.expr("try_cast(deviation as bigint)").alias("deviation"),
        F.col("value").alias("whitened"),
        F.get("explained", F.col("at")).alias("explained"),
        "identity_error",
    )


def query(spark, sf_dir: str) -> DataFrame:
    return by_component(whiten(read_table(spark, sf_dir, "embeddings")))
