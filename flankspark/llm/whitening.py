"""Whitening embeddings, with eigenvectors refined in mixed precision.

1. Entries become whole numbers (floor(SCALE * c) + SHIFT), so sums and cross products are exact whatever the order of tasks.
2. Two passes over the vectors give sums and, centred at the nearest whole number to the mean, cross products: each task adds to one
   matrix and sends its d * d entries once. The rest of the mean is taken off exactly, in whole numbers, so the covariance of all vectors
   is right to its last digit and doesn't depend on partitions or lost executors.
3. The driver holds d * d numbers. Eigenvectors in float32 are corrected by Ogita and Aishima's iteration, which is matrix products in
   extended precision and converges quadratically where eigenvalues are apart. Eigenvalues that are too close for that form clusters; each
   is solved in its own subspace, shifted by its mean so that the small differences are large against the sub-matrix, and refined again.
4. A third pass measures the covariance of the whitened vectors, and a fourth returns them.

Edge cases: vectors that are null, or hold null or non-finite entries, or entries beyond 2**LARGEST (which have no exact square here) are
dropped; so are vectors whose length isn't that of most (of equally frequent lengths the longest counts), and empty ones. Directions
without variance can't be whitened and are left out. Repeated rows count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flankspark.llm.common import cut

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Entries are below two to this power, after scaling.
LARGEST = 40
#: Rows of a product of small entries: 2**20 squared, times this, is exact in doubles.
_ROWS = 4096
_ROUNDS = 30
WIDE = np.longdouble


@dataclass
class Basis:
    """n vectors with sums of their entries; unit eigenvectors in columns, eigenvalues falling; each one's part of the variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray


# ---------------------------------------------------------------- eigenvectors


def _wide(x: int) -> np.longdouble:
    """x in extended precision, also where it has more digits than a double."""
    high = float(x)
    return WIDE(high) + WIDE(float(x - int(high)))


def _refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One correction of eigenvectors x of a: (x, eigenvalues, distance under which two eigenvalues can't be told apart)."""
    r = np.eye(x.shape[1], dtype=WIDE) - x.T @ x
    s = x.T @ (a @ x)
    # Rounding that isn't symmetric would be divided by gaps, and turn up as vectors that aren't orthogonal.
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    near = 2 * float(np.sqrt((off**2).sum()) + np.sqrt((a**2).sum()) * np.sqrt((r**2).sum()))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ step, values, near


def _settle(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Corrections until they don't grow smaller."""
    last, tiny = np.inf, float(np.finfo(WIDE).eps) * len(a)
    for _ in range(_ROUNDS):
        new, values, near = _refine(a, x)
        moved = float(np.abs(new - x).max())
        x = new
        if moved <= tiny or moved >= last / 2 and moved < 1e-7:
            break
        last = moved
    return x, values, near


def _clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Runs of two or more eigenvalues, each nearer to the next than near."""
    order = np.argsort(-values)
    breaks = np.flatnonzero(-np.diff(values[order]) > near) + 1
    return [c for c in np.split(order, breaks) if len(c) > 1]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors (columns) of a symmetric matrix in extended precision and its eigenvalues, falling."""
    scale = np.abs(a).max() if a.size else 0
    if not scale:
        return np.eye(len(a), dtype=WIDE), np.zeros(len(a), WIDE)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    x, values, near = _settle(a, x)
    # What float32 couldn't separate is separated inside of its subspace. Some eps of a are noise, and nothing below that is separated.
    floor = float(np.finfo(WIDE).eps) * len(a) * 8
    for _ in range(3):
        found = _clusters(values, max(near, 1e-6))
        if not found:
            break
        for c in found:
            q = x[:, c]
            middle = values[c].mean()
            sub = q.T @ (a @ q) - middle * (q.T @ q)
            sub = (sub + sub.T) / 2
            size = float(np.abs(sub).max())
            if size > floor:
                x[:, c] = q @ np.linalg.eigh((sub / size).astype(np.float64))[1].astype(WIDE)
        x, values, near = _settle(a, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    return x / np.sqrt((x**2).sum(axis=0)), values[order] * scale


# ---------------------------------------------------------------- passes over the vectors


def _rows(batch: pa.RecordBatch, size: int | None = None) -> tuple[np.ndarray, list[np.ndarray] | np.ndarray]:
    """Places of usable rows of a batch, and their whole numbers: a matrix if size is given, else a list of vectors."""
    column = batch.column(1)
    flat, offsets = column.values, column.offsets.to_numpy()
    entries = np.floor(flat.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    with np.errstate(invalid="ignore"):
        wrong = np.concatenate([[0], np.cumsum(~(np.abs(entries) < 2.0**LARGEST))])
    good = (wrong[offsets[1:]] == wrong[offsets[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    good &= sizes > 0 if size is None else sizes == size
    at = np.flatnonzero(good)
    whole = np.where(np.isfinite(entries) & (np.abs(entries) < 2.0**LARGEST), entries, 0).astype(np.int64) + SHIFT
    if size is None:
        return at, [whole[offsets[i] : offsets[i + 1]] for i in at]
    return at, whole[offsets[at][:, None] + np.arange(size)]


def _square(y: np.ndarray) -> np.ndarray:
    """y' y of whole numbers, exactly: as doubles where they are small, else as Python's numbers."""
    d = y.shape[1]
    if not len(y):
        return np.zeros((d, d), object)
    if np.abs(y).max() < 1 << 20:
        f = y.astype(np.float64)
        return sum(((f[i : i + _ROWS].T @ f[i : i + _ROWS]).astype(np.int64).astype(object) for i in range(0, len(f), _ROWS)), np.zeros((d, d), object))
    big = y.astype(object)
    return big.T @ big


def _sums(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """(length of most vectors, their number, sums of their entries); lengths 0 where there are none."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for x in _rows(batch)[1]:
                n, s = held.get(len(x), (0, 0))
                held[len(x)] = n + 1, s + x.astype(object) if np.abs(x).max() > 1 << 20 else s + x
        rows = [(d, i, n, Decimal(int(v))) for d, (n, s) in held.items() for i, v in enumerate(s)]
        columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.decimal128(38, 0))], names=["d", "i", "n", "s"])

    added = cut(vectors.mapInArrow(add, "d int, i int, n long, s decimal(38,0)").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")))
    most = added.where("i = 0").orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not most:
        return 0, 0, []
    d, n = most[0]["d"], most[0]["n"]
    return d, n, [int(r["s"]) for r in sorted(added.where(F.col("d") == d).collect(), key=lambda r: r["i"])]


def _products(vectors: DataFrame, d: int, centre: np.ndarray) -> list[list[int]]:
    """Exact sums of products of entries less centre."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((d, d), object)
        for batch in batches:
            held = held + _square(_rows(batch, d)[1] - centre)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array([Decimal(int(v)) for v in held[i, j]], pa.decimal128(38, 0))], names=["i", "j", "s"])

    out = [[0] * d for _ in range(d)]
    for i, j, s in vectors.mapInArrow(add, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s")).collect():
        out[i][j] = out[j][i] = int(s)
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Basis | None:
    """The basis of vectors (id, array of doubles), or None where there are none."""
    d, n, sums = _sums(vectors)
    if not n:
        return None
    centre = [(2 * s + n) // (2 * n) for s in sums]
    products = _products(vectors, d, np.array(centre, np.int64))
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    v = np.array([[_wide(n * products[i][j] - rest[i] * rest[j]) / (WIDE(n) * WIDE(n)) for j in range(d)] for i in range(d)], WIDE)
    x, values = eigen(v)
    trace = np.trace(v)
    # Below this a direction has no variance but rounding.
    kept = [k for k in range(min(components, d)) if values[k] > float(np.finfo(np.float64).eps) * d * max(float(values[0]), 0)]
    return Basis(n, sums, x[:, kept].astype(np.float64), values[kept].astype(np.float64), (values[kept] / trace if trace else values[kept]).astype(np.float64))


def _project(x: np.ndarray, basis: Basis) -> np.ndarray:
    """Whitened values of rows of whole numbers: what is left after the whole part of the mean is exact."""
    centre = [s // basis.n for s in basis.sums]
    part = np.array([(s - c * basis.n) / basis.n for s, c in zip(basis.sums, centre, strict=True)])
    return ((x - np.array(centre, np.int64)) - part) @ basis.vectors / np.sqrt(basis.values)


def identity_error(vectors: DataFrame, basis: Basis) -> float:
    """The largest entry of the covariance of all whitened vectors less the identity."""
    d, k = basis.vectors.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((k + 1, k))
        for batch in batches:
            w = _project(_rows(batch, d)[1], basis)
            held[:k] += w.T @ w
            held[k] += w.sum(axis=0)
        i, j = np.indices(held.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(held.ravel())], names=["i", "j", "s"])

    out = np.zeros((k + 1, k))
    for i, j, s in vectors.mapInArrow(add, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s")).collect():
        out[i, j] = s
    # The vectors are centred before; the mean that rounding leaves is taken off.
    mean = out[k] / basis.n
    return float(np.abs(out[:k] / basis.n - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """id, component, n, deviation (decimal), whitened, explained and identity_error: a row for each usable vector and component."""
    kind = embeddings.schema[id_col].dataType
    vectors = embeddings.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    basis = fit(vectors, components)
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)), *[T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]])
    if basis is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    error, (d, k) = identity_error(vectors, basis), basis.vectors.shape
    names = schema.names

    def deviations(x: np.ndarray) -> pa.Array:
        """sum((n x - S)^2) of each row, exactly."""
        sums = basis.sums
        least = max(abs(basis.n * int(x.max(initial=0)) - min(sums)), abs(basis.n * int(x.min(initial=0)) - max(sums)), *map(abs, sums))
        if least * least * d < 1 << 63:
            y = basis.n * x - np.array(sums, np.int64)
            return pa.array((y * y).sum(axis=1)).cast(pa.decimal128(38, 0))
        y = basis.n * x.astype(object) - np.array(sums, object)
        return pa.array([Decimal(int(v)) for v in (y * y).sum(axis=1)], pa.decimal128(38, 0))

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _rows(batch, d)
            rows = pa.array(np.repeat(np.arange(len(at)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(len(at) * k, basis.n, np.int64)), deviations(x).take(rows),
                    pa.array(_project(x, basis).ravel()), pa.array(np.tile(basis.explained, len(at))), pa.array(np.full(len(at) * k, error)),
                ],
                names=names,
            )

    return vectors.mapInArrow(give, schema)
