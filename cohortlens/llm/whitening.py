"""Whitening of embeddings by an incremental eigendecomposition.

The fit list is every distinct vector once. Each partition keeps the eigenvalues and vectors
of its own scatter and updates them by one centred row at a time: a rank-one update moves the
eigenvalues to the roots of a secular equation, after directions that cannot move have been
deflated. The partitions' spectra are combined by rank-one updates, too, level by level. The
result is the basis of one Rayleigh-Ritz step: the scatter in that basis is summed over all
partitions and diagonalised, which takes away what rounding the updates have gathered.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.sources.scratch import written

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Entries this large or larger count as not finite: their multiples would not fit a long.
LARGEST = 2.0**40
#: Centred rows that are rotated onto as many rows as they have entries before the updates.
BLOCK = 1024
#: Spectra combined in one task of a level.
FAN_IN = 8
#: Eigenvalues below this share of the largest are none: the vectors do not vary there.
FLAT = 1e-12

_EPS = np.finfo(float).eps
_X = np.dtype("<i8")


# ---------------------------------------------------------------- rank-one updates
def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(weights / (poles - x))``, poles ascending and weights positive.

    Root i lies between pole i and the next; the last one at most ``sum(weights)`` above the
    last pole. Each is given as its distance from the nearer pole, so that differences to the
    poles keep their digits: returned are the number of that pole and the distance.
    """
    m = len(poles)
    own = np.arange(m)
    gap = np.append(np.diff(poles), weights.sum())
    inner = own < m - 1
    # The sign in the middle tells which half the root is in.
    middle = (poles[None, :] - poles[:, None]) - (gap / 2)[:, None]
    right = inner & (1 + (weights / middle).sum(axis=1) < 0)
    origin = own + right
    delta = poles[None, :] - poles[origin][:, None]
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.where(inner, gap / 2, gap))
    p1 = delta[own, own]
    p2 = np.where(inner, delta[own, np.minimum(own + 1, m - 1)], 0.0)
    upto = own[None, :] <= own[:, None]
    x = (low + high) / 2
    for _ in range(100):
        apart = delta - x[:, None]
        terms = weights / apart
        slopes = terms / apart
        f = 1 + terms.sum(axis=1)
        # At its root, f is known no better than rounding of its terms allows.
        settled = np.abs(f) <= 4 * _EPS * (1 + np.abs(terms).sum(axis=1))
        low = np.where(f < 0, x, low)
        high = np.where(f > 0, x, high)
        # Both sides are replaced by one pole each with the same value and slope.
        d1, d2 = p1 - x, p2 - x
        s = np.where(upto, slopes, 0.0).sum(axis=1)
        t = np.where(upto, 0.0, slopes).sum(axis=1)
        s1, s2 = s * d1 * d1, t * d2 * d2
        c = f - s * d1 - t * d2
        a = c * (p1 + p2) + s1 + s2
        b = c * p1 * p2 + s1 * p2 + s2 * p1
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            two = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
            following = np.where(inner, two, p1 + s1 / c)
        outside = ~((following > low) & (following < high))
        following = np.where(outside, (low + high) / 2, following)
        settled |= np.abs(following - x) <= 2 * _EPS * np.abs(x)
        if settled.all():
            break
        x = np.where(settled, x, following)
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors (columns) of ``V diag(values) V' + row row'``."""
    z = vectors.T @ row
    size = float(z @ z)
    if not size > 0:
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    small = 8 * _EPS * max(float(np.abs(values).max()), size)
    moving: list[int] = []
    for j in np.flatnonzero(np.sqrt(size) * np.abs(z) > small).tolist():
        if moving:
            # Two directions of nearly one eigenvalue are turned until only one of them moves.
            i = moving[-1]
            length = np.hypot(z[i], z[j])
            cos, sin = z[j] / length, z[i] / length
            if (values[j] - values[i]) * abs(cos * sin) <= small:
                z[i], z[j] = 0.0, length
                vectors[:, [i, j]] = vectors[:, [i, j]] @ np.array([[cos, sin], [-sin, cos]])
                both = values[i], values[j]
                values[i] = both[0] * cos * cos + both[1] * sin * sin
                values[j] = both[0] * sin * sin + both[1] * cos * cos
                moving.pop()
        moving.append(j)
    if not moving:
        return values, vectors
    poles, part = values[moving], z[moving]
    # Turning may leave neighbours out of order by as much as rounding.
    order = np.argsort(poles, kind="stable")
    moving, poles, part = np.array(moving)[order], poles[order], part[order]
    origin, shift = secular_roots(poles, part * part)
    to_pole = (poles[origin][:, None] - poles[None, :]) + shift[:, None]
    # The row for which the roots found are exact; with it the vectors stay orthogonal.
    apart = poles[None, :] - poles[:, None]
    np.fill_diagonal(apart, 1.0)
    ratio = to_pole / np.where(np.eye(len(poles), dtype=bool), 1.0, apart.T)
    exact = np.sqrt(np.abs(np.prod(ratio, axis=0))) * np.where(part < 0, -1.0, 1.0)
    turn = exact[None, :] / to_pole
    turn /= np.linalg.norm(turn, axis=1)[:, None]
    vectors[:, moving] = vectors[:, moving] @ turn.T
    values[moving] = poles[origin] + shift
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def updated(values: np.ndarray, vectors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spectrum after all ``rows``. Many rows are rotated onto a triangle of the same scatter
    first, so that a block costs one update per dimension."""
    if len(rows) > rows.shape[1]:
        rows = np.linalg.qr(rows, mode="r")
    for row in rows:
        values, vectors = rank_one(values, vectors, row)
    return values, vectors


# ---------------------------------------------------------------- on the cluster
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("x", T.BinaryType())])
SPECTRUM = "part long, dims binary, axes binary"


def scaled_vectors(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, x)`` of the usable rows; ``x`` holds little-endian 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                ids, lists = batch.slice(start, 2048).columns
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.values.slice(lists.offsets[0].as_py(), int(sizes.sum()))
                entries = SCALE * flat.to_numpy(zero_copy_only=False).astype(float)
                fits = np.isfinite(entries) & (np.abs(entries) < LARGEST)
                row = np.repeat(np.arange(len(sizes)), sizes)
                usable = np.bincount(row[~fits], minlength=len(sizes)) == 0
                usable &= lists.is_valid().to_numpy(zero_copy_only=False)
                data = (np.floor(np.where(fits, entries, 0)).astype(_X) + OFFSET).tobytes()
                ends = 8 * np.cumsum(sizes)
                found = [data[e - 8 * n : e] for e, n in zip(ends[usable], sizes[usable], strict=True)]
                kept = ids.filter(pa.array(usable))
                yield pa.RecordBatch.from_arrays([kept, pa.array(found, pa.binary())], names=["vec_id", "x"])

    columns = embeddings.select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>"))
    return columns.mapInArrow(run, VECTORS)


def _blocks(batches: Iterable[pa.RecordBatch], width: int, column: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            yield part, np.frombuffer(b"".join(part.column(column).to_pylist()), _X).reshape(-1, width)


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Rows and per-dimension sums of the fit list, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(width, _X)
        for _, x in _blocks(batches, width):
            count += len(x)
            total += x.sum(axis=0)
        if count:
            arrays = [pa.array(range(-1, width), pa.int64()), pa.array([count, *total.tolist()], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["dim", "total"])

    rows = fit.mapInArrow(run, "dim long, total long").groupBy("dim").agg(F.sum("total").alias("total")).collect()
    found = {r["dim"]: r["total"] for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(width)]


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S/n``, from the exact difference of integers where it fits."""
    if float(np.abs(x).max(initial=0)) * n < 2.0**62:
        return (n * x - sums) / n
    return np.array((n * x.astype(object) - sums.astype(object)) / n, float)


def _spectrum(fit: DataFrame, width: int, n: int, sums: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors (columns) of the fit list's scatter, from rank-one updates."""

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, vectors, seen = np.zeros(width), np.eye(width), False
        for _, x in _blocks(batches, width):
            values, vectors = updated(values, vectors, _centred(x, n, sums))
            seen = True
        if seen:
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            arrays = [pa.array([part], pa.int64()), *(pa.array([a.tobytes()], pa.binary()) for a in (values, vectors))]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "dims", "axes"])

    def combine(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        values, vectors = np.zeros(width), np.eye(width)
        for dims, axes in parts.sort_values("part")[["dims", "axes"]].itertuples(index=False):
            lengths = np.sqrt(np.maximum(np.frombuffer(dims), 0))
            for row in (np.frombuffer(axes).reshape(width, width) * lengths).T:
                values, vectors = rank_one(values, vectors, row)
        return pd.DataFrame({"part": [key[0]], "dims": [values.tobytes()], "axes": [vectors.tobytes()]})

    spectra = written(fit.mapInArrow(partition, SPECTRUM), "spectra")
    left = spectra.agg(F.max("part")).first()[0] + 1
    while left > 1:
        spectra = spectra.groupBy((F.col("part") / FAN_IN).cast("long").alias("part")).applyInPandas(combine, SPECTRUM)
        left = -(-left // FAN_IN)
    return np.frombuffer(spectra.first()["axes"]).reshape(width, width)


def _scatter(fit: DataFrame, width: int, n: int, sums: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Covariance of the fit list in ``basis`` (divisor n) and the mean there."""
    k = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean, seen = np.zeros((k, k)), np.zeros(k), False
        for _, x in _blocks(batches, width):
            y = _centred(x, n, sums) @ basis
            total += y.T @ y
            mean += y.sum(axis=0)
            seen = True
        if seen:
            cells = np.concatenate([total.ravel(), mean])
            arrays = [pa.array(np.arange(len(cells))), pa.array(cells)]
            yield pa.RecordBatch.from_arrays(arrays, names=["cell", "value"])

    rows = fit.mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    cells = np.zeros(k * k + k)
    for r in rows:
        cells[r["cell"]] = r["value"]
    mean = cells[k * k :] / n
    return cells[: k * k].reshape(k, k) / n - np.outer(mean, mean), mean


OUT = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ]
)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of ``(n * x - S)**2`` per row, exact; None beyond a long."""
    rough = np.square(n * x.astype(float) - sums.astype(float)).sum(axis=1)
    if rough.max(initial=0) < 2.0**62:
        apart = n * x - sums
        return np.einsum("ij,ij->i", apart, apart).tolist()
    apart = n * x.astype(object) - sums.astype(object)
    return [v if v < 1 << 63 else None for v in (apart * apart).sum(axis=1).tolist()]


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per usable vector and leading component, see ``OUT`` for the columns.

    Rows whose vector is null or holds null, NaN or infinite entries, or entries of 2**34 and
    more, are dropped; so are vectors shorter than the longest, which lack entries. Repeated
    rows and equal vectors all get their rows, and count once in the fit. Components in which
    the fit list does not vary are not returned, so a table of one vector gives no rows, like
    an empty one; there are at most as many as dimensions. Of equal eigenvalues any basis is
    one; each component's largest entry is positive. ``deviation`` is null where it does not fit
    a long. Null ids stay null; other columns are not read. The driver gets sums per dimension
    and per pair of dimensions, and one spectrum.
    """
    spark = embeddings.sparkSession
    rows = written(scaled_vectors(embeddings, id_col, vector_col), "vectors")
    longest = rows.agg(F.max(F.octet_length("x"))).first()[0]
    if not longest:
        return spark.createDataFrame([], OUT)
    width = longest // 8
    rows = rows.filter(F.octet_length("x") == longest)
    fit = written(rows.select("x").distinct(), "fit-list")
    n, totals = _sums(fit, width)
    sums = np.array(totals, _X)
    basis = _spectrum(fit, width, n, sums)
    # The updates' basis is orthonormal but for rounding, which one factorisation removes.
    basis, _ = np.linalg.qr(basis)
    within, _ = _scatter(fit, width, n, sums, basis)
    values, turn = np.linalg.eigh((within + within.T) / 2)
    order = np.argsort(-values, kind="stable")
    values, axes = values[order], (basis @ turn)[:, order]
    k = int((values[:components] > max(FLAT * values[0], 0.0)).sum())
    if not k:
        return spark.createDataFrame([], OUT)
    explained = (values[:k] / values.sum()).tolist()
    axes = axes[:, :k]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(k)])
    filters = axes / np.sqrt(values[:k])
    covariance, _ = _scatter(fit, width, n, sums, filters)
    error = float(np.abs(covariance - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, width, 1):
            m = len(x)
            each = np.repeat(np.arange(m), k)
            columns = [
                part.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)),
                pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(each)),
                pa.array((_centred(x, n, sums) @ filters).ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=OUT.names)

    return rows.mapInArrow(run, OUT)
