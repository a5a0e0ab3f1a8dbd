"""Whitening of embeddings on the leading components, found by spectral divide and conquer."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.session import stage

SCALE, COMPONENTS = 256, 4
_EPS = np.finfo(float).eps


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps.

    Every step is a QR factorisation of [sqrt(c) X; I], so no inverse of an ill-conditioned
    matrix is formed. The weights follow a lower bound of the least singular value, and six
    or seven steps reach double precision for any condition number.
    """
    size = len(a)
    top = math.sqrt(np.abs(a).sum(axis=0).max() * np.abs(a).sum(axis=1).max())
    x = a / top
    try:
        low = 1 / (np.linalg.norm(np.linalg.inv(x), 1) * math.sqrt(size))
    except np.linalg.LinAlgError:
        low = _EPS
    low = min(max(low, _EPS), 1.0)
    for _ in range(30):
        square = low * low
        d = (4 * max(1 - square, 0.0) / square ** 2) ** (1 / 3)
        wa = math.sqrt(1 + d) + 0.5 * math.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * math.sqrt(1 + d)), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([math.sqrt(wc) * x, np.eye(size)]))
        after = wb / wc * x + (wa - wb / wc) / math.sqrt(wc) * q[:size] @ q[size:].T
        after = (after + after.T) / 2
        change = np.linalg.norm(after - x)
        x, low = after, min(low * (wa + wb * square) / (1 + wc * square), 1.0)
        if change < (5 * _EPS) ** (1 / 3) and abs(1 - low) < 10 * _EPS:
            break
    return x


def _halves(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span the upper invariant subspace, and their number.

    (polar factor of A - shift + I) / 2 projects on the eigenvectors above the shift. A shift on an
    eigenvalue, or one with all eigenvalues on one side, parts nothing; then the next is tried.
    """
    size = len(a)
    norm = np.linalg.norm(a)
    values = np.sort(np.diag(a))
    gaps = np.diff(values)
    wide = int(np.argmax(gaps))
    shifts = [float(np.median(values)), (values[wide] + values[wide + 1]) / 2, float(values.mean())]
    spread = np.abs(a).sum(axis=1) - np.abs(np.diag(a))
    low, high = float((np.diag(a) - spread).min()), float((np.diag(a) + spread).max())
    shifts += [low + (high - low) * k / 32 for k in (16, 8, 24, 4, 12, 20, 28, *range(1, 32, 2))]
    for shift in shifts:
        moved = a - shift * np.eye(size)
        if np.linalg.norm(moved) <= 4 * _EPS * size * norm:
            continue
        projector = (polar_factor(moved) + np.eye(size)) / 2
        trace = np.trace(projector)
        upper = int(round(trace))
        if not 0 < upper < size or abs(trace - upper) > 1e-6:
            continue
        order = np.argsort(-np.diag(projector), kind="stable")
        basis, _ = np.linalg.qr(projector[:, order[:upper]], mode="complete")
        for _ in range(3):  # subspace iteration on the projector settles what the picked columns left out
            basis, _ = np.linalg.qr(np.hstack([projector @ basis[:, :upper], basis[:, upper:] - projector @ basis[:, upper:]]))
            if np.linalg.norm(basis[:, upper:].T @ a @ basis[:, :upper]) <= 20 * _EPS * size * norm:
                return basis, upper
    return None


def leading_components(a: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``number`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    The space is split in two invariant subspaces at a shift by its spectral projector, and the parts
    that hold wanted components are split again until they have one dimension or are a multiple
    of the identity to double precision, where any basis is one of eigenvectors.
    """
    a = (a + a.T) / 2
    whole = np.linalg.norm(a)
    values, vectors = [], []

    def split(part: np.ndarray, basis: np.ndarray, wanted: int) -> None:
        size = len(part)
        off = part - np.diag(np.diag(part))
        halves = None if size == 1 or np.linalg.norm(off) <= 2 * _EPS * whole else _halves(part)
        if halves is None:
            # One dimension, diagonal to precision, or a cluster that no shift parts: Jacobi turns finish it.
            turned, turn = _jacobi(part)
            for k in np.argsort(-turned, kind="stable")[:wanted]:
                values.append(turned[k])
                vectors.append(basis @ turn[:, k])
            return
        turn, upper = halves
        for begin, end in ((0, upper), (upper, size)):
            if begin < wanted:
                own = turn[:, begin:end]
                inner = own.T @ part @ own
                split((inner + inner.T) / 2, basis @ own, min(wanted - begin, end - begin))

    if len(a):
        split(a, np.eye(len(a)), min(number, len(a)))
    found = np.stack(vectors, axis=1) if vectors else np.zeros((len(a), 0))
    # One Rayleigh quotient each from the whole matrix; the order is theirs.
    values = np.einsum("ij,ij->j", found, a @ found) if vectors else np.zeros(0)
    order = np.argsort(-values, kind="stable")
    found = found[:, order]
    return values[order], found / np.linalg.norm(found, axis=0) if vectors else found


def _jacobi(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of a small symmetric block by plane turns."""
    a, turn = a.copy(), np.eye(len(a))
    for _ in range(60):
        off = np.linalg.norm(a - np.diag(np.diag(a)))
        if off <= _EPS * np.linalg.norm(a):
            break
        for i in range(len(a)):
            for j in range(i + 1, len(a)):
                if a[i, j]:
                    angle = 0.5 * math.atan2(2 * a[i, j], a[j, j] - a[i, i])
                    c, s = math.cos(angle), math.sin(angle)
                    plane = np.array([[c, s], [-s, c]])
                    a[:, [i, j]] = a[:, [i, j]] @ plane
                    a[[i, j], :] = plane.T @ a[[i, j], :]
                    turn[:, [i, j]] = turn[:, [i, j]] @ plane
    return np.diag(a).copy(), turn


def _matrix(column: pa.Array | pa.ChunkedArray, size: int, kind=np.int64) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, size)


def whole_vectors(rows: DataFrame, vector_column: str, scale: int = SCALE) -> Column:
    """The vector as whole numbers floor(scale * entry), null where it is null, empty or has a null or non-finite entry."""
    entries = F.col(vector_column).cast("array<double>")
    unfit = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when((F.size(entries) > 0) & ~unfit, F.transform(entries, lambda c: F.floor(F.lit(float(scale)) * c).cast("long")))


@dataclass
class Whitening:
    """What was learned: ``number`` of different vectors, ``sums`` by dimension, ``values`` and unit ``vectors``
    (columns) of the components, the ``trace`` of the covariance, and the ``error`` of whitening them."""

    number: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.number for s in self.sums])

    @property
    def positive(self) -> np.ndarray:
        """Components that have a variance beyond rounding."""
        return self.values > len(self.sums) * _EPS * max(self.trace, 0.0)

    @property
    def projection(self) -> np.ndarray:
        good = self.positive
        return np.where(good, self.vectors / np.sqrt(np.where(good, self.values, 1.0)), np.nan)


def _added(rows: DataFrame, work, size: int, shape: tuple[int, int]) -> np.ndarray:
    """Add up matrices of a ``shape`` that ``work`` makes of the batches, entry by entry.

    A task adds up its batches and sends one matrix, Spark adds those up by entry, and the driver
    gets one matrix, whose size doesn't depend on the number of rows.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += work(_matrix(batch.column("x"), size))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "value"])

    got = rows.mapInArrow(add, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(shape[0] * shape[1])
    out[got.column("at").to_numpy()] = got.column("value").to_numpy()
    return out.reshape(shape)


def learn_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the different vectors ``x`` of a written table, or None if it has none.

    Sums of whole numbers are exact. The covariance is added up from centred vectors by task. Only matrices
    of the vector's dimension reach the driver.
    """
    first = fit.select(F.size("x").alias("size")).first()
    if first is None:
        return None
    size = first["size"]
    added = fit.select(F.posexplode("x")).groupBy("pos").agg(
        F.sum(F.col("col").cast("decimal(38,0)")).alias("sum"), F.count(F.lit(1)).alias("n")).orderBy("pos").collect()
    number, sums = added[0]["n"], [int(r["sum"]) for r in added]
    mean = np.array([s / number for s in sums])

    def spread(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return centred.T @ centred

    covariance = _added(fit, spread, size, (size, size)) / number
    values, vectors = leading_components(covariance, components)
    learned = Whitening(number, sums, values, vectors, float(np.trace(covariance)))
    good = np.flatnonzero(learned.positive)
    if len(good):
        projection = learned.projection[:, good]

        def moments(x: np.ndarray) -> np.ndarray:
            white = (x - mean) @ projection
            return np.vstack([white.T @ white, white.sum(axis=0)])

        total = _added(fit, moments, size, (len(good) + 1, len(good)))
        center = total[-1] / number
        learned.error = float(np.abs(total[:-1] / number - np.outer(center, center) - np.eye(len(good))).max())
    return learned


def _deviations(x: np.ndarray, number: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (number * x - sum)^2; None where they pass 64 bits."""
    reach = number * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(abs(s) for s in sums)
    if reach * reach * len(sums) < 1 << 63:
        moved = x * np.int64(number) - np.array(sums, np.int64)
        return np.einsum("ij,ij->i", moved, moved).tolist()
    out = []
    for row in x.tolist():
        value = sum((number * v - s) ** 2 for v, s in zip(row, sums))
        out.append(value if value < 1 << 63 else None)
    return out


def whitened(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, id_column: str = "vec_id",
             vector_column: str = "embedding") -> DataFrame:
    """For every remaining row and component ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null, empty or holds a null or non-finite entry take no part, nor do those of another
    length than most (of equally frequent lengths, the smallest). Entries become x = floor(scale * entry).
    The components are fitted on the different vectors, each once, however many copies there are:
    unit eigenvectors of their covariance (divisor n), by falling eigenvalue, found on the driver
    by polar decompositions of the shifted covariance, which has the square of the dimension whatever
    the number of rows. They are then sent to all tasks.

    ``whitened`` is null for a component without variance, ``explained`` if there is no variance at
    all, ``deviation`` if it passes 64 bits. Repeated rows each have their answers; a null
    identifier stays null. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    valid = rows.select(F.col(id_column).cast("long").alias("vec_id"),
                        whole_vectors(rows, vector_column, scale).alias("x")).filter("x IS NOT NULL")
    lengths = valid.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    valid = valid.filter(F.size("x") == lengths["size"])
    fit = stage(valid.select("x").distinct(), "vectors")
    learned = learn_whitening(fit, components)
    size, mean, projection = lengths["size"], learned.mean, learned.projection
    part = learned.values / learned.trace if learned.trace > 0 else np.full(len(learned.values), np.nan)
    number, sums, error, width = learned.number, learned.sums, learned.error, len(learned.values)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), size)
            white = (x - mean) @ projection
            take = pa.array(np.repeat(np.arange(len(x)), width))
            count = len(x) * width
            none = lambda v: pa.array(v, from_pandas=True)  # noqa: E731  NaN becomes null
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(take), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(count, number)), pa.array(_deviations(x, number, sums), pa.int64()).take(take),
                 none(white.ravel()), none(np.tile(part, len(x))), pa.array([error] * count, pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return valid.mapInArrow(apply, schema)
