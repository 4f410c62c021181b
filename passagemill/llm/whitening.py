"""Embedding whitening: leading principal components, each scaled to variance one.

Entries become whole numbers (64 steps a unit, moved by 1,000,000), so all sums
over the rows are exact whatever the order in which tasks add them: first the
sums per dimension, then the products of entries that were centred at the whole
number next to the mean, with the rest of the centring subtracted exactly. One
row of a dimensions x dimensions matrix is added up per group in a second
shuffle; only the finished matrix, whose size depends on the number of
dimensions alone, comes to the driver.

There it is reduced to tridiagonal form by Householder reflections, the largest
eigenvalues are enclosed by bisection on Sturm counts, and inverse iteration
gives the vectors, orthogonalised again within clusters of close eigenvalues. All
of that is done in extended precision and rounded to doubles at the end. The
components are sent to the tasks (at most ``components`` x dimensions numbers),
which project the centred rows.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exact_search import usable

#: Fixed-point form of an entry: steps a unit and shift (fixed values).
STEPS, SHIFT = 64.0, 1_000_000
#: Entries beyond this count as this (2^40 steps); sums and products stay exact.
LARGEST = float(1 << 40)
#: Rows multiplied at a time: with 21-bit parts all sums stay whole in double precision.
ROWS = 1024
_LOW = 1 << 21
Real = np.longdouble


def fixed_point(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number rows of a list column of finite numbers, and the rows' lengths; short rows end in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(lengths.max(initial=0))
    out = np.full((len(lengths), width), SHIFT, np.int64)
    whole = np.clip(np.floor(STEPS * flat), -LARGEST, LARGEST).astype(np.int64) + SHIFT
    out[np.arange(width) < lengths[:, None]] = whole
    return out, lengths


def _usable_rows(vectors: DataFrame, vector_col: str) -> DataFrame:
    return vectors.filter(usable(vector_col)).select(F.col(vector_col).cast("array<double>").alias("v"))


def _added(rows: DataFrame, partial, names: str) -> list[tuple[int, list[int]]]:
    """Exact sums by key of the arrays that ``partial`` yields for the batches of a task.

    ``partial`` gives {key: whole-number array} once a task; a second shuffle by key
    adds the tasks' arrays. Whole numbers travel as decimals of 38 digits.
    """
    schema = f"{names} int, sums array<decimal(38,0)>"

    def pack(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.decimal128(38, 0))
        for key, values in sums.items():
            cells = pa.array([[decimal.Decimal(int(x)) for x in values]], kind)
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), cells], names=[names, "sums"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pack(partial(batches))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                array = np.array([int(x) for x in values], object)
                have = sums.get(key, np.zeros(0, object))
                if len(have) < len(array):
                    have, array = array, have
                have[: len(array)] += array
                sums[key] = have
        yield from pack(sums)

    totals = rows.mapInArrow(first, schema).repartition(names).mapInArrow(second, schema)
    return sorted((r[0], [int(x) for x in r[1]]) for r in totals.collect())


@dataclass
class Statistics:
    """Exact sums over the fit list: number of rows, sums S per dimension, n^2 times the covariance."""

    n: int
    sums: list[int]
    scaled_covariance: np.ndarray  # object: whole numbers

    @property
    def covariance(self) -> np.ndarray:
        n2 = Real(self.n) * Real(self.n)
        return np.array([[_real(x) / n2 for x in row] for row in self.scaled_covariance], Real).reshape(self.scaled_covariance.shape)


def _real(x: int) -> Real:
    """A whole number of any size in extended precision."""
    sign, x = (-1, -x) if x < 0 else (1, x)
    extra = max(0, x.bit_length() - 63)
    return sign * np.ldexp(Real(x >> extra), extra)


def statistics(vectors: DataFrame, vector_col: str = "embedding") -> Statistics:
    """Two passes over the rows: sums, then products of centred entries."""
    rows = _usable_rows(vectors, vector_col)

    def counted(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        n, sums = 0, np.zeros(0, object)
        for batch in batches:
            x, _ = fixed_point(batch.column(0))
            n += len(x)
            part = (x - SHIFT).sum(0).astype(object)  # at most 2^40 times the rows of one batch
            if len(part) > len(sums):
                sums, part = part, sums
            sums[: len(part)] += part
        return {0: np.array([n], object), 1: sums} if n else {}

    totals = dict(_added(rows, counted, "part"))
    if not totals:
        return Statistics(0, [], np.zeros((0, 0), object))
    n, moved = totals[0][0], totals[1]
    width = len(moved)
    centre = np.array([round(decimal.Decimal(s) / n) for s in moved], np.int64) + SHIFT

    def products(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        total = np.zeros((width, width), object)
        whole = np.zeros((width, width), np.int64)  # sums of small entries, below 2^62
        pending = 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                z = _wide(fixed_point(batch.column(0).slice(at, ROWS))[0], width) - centre
                high, low = np.divmod(z + _LOW // 2, _LOW)
                low = (low - _LOW // 2).astype(np.float64)
                whole += (low.T @ low).astype(np.int64)
                pending += len(z)
                if pending > 1 << 20:
                    total, pending = total + whole, 0
                    whole[:] = 0
                if high.any():
                    high = high.astype(np.float64)
                    cross = (high.T @ low).astype(np.int64).astype(object) * _LOW
                    total = total + cross + cross.T + (high.T @ high).astype(np.int64).astype(object) * (_LOW * _LOW)
        total = total + whole
        return dict(enumerate(total)) if width else {}

    square = np.zeros((width, width), object)
    for key, values in _added(rows, products, "dim"):
        square[key] = values
    rest = np.array(moved, object) - n * (centre.astype(object) - SHIFT)  # what is left of the centring
    return Statistics(n, [s + n * SHIFT for s in moved], square * n - np.outer(rest, rest))


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])), constant_values=SHIFT)


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflections of a symmetric matrix; reflection i acts on rows i + 1 and below."""
    a = matrix.astype(Real).copy()
    n = len(a)
    reflections = []
    off = np.zeros(max(n - 1, 0), Real)
    for i in range(n - 2):
        x = a[i + 1 :, i].copy()
        length = np.sqrt(x @ x)
        if length == 0 or not x[1:].any():
            reflections.append(np.zeros(n - 1 - i, Real))
            off[i] = x[0]
            continue
        off[i] = -length if x[0] > 0 else length
        x[0] -= off[i]
        u = x / np.sqrt(x @ x)
        reflections.append(u)
        block = a[i + 1 :, i + 1 :]
        p = block @ u
        p -= u * (u @ p)
        block -= 2 * (np.outer(u, p) + np.outer(p, u))
    if n > 1:
        off[n - 2] = a[n - 1, n - 2]
    return np.diagonal(a).copy(), off, reflections


def sturm_count(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """For each shift the number of eigenvalues below it: negative pivots of the shifted matrix."""
    tiny = np.finfo(Real).tiny / np.finfo(Real).eps
    pivot = diagonal[0] - shifts
    count = (pivot < 0).astype(int)
    for d, e in zip(diagonal[1:], off, strict=True):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - shifts - e * e / pivot
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection from Gershgorin's bounds, all at once."""
    n = len(diagonal)
    radius = np.zeros(n, Real)
    radius[:-1] += np.abs(off)
    radius[1:] += np.abs(off)
    low = np.full(k, (diagonal - radius).min(), Real)
    high = np.full(k, (diagonal + radius).max(), Real)
    wanted = n - np.arange(k)  # the i-th largest has n - i eigenvalues at or below it
    span = np.maximum(np.abs(low), np.abs(high))[0]
    low -= span * np.finfo(Real).eps
    high += span * np.finfo(Real).eps
    for _ in range(200):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        below = sturm_count(diagonal, off, middle) >= wanted
        high = np.where(below, middle, high)
        low = np.where(below, low, middle)
    return (low + high) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: Real, right: np.ndarray, floor: Real) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges; vanishing pivots become ``floor``."""
    n = len(diagonal)
    main, upper, upper2, b = diagonal - shift, np.append(off, Real(0)), np.zeros(n, Real), right.copy()
    for i in range(n - 1):
        below, next_main, next_upper = off[i], main[i + 1], upper[i + 1]
        if abs(below) > abs(main[i]):
            main[i], upper[i], upper2[i], below, next_main, next_upper = below, next_main, next_upper, main[i], upper[i], Real(0)
            b[i], b[i + 1] = b[i + 1], b[i]
        if abs(main[i]) < floor:
            main[i] = floor
        factor = below / main[i]
        main[i + 1] = next_main - factor * upper[i]
        upper[i + 1] = next_upper - factor * upper2[i]
        b[i + 1] -= factor * b[i]
    if abs(main[-1]) < floor:
        main[-1] = floor
    for i in range(n - 1, -1, -1):
        after = (upper[i] * b[i + 1] if i + 1 < n else 0) + (upper2[i] * b[i + 2] if i + 2 < n else 0)
        b[i] = (b[i] - after) / main[i]
    return b / np.sqrt(b @ b)


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) by inverse iteration; close values are held orthogonal to each other."""
    n = len(diagonal)
    scale = max(np.abs(diagonal).max(), np.abs(off).max(initial=Real(0)))
    floor = max(scale, Real(1e-300)) * np.finfo(Real).eps
    vectors = np.zeros((len(values), n), Real)
    cluster, rng = 0, np.random.default_rng(11)
    for i, value in enumerate(values):
        if i and values[i - 1] - value > scale * Real(1e-3):
            cluster = i
        # equal values are moved apart a little, so that each start leads elsewhere
        shift = value - (i - cluster) * 2 * floor
        x = rng.standard_normal(n).astype(Real)
        for _ in range(5):
            for _ in range(2):
                x = x - vectors[cluster:i].T @ (vectors[cluster:i] @ x)
            x = _solve(diagonal, off, shift, x / np.sqrt(x @ x), floor)
        for _ in range(2):
            x = x - vectors[cluster:i].T @ (vectors[cluster:i] @ x)
        vectors[i] = x / np.sqrt(x @ x)
    return vectors


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as rows.

    Each vector is turned so that its entry of largest size (the first of them) is positive.
    """
    n, k = len(matrix), min(k, len(matrix))
    if not n:
        return np.zeros(0, Real), np.zeros((0, 0), Real)
    scale = np.abs(matrix).max()
    if not scale:
        return np.zeros(k, Real), np.eye(n, dtype=Real)[:k]
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, k)
    vectors = tridiagonal_vectors(diagonal, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        u, part = reflections[i], vectors[:, i + 1 :]
        part -= 2 * np.outer(part @ u, u)
    signs = np.sign(vectors[np.arange(k), np.argmax(np.abs(vectors), axis=1)])
    return values * scale, vectors * signs[:, None]


@dataclass
class Whitening:
    """A fitted transform: n, exact sums, components (rows), eigenvalues and their shares of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: list[float]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S: int64 where that is safe, otherwise whole numbers of any size."""
        largest = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if largest < 1 << 62 else object
        return _wide(x, len(self.sums)).astype(kind) * self.n - np.array(self.sums, kind)

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(np.float64) / self.n @ (self.components / np.sqrt(self.values)[:, None]).T


def fit(vectors: DataFrame, components: int = 32, vector_col: str = "embedding") -> Whitening:
    """The transform for all usable rows of a table.

    Null vectors and those with null or non-finite entries take no part; repeated
    rows count as often as they come; shorter vectors end in zeros. Components whose
    eigenvalue is nothing but rounding (below 1e-15 of the largest) cannot be scaled
    to variance one and are left out, so equal rows, and an empty table, give none.
    """
    found = statistics(vectors, vector_col)
    matrix = found.covariance
    values, rows = leading_components(matrix, components)
    trace = sum(np.diagonal(matrix), Real(0))
    kept = values > (values[0] if len(values) else 0) * Real(1e-15)
    kept &= values > 0
    values, rows = values[kept], rows[kept]
    return Whitening(
        found.n, found.sums, rows.astype(np.float64), values.astype(np.float64), [float(v / trace) for v in values]
    )


def transform(vectors: DataFrame, model: Whitening, vector_col: str = "embedding") -> DataFrame:
    """Every usable row with ``whitened`` (array of double) and ``deviation`` (decimal(38,0)).

    deviation is the exact sum over the dimensions of (n*x - S)^2. All columns are
    kept, but those of these two names are replaced. A vector longer than those
    of the fit is an error.
    """
    kept = vectors.drop("whitened", "deviation").filter(usable(vector_col))
    width = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                x, lengths = fixed_point(batch.column(vector_col))
                if lengths.max(initial=0) > width:
                    raise ValueError(f"a vector has {lengths.max()} entries, the fitted ones {width}")
                y = model.centred(x)
                z = model.project(y)
                if y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * max(width, 1) >= 1 << 62:
                    y = y.astype(object)
                deviation = pa.array([decimal.Decimal(int(d)) for d in (y * y).sum(1)], pa.decimal128(38, 0))
                offsets = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
                white = pa.ListArray.from_arrays(offsets, pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, white, deviation], names=[*batch.schema.names, "whitened", "deviation"]
                )

    added = [T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.DecimalType(38, 0))]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))


def identity_error(whitened: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of column ``whitened`` minus the identity; 0 without rows.

    One pass: the rows are centred by the transform, so the products are summed as
    they are, and what rounding left of the mean is taken off at the end.
    """
    if not k:
        return 0.0

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))  # below the products the sums
        n = 0
        for batch in batches:
            z = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            total[:k] += z.T @ z
            total[k] += z.sum(0)
            n += len(z)
        cells = pa.ListArray.from_arrays(np.arange(k + 2, dtype=np.int32) * k, pa.array(total.ravel()))
        dims = pa.array(np.arange(k + 1, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([dims, pa.array([n] * (k + 1), pa.int64()), cells], names=["dim", "n", "sums"])

    partial = whitened.select("whitened").mapInArrow(products, "dim int, n bigint, sums array<double>")
    sums = partial.groupBy("dim").agg(F.sum("n"), *[F.sum(F.col("sums")[i]) for i in range(k)]).orderBy("dim").collect()
    n = sums[0][1] if sums else 0
    if not n:
        return 0.0
    totals = np.array([r[2:] for r in sums]) / n
    return float(np.abs(totals[:k] - np.outer(totals[k], totals[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 32, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row and component of the table whitened by itself.

    Columns: the id column, component (from 1), n, deviation (null if it does not fit
    a long), whitened, explained (share of the trace), identity_error. See ``fit``
    and ``transform`` for nulls, repeats and short vectors; a null id is kept. Other
    columns are ignored. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col), F.col(vector_col))
    model = fit(rows, components, vector_col)
    white = transform(rows, model, vector_col)
    error = identity_error(white, len(model.values))
    share: Column = F.element_at(F.lit(model.explained or [0.0]).cast("array<double>"), F.col("component"))
    return (
        white.select(id_col, "deviation", F.posexplode("whitened").alias("place", "whitened"))
        .withColumn("component", F.col("place") + 1)
        .select(
            id_col,
            F.col("component").cast("int").alias("component"),
            F.lit(model.n).cast("bigint").alias("n"),
            F.expr("try_cast(deviation AS bigint)").alias("deviation"),
            "whitened",
            share.alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
