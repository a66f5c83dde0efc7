"""Whitening of embeddings on leading components found by spectrum slicing.

Entries become integers, so that counts, sums and distances from the mean are
exact.  The covariance is gathered in one pass as partial matrices, centred
before they are multiplied, and only the matrix (dimension x dimension)
reaches the driver.  There, the number of negative pivots in the LDL'
factorisation of ``V - s I`` is the number of eigenvalues below ``s`` (the
inertia): bisecting on that count isolates each leading eigenvalue, Rayleigh
quotient iteration, which converges cubically, makes it exact, and two more
counts certify that it is the one of its number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Integer form of an entry c: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Eigenvalues closer than this share of the matrix norm count as one cluster;
#: those below it are no direction to divide by.
CLOSE = 1e-13
#: Largest total of squares that a long holds, with room for rounding.
LONG_ROOM = 9.2e18


def inertia_below(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of symmetric ``v`` below ``shift``: negative pivots of LDL' of ``v - shift I``.

    Pivots are 1x1 or 2x2 blocks chosen symmetrically (Bunch and Parlett's
    bound), so the factorisation stays stable for an indefinite matrix.
    """
    a = v - shift * np.eye(len(v))
    tiny = np.finfo(float).eps * max(1e-300, np.abs(a).max(initial=0.0))
    bound, below = (1 + np.sqrt(17)) / 8, 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        i = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        r, c = np.unravel_index(int(off.argmax()), off.shape)
        if len(a) == 1 or diagonal[i] >= bound * off[r, c]:
            pivot = a[i, i]
            if abs(pivot) <= tiny:  # nothing is left above rounding: an eigenvalue at the shift, not below it
                return below
            below += pivot < 0
            rest = np.delete(np.arange(len(a)), i)
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, i], a[rest, i]) / pivot
        else:
            block = np.array([r, c])
            below += 1  # a 2x2 pivot has one eigenvalue of each sign
            rest = np.delete(np.arange(len(a)), block)
            side = a[np.ix_(rest, block)]
            a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(block, block)], side.T)
    return int(below)


class Slices:
    """Counts of a matrix's spectrum, kept by shift."""

    def __init__(self, v: np.ndarray):
        self.v, self.n = v, len(v)
        self.norm = float(np.abs(v).sum(axis=1).max(initial=0.0))
        self.counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        """Eigenvalues at or above ``shift``."""
        if shift not in self.counts:
            self.counts[shift] = self.n - inertia_below(self.v, shift)
        return self.counts[shift]

    def bracket(self, number: int) -> tuple[float, float]:
        """Bounds around the eigenvalue of this number (1 is the greatest), from the counts so far."""
        lo = max((s for s, k in self.counts.items() if k >= number), default=-2 * self.norm)
        return lo, min((s for s, k in self.counts.items() if k < number and s > lo), default=2 * self.norm)


def leading_eigenpairs(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest eigenvalues of symmetric ``v``, falling, and their unit vectors as rows."""
    spectrum = Slices(v)
    close = CLOSE * spectrum.norm
    values, vectors = [], []
    rng = np.random.default_rng(0)
    for number in range(1, min(count, len(v)) + 1):
        while True:
            lo, hi = spectrum.bracket(number)
            alone = spectrum.above(lo) - spectrum.above(hi) == 1
            if alone or hi - lo <= close:
                found = _rayleigh(v, lo, hi, np.array(vectors).reshape(-1, len(v)), rng, close)
                if found and (not alone or _certified(spectrum, found[0], number, close)):
                    break
                if hi - lo <= close:
                    raise ArithmeticError(f"eigenvalue {number} did not converge")
            middle = (lo + hi) / 2
            if middle in (lo, hi):
                raise ArithmeticError(f"eigenvalue {number} could not be isolated")
            spectrum.above(middle)
        values.append(found[0])
        vectors.append(found[1])
    values, vectors = np.array(values), np.array(vectors).reshape(-1, len(v))
    order = np.argsort(-values, kind="stable")  # within a cluster, of equal numbers to rounding
    vectors = vectors[order]
    return values[order], vectors * np.where(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]


def _certified(spectrum: Slices, value: float, number: int, close: float) -> bool:
    """Whether the counts just below and above ``value`` give it this number."""
    return spectrum.above(value - close) >= number and spectrum.above(value + close) < number


def _rayleigh(v: np.ndarray, lo: float, hi: float, before: np.ndarray, rng, close: float) -> tuple[float, np.ndarray] | None:
    """An eigenpair with its value in [lo, hi], orthogonal to the vectors before; None if the iteration leaves the bounds."""
    def cleaned(x):
        for _ in range(2):
            x = x - before.T @ (before @ x)
        size = np.linalg.norm(x)
        return x / size if size > 0 and np.isfinite(size) else None

    def solved(shift, x):
        for nudge in (0.0, close, -close, 4 * close):
            try:
                y = np.linalg.solve(v - (shift + nudge) * np.eye(len(v)), x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all():
                return cleaned(y)
        return x

    x = cleaned(rng.standard_normal(len(v)))
    shift, best = (lo + hi) / 2, None
    for step in range(40):
        if x is None:
            return None
        y = solved(shift, x)
        if y is None:
            return None
        x, value = y, float(y @ v @ y)
        residual = np.linalg.norm(v @ x - value * x)
        if best is None or residual < best[0]:
            best = residual, value, x
        elif residual <= 64 * close:
            break
        if step >= 2:
            if not lo - close <= value <= hi + close:
                return None
            shift = value
    residual, value, x = best
    return (value, x) if residual <= 64 * close and lo - close <= value <= hi + close else None


def integer_rows(vectors: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector is usable, with ``_x``: its entries as longs."""
    c = F.col(vec_col)
    usable = c.isNotNull() & ~F.exists(c, lambda e: F.coalesce(F.isnan(e) | (F.abs(e) == float("inf")), F.lit(True)))
    return vectors.filter(usable).withColumn("_x", F.transform(c, lambda e: F.floor(F.lit(float(SCALE)) * e.cast("double")) + F.lit(SHIFT)))


def rows_of(batch: pa.RecordBatch, column: int, d: int) -> np.ndarray:
    """A column of vectors of length ``d`` as a matrix of longs."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


def summed(parts: DataFrame, d: int) -> np.ndarray:
    """Sums over partial rows (i, sums): one row of ``d`` doubles for each i, added up in the tasks."""
    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in it:
            for i, row in zip(b.column(0).to_pylist(), rows_float(b.column(1), d)):
                total[i] = total[i] + row if i in total else row.copy()
        if total:
            yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], names=["i", "sums"])

    done = parts.repartition("i").mapInArrow(add, "i int, sums array<double>").collect()  # a row for each i: the matrix itself
    out = np.zeros((max([r.i for r in done], default=-1) + 1, d))
    for r in done:
        out[r.i] = r.sums
    return out


def rows_float(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def scatter(rows: DataFrame, d: int, n: int, sums: np.ndarray, onto: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor ``n``) of the rows' exact distances from the mean, or of those projected by ``onto``.

    Each task multiplies distances from ``sums / n``; what is left of the mean
    after rounding is taken off at the end.
    """
    k = d if onto is None else len(onto)

    def partial(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, at = np.zeros((k + 1, k)), None
        for b in it:
            at = centred(rows_of(b, 0, d), n, sums)
            at = at if onto is None else at @ onto.T
            total[:k] += at.T @ at
            total[k] += at.sum(axis=0)
        if at is not None:
            yield pa.record_batch([pa.array(np.arange(k + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"])

    total = summed(rows.select("_x").mapInArrow(partial, "i int, sums array<double>"), k)
    left = total[k] / n
    return total[:k] / n - np.outer(left, left)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - sums / n``: from exact integers where they fit a long."""
    if len(x) and float(np.abs(x).max()) * n < LONG_ROOM and np.abs(sums.astype(float)).max() < LONG_ROOM:
        return (n * x - sums) / n
    return x - sums / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of ``(n x - sums)^2`` of each row, exact; None where it does not fit a long."""
    if not len(x):
        return []
    far = (x.astype(float) - (sums.astype(float) / n)) * n
    if float((far * far).sum(axis=1).max()) < LONG_ROOM and float(np.abs(x).max()) * n < LONG_ROOM:
        y = n * x - sums
        return (y * y).sum(axis=1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums.tolist())) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8) -> DataFrame:
    """One row for each usable vector and leading component.

    Columns: ``id_col``; ``component`` int from 1 by falling eigenvalue;
    ``n`` long, vectors fitted on; ``deviation`` long, the exact sum over
    dimensions of ``(n x - S)^2`` (null where it does not fit a long);
    ``whitened`` double, the distance from the mean projected on the
    component, over the root of its eigenvalue; ``explained`` double, the
    eigenvalue's share of the total variance; ``identity_error`` double, the
    largest absolute entry of the whitened columns' covariance minus the
    identity (one value for all rows).

    Vectors that are null, empty, or hold null or non-finite entries are left
    out.  Of several lengths the one of most vectors is fitted (ties: the
    least), others are left out.  Repeated rows and null ids each count and
    get their rows.  Where a component has no variance to rounding (equal
    vectors, fewer vectors than components) its ``whitened`` is null and it is
    no part of ``identity_error``; ``explained`` is null if nothing varies.
    Vectors shorter than ``components`` have as many as entries.  An empty
    table gives no rows.
    """
    rows = integer_rows(vectors.select(id_col, vec_col), vec_col).select(id_col, "_x")
    sizes = rows.groupBy(F.size("_x").alias("d")).agg(F.count(F.lit(1)).alias("n")).filter("d > 0")
    most = sizes.orderBy(F.desc("n"), "d").first()
    out = T.StructType([vectors.schema[id_col], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    if most is None:
        return vectors.sparkSession.createDataFrame([], out)
    d, n = int(most["d"]), int(most["n"])
    rows = rows.filter(F.size("_x") == d)
    sums = dimension_sums(rows, d)
    v = scatter(rows, d, n, sums)
    values, axes = leading_eigenpairs((v + v.T) / 2, components)
    total = float(np.trace(v))
    varies = values > CLOSE * d * max(total, 0.0)
    onto = axes[varies] / np.sqrt(values[varies])[:, None]
    error = float(np.abs(scatter(rows, d, n, sums, onto) - np.eye(len(onto))).max()) if len(onto) else None
    share = [float(e) / total if total > 0 else None for e in values]
    k, place = len(values), np.cumsum(varies) - 1

    def project(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            x = rows_of(b, 1, d)
            seen = centred(x, n, sums) @ onto.T
            flat = np.zeros((len(x), k))
            flat[:, varies] = seen[:, place[varies]]
            pick = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(pick)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(len(pick), n), pa.int64()), pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(pick)),
                pa.array(flat.ravel(), pa.float64(), mask=np.tile(~varies, len(x))),
                pa.array(share * len(x), pa.float64()), pa.array([error] * len(pick), pa.float64())], names=out.names)

    return rows.mapInArrow(project, out)


def dimension_sums(rows: DataFrame, d: int) -> np.ndarray:
    """Exact sums of each dimension."""
    def partial(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros(d, np.int64), False
        for b in it:
            total += rows_of(b, 0, d).sum(axis=0)
            any_row |= b.num_rows > 0
        if any_row:
            yield pa.record_batch([pa.array(np.arange(d), pa.int32()), pa.array(total)], names=["i", "s"])

    sums = rows.select("_x").mapInArrow(partial, "i int, s long").groupBy("i").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(d, np.int64)
    for r in sums:
        out[r.i] = r.s
    return out
