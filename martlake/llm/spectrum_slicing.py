"""Whitening of embeddings by the leading components of their covariance.

Entries become whole numbers (``floor(256 * c)``), so that counts, sums and second
moments are exact and independent of the order of addition.  The covariance is that
of the distinct vectors, each once, about their mean: products are taken of entries
centred on the whole number next to the mean, and the remaining fraction is taken
off exactly.

*Spectrum slicing.*  The number of eigenvalues above a shift is the number of
positive pivots in an LDL' factorisation of the shifted covariance (Sylvester's law
of inertia; symmetric pivoting with 1x1 and 2x2 blocks).  Bisection by these counts
isolates each leading eigenvalue; Rayleigh quotient iteration then converges to it
(cubically), and counts on both sides of the value found certify its number.
Eigenvalues that no shift can separate in double precision are taken together: their
vectors are any orthonormal ones of their common space.

The tables are read and reduced on executors; the driver holds one matrix of the
dimension squared.

Defined cases: rows whose vector is null or has null or non-finite entries are left
out, as are rows whose vector has not the table's most frequent length (ties: the
longer).  Numbers beyond the long range take its ends; a deviation that no long
holds is null.  Null and repeated ids stay as they are; other columns, whatever their
names, are not read.  Components of no variance (equal vectors, fewer vectors than
dimensions) are not returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.tables import dropped, stored

COMPONENTS = 4
SCALE = 256
#: Rows multiplied at a time.
ROWS = 4096
_HALF = 1 << 62


def whole_vectors(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, x) of every row with finite entries only; x as whole numbers."""
    v = F.col(vector_column).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = table.filter(F.col(vector_column).isNotNull() & finite)
    return rows.select(F.col(id_column).alias("id"), F.transform(v, lambda c: F.floor(c * SCALE)).alias("x"))


def usual_length(rows: DataFrame, column: str) -> int:
    """The most frequent length of an array column (ties: the longer); 0 without rows."""
    n = rows.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return n["d"] if n else 0


def _matrices(batches: Iterator[pa.RecordBatch], d: int, name: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            yield part, part.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _split(i: int, j: int, value: int) -> tuple[int, int, Decimal, Decimal]:
    return i, j, Decimal(value // _HALF), Decimal(value % _HALF)


def _moments(fit: DataFrame, d: int, centre: list[int] | None) -> dict[tuple[int, int], int]:
    """Exact sums over the vectors, as whole numbers: without ``centre`` the count
    under (-1, -1) and the sum of each entry i under (i, -1); with it the sums of
    the centred entries and of their products under (i, j), j <= i."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        products = np.zeros((d, d), object)
        for _, x in _matrices(batches, d, "x"):
            n += len(x)
            if centre is not None:
                wide = int(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, centre))
                x = x.astype(object) - np.array(centre, object) if wide > 1 << 52 else x - np.array(centre)
                top = int(np.abs(x).max(initial=0))
                if top * top * len(x) < 1 << 53:  # exact in double precision
                    y = x.astype(float)
                    products = products + (y.T @ y).astype(np.int64)
                else:
                    y = x.astype(object)
                    products = products + y.T @ y
            total = total + x.astype(object).sum(0)
        if not n:
            return
        out = [_split(i, -1, int(total[i])) for i in range(d)]
        if centre is None:
            out.append(_split(-1, -1, n))
        else:
            out += [_split(i, j, int(products[i, j])) for i in range(d) for j in range(i + 1)]
        kinds = [pa.int32(), pa.int32(), pa.decimal128(38), pa.decimal128(38)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["i", "j", "high", "low"]
        )

    rows = fit.select("x").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    # at most (d + 1)(d + 2) / 2 rows
    got = rows.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {(r["i"], r["j"]): int(r["high"]) * _HALF + int(r["low"]) for r in got}


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix above ``shift``, by the inertia of the
    LDL' factorisation of the shifted matrix (Bunch and Kaufman's pivoting)."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive, alpha = len(a), 0, 0, (1 + 17**0.5) / 8
    while k < n:
        below = np.abs(a[k + 1 :, k])
        largest = below.max(initial=0.0)
        pair = False
        if abs(a[k, k]) < alpha * largest:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            other = row.max()
            if abs(a[k, k]) * other < alpha * largest * largest:
                pair = abs(a[r, r]) < alpha * other
                to = k + 1 if pair else k
                if to != r:
                    a[[to, r]] = a[[r, to]]
                    a[:, [to, r]] = a[:, [r, to]]
        if pair:  # a 2x2 block of this pivoting has one positive and one negative eigenvalue
            positive += 1
            c = a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(a[k : k + 2, k : k + 2], c.T)
            k += 2
        else:
            positive += bool(a[k, k] > 0)
            if a[k, k] != 0:
                c = a[k + 1 :, k].copy()
                a[k + 1 :, k + 1 :] -= np.outer(c, c / a[k, k])
            k += 1
    return positive


class Slicer:
    """Leading eigenpairs of a positive semidefinite matrix."""

    def __init__(self, matrix: np.ndarray):
        self.v = matrix
        d = len(matrix)
        self.bound = float(np.abs(matrix).sum(1).max(initial=0.0))
        self.near = 8 * d * np.finfo(float).eps * self.bound
        self.rng = np.random.default_rng(11)
        top = self.bound + self.near
        #: (shift, eigenvalues above it)
        self.marks = [(self.near, self.count(self.near)), (top, 0)] if self.bound > 0 else []

    def count(self, shift: float) -> int:
        return count_above(self.v, shift)

    def _between(self, k: int) -> tuple[float, int, float, int]:
        """The closest marks with at least k eigenvalues, and fewer, above them."""
        low = max(m for m in self.marks if m[1] >= k)
        high = min(m for m in self.marks if m[1] < k)
        return (*low, *high)

    def _iterate(self, shift: float, found: list[np.ndarray]) -> tuple[float, np.ndarray, float]:
        """Inverse steps at ``shift``, then Rayleigh quotient steps, orthogonal to
        the vectors found; value, vector and residual."""
        d = len(self.v)

        def clean(x):
            for _ in (0, 1):
                for f in found:
                    x = x - (f @ x) * f
            return x / np.linalg.norm(x)

        def solve(at, x):
            for turn in (0.0, 1.0, -3.0):
                try:
                    y = np.linalg.solve(self.v - (at + turn * self.near / d) * np.eye(d), x)
                except np.linalg.LinAlgError:
                    continue
                if np.isfinite(y).all():
                    return y
            return x

        x = clean(self.rng.standard_normal(d))
        for _ in range(3):
            x = clean(solve(shift, x))
        for _ in range(12):
            value = float(x @ self.v @ x)
            rest = float(np.linalg.norm(self.v @ x - value * x))
            if rest <= self.near / d:
                break
            x = clean(solve(value, x))
        value = float(x @ self.v @ x)
        return value, x, float(np.linalg.norm(self.v @ x - value * x))

    def leading(self, most: int) -> list[tuple[float, np.ndarray]]:
        pairs: list[tuple[float, np.ndarray]] = []
        if not self.marks:
            return pairs
        most = min(most, self.marks[0][1])
        while len(pairs) < most:
            k = len(pairs) + 1
            low, above_low, high, above_high = self._between(k)
            vectors = [x for _, x in pairs]
            if above_low == k and above_high == k - 1:  # isolated
                value, x, rest = self._iterate((low + high) / 2, vectors)
                slack = max(self.near, rest)
                if low - slack <= value <= high + slack and rest <= self.near:
                    if self.count(value - slack) >= k > self.count(value + slack):
                        pairs.append((value, x))
                        continue
            if high - low <= self.near:  # no shift separates them
                for _ in range(min(above_low, most) - above_high):
                    value, x, _ = self._iterate((low + high) / 2, [x for _, x in pairs])
                    pairs.append((value, x))
                continue
            middle = (low + high) / 2
            self.marks.append((middle, self.count(middle)))
        return sorted(pairs, key=lambda p: -p[0])


@dataclass
class Whitening:
    """A fitted whitening; its size depends on the dimension only."""

    n: int
    sums: list[int]
    values: list[float]
    vectors: list[np.ndarray]
    trace: float
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        turn = np.array(self.vectors).T / np.sqrt(self.values)
        return (x.astype(float) - mean) @ turn

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """sum (n x - S)^2 of every row."""
        top = self.n * int(np.abs(x.astype(float)).max(initial=0) + 1) + max(map(abs, self.sums))
        if top * top * x.shape[1] < 1 << 63:
            y = x * self.n - np.array(self.sums)
            return (y * y).sum(1).tolist()
        y = x.astype(object) * self.n - np.array(self.sums, object)
        return [int(t) if t < 1 << 63 else None for t in (y * y).sum(1)]


def covariance(fit: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """Count, sums and covariance (divisor n) of the vectors x."""
    first = _moments(fit, d, None)
    n = first.get((-1, -1), 0)
    if not n:
        return 0, [0] * d, np.zeros((d, d))
    sums = [first[i, -1] for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    got = _moments(fit, d, centre)
    v = np.zeros((d, d))
    for i in range(d):
        for j in range(i + 1):
            v[i, j] = v[j, i] = (n * got[i, j] - got[i, -1] * got[j, -1]) / (n * n)
    return n, sums, v


def fit_whitening(vectors: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """Fits on the distinct x of ``vectors``, all of length ``d``."""
    fit, folder = stored(vectors.select("x").distinct(), "distinct-vectors")
    n, sums, v = covariance(fit, d)
    pairs = Slicer(v).leading(components) if d else []
    w = Whitening(n, sums, [e for e, _ in pairs], [x for _, x in pairs], float(np.trace(v)))
    if pairs:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, x in _matrices(batches, d, "x"):
                y = w.project(x)
                yield pa.RecordBatch.from_arrays([pa.array(y[:, c]) for c in range(len(pairs))], names)

        names = [f"w{c}" for c in range(len(pairs))]
        white = fit.mapInArrow(run, ", ".join(f"{c} double" for c in names))
        cells = [(a, b) for i, a in enumerate(names) for b in names[: i + 1]]
        row = white.agg(*(F.covar_pop(a, b) for a, b in cells)).first()
        w.identity_error = max(abs(c - (a == b)) for c, (a, b) in zip(row, cells))
    dropped(vectors.sparkSession, folder)
    return w


def whitened(
    table: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """Per row and component: the id, component, n, deviation, whitened,
    explained, identity_error."""
    rows = whole_vectors(table, id_column, vector_column)
    d = usual_length(rows, "x")
    rows = rows.filter(F.size("x") == d)
    w = fit_whitening(rows, d, components)
    m = len(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not m:
            return
        for part, x in _matrices(batches, d, "x"):
            each = pa.array(np.repeat(np.arange(part.num_rows), m))
            size = len(each)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(each), pa.array(np.tile(np.arange(1, m + 1), part.num_rows), pa.int32()),
                    pa.array(np.full(size, w.n)), pa.array(w.deviation(x), pa.int64()).take(each),
                    pa.array(w.project(x).ravel()), pa.array(np.tile([e / w.trace for e in w.values], part.num_rows)),
                    pa.array(np.full(size, w.identity_error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = table.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double",
    ).withColumnRenamed("id", id_column)
