"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With X the centred rows, a step forms X v over all rows, makes it orthogonal to the left vectors before it, forms Xᵀ u,
and makes that orthogonal to the right vectors before it. A left vector has an entry for each row and is never stored:
u_j = X y_j for a short y_j that the driver knows, so a task makes its own stretch of every u again from its own rows,
and a lost task costs nothing else. One pass over the rows gives X v, Xᵀ(X v) and the products with all earlier left
vectors. Right vectors, y and the bidiagonal are of the length of a row and live on the driver. There are as many steps
as dimensions, so that directions of equal variance, of which one start vector shows only one, are all found: a step
that finds nothing new starts again from a fresh direction. The SVD of the small bidiagonal gives components (right
singular vectors) and deviations (singular values over the root of n).

Rows are packed once into blocks of whole numbers. Sums over rows are made in tasks and added up by Spark.

Defined results: rows count as `vectors.usable` says, with entries below 2**20 in size (sums are exact in 64 bits up to 2**33 rows). Components whose variance is
no more than 1e-12 of the largest are left out (whitening would divide by nothing), so equal rows, or one row alone, or
an empty table give no rows. deviation is exact; where it does not fit in 64 bits it is null, and deviation_exact
(decimal) holds it. Null and repeated vec_ids are rows like others. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import written
from lakemill.llm.vectors import matrix, usable

SCALE, SHIFT = 1024, 100_000


@dataclass(frozen=True)
class Centre:
    """n rows and the sums of their dimensions; rows are centred on sums / n without losing digits of either."""

    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum over the dimensions of (n * x - sums)**2 of each row, exact."""
        whole, rest = np.array([s // self.n for s in self.sums], np.int64), np.array([s % self.n for s in self.sums], np.int64)
        apart = x - whole
        most = self.n * (int(np.abs(apart).max()) + 1) if len(x) else 0
        root = int(len(self.sums) ** 0.5) + 1
        if most < 2**31 // root:
            return ((self.n * apart - rest) ** 2).sum(axis=1).tolist()
        if most < 2**57 // root:  # squares in halves of 26 bits, put together as Python's whole numbers
            v = self.n * apart - rest
            high, low = v >> 26, v & (2**26 - 1)
            return [(a << 52) + (b << 27) + c for a, b, c in zip((high**2).sum(axis=1).tolist(), (high * low).sum(axis=1).tolist(), (low**2).sum(axis=1).tolist())]
        wide = apart.astype(object) * self.n - rest.astype(object)
        return [int(v) for v in (wide * wide).sum(axis=1)]


def blocks(rows: DataFrame, size: int = 2048) -> DataFrame:
    """rows (vec) as blocks of whole numbers: n rows each, and their bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(0), SCALE, SHIFT)
            for i in range(0, len(x), size):
                part = x[i : i + size]
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), pa.array([part.tobytes()], pa.binary())], ["n", "x"])

    return rows.select("vec").mapInArrow(pack, "n long, x binary")


def _totals(packed: DataFrame, work: Callable[[np.ndarray], np.ndarray], width: int, kind: type) -> np.ndarray:
    """The sum over all blocks of work(rows of the block), `width` numbers of a kind.

    Each task adds up its own blocks, and as many tasks as the root of their number add up those sums, so that the driver
    gets few rows however many there are.
    """

    def summed(parts: Iterator[np.ndarray]) -> pa.RecordBatch:
        total = np.zeros(width, kind)
        for x in parts:
            total += x
        return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["t"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield summed(work(np.frombuffer(x.as_buffer(), np.int64).reshape(n, -1)) for b in batches for n, x in zip(b.column(0).to_pylist(), b.column(1)))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield summed(np.frombuffer(x.as_buffer(), kind) for b in batches for x in b.column(0))

    groups = max(1, isqrt(len(packed.inputFiles())))
    rows = packed.mapInArrow(add, "t binary").repartition(groups).mapInArrow(again, "t binary").collect()
    return sum((np.frombuffer(r["t"], kind) for r in rows), np.zeros(width, kind))


def bidiagonalise(packed: DataFrame, at: Centre, steps: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(right vectors as columns, bidiagonal) of the centred rows after so many steps, at most one for each dimension."""
    d = len(at.sums)
    steps = min(steps, d)
    random = np.random.default_rng(seed)
    v, y, xu = np.zeros((d, steps)), np.zeros((d, steps)), np.zeros((d, steps))
    b = np.zeros((steps, steps))

    def product(left: np.ndarray, j: int) -> tuple[float, np.ndarray, np.ndarray]:
        """Of u = X left over all rows: u·u, Xᵀu and the products with the first j left vectors."""
        known = y[:, :j].copy()

        def work(x: np.ndarray) -> np.ndarray:
            rows = at.centred(x)
            u = rows @ left
            out = np.zeros(1 + 2 * d)
            out[0], out[1 : d + 1], out[d + 1 : d + 1 + j] = u @ u, rows.T @ u, (rows @ known).T @ u
            return out

        t = _totals(packed, work, 1 + 2 * d, np.float64)
        return t[0], t[1 : d + 1], t[d + 1 : d + 1 + j]

    def orthogonal(w: np.ndarray, j: int) -> np.ndarray:
        for _ in range(2):
            w = w - v[:, :j] @ (v[:, :j].T @ w)
        return w

    v[:, 0] = random.standard_normal(d)
    v[:, 0] /= np.linalg.norm(v[:, 0])
    most = 0.0
    for j in range(steps):
        left = v[:, j] - (b[j - 1, j] * y[:, j - 1] if j else 0)
        for _ in range(3):
            uu, w, along = product(left, j)
            left, w, rest = left - y[:, :j] @ along, w - xu[:, :j] @ along, uu - along @ along
            if along @ along <= 1e-20 * uu:
                break
        alpha = np.sqrt(max(rest, 0.0))
        most = max(most, alpha)
        if alpha > 1e-10 * most:
            b[j, j], y[:, j], xu[:, j] = alpha, left / alpha, w / alpha
        else:  # v_j adds nothing to the left side: its left vector is nought, and so is its row of the bidiagonal
            alpha = 0.0
        if j + 1 == steps:
            break
        after = orthogonal(xu[:, j] - alpha * v[:, j], j + 1)
        beta = np.linalg.norm(after)
        if beta > 1e-10 * most:
            b[j, j + 1] = beta
        else:  # nothing more follows from this start: go on from a fresh direction
            after = orthogonal(random.standard_normal(d), j + 1)
            beta = np.linalg.norm(after)
        v[:, j + 1] = after / beta
        most = max(most, b[j, j + 1])
    return v, b


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    components: np.ndarray  # columns, by falling variance
    variances: np.ndarray
    total_variance: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components / np.sqrt(self.variances)


def fit(packed: DataFrame, d: int, components: int = 8, steps: int | None = None) -> Whitening:
    """Components and deviations of all rows. steps: fewer than the dimensions leave out directions, so only for long rows."""
    n, *sums = _totals(packed, lambda x: np.concatenate(([len(x)], x.sum(axis=0))), d + 1, np.int64).tolist()
    at = Centre(n, tuple(sums))
    v, b = bidiagonalise(packed, at, steps or d)
    _, s, qt = np.linalg.svd(b)
    axes, e = v @ qt.T, s**2 / n
    total = _totals(packed, lambda x: np.array([(at.centred(x) ** 2).sum()]), 1, np.float64)[0] / n
    take = [i for i in range(min(components, len(e))) if e[i] > 1e-12 * e[0] and e[i] > 0]
    axes = axes[:, take]
    return Whitening(at, axes * np.sign(np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None], 0)) if take else axes, e[take], total)


def identity_error(packed: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity, from a pass over all rows."""
    k = len(w.variances)

    def work(x: np.ndarray) -> np.ndarray:
        z = w.whiten(x)
        return np.concatenate((z.sum(axis=0), (z.T @ z).reshape(-1)))

    t = _totals(packed, work, k + k * k, np.float64) / w.centre.n
    return float(np.abs(t[k:].reshape(k, k) - np.outer(t[:k], t[:k]) - np.eye(k)).max())


OUT = "component int, n long, deviation long, deviation_exact decimal(38,0), whitened double, explained double, identity_error double"


def whitened(embeddings: DataFrame, components: int = 8, steps: int | None = None) -> DataFrame:
    """For every row that counts and each component: vec_id, component, n, deviation, deviation_exact, whitened, explained, identity_error."""
    rows = usable(embeddings, float(1 << 20))
    kind = dict(rows.dtypes)["vec_id"]
    packed = written(blocks(rows))
    first = rows.select(F.size("vec").alias("d")).first()
    w = fit(packed, first["d"], components, steps) if first else None
    if w is None or not len(w.variances):
        return rows.select("vec_id").where("false").selectExpr("vec_id", *[f"cast(null as {t}) as {c}" for c, t in (x.split(" ") for x in OUT.split(", "))])
    error, k, share = identity_error(packed, w), len(w.variances), w.variances / w.total_variance

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import decimal

        for b in batches:
            x = matrix(b.column(1), SCALE, SHIFT)
            rows_ = np.repeat(np.arange(len(x)), k)
            far = [far for far in w.centre.deviations(x) for _ in range(k)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(rows_)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(rows_), w.centre.n)),
                    pa.array([v if v < 2**63 else None for v in far], pa.int64()), pa.array([decimal.Decimal(v) for v in far], pa.decimal128(38, 0)),
                    pa.array(w.whiten(x).reshape(-1) if len(x) else np.zeros(0)), pa.array(np.tile(share, len(x))), pa.array(np.full(len(rows_), error)),
                ],
                ["vec_id", *[c.split(" ")[0] for c in OUT.split(", ")]],
            )

    return rows.select("vec_id", "vec").mapInArrow(out, f"vec_id {kind}, {OUT}")
