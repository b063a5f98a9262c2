"""Whitening of embeddings through the singular values of their centred rows.

Rows are reduced to an upper triangle block by block (QR in the tasks, triangles combined by eights), the triangle is
made bidiagonal by Householder reflections, dqds finds the squared singular values to high relative accuracy, and
twisted factorisations of the bidiagonal form give the directions. What the driver holds is one triangle, whose size is
the square of the dimension.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import staged

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny

# Rows stacked below a triangle before each reduction, and triangles that one task combines.
QR_ROWS = 4096
FAN_IN = 8


# --- dense work on one triangle ---------------------------------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of `r` = U B V' by Householder reflections from both sides."""
    a, d = r.copy(), r.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if norm == 0 or not x[1:].any():
            return None
        w = x / norm
        w[0] += math.copysign(1.0, w[0])
        return w / np.linalg.norm(w)

    for k in range(d):
        w = reflector(a[k:, k])
        if w is not None:
            a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
        if k < d - 2:
            w = reflector(a[k, k + 1 :])
            if w is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One dqds transform of a qd array; None if the shift was above the smallest eigenvalue."""
    n = len(q)
    out_q, out_e, ds = [0.0] * n, [0.0] * (n - 1), []
    d = q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return None
        ds.append(d)
        out_q[i] = top = max(d + e[i], TINY)
        ratio = q[i + 1] / top
        out_e[i] = e[i] * ratio
        d = d * ratio - shift
    if d < 0:
        return None
    ds.append(d)
    out_q[-1] = d
    return out_q, out_e, ds


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Eigenvalues of B'B, falling, by dqds with shifts from below: none is lost by cancellation.

    An unshifted sweep bounds the smallest eigenvalue from below (one over the trace of the inverse); a sweep with that
    bound as shift follows. Values split off at the end, or where an off-diagonal entry is negligible.
    """
    found: list[float] = []
    work = [([x * x for x in map(float, diagonal)], [x * x for x in map(float, above)], 0.0)]
    small = (10 * EPS) ** 2
    while work:
        q, e, sigma = work.pop()
        while q:
            n = len(q)
            if n == 1 or e[-1] <= small * (sigma + q[-1]) or (q[-1] + e[-1] <= TINY):
                found.append(sigma + q[-1])
                q, e = q[:-1], e[:-1]
                continue
            split = next((i for i in range(n - 1) if e[i] <= small * sigma or e[i] <= small * small * q[i]), None)
            if split is not None:
                work.append((q[: split + 1], e[:split], sigma))
                q, e = q[split + 1 :], e[split + 1 :]
                continue
            q, e, ds = _sweep(q, e, 0.0)
            if min(ds) <= TINY:
                continue
            shift = (1 - 4 * EPS * n) / math.fsum(1 / x for x in ds)
            moved = _sweep(q, e, shift) if shift > EPS * EPS * sigma else None
            if moved is not None:
                q, e, sigma = moved[0], moved[1], sigma + shift
    return np.sort(np.array(found))[::-1]


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float, start: np.ndarray | None = None) -> np.ndarray:
    """Unit vector of B'B for `value`: the stationary factorisation from the top meets the progressive one from the
    bottom where the rest of the equation is smallest. With `start`, one step of inverse iteration from there instead."""
    n = len(diagonal)
    pivots, lower = diagonal * diagonal, above / diagonal[:-1]
    floor = EPS * EPS * max(float(pivots.max()), TINY)

    def safe(x: float) -> float:
        return x if abs(x) > floor else math.copysign(floor, x)

    s, down, plus = np.empty(n), np.empty(n - 1), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        plus[i] = safe(s[i] + pivots[i])
        down[i] = pivots[i] * lower[i] / plus[i]
        s[i + 1] = down[i] * lower[i] * s[i] - value
    plus[-1] = safe(s[-1] + pivots[-1])
    if start is not None:
        z = start.copy()
        for i in range(n - 1):
            z[i + 1] -= down[i] * z[i]
        z /= plus
        for i in range(n - 2, -1, -1):
            z[i] -= down[i] * z[i + 1]
        return z / np.linalg.norm(z)
    p, up = np.empty(n), np.empty(n - 1)
    p[-1] = pivots[-1] - value
    for i in range(n - 2, -1, -1):
        minus = safe(pivots[i] * lower[i] ** 2 + p[i + 1])
        ratio = pivots[i] / minus
        up[i] = lower[i] * ratio
        p[i] = p[i + 1] * ratio - value
    k = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` largest eigenvalues of r'r, without those that rounding cannot tell from 0, and their unit vectors as columns.

    Vectors of a cluster, which one value does not tell apart, are made orthogonal by inverse iteration.
    """
    d = r.shape[1]
    scale = float(np.abs(r).max()) if r.size else 0.0
    if scale == 0.0:
        return np.zeros(0), np.zeros((d, 0))
    diagonal, above, v = bidiagonal(r / scale)
    values = squared_singular_values(diagonal, above)
    values = values[: min(most, int((values > values[0] * (d * EPS) ** 2).sum()))]
    # A zero on the diagonal would hide the entries beside it from the factorisations.
    filled = np.where(np.abs(diagonal) > EPS * TINY**0.5, diagonal, EPS * EPS)
    columns: list[np.ndarray] = []
    draw = np.random.default_rng(12)
    for value in values:
        z = _twisted(filled, above, float(value)) if d > 1 else np.ones(1)
        before = np.array(columns).T if columns else np.zeros((d, 0))
        left = z - before @ (before.T @ z)
        if np.linalg.norm(left) < 0.999:
            left = draw.standard_normal(d)
            for _ in range(4):
                left -= before @ (before.T @ left)
                left = _twisted(filled, above, float(value), left / np.linalg.norm(left))
        left -= before @ (before.T @ left)
        columns.append(left / np.linalg.norm(left))
    vectors = v @ np.array(columns).T
    return values * scale * scale, vectors


# --- jobs -------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: exact row count and sums of the fit list, directions, eigenvalues, share of the variance of each."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = math.nan

    def _offsets(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean as whole part and rest over n, so that differences from it are exact before the last rounding."""
        parts = [divmod(s, self.n) for s in self.sums]
        return np.array([q for q, _ in parts], np.int64), np.array([r for _, r in parts], object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole, rest = self._offsets()
        return (x - whole).astype(float) - np.array([r / self.n for r in rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.directions / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S) squared, exact; None where it does not fit a long."""
        whole, rest = self._offsets()
        y = x - whole
        most, most_rest = int(np.abs(y).max(initial=0)), max([*map(int, rest), 1])
        kind = np.int64 if most * max(most, most_rest) * max(1, len(whole)) < 2**62 else object
        y, rest = y.astype(kind), rest.astype(kind)
        squares, products = (y * y).sum(axis=1), (y * rest).sum(axis=1)
        constant = sum(int(r) ** 2 for r in rest)
        exact = [self.n * self.n * int(a) - 2 * self.n * int(b) + constant for a, b in zip(squares, products)]
        return [v if v < 2**63 else None for v in exact]


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """Staged rows (id, x): entries times `scale`, rounded down. Without rows whose vector is null, or has null or
    non-finite entries, or another length than most rows (of equally frequent lengths the greatest)."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = vectors.filter(F.col(vector_col).isNotNull()).filter(~bad)
    x = F.transform(v, lambda c: F.floor(c * scale))
    rows = staged(kept.select(F.col(id_col).alias("id"), x.alias("x")), "whitening-rows")
    # One row for each length.
    most = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.filter(F.size("x") == (most["d"] if most else 0))


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    lists = batch.column(batch.schema.names.index(column))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _triangle(stack: np.ndarray) -> np.ndarray:
    return np.linalg.qr(stack, mode="r")


def _as_rows(triangle: np.ndarray, part: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([triangle.astype(float).tobytes()], pa.binary())], names=["part", "triangle"]
    )


def triangle_of(rows: DataFrame, centre, d: int) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""

    def reduce(batches):
        r, held, waiting = np.zeros((0, d)), [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(centre(_matrix(batch)))
                waiting += batch.num_rows
            if waiting >= QR_ROWS:
                r, held, waiting = _triangle(np.vstack([r, *held])), [], 0
        if held:
            r = _triangle(np.vstack([r, *held]))
        if len(r):
            yield _as_rows(r, 0)

    def combine(group: pa.Table) -> pa.Table:
        r = np.zeros((0, d))
        for raw in group.column("triangle").to_pylist():
            r = _triangle(np.vstack([r, np.frombuffer(raw).reshape(-1, d)]))
        return pa.Table.from_batches([_as_rows(r, group.column("part")[0].as_py())])

    schema = "part bigint, triangle binary"
    left = staged(rows.select("x").mapInArrow(reduce, schema).withColumn("part", F.monotonically_increasing_id()), "whitening-triangles")
    while (count := left.count()) > 1:
        groups = math.ceil(count / FAN_IN)
        dealt = left.withColumn("part", F.pmod(F.xxhash64("triangle"), F.lit(groups)))
        left = staged(dealt.groupBy("part").applyInArrow(combine, schema), "whitening-triangles")
    found = left.first()
    r = np.frombuffer(bytes(found["triangle"])).reshape(-1, d) if found else np.zeros((0, d))
    return np.vstack([r, np.zeros((max(0, d - len(r)), d))])


def fit(rows: DataFrame, most: int = 4) -> Whitening | None:
    """Whitening of the distinct vectors of `rows` (id, x; see `whole_numbers`) in up to `most` directions, with the
    measured distance of its covariance from the identity. None without rows."""
    distinct = staged(rows.select("x").distinct(), "whitening-fit")
    n = distinct.count()
    if not n:
        return None
    d = len(distinct.first()["x"])

    def sums_of(batches):
        # Python numbers: no sum overflows.
        total = [0] * d
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                wide = np.abs(x).max(initial=0) >= 2**62 // max(1, len(x))
                total = [a + int(b) for a, b in zip(total, (x.astype(object) if wide else x).sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([str(t) for t in total], pa.string())], names=["place", "total"])

    sums = distinct.mapInArrow(sums_of, "place int, total string").groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    exact = tuple(int(r["total"]) for r in sums.orderBy("place").collect())
    start = Whitening(n, exact, np.zeros((d, 0)), np.zeros(0), np.zeros(0))
    r = triangle_of(distinct, start.centred, d)
    values, vectors = directions(r, most)
    total = float((r * r).sum())
    model = Whitening(n, exact, vectors, values / n, values / total if total else values)
    k = len(values)

    def moments(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(_matrix(batch))
                total[0] += w.sum(axis=0)
                total[1:] += w.T @ w
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], names=["place", "total"])

    if not k:
        return model
    pieces = distinct.mapInArrow(moments, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    measured = np.array([r["total"] for r in pieces.orderBy("place").collect()]).reshape(k + 1, k) / n
    covariance = measured[1:] - np.outer(measured[0], measured[0])
    return Whitening(n, exact, vectors, values / n, model.explained, float(np.abs(covariance - np.eye(k)).max()))


def whitened(vectors: DataFrame, most: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """Per usable row of `vectors` and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or has null or non-finite entries, or another length than most rows, have no result.
    Equal vectors count once in the fit. Null and repeated ids are results like any other. There are as many components
    as directions with variance, `most` at most; none if all vectors are equal. `deviation` is null where it does not
    fit a long. Other columns are not read. An empty table gives an empty one.
    """
    schema = f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = whole_numbers(vectors, id_col, vector_col, scale)
    model = fit(rows, most)
    k = len(model.values) if model else 0
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)

    def project(batches):
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = _matrix(batch)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(m), k)))
            columns = [
                ids,
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n, np.int64)),
                pa.array([v for v in model.deviation(x) for _ in range(k)], pa.int64()),
                pa.array(model.whitened(x).ravel()),
                pa.array(np.tile(model.explained, m)),
                pa.array(np.full(m * k, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col("id"), "x").mapInArrow(project, schema)
