"""Operator 11, embedding whitening: principal directions by a bidiagonal qd solver.

Entries become whole numbers, ``floor(1024 c) + 100000``, whose sums per dimension are exact. Each task
reduces its centred rows block by block to the triangle of a QR factorisation; triangles are merged in
groups of ``MERGE`` until one is left. Householder reflections make it bidiagonal, dqds finds its
singular values to high relative accuracy, and twisted factorisations give the vectors of the largest
ones. No covariance is formed on the way; one more pass measures that of the whitened rows.

Rows are only scanned. Between the scans there are, per width of the vectors, one mean, one triangle per
task (width x width, merged in tasks) and the directions; means and directions come to the driver, their
size is that of ten vectors.

Defined results: a row whose vector is null, or holds a null, a non-finite entry or one with
``|1024 c| >= 2**62`` (no long), is left out. Vectors of different widths have a fit each, and ``n`` counts
those of the row's width; empty vectors give no rows. A component whose eigenvalue is zero to rounding
(equal rows, fewer rows than dimensions) cannot be whitened and gives no rows, so a single vector gives
none. Rows with a null id or a repeated one are all returned. ``deviation`` is null where it exceeds a long.
An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.session import materialise, spread

COMPONENTS = 8
SCALE, OFFSET = 1024.0, 100_000
LARGEST = 2.0**62
BLOCK_CELLS = 1 << 20  # entries of a block of rows that is reduced at once
MERGE = 16  # triangles merged by one task
EPS = float(np.finfo(float).eps)
LONG = 2.0**63


# --- the solver, on one triangle ---


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit ``v`` with ``x - 2 v (v . x)`` zero behind its first entry, and that entry."""
    size = float(np.linalg.norm(x))
    v = x.copy()
    if size == 0.0:
        return v, 0.0
    target = -size if x[0] >= 0 else size
    v[0] -= target
    return v / np.linalg.norm(v), target


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Diagonal and upper diagonal of ``Qt A P`` for a square ``A``, and the reflections that make up ``P``."""
    a = np.array(matrix, float)
    n = len(a)
    rights = []
    for k in range(n):
        v, _ = _reflector(a[k:, k])
        a[k:, k:] -= 2.0 * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v, _ = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ v, v)
            rights.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, 1).copy(), rights


def _sweep(q: list, e: list, tau: float) -> tuple[list, list, float, bool]:
    """One differential qd step with a shift: the new arrays, the least pivot, whether only the last is negative."""
    new_q, new_e = [0.0] * len(q), [0.0] * len(e)
    d = q[0] - tau
    least = d
    for k in range(len(e)):
        if d < 0.0:
            return new_q, new_e, d, False
        new_q[k] = total = d + e[k]
        ratio = q[k + 1] / total if total > 0.0 else 0.0
        new_e[k] = e[k] * ratio
        d = d * ratio - tau if total > 0.0 else q[k + 1] - tau
        least = min(least, d)
    new_q[-1] = d
    return new_q, new_e, least, True


def _pair(a: float, b: float, e: float) -> tuple[float, float]:
    """Both eigenvalues of a qd pair, the larger one first."""
    large = (a + b + e + ((a - b - e) ** 2 + 4.0 * a * e) ** 0.5) / 2.0
    return large, (a * (b / large) if large > 0.0 else 0.0)


def squares(diagonal: np.ndarray, upper: np.ndarray) -> list[float]:
    """Squared singular values of an upper bidiagonal matrix by dqds, largest first."""
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0))
    if scale == 0.0:
        return [0.0] * len(diagonal)
    tiny = (4.0 * EPS) ** 2
    found: list[float] = []
    waiting = [(list(np.square(diagonal / scale)), list(np.square(upper / scale)), 0.0)]
    while waiting:
        q, e, base = waiting.pop()
        while len(q) > 2:
            cut = next((k for k in range(len(e)) if e[k] <= tiny * (base + min(q[k], q[k + 1]))), None)
            if cut is not None:
                waiting.append((q[: cut + 1], e[:cut], base))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:  # the small end comes last
                q, e = q[::-1], e[::-1]
            tau = _pair(q[-2], q[-1], e[-1])[1] * (1.0 - 4.0 * EPS)
            for attempt in range(5):
                new_q, new_e, least, late = _sweep(q, e, tau)
                if least >= 0.0:
                    break
                tau = max(tau + least, 0.0) * (1.0 - 4.0 * EPS) if late and attempt == 0 else tau / 4.0
                if attempt == 3:
                    tau = 0.0  # always possible
            q, e, base = new_q, new_e, base + tau
        if len(q) == 2:
            found += [base + x for x in _pair(q[0], q[1], e[0])]
        elif q:
            found.append(base + q[0])
    return sorted((x * scale * scale for x in found), reverse=True)


class _Twisted:
    """The factorisation of ``Bt B - value`` that meets at the row where its pivot is least."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float):
        n = len(a)
        pivots, links = np.square(a), b / a[:-1]
        down, low, s = np.empty(n), np.empty(n - 1), np.empty(n)
        floor = EPS * EPS * max(float(pivots.max()), value) + np.finfo(float).tiny
        safe = lambda x: x if abs(x) > floor else floor
        s[0] = -value
        for k in range(n - 1):
            down[k] = safe(pivots[k] + s[k])
            low[k] = pivots[k] * links[k] / down[k]
            s[k + 1] = low[k] * links[k] * s[k] - value
        up, high, p = np.empty(n), np.empty(n - 1), np.empty(n)
        p[-1] = pivots[-1] - value
        for k in range(n - 2, -1, -1):
            up[k + 1] = safe(pivots[k] * links[k] ** 2 + p[k + 1])
            high[k] = pivots[k] * links[k] / up[k + 1]
            p[k] = p[k + 1] * (pivots[k] / up[k + 1]) - value
        down[-1] = up[0] = 0.0
        self.gamma = s + p + value
        self.at = int(np.abs(self.gamma).argmin())
        self.down, self.low, self.up, self.high, self.floor = down, low, up, high, floor

    def vector(self) -> np.ndarray:
        """The solution for the unit vector of the twist."""
        z = np.zeros(len(self.down))
        z[self.at] = 1.0
        for k in range(self.at - 1, -1, -1):
            z[k] = -self.low[k] * z[k + 1]
        for k in range(self.at, len(z) - 1):
            z[k + 1] = -self.high[k] * z[k]
        return z

    def solve(self, x: np.ndarray) -> np.ndarray:
        """One step of inverse iteration."""
        y = x.copy()
        for k in range(self.at):
            y[k + 1] -= self.low[k] * y[k]
        for k in range(len(y) - 1, self.at, -1):
            y[k - 1] -= self.high[k - 1] * y[k]
        gamma = self.gamma[self.at]
        y[: self.at] /= self.down[: self.at]
        y[self.at + 1 :] /= self.up[self.at + 1 :]
        y[self.at] /= gamma if abs(gamma) > self.floor else self.floor
        for k in range(self.at - 1, -1, -1):
            y[k] -= self.low[k] * y[k + 1]
        for k in range(self.at, len(y) - 1):
            y[k + 1] -= self.high[k] * y[k]
        return y / np.abs(y).max()


def _apart(z: np.ndarray, known: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """Unit vector orthogonal to the known ones, and what was left of the length."""
    z = z / np.linalg.norm(z)
    left = 1.0
    for _ in range(2):
        for w in known:
            z = z - w * (w @ z)
        size = float(np.linalg.norm(z))
        if size == 0.0:
            return z, 0.0
        left, z = left * size, z / size
    return z, left


def _direction(a: np.ndarray, b: np.ndarray, value: float, known: list[np.ndarray]) -> np.ndarray:
    """Unit right singular vector of one unreduced block for a squared singular value."""
    if len(a) == 1:
        return np.ones(1)
    z = None
    for _ in range(2):  # the second step corrects the value by its Rayleigh quotient
        twisted = _Twisted(a, b, value)
        z = twisted.vector()
        size = float(z @ z)
        value += float(twisted.gamma[twisted.at]) / size if np.isfinite(size) else 0.0
    z, left = _apart(z, known) if np.isfinite(z).all() else (z, 0.0)
    if left < 0.9:  # close to the value of a known vector: inverse iteration beside those
        z = np.random.default_rng(len(known)).standard_normal(len(a)) if left < 1e-3 else z
        for _ in range(4):
            z, _ = _apart(z, known)
            z = twisted.solve(z)
        z, _ = _apart(z, known)
    return z


def directions(triangle: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of ``Rt R`` above rounding, falling, and their unit vectors as columns."""
    n = triangle.shape[1]
    square = np.zeros((n, n))
    square[: min(n, len(triangle))] = triangle[:n]
    scale = float(np.abs(square).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(0), np.zeros((n, 0))
    a, b, rights = bidiagonalise(square / scale)
    size = float(np.abs(a).max() + np.abs(b).max(initial=0.0))
    cuts = [0, *(np.flatnonzero(np.abs(b) <= EPS * size * 0.01) + 1).tolist(), n]
    small = EPS * size * 0.01
    a = np.where(np.abs(a) < small, np.where(a < 0, -small, small), a)
    found = []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        found += [(value, low, high) for value in squares(a[low:high], b[low : high - 1])[:count]]
    found.sort(key=lambda f: (-f[0], f[1]))
    found = [f for f in found[:count] if f[0] > (n * EPS) ** 2 * found[0][0]]
    known: dict[int, list] = {}
    out = np.zeros((n, len(found)))
    for j, (value, low, high) in enumerate(found):
        z = _direction(a[low:high], b[low : high - 1], value, known.setdefault(low, []))
        known[low].append(z)
        out[low:high, j] = z
    for start, v in reversed(rights):
        out[start:] -= 2.0 * np.outer(v, v @ out[start:])
    return np.array([f[0] for f in found]) * scale * scale, out


# --- rows ---


@dataclass(frozen=True)
class Fit:
    """One width: ``n`` vectors, their mean as ``base + rest / n``, directions and eigenvalues."""

    n: int
    base: np.ndarray  # whole part of the mean
    rest: np.ndarray  # what is left of the sums, 0 <= rest < n
    axes: np.ndarray
    values: np.ndarray
    shares: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(float) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum over dimensions of ``(n x - S)^2`` and whether it fits a long.

        Arithmetic modulo 2**64 is exact wherever the result fits; only values at the very limit
        are worked out once more in whole numbers of any size.
        """
        about = np.square(self.centred(x) * self.n).sum(axis=1)
        with np.errstate(over="ignore"):
            apart = (x - self.base) * np.int64(self.n) - self.rest
            exact = np.square(apart).sum(axis=1)
        fits = about < LONG * (1 - 1e-9)
        for i in np.flatnonzero(~fits & (about < LONG * (1 + 1e-9))):
            value = sum((self.n * (int(v) - int(m)) - int(r)) ** 2 for v, m, r in zip(x[i], self.base, self.rest, strict=True))
            fits[i] = value < 2**63
            exact[i] = value if fits[i] else 0
        return exact, fits


def _longs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows that remain, by width: their places in the batch and their entries as whole numbers."""
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    entries = pc.fill_null(column.values, float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = entries * SCALE
        bad = ~(np.abs(scaled) < LARGEST)
    numbers = np.floor(np.where(bad, 0.0, scaled)).astype(np.int64) + OFFSET
    before = np.r_[0, np.cumsum(bad)]
    widths = np.diff(offsets)
    good = column.is_valid().to_numpy(zero_copy_only=False) & (before[offsets[1:]] == before[offsets[:-1]]) & (widths > 0)
    for width in np.unique(widths[good]).tolist():
        rows = np.flatnonzero(good & (widths == width))
        step = max(2 * width, BLOCK_CELLS // width)
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            yield width, some, numbers[offsets[some][:, None] + np.arange(width)]


def _rows(df: DataFrame, item_id: str, vector: str) -> DataFrame:
    column = F.col(vector).cast("array<double>")
    return spread(df.select(F.col(item_id).cast("long").alias("id"), column.alias("entries")))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums per width and dimension; 24 bits apart, so that no batch overflows."""
    total: dict[int, list] = {}
    for batch in batches:
        for width, _, x in _longs(batch.column("entries")):
            held = total.setdefault(width, [0, np.zeros(width, object)])
            held[0] += len(x)
            high, low = (x >> 24).sum(axis=0), (x & 0xFFFFFF).sum(axis=0)
            held[1] += high.astype(object) * (1 << 24) + low.astype(object)
    for width, (n, sums) in total.items():
        columns = [pa.array([width] * width), pa.array(range(width)), pa.array([n] * width)]
        columns.append(pa.array([str(s) for s in sums], pa.string()))
        yield pa.RecordBatch.from_arrays(columns, ["width", "dim", "n", "s"])


def _triangle(held: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if held is None else np.vstack([held, rows]), mode="r")


def _merged(group: pd.DataFrame) -> tuple[int, np.ndarray]:
    """One triangle from those of a group, always in the same order."""
    width, held = int(group.width.iloc[0]), None
    for flat in group.sort_values("source").r:
        held = _triangle(held, np.asarray(flat, float).reshape(-1, width))
    return width, held


def _merge_group(group: pd.DataFrame) -> pd.DataFrame:
    width, r = _merged(group)
    return pd.DataFrame({"width": [width], "source": [int(group.source.min())], "r": [r.ravel()]})


def fit(df: DataFrame, item_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of every width that occurs."""
    rows = _rows(df, item_id, vector)
    spark = df.sparkSession
    sums = rows.select("entries").mapInArrow(_sums, "width long, dim long, n long, s string")
    sums = sums.groupBy("width", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    means: dict[int, Fit] = {}
    none = np.zeros(0), np.zeros(0), np.zeros(0)
    for width, part in sums.toPandas().sort_values("dim").groupby("width"):
        n, total = int(part.n.iloc[0]), [int(s) for s in part.s]
        means[int(width)] = Fit(n, np.array([s // n for s in total]), np.array([s % n for s in total]), *none)
    if not means:
        return {}
    shared = spark.sparkContext.broadcast(means)

    def factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, _, x in _longs(batch.column("entries")):
                held[width] = _triangle(held.get(width), shared.value[width].centred(x))
        source = TaskContext.get().partitionId()
        for width, r in held.items():
            columns = [pa.array([width]), pa.array([source], pa.int64()), pa.array([r.ravel()], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["width", "source", "r"])

    schema = "width long, source long, r array<double>"
    triangles = materialise(rows.select("entries").mapInArrow(factors, schema), "triangles")
    parts = (triangles.agg(F.max("source")).first()[0] or 0) + 1
    while parts > MERGE:
        parts = -(-parts // MERGE)
        groups = triangles.groupBy("width", F.pmod("source", F.lit(parts)).alias("_group"))
        triangles = groups.applyInPandas(_merge_group, schema)
        triangles = materialise(triangles, "triangles")

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        width, r = _merged(group)
        values, axes = directions(r, components)
        total = float(np.square(r).sum())
        share = values / total if total else values
        order = range(1, len(values) + 1)
        axis = pd.Series(list(axes.T), dtype=object)
        return pd.DataFrame({"width": width, "component": order, "value": values, "share": share, "axis": axis})

    solved = triangles.groupBy("width").applyInPandas(solve, "width long, component int, value double, share double, axis array<double>")
    out = {}
    for width, part in solved.toPandas().sort_values("component").groupby("width"):
        m = means[int(width)]
        out[int(width)] = Fit(m.n, m.base, m.rest, np.stack(part.axis).T, part.value.to_numpy() / m.n, part.share.to_numpy())
    return out


def whiten(df: DataFrame, fits: dict[int, Fit], item_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, width, component, n, deviation, whitened, explained`` of every remaining row and component."""
    shared = df.sparkSession.sparkContext.broadcast(fits)
    names = ["id", "width", "component", "n", "deviation", "whitened", "explained"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, places, x in _longs(batch.column("entries")):
                f = shared.value.get(width)
                if f is None:
                    continue
                k, rows = len(f.values), len(x)
                exact, fits_long = f.deviations(x)
                columns = [
                    batch.column("id").take(pa.array(np.repeat(places, k))),
                    pa.array(np.full(rows * k, width), pa.int64()),
                    pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                    pa.array(np.full(rows * k, f.n), pa.int64()),
                    pa.array(np.repeat(exact, k), pa.int64(), mask=np.repeat(~fits_long, k)),
                    pa.array(f.whitened(x).ravel()),
                    pa.array(np.tile(f.shares, rows)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "id long, width long, component int, n long, deviation long, whitened double, explained double"
    return _rows(df, item_id, vector).mapInArrow(run, schema)


def identity_errors(df: DataFrame, fits: dict[int, Fit], item_id: str = "vec_id", vector: str = "embedding") -> dict[int, float]:
    """Per width, how far the covariance of the whitened rows is from the identity at most."""
    shared = df.sparkSession.sparkContext.broadcast(fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, _, x in _longs(batch.column("entries")):
                if width in shared.value:
                    y = np.hstack([shared.value[width].whitened(x), np.ones((len(x), 1))])
                    held[width] = held.get(width, 0.0) + y.T @ y
        for width, sums in held.items():
            cells = pa.array(range(sums.size), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([width] * sums.size), cells, pa.array(sums.ravel())], ["width", "cell", "x"])

    parts = _rows(df, item_id, vector).select("entries").mapInArrow(run, "width long, cell long, x double")
    out = {}
    for width, part in parts.groupBy("width", "cell").agg(F.sum("x").alias("x")).toPandas().sort_values("cell").groupby("width"):
        k = len(shared.value[int(width)].values)
        sums = part.x.to_numpy().reshape(k + 1, k + 1) / shared.value[int(width)].n
        covariance = sums[:k, :k] - np.outer(sums[:k, k], sums[:k, k])
        out[int(width)] = float(np.abs(covariance - np.eye(k)).max(initial=0.0))
    return out
