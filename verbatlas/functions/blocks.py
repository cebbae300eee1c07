"""NumPy helpers that run inside Spark tasks on one Arrow batch at a time.

Each works on a block of corpus vectors against a bounded block of reference
vectors (queries or cluster centres). Euclidean-like metrics are screened by one
matrix product, in single precision where a search looks at many pairs; every value that is
kept is then computed again row by row, so the screening never decides between close candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Cells of the largest temporary array in one step (8 bytes each, 4 in single precision).
CELLS = 1_000_000
TILE_CELLS = 32_768

# Distances are compared to so many decimals. Vectors at the same distance whose float
# sums differ in the last bits are then ordered by id, on every machine alike.
TIE_DIGITS = 9

SINGLE = 2.0**-24  # relative rounding of single precision


def to_matrix(column: pa.Array, dim: int | None = None) -> np.ndarray:
    """A list column as an (n, dim) float64 matrix; all rows must have one width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, dim or 0))
    widths = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    dim = dim or int(widths[0])
    if column.null_count or not (widths == dim).all():
        raise ValueError(f"every vector must have exactly {dim} components")
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(len(column), dim)


def to_lists(matrix: np.ndarray) -> pa.Array:
    n, dim = matrix.shape
    offsets = np.arange(0, (n + 1) * dim, dim, dtype=np.int32) if dim else np.zeros(n + 1, np.int32)
    return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(matrix).ravel())


def row_distance(a: np.ndarray, b: np.ndarray, metric: str, p: float = 2.0) -> np.ndarray:
    """Distance of row i of ``a`` to row i of ``b``."""
    if metric in ("euclidean", "sqeuclidean"):
        total = np.square(a - b).sum(axis=1)
        return np.sqrt(total) if metric == "euclidean" else total
    if metric == "cityblock":
        return np.abs(a - b).sum(axis=1)
    if metric == "chebyshev":
        return np.abs(a - b).max(axis=1)
    if metric == "minkowski":
        return (np.abs(a - b) ** p).sum(axis=1) ** (1.0 / p)
    if metric in ("cosine", "correlation"):
        if metric == "correlation":
            a = a - a.mean(axis=1, keepdims=True)
            b = b - b.mean(axis=1, keepdims=True)
        size = np.sqrt(np.square(a).sum(axis=1)) * np.sqrt(np.square(b).sum(axis=1))
        with np.errstate(invalid="ignore", divide="ignore"):
            return 1.0 - (a * b).sum(axis=1) / size
    if metric == "braycurtis":
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.abs(a - b).sum(axis=1) / np.abs(a + b).sum(axis=1)
    if metric == "canberra":
        size = np.abs(a) + np.abs(b)
        return np.divide(np.abs(a - b), size, out=np.zeros_like(size), where=size > 0).sum(axis=1)
    if metric == "hamming":
        return (a != b).mean(axis=1)
    if metric == "jensenshannon":
        usable = (a >= 0).all(axis=1) & (b >= 0).all(axis=1) & (a.sum(axis=1) > 0) & (b.sum(axis=1) > 0)
        with np.errstate(invalid="ignore", divide="ignore"):
            pp, qq = a / a.sum(axis=1, keepdims=True), b / b.sum(axis=1, keepdims=True)
            mid = (pp + qq) / 2
            left = np.where(pp > 0, pp * np.log(pp / mid), 0.0).sum(axis=1)
            right = np.where(qq > 0, qq * np.log(qq / mid), 0.0).sum(axis=1)
            return np.where(usable, np.sqrt(np.maximum((left + right) / 2, 0.0)), np.nan)
    raise ValueError(f"unknown metric {metric!r}")


def screen(vectors: np.ndarray, refs: np.ndarray, metric: str, p: float = 2.0) -> np.ndarray:
    """(len(refs), len(vectors)) values in the order of the distances, good to ``slack``.

    For the Euclidean distance these are squares; undefined distances become infinite.
    """
    if metric in ("euclidean", "sqeuclidean"):
        out = refs @ vectors.T
        out *= -2.0
        out += np.square(vectors).sum(axis=1)[None, :]
        out += np.square(refs).sum(axis=1)[:, None]
        return out
    if metric == "cosine":
        vv, rr = np.sqrt(np.square(vectors).sum(axis=1)), np.sqrt(np.square(refs).sum(axis=1))
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.nan_to_num(1.0 - (refs @ vectors.T) / rr[:, None] / vv[None, :], nan=np.inf)
    out = np.empty((len(refs), len(vectors)))
    if metric in ("cityblock", "chebyshev"):
        # Tiles of references whose differences to all vectors stay in the cache.
        tile = max(1, TILE_CELLS // max(vectors.size, 1))
        join = np.sum if metric == "cityblock" else np.max
        for i in range(0, len(refs), tile):
            out[i : i + tile] = join(np.abs(vectors[None] - refs[i : i + tile, None]), axis=2)
        return np.nan_to_num(out, copy=False, nan=np.inf)
    for i, ref in enumerate(refs):
        out[i] = row_distance(vectors, np.broadcast_to(ref, vectors.shape), metric, p)
    return np.nan_to_num(out, copy=False, nan=np.inf)


def screened_bound(bounds: np.ndarray, metric: str) -> np.ndarray:
    """Distances as values that compare with those of ``screen``."""
    return np.square(bounds) if metric == "euclidean" else bounds


def slack(vectors: np.ndarray, refs: np.ndarray, metric: str) -> float:
    """Width of the band around a screened value in which the true one lies.

    It covers rounding errors of the matrix product and distances that count as equal
    because they agree to nine decimals.
    """
    if len(vectors) == 0 or len(refs) == 0:
        return 0.0
    return _slack(np.sqrt(max(np.square(vectors).sum(axis=1).max(), np.square(refs).sum(axis=1).max())), metric)


def _slack(length: float, metric: str) -> float:
    if metric == "cosine":
        return 1e-6
    if metric in ("euclidean", "sqeuclidean"):
        return 2e-9 * (metric == "sqeuclidean") + 8e-9 * length + 1e-9 * length * length
    return 2e-9


class Single:
    """``screen`` in single precision for one set of references."""

    def __init__(self, refs: np.ndarray, metric: str):
        self.metric, self.n = metric, len(refs)
        squares = np.square(refs).sum(axis=1)
        self.usable = metric in ("euclidean", "sqeuclidean", "cityblock", "chebyshev") and len(refs) > 0
        self.square = squares.max() if len(refs) else 0.0
        if self.usable and self.square < 1e30:
            columns = np.column_stack((-2.0 * refs, squares, np.ones(len(refs)))) if "euclidean" in metric else refs.T
            self.refs = np.ascontiguousarray(columns, np.float32)

    def __call__(self, vectors: np.ndarray) -> tuple[np.ndarray, float] | None:
        """The values and the width of their band, which covers the rounding of both sides of a comparison.

        Nothing is returned for other metrics, for undefined numbers and for lengths whose squares single precision cannot hold.
        """
        if not self.usable or not len(vectors):
            return None
        dim, squares = vectors.shape[1], np.square(vectors).sum(axis=1)
        length = np.sqrt(max(self.square, squares.max()))
        if not 1e-12 < length < 1e15:
            return None
        if "euclidean" in self.metric:
            other = np.column_stack((vectors, np.ones(len(vectors)), squares)).astype(np.float32)
            return self.refs @ other.T, 8.8 * (dim + 8) * SINGLE * length**2 + _slack(length, self.metric)
        other = np.ascontiguousarray(vectors.T, np.float32)
        add = np.add if self.metric == "cityblock" else np.maximum
        out = _by_component(self.refs, other, add) if self.n < len(vectors) else _by_component(other, self.refs, add).T
        # No sum of absolute components is above sqrt(dim) times the length.
        return out, 4.4 * (dim + 4) * SINGLE * np.sqrt(dim) * length + _slack(length, self.metric)


def _by_component(a: np.ndarray, b: np.ndarray, add: np.ufunc) -> np.ndarray:
    """Absolute differences of all columns of ``a`` and ``b`` added up over the rows, in tiles that stay in the cache."""
    out = np.empty((a.shape[1], b.shape[1]), np.float32)
    wide = max(1, min(TILE_CELLS // 8, b.shape[1]))
    high = max(1, TILE_CELLS // wide)
    held = np.empty((2, high * wide), np.float32)
    for low in range(0, b.shape[1], wide):
        for top in range(0, a.shape[1], high):
            left, right = a[:, top : top + high], b[:, low : low + wide]
            shape = left.shape[1], right.shape[1]
            step, total = (h[: shape[0] * shape[1]].reshape(shape) for h in held)
            total[:] = 0.0
            for j in range(len(a)):
                np.subtract(right[j], left[j][:, None], out=step)
                np.abs(step, out=step)
                add(total, step, out=total)
            out[top : top + high, low : low + wide] = total
    return out


def step_rows(m: int, dim: int) -> int:
    """Rows that keep a (rows, m) and a (rows, dim) block below ``CELLS``."""
    return max(1, CELLS // max(m, dim, 1))


def _exact_pairs(a: np.ndarray, ai: np.ndarray, b: np.ndarray, bi: np.ndarray, metric: str, p: float) -> np.ndarray:
    out, rows = np.empty(len(ai)), step_rows(1, a.shape[1])
    for at in range(0, len(ai), rows):
        take = slice(at, at + rows)
        out[take] = row_distance(a[ai[take]], b[bi[take]], metric, p)
    return out


def nearest_ref(
    vectors: np.ndarray, refs: np.ndarray, metric: str, p: float = 2.0
) -> tuple[np.ndarray, np.ndarray]:
    """Index and exact distance of the closest reference; the first one wins a tie.

    A vector without any comparable reference (all distances undefined) gets -1.
    """
    n, dim = vectors.shape
    best, dist = np.full(n, -1, np.int64), np.full(n, np.nan)
    rows = step_rows(len(refs), dim)
    for start in range(0, n, rows):
        part = vectors[start : start + rows]
        approx = screen(part, refs, metric, p)
        limit = approx.min(axis=0) + slack(part, refs, metric)
        limit[~np.isfinite(limit)] = -np.inf
        ri, vi = np.nonzero(approx <= limit[None, :])
        exact = _exact_pairs(part, vi, refs, ri, metric, p)
        order = np.lexsort((ri, np.round(exact, TIE_DIGITS), vi))
        vi, ri, exact = vi[order], ri[order], exact[order]
        first = np.r_[True, vi[1:] != vi[:-1]] if len(vi) else np.zeros(0, bool)
        best[start + vi[first]] = ri[first]
        dist[start + vi[first]] = exact[first]
    return best, dist


def within(
    vectors: np.ndarray,
    refs: np.ndarray,
    metric: str,
    p: float,
    k: int,
    bounds: np.ndarray,
    tie: np.ndarray,
    place: np.ndarray | None = None,
    below: float | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` vectors of every reference: (ref index, vector index, exact distance).

    First means nearest, or lowest in ``place`` where that is given; what counts as equal is
    ordered by ``tie``. ``bounds`` holds a distance per reference beyond which none counts,
    ``below`` one that all must stay under. What has been found is cut to ``k`` per reference
    whenever it has doubled, so memory is that of ``k`` per reference and one step.

    Where single precision lets more than twice as many pass as can count, as among vectors that lie close
    together far from zero, a step is screened again in double precision.
    """
    limits = np.array(bounds, float)
    held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    waiting: list[tuple] = []
    size = 0

    def merge() -> None:
        nonlocal held, waiting, size
        ri, vi, dist = (np.concatenate(c) for c in zip(held, *waiting, strict=True))
        first = np.round(dist, TIE_DIGITS) if place is None else place[vi]
        top = keep_first(ri, [first, tie[vi]], k)
        held = ri[top], vi[top], dist[top]
        waiting, size = [], 0
        if place is None and len(top):
            found, start, counts = np.unique(held[0], return_index=True, return_counts=True)
            worst = np.maximum.reduceat(held[2], start)
            full = counts == k
            limits[found[full]] = np.minimum(limits[found[full]], worst[full])

    def candidates(part: np.ndarray, approx: np.ndarray, spare: float) -> np.ndarray:
        most = screened_bound(limits, metric) + spare
        if approx.dtype == np.float32:
            keep = approx <= np.nextafter(most.astype(np.float32), np.float32(np.inf))[:, None]
        else:
            keep = (approx <= most[:, None]) & np.isfinite(approx)
        if place is None and len(part) > k and np.count_nonzero(keep) > 2 * k * len(refs):
            kth = np.partition(approx, k - 1, axis=1)[:, k - 1].astype(np.float64) + spare
            keep &= approx <= np.nextafter(kth.astype(approx.dtype), approx.dtype.type(np.inf))[:, None]
        return np.flatnonzero(keep)

    single = Single(refs, metric)
    rows = step_rows(len(refs), vectors.shape[1])
    for start in range(0, len(vectors), rows):
        part = vectors[start : start + rows]
        found = None if (approx := single(part)) is None else candidates(part, *approx)
        if found is None or (place is None and len(found) > 2 * k * len(refs)):
            found = candidates(part, screen(part, refs, metric, p), slack(part, refs, metric))
        ri, vi = np.divmod(found, len(part))
        dist = _exact_pairs(part, vi, refs, ri, metric, p)
        if below is not None:
            ri, vi, dist = ri[dist < below], vi[dist < below], dist[dist < below]
        waiting.append((ri, vi + start, dist))
        size += len(ri)
        if size >= max(min(CELLS, k * len(refs)), len(held[0])):
            merge()
    merge()
    return held


def keep_first(group: np.ndarray, orders: list[np.ndarray], n: int) -> np.ndarray:
    """Positions of the first ``n`` rows of every group under the given sort keys."""
    if len(group) == 0:
        return np.zeros(0, np.int64)
    order = np.lexsort((*reversed(orders), group))
    sorted_group = group[order]
    starts = np.flatnonzero(np.r_[True, sorted_group[1:] != sorted_group[:-1]])
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[place < n]
