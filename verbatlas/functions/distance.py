"""Vector metrics as column expressions over two ``array<double>`` columns.

These are for pairs that a join has already formed. Searching and assigning, where
one side meets a whole block of vectors, use :mod:`verbatlas.functions.blocks`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two vectors closer than this count as the same (fixed value).
SAME_VECTOR_TOLERANCE = 1e-4


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _pairs(a: Column, b: Column, f: Callable[[Column, Column], Column]) -> Column:
    return F.zip_with(as_double(a), as_double(b), f)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, not once per element of a lambda."""
    return F.transform(F.array(value), body)[0]


def dot(a: Column, b: Column) -> Column:
    return _sum(_pairs(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def sqeuclidean(a: Column, b: Column) -> Column:
    return _sum(_pairs(a, b, lambda x, y: (x - y) * (x - y)))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(sqeuclidean(a, b))


def cityblock(a: Column, b: Column) -> Column:
    return _sum(_pairs(a, b, lambda x, y: F.abs(x - y)))


def chebyshev(a: Column, b: Column) -> Column:
    return F.array_max(_pairs(a, b, lambda x, y: F.abs(x - y)))


def minkowski(a: Column, b: Column, p: float = 2.0) -> Column:
    powers = _pairs(a, b, lambda x, y: F.pow(F.abs(x - y), F.lit(float(p))))
    return F.pow(_sum(powers), F.lit(1.0 / p))


def cosine(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.try_divide(dot(a, b), norm(a) * norm(b))


def _centred(a: Column) -> Column:
    mean = F.try_divide(_sum(as_double(a)), F.size(a).cast("double"))
    return _let(mean, lambda m: F.transform(as_double(a), lambda x: x - m))


def correlation(a: Column, b: Column) -> Column:
    both = F.struct(_centred(a).alias("a"), _centred(b).alias("b"))
    return _let(both, lambda c: cosine(c["a"], c["b"]))


def braycurtis(a: Column, b: Column) -> Column:
    return F.try_divide(cityblock(a, b), _sum(_pairs(a, b, lambda x, y: F.abs(x + y))))


def canberra(a: Column, b: Column) -> Column:
    def term(x: Column, y: Column) -> Column:
        size = F.abs(x) + F.abs(y)
        return F.when(size == 0.0, F.lit(0.0)).otherwise(F.abs(x - y) / size)

    return _sum(_pairs(a, b, term))


def jensenshannon(a: Column, b: Column) -> Column:
    """Null when a component is negative or a vector sums to zero."""
    a, b = as_double(a), as_double(b)

    def part(p: Column, q: Column) -> Column:
        def rel(v: Column) -> Column:
            return F.when(v == 0.0, F.lit(0.0)).otherwise(v * F.ln(v * 2 / (p + q)))

        return rel(p) + rel(q)

    def root(total: Column) -> Column:
        def shares(x: Column, y: Column) -> Column:
            return part(x / total["p"], y / total["q"])

        divergence = _sum(F.zip_with(a, b, shares)) / 2
        usable = (F.array_min(a) >= 0) & (F.array_min(b) >= 0) & (total["p"] > 0) & (total["q"] > 0)
        return F.when(usable, F.sqrt(F.greatest(divergence, F.lit(0.0))))

    return _let(F.struct(_sum(a).alias("p"), _sum(b).alias("q")), root)


def hamming(a: Column, b: Column) -> Column:
    unequal = _pairs(a, b, lambda x, y: F.when(x == y, F.lit(0.0)).otherwise(F.lit(1.0)))
    return F.try_divide(_sum(unequal), F.size(a).cast("double"))


METRICS: dict[str, Callable[..., Column]] = {
    "euclidean": euclidean,
    "sqeuclidean": sqeuclidean,
    "cityblock": cityblock,
    "cosine": cosine,
    "correlation": correlation,
    "chebyshev": chebyshev,
    "minkowski": minkowski,
    "braycurtis": braycurtis,
    "canberra": canberra,
    "jensenshannon": jensenshannon,
    "hamming": hamming,
}


def distance(a: Column, b: Column, metric: str = "euclidean", p: float = 2.0) -> Column:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose one of {sorted(METRICS)}")
    return minkowski(a, b, p) if metric == "minkowski" else METRICS[metric](a, b)


def same_vector(a: Column, b: Column, tolerance: float = SAME_VECTOR_TOLERANCE) -> Column:
    return euclidean(a, b) < F.lit(tolerance)
