"""Distance functions: every vector against the mean of its own label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verbatlas.functions import distance as D
from verbatlas.operators.cluster import mean_vectors
from verbatlas.operators.nearest import nearest
from verbatlas.registry import ORACLES, QUERIES, query
from verbatlas.registry.common import MEANS, V, vectors
from verbatlas.session import broadcast_if_small, materialise

_PAIRS = f"with {V}, {MEANS}, pairs as (select label, v.vec_id, v.e as a, cen.c as b from v join cen using (label))"
_ALL = f"with {V}, {MEANS}, pairs as (select cen.label, v.vec_id, v.e as a, cen.c as b from v, cen)"
_R = "range(1, 65)"


def _total(term: str) -> str:
    return f"list_sum(list_transform({_R}, lambda i: {term}))"


def _cosine(a: str, b: str) -> str:
    dot = lambda x, y: f"list_dot_product({x}, {y})"
    return f"1 - {dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)}))"


_SQL = {
    "euclidean": "list_distance(a, b)",
    "sqeuclidean": _total("(a[i] - b[i]) * (a[i] - b[i])"),
    "cityblock": _total("abs(a[i] - b[i])"),
    "cosine": _cosine("a", "b"),
    "chebyshev": f"list_max(list_transform({_R}, lambda i: abs(a[i] - b[i])))",
    "minkowski": f"pow({_total('pow(abs(a[i] - b[i]), 3)')}, 1.0 / 3)",
    "braycurtis": f"{_total('abs(a[i] - b[i])')} / {_total('abs(a[i] + b[i])')}",
    "canberra": _total(
        "case when abs(a[i]) + abs(b[i]) = 0 then 0 else abs(a[i] - b[i]) / (abs(a[i]) + abs(b[i])) end"
    ),
    "hamming": f"{_total('case when a[i] = b[i] then 0 else 1 end')} / 64.0",
}

_CENTRED = """centred as (select label, vec_id,
    list_transform(a, lambda x: x - list_avg(a)) as a, list_transform(b, lambda x: x - list_avg(b)) as b
    from pairs)"""
_POSITIVE = """positive as (select label, vec_id, list_transform(a, lambda x: abs(x)) as a,
    list_transform(b, lambda x: abs(x)) as b from pairs),
shares as (select label, vec_id, list_transform(a, lambda x: x / list_sum(a)) as p,
    list_transform(b, lambda x: x / list_sum(b)) as q from positive)"""
_SIGNS = """signs as (select label, vec_id, list_transform(a, lambda x: sign(x)) as a,
    list_transform(b, lambda x: sign(x)) as b from pairs)"""
_KL = "case when {0}[i] = 0 then 0 else {0}[i] * ln({0}[i] / ((p[i] + q[i]) / 2)) end"


def _distances(pairs: str, metric: str) -> str:
    """CTEs up to ``d(label, vec_id, d)``."""
    steps, value, source = pairs, _SQL.get(metric), "pairs"
    if metric == "correlation":
        steps, value, source = f"{pairs}, {_CENTRED}", _cosine("a", "b"), "centred"
    elif metric == "jensenshannon":
        both = f"({_total(_KL.format('p'))} + {_total(_KL.format('q'))}) / 2"
        steps, value, source = f"{pairs}, {_POSITIVE}", f"sqrt({both})", "shares"
    elif metric == "hamming":
        steps, source = f"{pairs}, {_SIGNS}", "signs"
    return f"{steps}, d as (select label, vec_id, {value} as d from {source})"


def _prepare(metric: str, v: Column) -> Column:
    """Signs for hamming (floats are hardly ever equal), absolute values for shares."""
    if metric == "hamming":
        return F.transform(v, lambda x: F.signum(x))
    if metric == "jensenshannon":
        return F.transform(v, lambda x: F.abs(x))
    return v


def _register(metric: str) -> None:
    def run(spark, folder):
        v = vectors(spark, folder)
        means = materialise(mean_vectors(v, "label", width=64), "means")
        pairs = v.join(broadcast_if_small(means, row_bytes=8 * 64), "label")
        a, b = _prepare(metric, F.col("vector")), _prepare(metric, F.col("centroid"))
        return pairs.select("vec_id", F.round(D.distance(a, b, metric, p=3.0), 5).alias("distance"))

    QUERIES[f"metric_{metric}"] = run
    ORACLES[f"metric_{metric}"] = f"{_distances(_PAIRS, metric)} select vec_id, round(d, 5) as distance from d"

    def ranked(spark, folder):
        v = vectors(spark, folder)
        means = materialise(mean_vectors(v, "label", width=64), "means")
        asked = means.select(F.col("label").alias("query_id"), _prepare(metric, F.col("centroid")).alias("vector"))
        corpus = v.select("vec_id", _prepare(metric, F.col("vector")).alias("vector"))
        hits = nearest(asked, corpus, 3, item_id="vec_id", metric=metric, p=3.0)
        return hits.select("query_id", "vec_id", F.col("rank").cast("bigint").alias("rank"), F.round("distance", 5).alias("distance"))

    # The same metric as NumPy has it in the searches: the three vectors nearest to each mean.
    QUERIES[f"nearest_{metric}"] = ranked
    ORACLES[f"nearest_{metric}"] = f"""{_distances(_ALL, metric)}, r as (select *, row_number() over (
        partition by label order by round(d, 9), vec_id) as rank from d)
        select label as query_id, vec_id, rank, round(d, 5) as distance from r where rank <= 3"""


for _metric in D.METRICS:
    _register(_metric)


@query(
    f"""with {V}, moved as (select vec_id, e as a,
            list_concat([e[1] + label * 0.00003], e[2:]) as b from v)
        select vec_id, list_distance(a, b) < 1e-4 as same from moved"""
)
def same_vector_check(spark, folder):
    """Each vector against a copy with one component moved by 0 .. 0.00027."""
    v = vectors(spark, folder)
    shift = F.col("label") * F.lit(0.00003)
    moved = F.transform("vector", lambda x, i: F.when(i == 0, x + shift).otherwise(x))
    return v.select("vec_id", D.same_vector(F.col("vector"), moved).alias("same"))
