"""The first n hits of every query, reading the members of its cluster from the front in waves.

A wave reads a range of stored places of the clusters that are still asked for. Queries that have ``n`` hits, or
whose cluster has no further member, leave before the next wave, which is ``GROWTH`` times as long. What
is read follows from the number of hits and not from the size of a cluster, and a query that finds
nothing costs one scan of its cluster in a number of waves that grows with the logarithm of its size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.functions import blocks
from verbatlas.operators.nearest import nearest
from verbatlas.operators.ordering import first_per_group
from verbatlas.session import broadcast_if_small, materialise

GROWTH = 4
PER_HIT = 16  # places of the first wave for each hit that is asked for

# ``fetch(queries, low, high)``: members at the places ``low < place <= high`` of the queries' clusters.
Fetch = Callable[[DataFrame, int, int], DataFrame]


def first_n_waves(
    queries: DataFrame,
    fetch: Fetch,
    more: Callable[[int], DataFrame],
    n: int,
    max_distance: float,
    *,
    key: str = "cluster_id",
    prune_by: Sequence[str] = (),
    query_id: str = "query_id",
    item_id: str = "script_id",
    order: str = "rank",
    metric: str = "euclidean",
    first: int | None = None,
    report: list | None = None,
    **options,
) -> DataFrame:
    """``query_id, item_id, rank, distance`` of the first ``n`` members in stored order closer than ``max_distance``.

    ``more(place)`` names the keys that have a member at a place; places of a key have no gaps. ``order``
    is the column of ``fetch`` that holds the stored order, which never falls from one wave to the next.
    A dict per wave is appended to ``report``: its range and the number of queries in it.
    """
    active = materialise(queries.filter(F.col(key).isNotNull()), "active")
    low, high = 0, first or PER_HIT * n
    found: DataFrame | None = None
    while True:
        if report is not None:
            report.append({"low": low, "high": high, "queries": active.count()})
        hits = nearest(
            active, fetch(active, low, high), n, query_id=query_id, item_id=item_id, metric=metric, key=key, prune_by=prune_by,
            mode="first_n", item_rank=order, max_distance=max_distance, in_order=True, **options,
        )
        hits = materialise(hits, "hits")
        found = hits if found is None else found.unionByName(hits)
        full = found.groupBy(query_id).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= n).select(query_id)
        longer = broadcast_if_small(materialise(more(high + 1).select(key).distinct(), "longer"))
        rest = active.join(longer, key, "left_semi").join(full, query_id, "left_anti")
        active = materialise(rest.select(*active.columns), "active")
        if active.isEmpty():
            break
        low, high = high, high + (high - low) * GROWTH
    top = first_per_group(found, [query_id], ["_order", item_id], n).drop("rank")
    out = first_per_group(top, [query_id], [F.round("distance", blocks.TIE_DIGITS), item_id], n)
    return out.select(query_id, item_id, "rank", "distance")
