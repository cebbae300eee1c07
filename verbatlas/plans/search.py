"""Search: whole tables of queries are routed, ranked and formatted in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.functions.distance import distance
from verbatlas.functions.text import normalise_query, time_label
from verbatlas.operators.encode import Encoder, embed
from verbatlas.operators.nearest import assign, nearest
from verbatlas.operators.publish import reassemble
from verbatlas.operators.waves import PER_HIT, first_n_waves
from verbatlas.plans.index import VectorIndex
from verbatlas.session import materialise
from verbatlas.sources.tables import pick

# The defaults of the original searches.
SERVED_RESULTS = 300
THRESHOLD_RESULTS = 10
ONE_LEVEL_THRESHOLD = 3.5
PUBLISHED_THRESHOLD = 3.4
EXHAUSTIVE_BOUND = 100.0


def encode_queries(queries: DataFrame, encoder: Encoder, text: str = "text") -> DataFrame:
    """Normalise and encode query texts."""
    return embed(queries.withColumn(text, normalise_query(F.col(text))), encoder, text)


def route(
    queries: DataFrame,
    index: VectorIndex,
    levels: int = 2,
    metric: str = "cityblock",
    max_distance: float | None = None,
) -> DataFrame:
    """The cluster of every query: ``query_id, [lv2_id,] cluster_id, distance, vector``."""
    if levels == 1:
        return assign(
            queries, index.lv1, item_id="query_id", keep=["vector"], metric=metric, max_distance=max_distance
        )
    upper = assign(queries, index.lv2, item_id="query_id", keep=["vector"], centre_id="lv2_id", metric=metric)
    return assign(
        upper,
        index.lv1,
        item_id="query_id",
        keep=["vector", "lv2_id"],
        metric=metric,
        key="lv2_id",
        max_distance=max_distance,
    )


def add_info(
    hits: DataFrame, segments: DataFrame, padded: bool = True, how: str = "left", block_rows: int | None = None
) -> DataFrame:
    """Text, video and time label for the few rows that are left after ranking.

    The hits are written first: they are small, and what follows needs their ids twice.
    """
    hits = materialise(hits, "hits")
    found = pick(segments, hits, block_rows=block_rows)
    info = found.select("script_id", "video_id", time_label(F.col("timestamp"), padded).alias("at"), "text")
    joined = hits.join(info, "script_id", how)
    return joined.select("query_id", "rank", "distance", "script_id", "video_id", "at", "text")


def exhaustive(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 1,
    metric: str = "euclidean",
    max_distance: float | None = None,
    **options,
) -> DataFrame:
    """The exact ``k`` nearest of the whole corpus."""
    return nearest(queries, vectors, k, metric=metric, max_distance=max_distance, **options)


def ranked_ids(
    queries: DataFrame,
    index: VectorIndex,
    k: int = SERVED_RESULTS,
    levels: int = 2,
    route_metric: str = "cityblock",
    rank_metric: str = "euclidean",
    max_distance: float | None = None,
    mode: str = "top_k",
    first_wave: int | None = None,
    report: list | None = None,
) -> DataFrame:
    """Route, then rank the members of the chosen cluster: ``query_id, script_id, rank, distance``.

    ``mode="first_n"`` reads the postings in waves of ranks and stops for a query at its ``k``-th hit.
    """
    routed = route(queries, index, levels, route_metric)
    if mode == "first_n":
        if max_distance is None:
            raise ValueError("first_n needs max_distance")
        # Two scans a wave: an index that only exists as a plan is written first.
        postings = index.postings if index.block_rows is not None else materialise(index.postings, "postings")
        return first_n_waves(
            routed.drop("distance"),
            lambda _, low, high: postings.filter((F.col("rank") > low) & (F.col("rank") <= high)),
            lambda place: postings.filter(F.col("rank") == place),
            k,
            max_distance,
            metric=rank_metric,
            prune_by=["lv2_id"] if levels == 2 else [],
            first=first_wave,
            report=report,
        )
    return nearest(
        routed,
        index.postings,
        k,
        metric=rank_metric,
        key="cluster_id",
        prune_by=["lv2_id"] if levels == 2 else [],
        mode=mode,
        max_distance=max_distance,
    )


def search(
    queries: DataFrame,
    index: VectorIndex,
    k: int = SERVED_RESULTS,
    levels: int = 2,
    route_metric: str = "cityblock",
    rank_metric: str = "euclidean",
    max_distance: float | None = None,
    mode: str = "top_k",
    padded: bool = True,
) -> DataFrame:
    """Ranked segments for every query.

    The served search is the default. The other variants are arguments: Euclidean
    routing with city-block ranking, ``levels=1``, and ``mode="first_n"`` with a
    distance threshold, which takes the first ``k`` members in stored order.
    """
    hits = ranked_ids(queries, index, k, levels, route_metric, rank_metric, max_distance, mode)
    return add_info(hits, index.segments, padded, block_rows=index.block_rows)


def search_published(
    queries: DataFrame,
    centroids: DataFrame,
    chunks: DataFrame,
    documents: DataFrame,
    k: int = THRESHOLD_RESULTS,
    max_distance: float = PUBLISHED_THRESHOLD,
    mode: str = "first_n",
    metric: str = "euclidean",
    first_chunk: int | None = None,
    last_chunk: int | None = None,
) -> DataFrame:
    """One-level search over published documents; members without a document are skipped."""
    routed = assign(queries, centroids, item_id="query_id", keep=["vector"], metric=metric)
    routed = materialise(routed.drop("distance"), "routed")
    span = F.lit(True)
    if first_chunk is not None:
        span = span & (F.col("chunk_no") >= first_chunk)
    if last_chunk is not None:
        span = span & (F.col("chunk_no") <= last_chunk)
    before = 0 if first_chunk is None else max(first_chunk, 1) - 1
    chunks = chunks.filter(span)
    longest = chunks.agg(F.max("n")).first()[0] or 0

    def stored(asked: DataFrame, low: int | None, high: int | None) -> DataFrame:
        """Members of some chunks with their vectors; the order is the chunk, then the place in it, as one exact number."""
        some = chunks
        if high is not None:
            some = chunks.filter((F.col("chunk_no") > before + low) & (F.col("chunk_no") <= before + high))
        members = materialise(reassemble(pick(some, asked, "cluster_id")), "members")
        rows = members.join(pick(documents, members).select("script_id", "vector"), "script_id")
        return rows.withColumn("_stored", (F.col("chunk_no") * F.lit(longest + 1) + F.col("place")).cast("double"))

    if mode == "first_n":
        # Waves of chunks; a chunk may be absent, and a member without a document is skipped.
        more = lambda place: chunks.filter(F.col("chunk_no") >= before + place)
        wave = max(1, PER_HIT * k // max(longest, 1))
        hits = first_n_waves(routed, stored, more, k, max_distance, metric=metric, order="_stored", first=wave)
    else:
        hits = nearest(routed, stored(routed, None, None), k, metric=metric, key="cluster_id", max_distance=max_distance)
    return add_info(hits, documents, padded=False, how="inner")


def distance_table(reference: DataFrame, queries: DataFrame, metric: str = "euclidean") -> DataFrame:
    """Distance of every query to the one reference row, nearest first."""
    rows = reference.select("vector").take(2)
    if len(rows) != 1:
        raise ValueError("the reference must be one row")
    point = F.lit([float(x) for x in rows[0]["vector"]])
    scored = queries.select("query_id", distance(F.col("vector"), point, metric).alias("distance"))
    return scored.orderBy("distance", "query_id")


def write_report(report: DataFrame, path: str) -> None:
    report.write.option("header", True).option("quoteAll", True).csv(path)
