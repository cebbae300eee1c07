"""Exact nearest neighbours that skip blocks of the corpus by their distances to a few pivots.

The corpus is laid out in blocks of vectors that lie near one pivot and about as far from it. Per block and
pivot the smallest and the largest distance are kept. By the triangle inequality a query is at least as
far from every vector of a block as its own distance to a pivot lies outside that range, for each pivot.

A search takes two rounds. Every query first meets the blocks with the lowest bounds that hold ``k`` vectors;
the ``k``-th distance found there is an upper limit. Then it meets the other blocks whose bound does not
exceed the limit. Pairs of a query and a block it has to meet are the only pairs that become rows; a block
meets its queries in slices. Nothing is skipped that could be among the ``k``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatlas.functions import blocks
from verbatlas.operators.ordering import first_per_group, global_ordinals
from verbatlas.operators.pruned import METRICS
from verbatlas.operators.sampling import sample_key
from verbatlas.operators.units import deal
from verbatlas.session import BROADCAST_LIMIT_BYTES, materialise

PIVOTS = 16
BLOCK_ROWS = 4096
QUERIES = 4096  # queries that meet a block in one unit
PAIRS = 4096  # pairs of a query and a block that a task hands on at a time
SEED = 3571
MARGIN = 1e-7  # on bounds, relative to the distances: rounding, and distances that count as equal


@dataclass(frozen=True)
class PivotTable:
    """``rows`` (``block``, item, vector), ``bounds`` (``block, n, low, high``, distances per pivot) and the pivots (``pivot``, vector)."""

    rows: DataFrame
    bounds: DataFrame
    pivots: DataFrame
    metric: str
    item_id: str
    vector: str

    def save(self, path: str) -> None:
        self.rows.write.parquet(f"{path}/rows")
        self.bounds.write.parquet(f"{path}/bounds")
        self.pivots.write.parquet(f"{path}/pivots")


def load_table(spark: SparkSession, path: str, metric: str, item_id: str = "script_id", vector: str = "vector") -> PivotTable:
    rows, bounds, pivots = (spark.read.parquet(f"{path}/{name}") for name in ("rows", "bounds", "pivots"))
    return PivotTable(rows, bounds, pivots, metric, item_id, vector)


def _to_pivots(vectors: np.ndarray, pivots: np.ndarray, metric: str) -> np.ndarray:
    """(vectors, pivots) distances, each computed row by row."""
    return np.stack([blocks.row_distance(vectors, np.broadcast_to(p, vectors.shape), metric) for p in pivots], axis=1)


def build_table(
    vectors: DataFrame,
    metric: str = "euclidean",
    *,
    item_id: str = "script_id",
    vector: str = "vector",
    pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS,
) -> PivotTable:
    """Choose pivots by hash, lay the corpus out in blocks and find their bounds.

    The bounds of all blocks are broadcast in a search; blocks are made larger where they would not fit.
    Vectors that are null or hold an undefined number have no distance and are left out.
    """
    if metric not in METRICS or metric == "minkowski":
        raise ValueError(f"no bounds are known for {metric!r}")
    rows = vectors.filter(F.col(vector).isNotNull() & F.col(item_id).isNotNull()).select(item_id, vector)
    rows = rows.filter(~F.exists(vector, lambda x: x.isNull() | F.isnan(x)))
    spark = vectors.sparkSession
    chosen = rows.orderBy(sample_key(item_id, SEED), item_id).limit(pivots).select(vector).toArrow()
    matrix = blocks.to_matrix(chosen[vector])
    shared = spark.sparkContext.broadcast(matrix)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = shared.value
        for batch in batches:
            if not len(points) or not batch.num_rows:
                continue
            away = _to_pivots(blocks.to_matrix(batch.column(vector), points.shape[1]), points, metric)
            home = away.argmin(axis=1)
            own = away[np.arange(len(away)), home]
            columns = [*batch.columns, blocks.to_lists(away), pa.array(home, pa.int32()), pa.array(own)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_away", "_home", "_own"])

    kinds = [("_away", T.ArrayType(T.DoubleType())), ("_home", T.IntegerType()), ("_own", T.DoubleType())]
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, t) for n, t in kinds]])
    placed = global_ordinals(rows.mapInArrow(measure, schema), ["_home", "_own", item_id], "_place")
    fitting = max(1, BROADCAST_LIMIT_BYTES // (16 * max(1, len(matrix))))
    size = max(block_rows, -(-placed.count() // fitting))
    placed = placed.withColumn("block", F.floor(F.col("_place") / F.lit(size)).cast("int"))
    sides = [F.array(*[f(F.col("_away")[j]) for j in range(len(matrix))]).cast("array<double>") for f in (F.min, F.max)]
    bounds = placed.groupBy("block").agg(F.count(F.lit(1)).alias("n"), sides[0].alias("low"), sides[1].alias("high"))
    written = materialise(placed.select("block", item_id, vector), "blocks")
    chosen = chosen.append_column("pivot", pa.array(range(len(matrix)), pa.int32()))
    return PivotTable(written, materialise(bounds, "bounds"), spark.createDataFrame(chosen), metric, item_id, vector)


class _Bounds:
    def __init__(self, table: PivotTable):
        bounds = table.bounds.toArrow().sort_by("block")  # of checked size, see build_table
        pivots = table.pivots.toArrow().sort_by("pivot")
        self.pivots, self.metric = blocks.to_matrix(pivots[table.vector]), table.metric
        self.block, self.n = bounds["block"].to_numpy(), bounds["n"].to_numpy()
        self.low, self.high = blocks.to_matrix(bounds["low"]), blocks.to_matrix(bounds["high"])

    def lower(self, queries: np.ndarray) -> np.ndarray:
        """(queries, blocks) distance that no vector of the block falls below."""
        away = _to_pivots(queries, self.pivots, self.metric)
        out = np.zeros((len(queries), len(self.block)))
        for j in range(len(self.pivots)):
            a = away[:, j : j + 1]
            np.maximum(out, np.maximum(self.low[:, j][None] - a, a - self.high[:, j][None]), out=out)
        return out

    def first(self, lower: np.ndarray, k: int) -> np.ndarray:
        """Which blocks a query meets first: those with the lowest bounds, until they hold ``k`` vectors."""
        order = np.argsort(lower, axis=1, kind="stable")
        before = np.cumsum(self.n[order], axis=1) - self.n[order]
        out = np.zeros(lower.shape, bool)
        np.put_along_axis(out, order, before < k, axis=1)
        return out


def _met(part: pa.RecordBatch, wanted: np.ndarray, block: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The queries of ``part`` with every block they want; each pair carries its vector, and a query may want all blocks."""
    q, b = np.nonzero(wanted)
    for low in range(0, len(q), PAIRS):
        columns = [c.take(pa.array(q[low : low + PAIRS])) for c in part.columns]
        columns.append(pa.array(block[b[low : low + PAIRS]], pa.int32()))
        yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "block"])


def search_pivots(
    queries: DataFrame, table: PivotTable, k: int, *, query_id: str = "query_id", vector: str = "vector", report: dict | None = None
) -> DataFrame:
    """The ``k`` nearest of the whole corpus: ``query_id, item_id, rank, distance``, exact, ties by item.

    ``report`` gets the pairs of a query and a block that were compared, and how many there are in all.
    """
    spark = queries.sparkSession
    asked = queries.filter(F.col(vector).isNotNull() & F.col(query_id).isNotNull()).select(query_id, vector)
    asked = materialise(asked, "queries")
    shared = spark.sparkContext.broadcast(_Bounds(table))
    item, held, metric = table.item_id, table.vector, table.metric
    fields = [asked.schema[query_id], table.rows.schema[item], T.StructField("distance", T.DoubleType())]
    schema = T.StructType(fields)

    def pairs(rows: DataFrame, late: bool) -> DataFrame:
        """A row per query and block that it meets in this round."""

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bounds = shared.value
            step = blocks.step_rows(max(1, len(bounds.block)), 1)
            for batch in batches:
                for at in range(0, batch.num_rows if len(bounds.block) else 0, step):
                    part = batch.slice(at, step)
                    lower = bounds.lower(blocks.to_matrix(part.column(vector), bounds.pivots.shape[1]))
                    wanted = bounds.first(lower, k)
                    if late:
                        limit = pc.fill_null(part.column("_limit"), np.inf).to_numpy(zero_copy_only=False)[:, None]
                        wanted = ~wanted & (lower <= limit + MARGIN * (1.0 + limit))
                    yield from _met(part, wanted, bounds.block)

        return rows.mapInArrow(choose, T.StructType([*rows.schema.fields, T.StructField("block", T.IntegerType())]))

    def compare(rows: DataFrame, late: bool) -> DataFrame:
        met = materialise(pairs(rows, late), "pairs")
        if report is not None:
            report["compared"] = report.get("compared", 0) + met.count()
        many, few = deal(met, table.rows, ["block"], [query_id], QUERIES)

        def unit(some: pa.Table, corpus: pa.Table) -> pa.Table:
            qi, vi, dist = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            if some.num_rows and corpus.num_rows:
                matrix = blocks.to_matrix(some[vector])
                limits = np.full(len(matrix), np.inf)
                if late:
                    limits = pc.fill_null(some["_limit"], np.inf).to_numpy()
                    limits = limits + MARGIN * (1.0 + limits)
                tie = pc.rank(corpus[item], tiebreaker="dense").to_numpy()
                qi, vi, dist = blocks.within(blocks.to_matrix(corpus[held]), matrix, metric, 2.0, k, limits, tie)
            columns = [some[query_id].take(pa.array(qi)), corpus[item].take(pa.array(vi)), pa.array(dist)]
            return pa.table(columns, names=schema.names)

        found = many.groupBy("block", "_slice").cogroup(few.groupBy("block", "_slice")).applyInArrow(unit, schema)
        top = first_per_group(found, [query_id], [F.round("distance", blocks.TIE_DIGITS), item], k)
        return materialise(top.drop("rank"), "near")

    early = compare(asked, False)
    kth = early.groupBy(query_id).agg(F.max("distance").alias("d"), F.count(F.lit(1)).alias("n"))
    limit = kth.select(query_id, F.when(F.col("n") >= k, F.col("d")).alias("_limit"))
    late = compare(asked.join(limit, query_id, "left").select(query_id, vector, "_limit"), True)
    if report is not None:
        report["all"] = asked.count() * len(shared.value.block)
    both = early.unionByName(late)
    out = first_per_group(both, [query_id], [F.round("distance", blocks.TIE_DIGITS), item], k)
    return out.select(query_id, item, "rank", "distance")
