"""Exact assignment to many centres that computes only the distances which can still matter.

Some of the centres serve as pivots, and every centre is grouped under its nearest pivot. A group has a
radius, the largest distance of its centres to the pivot. By the triangle inequality no centre of a group
is nearer to a vector than its distance to the pivot less the radius, so a vector first meets the group
of its nearest pivot and then only those groups whose bound does not exceed the best distance so far.
Metrics without that inequality are not pruned.

Groups that fit one block are broadcast, and the vectors only scanned. Otherwise groups are packed into
blocks, a vector is sent to the blocks that hold one of its groups, and a task holds one block at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatlas.functions import blocks
from verbatlas.operators import nearest
from verbatlas.operators.sampling import sample_key
from verbatlas.operators.units import deal
from verbatlas.session import materialise

METRICS = ("euclidean", "cityblock", "chebyshev", "minkowski")
PIVOT_SEED = 977


@dataclass(frozen=True)
class Pivots:
    """A pivot per group, its radius, and the blocks ``first .. first + parts - 1`` that hold the group."""

    matrix: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    parts: np.ndarray
    metric: str
    p: float

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, float]:
        """(vectors, groups) distances to the pivots, and how far off they may be; 0 where nothing is pruned."""
        if self.metric not in METRICS or (self.metric == "minkowski" and self.p < 1):
            return np.zeros((len(vectors), len(self.radius))), 0.0
        values = blocks.screen(vectors, self.matrix, self.metric, self.p).T
        spare = blocks.slack(vectors, self.matrix, self.metric)
        if self.metric == "euclidean":
            return np.sqrt(np.maximum(values, 0.0)), math.sqrt(spare)
        return values, spare


@dataclass(frozen=True)
class Groups:
    """Centres in the order of their ids, and the rows of each group among them."""

    ids: pa.Array
    matrix: np.ndarray
    rows: dict[int, np.ndarray]

    @staticmethod
    def of(table: pa.Table, centre_id: str, centroid: str) -> Groups:
        table = table.sort_by(centre_id).combine_chunks()
        group = table["_group"].to_numpy()
        order = np.argsort(group, kind="stable")
        names, starts = np.unique(group[order], return_index=True)
        rows = dict(zip(names.tolist(), np.split(order, starts[1:]), strict=True))
        return Groups(table[centre_id].combine_chunks(), blocks.to_matrix(table[centroid]), rows)


def closest(vectors: np.ndarray, groups: Groups, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and distance of the closest centre of some groups (-1: none can win), and distances computed."""
    n = len(vectors)
    best, dist, seen = np.full(n, -1, np.int64), np.full(n, np.inf), np.zeros(n, np.int64)
    near, spare = pivots.distances(vectors)
    bound = near.min(axis=1) + 2 * spare  # a pivot is a centre, too
    home = near.argmin(axis=1)

    def meet(some: np.ndarray, own: np.ndarray) -> None:
        at, d = blocks.nearest_ref(vectors[some], groups.matrix[own], pivots.metric, pivots.p)
        at = own[at]
        new, old = np.round(d, blocks.TIE_DIGITS), np.round(dist[some], blocks.TIE_DIGITS)
        better = (new < old) | ((new == old) & ((best[some] < 0) | (at < best[some])))
        best[some[better]], dist[some[better]] = at[better], d[better]
        bound[some] = np.minimum(bound[some], dist[some] + 2 * spare)
        seen[some] += len(own)

    for first in (True, False):
        for g, own in groups.rows.items():
            at_home = home == g
            wanted = at_home if first else ~at_home & (near[:, g] - pivots.radius[g] <= bound)
            some = np.flatnonzero(wanted & np.isfinite(near[:, g]))
            if len(some):
                meet(some, own)
    return best, dist, seen


def _grouped(centres: DataFrame, centre_id: str, centroid: str, metric: str, p: float, count: int) -> tuple[DataFrame, pa.Table]:
    """Every centre with the number of its ``_group`` and its distance to the pivot; the pivots."""
    order = [sample_key(centre_id, PIVOT_SEED), F.col(centre_id)]
    table = centres.orderBy(*order).limit(count).select(centroid).toArrow()
    table = table.append_column("_group", pa.array(range(table.num_rows), pa.int32()))
    pivots = centres.sparkSession.createDataFrame(table)
    placed = nearest.assign(
        centres, pivots, item_id=centre_id, vector=centroid, centre_id="_group", centroid=centroid, keep=[centroid], metric=metric, p=p
    )
    return materialise(placed.withColumnRenamed("distance", "_away"), "groups"), table


def _packed(grouped: DataFrame, table: pa.Table, centroid: str, size: int, metric: str, p: float) -> Pivots:
    """Radius of every group, and blocks of at most ``size`` centres; a larger group gets several."""
    stats = grouped.groupBy("_group").agg(F.max("_away").alias("r"), F.count(F.lit(1)).alias("n")).toArrow()
    count = table.num_rows  # one row per pivot comes back
    radius, n = np.full(count, -np.inf), np.zeros(count, np.int64)
    radius[stats["_group"].to_numpy()], n[stats["_group"].to_numpy()] = stats["r"].to_numpy(), stats["n"].to_numpy()
    parts = np.maximum(1, -(-n // size))
    first, block, filled = np.zeros(count, np.int64), 0, 0
    for g in range(count):
        if filled and filled + n[g] > size:
            block, filled = block + 1, 0
        first[g] = block
        if parts[g] > 1:
            block, filled = block + int(parts[g]), 0
        else:
            filled += int(n[g])
    return Pivots(blocks.to_matrix(table[centroid]), radius, first, parts, metric, p)


def assign_many(
    rows: DataFrame,
    centres: DataFrame,
    vector: str,
    centre_id: str,
    centroid: str,
    metric: str,
    p: float = 2.0,
    limit_bytes: int | None = None,
    groups: int | None = None,
) -> DataFrame:
    """``rows`` with ``_id, _d`` of the closest centre and ``compared``, the distances computed for it.

    ``groups`` is the number of pivots, by default the square root of the number of centres.
    """
    id_type = centres.schema[centre_id].dataType
    total = centres.count()
    size = nearest._block_rows(centres.limit(1).toArrow(), centroid, limit_bytes)
    count = max(1, min(size, groups or math.isqrt(max(total - 1, 0)) + 1))
    if not total:
        nothing = {"_id": F.lit(None).cast(id_type), "_d": F.lit(None).cast("double"), "compared": F.lit(0).cast("bigint")}
        return rows.limit(0).withColumns(nothing)
    if metric in METRICS and not (metric == "minkowski" and p < 1):
        grouped, table = _grouped(centres, centre_id, centroid, metric, p, count)
        pivots = _packed(grouped, table, centroid, size, metric, p)
    else:  # groups by hash whose bounds exclude nothing
        count = -(-total // size)
        grouped = centres.withColumn("_group", F.pmod(F.xxhash64(centre_id), F.lit(count)).cast("int"))
        grouped = materialise(grouped.withColumn("_away", F.lit(math.inf)), "groups")
        table = centres.limit(1).select(centroid).toArrow()
        table = pa.concat_tables([table] * count)
        pivots = _packed(grouped, table, centroid, size, metric, p)
    spark = rows.sparkSession
    if total <= size:
        tree = spark.sparkContext.broadcast((Groups.of(grouped.drop("_away").toArrow(), centre_id, centroid), pivots))
        return _scan(rows, tree, vector, id_type)
    shared = spark.sparkContext.broadcast(pivots)
    return _units(rows, grouped, shared, vector, centre_id, centroid, id_type)


def _scan(rows: DataFrame, tree, vector: str, id_type: T.DataType) -> DataFrame:
    passed = rows.columns
    found = [T.StructField("_id", id_type), T.StructField("_d", T.DoubleType()), T.StructField("compared", T.LongType())]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, pivots = tree.value
        for batch in batches:
            for low in range(0, batch.num_rows, blocks.step_rows(len(pivots.radius), 1)):
                part = batch.slice(low, blocks.step_rows(len(pivots.radius), 1))
                best, dist, seen = closest(blocks.to_matrix(part.column(vector), groups.matrix.shape[1]), groups, pivots)
                at = np.flatnonzero(best >= 0)
                columns = [part.column(c).take(pa.array(at)) for c in passed]
                columns += [groups.ids.take(pa.array(best[at])), pa.array(dist[at]), pa.array(seen[at] + len(pivots.radius))]
                yield pa.RecordBatch.from_arrays(columns, [*passed, "_id", "_d", "compared"])

    return rows.mapInArrow(step, T.StructType([*rows.schema.fields, *found]))


def _units(rows: DataFrame, grouped: DataFrame, shared, vector: str, centre_id: str, centroid: str, id_type: T.DataType) -> DataFrame:
    written = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "vectors")
    sent = written.select("_row", vector)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per vector and block that holds a group whose bound does not exclude it."""
        pivots = shared.value
        blocks_of = [np.arange(f, f + n) for f, n in zip(pivots.first, pivots.parts, strict=True)]
        last = int((pivots.first + pivots.parts).max())
        step = blocks.step_rows(max(len(pivots.radius), last), 1)
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                near, spare = pivots.distances(blocks.to_matrix(part.column(vector), pivots.matrix.shape[1]))
                wanted = near - pivots.radius <= near.min(axis=1, keepdims=True) + 2 * spare
                goes = np.zeros((part.num_rows, last), bool)
                for g, own in enumerate(blocks_of):
                    goes[:, own] |= wanted[:, g : g + 1]
                at, block = np.nonzero(goes)
                columns = [part.column(c).take(pa.array(at)) for c in ("_row", vector)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(block, pa.int32())], ["_row", vector, "_block"])

    sent = sent.mapInArrow(route, T.StructType([*sent.schema.fields, T.StructField("_block", T.IntegerType())]))
    pivots = shared.value
    where = pa.table({"_group": pa.array(range(len(pivots.first)), pa.int32()), "_first": pivots.first, "_parts": pivots.parts})
    where = rows.sparkSession.createDataFrame(where)
    block = (F.col("_first") + F.pmod(F.xxhash64(centre_id), F.col("_parts"))).cast("int")
    placed = grouped.drop("_away").join(F.broadcast(where), "_group").withColumn("_block", block).drop("_first", "_parts")
    left, right = deal(sent, placed, ["_block"], ["_row"], nearest.SLICE_ROWS)
    found = [T.StructField("_id", id_type), T.StructField("_d", T.DoubleType()), T.StructField("_seen", T.LongType())]
    schema = T.StructType([written.schema["_row"], *found])

    def unit(some: pa.Table, refs: pa.Table) -> pa.Table:
        pivots, out = shared.value, []
        groups = Groups.of(refs, centre_id, centroid) if refs.num_rows else None
        step = blocks.step_rows(len(pivots.radius), 1)
        for low in range(0, some.num_rows if refs.num_rows else 0, step):
            part = some.slice(low, step)
            best, dist, seen = closest(blocks.to_matrix(part[vector]), groups, pivots)
            at = np.flatnonzero(best >= 0)
            row = part["_row"].combine_chunks().take(pa.array(at))
            out.append(pa.table([row, groups.ids.take(pa.array(best[at])), pa.array(dist[at]), pa.array(seen[at])], names=schema.names))
        return pa.concat_tables(out) if out else pa.table([pa.array([], f.type) for f in _arrow(schema, refs[centre_id].type)], names=schema.names)

    partial = left.groupBy("_block", "_slice").cogroup(right.groupBy("_block", "_slice")).applyInArrow(unit, schema)
    seen = (F.sum("_seen") + F.lit(len(pivots.radius))).alias("compared")
    return nearest.best_of_units(written, partial, [seen])


def _arrow(schema: T.StructType, id_type: pa.DataType) -> list[pa.Field]:
    kinds = [pa.int64(), id_type, pa.float64(), pa.int64()]
    return [pa.field(n, k) for n, k in zip(schema.names, kinds, strict=True)]


def assign_pruned(
    vectors: DataFrame,
    centres: DataFrame,
    *,
    item_id: str = "script_id",
    vector: str = "vector",
    centre_id: str = "cluster_id",
    centroid: str = "centroid",
    metric: str = "euclidean",
    p: float = 2.0,
    keep: Sequence[str] = (),
    groups: int | None = None,
    limit_bytes: int | None = None,
) -> DataFrame:
    """The rows of ``nearest.assign`` by way of the groups, with ``compared``, the distances computed.

    ``compared`` counts the pivots, too; without pruning it would be the number of centres.
    """
    nearest._check_metric(metric)
    passed = list(dict.fromkeys([item_id, *keep, vector]))
    rows = vectors.filter(F.col(vector).isNotNull()).select(*passed)
    wanted = centres.filter(F.col(centroid).isNotNull()).select(centre_id, centroid)
    out = assign_many(rows, wanted, vector, centre_id, centroid, metric, p, limit_bytes, groups)
    return out.select(*dict.fromkeys([item_id, *keep]), F.col("_id").alias(centre_id), F.col("_d").alias("distance"), "compared")
