"""Nearest centre and nearest neighbours without forming the pairs as rows.

One side (queries, centres) is cut into blocks of a fixed byte size. What fits one block goes to
all tasks as a broadcast variable; the other side, of any size, is only scanned: each task scores
its Arrow batches against the block and hands on a winner or the best ``k``, so a cluster that holds
a third of the corpus is spread over as many tasks as its files have splits. Where there are more,
blocks meet slices of the other side on the executors, one block in a task at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatlas.functions import blocks
from verbatlas.functions.distance import METRICS
from verbatlas.operators.ordering import first_per_group, global_ordinals, ranks_within
from verbatlas.operators.units import deal
from verbatlas.session import BROADCAST_LIMIT_BYTES, broadcast_if_small, materialise

# A table with no more rows than this is fetched without numbering its rows first.
HEAD_ROWS = 16_384

# Corpus rows that meet a block of queries or centres in one unit of work.
SLICE_ROWS = 50_000

# Rows of either side of a unit that pairs queries with a corpus, at most: those of metrics that a matrix product
# screens, and of the others, which cost several times as much a pair.
UNIT_ROWS, DEAR_UNIT_ROWS = 32_768, 16_384
LEAST_UNIT_ROWS = 4_096

# Longest IN list pushed to the scan of a keyed corpus; with more keys it reads all.
PRUNE_KEYS = 1000


def _block_rows(sample: pa.Table, vector: str, limit_bytes: int | None, results: int = 0) -> int:
    """Rows of a block, for each of which a task also holds ``results`` results."""
    width = max(1, len(sample[vector][0])) if sample.num_rows else 1
    return max(1, (limit_bytes or BROADCAST_LIMIT_BYTES) // (8 * (width + results)))


def _unit_rows(spark: SparkSession, count: int, metric: str) -> int:
    """Rows of either side of a unit for ``count`` queries: few enough that all cores get several units of like size."""
    most = UNIT_ROWS if metric in ("euclidean", "sqeuclidean", "cosine") else DEAR_UNIT_ROWS
    return min(most, max(LEAST_UNIT_ROWS, math.ceil(count / math.sqrt(4 * spark.sparkContext.defaultParallelism))))


def _check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose one of {sorted(METRICS)}")


def _values(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        return np.array(column.to_pylist(), dtype=str)
    return column.to_numpy(zero_copy_only=False)


def _by_key(keys: pa.Array) -> dict:
    """Row numbers by key; only the distinct keys become Python objects."""
    if isinstance(keys, pa.ChunkedArray):
        keys = keys.combine_chunks()
    coded = keys.dictionary_encode()
    codes = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    uniq, starts = np.unique(codes[order], return_index=True)
    names = coded.dictionary.to_pylist()
    return {names[c]: rows for c, rows in zip(uniq.tolist(), np.split(order, starts[1:])) if c >= 0}


def assign(
    vectors: DataFrame,
    centres: DataFrame,
    *,
    item_id: str = "script_id",
    vector: str = "vector",
    centre_id: str = "cluster_id",
    centroid: str = "centroid",
    metric: str = "euclidean",
    p: float = 2.0,
    key: str | None = None,
    keep: Sequence[str] = (),
    max_distance: float | None = None,
    limit_bytes: int | None = None,
) -> DataFrame:
    """Closest centre of every vector: ``item_id, *keep, centre_id, distance``.

    Equal distances go to the smaller centre id. With ``key`` a vector only meets the centres of its
    own key. Centres that fit one block are broadcast and the vectors only scanned. More centres are
    cut into blocks, and units of one block and a slice of the vectors meet on the executors:
    by key, or by groups around pivots whose bounds tell which blocks a vector has to meet (see
    `pruned`). ``max_distance`` drops what lies beyond.
    """
    _check_metric(metric)
    passed = list(dict.fromkeys([item_id, *keep, *([key] if key else []), vector]))
    rows = vectors.filter(F.col(vector).isNotNull()).select(*passed)
    wanted = centres.filter(F.col(centroid).isNotNull()).select(centre_id, centroid, *([key] if key else []))
    table = fits_block(wanted, centroid, limit_bytes)
    if table is not None:
        out = _assign_block(rows, table, vector, centre_id, centroid, centres.schema[centre_id].dataType, metric, p, key)
    elif key:
        out = _assign_keyed(rows, wanted, vector, centre_id, centroid, metric, p, key, limit_bytes)
    else:
        from verbatlas.operators import pruned  # it groups the centres by an assignment of its own

        out = pruned.assign_many(rows, wanted, vector, centre_id, centroid, metric, p, limit_bytes)
    if max_distance is not None:
        out = out.filter(F.col("_d") < F.lit(max_distance))
    named = [F.col("_id").alias(centre_id), F.col("_d").alias("distance")]
    return out.select(*dict.fromkeys([item_id, *keep]), *named)


def fits_block(df: DataFrame, vector: str, limit_bytes: int | None = None) -> pa.Table | None:
    """The whole table if it is no larger than a block, else nothing."""
    # One job: limit() stops after the first few partitions of a large table.
    table = df.limit(HEAD_ROWS + 1).toArrow()
    rows = _block_rows(table, vector, limit_bytes)
    if table.num_rows <= min(HEAD_ROWS, rows):
        return table
    return df.toArrow() if rows > HEAD_ROWS and df.count() <= rows else None


def _assign_block(
    rows: DataFrame,
    table: pa.Table,
    vector: str,
    centre_id: str,
    centroid: str,
    id_type: T.DataType,
    metric: str,
    p: float,
    key: str | None,
) -> DataFrame:
    """The rows with ``_id`` and ``_d`` of the closest of one block of centres, in one scan."""
    passed = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("_id", id_type), T.StructField("_d", T.DoubleType())])
    if table.num_rows == 0:
        return rows.limit(0).withColumns({"_id": F.lit(None).cast(id_type), "_d": F.lit(None).cast("double")})
    table = table.sort_by(centre_id)
    shared = rows.sparkSession.sparkContext.broadcast(
        (table[centre_id].combine_chunks(), blocks.to_matrix(table[centroid]), _by_key(table[key]) if key else None)
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix, groups = shared.value
        for batch in batches:
            data = blocks.to_matrix(batch.column(vector), matrix.shape[1])
            if groups is None:
                best, dist = blocks.nearest_ref(data, matrix, metric, p)
            else:
                best, dist = np.full(len(data), -1, np.int64), np.full(len(data), np.nan)
                for value, own in _by_key(batch.column(key)).items():
                    if value in groups:
                        at, d = blocks.nearest_ref(data[own], matrix[groups[value]], metric, p)
                        best[own], dist[own] = np.where(at >= 0, groups[value][at], -1), d
            found = np.flatnonzero(best >= 0)
            columns = [batch.column(c).take(pa.array(found)) for c in passed]
            columns += [ids.take(pa.array(best[found])), pa.array(dist[found])]
            yield pa.RecordBatch.from_arrays(columns, names=[*passed, "_id", "_d"])

    return rows.mapInArrow(step, schema)


def best_of_units(rows: DataFrame, partial: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """``rows`` with ``_id`` and ``_d`` of the best of all partial winners ``_row, _id, _d`` of a row."""
    order = F.struct(F.round("_d", blocks.TIE_DIGITS).alias("r"), F.col("_id"), F.col("_d"))
    best = partial.groupBy("_row").agg(F.min(order).alias("_best"), *extra)
    best = best.select("_row", "_best._id", "_best._d", *[c for c in best.columns if c not in ("_row", "_best")])
    return rows.join(best, "_row").drop("_row")


def _assign_keyed(
    rows: DataFrame,
    centres: DataFrame,
    vector: str,
    centre_id: str,
    centroid: str,
    metric: str,
    p: float,
    key: str,
    limit_bytes: int | None,
) -> DataFrame:
    """Blocks of centres of one key meet slices of the vectors of that key."""
    size = _block_rows(centres.limit(1).toArrow(), centroid, limit_bytes)
    placed = ranks_within(centres.filter(F.col(key).isNotNull()), [key], [centre_id], "_place")
    placed = placed.withColumn("_block", F.floor((F.col("_place") - 1) / F.lit(size)).cast("int")).drop("_place")
    placed = materialise(placed, "centres")
    parts = placed.groupBy(key).agg((F.max("_block") + 1).alias("_parts"))
    written = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "vectors")
    sent = written.select("_row", key, vector).join(broadcast_if_small(materialise(parts, "parts")), key)
    sent = sent.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    left, right = deal(sent, placed, [key, "_block"], ["_row"], SLICE_ROWS)
    id_type = centres.schema[centre_id].dataType
    schema = T.StructType([written.schema["_row"], T.StructField("_id", id_type), T.StructField("_d", T.DoubleType())])

    def unit(some: pa.Table, refs: pa.Table) -> pa.Table:
        if not some.num_rows or not refs.num_rows:
            return pa.table([some["_row"].slice(0, 0), refs[centre_id].slice(0, 0), pa.array([], pa.float64())], names=schema.names)
        refs = refs.sort_by(centre_id)
        best, dist = blocks.nearest_ref(blocks.to_matrix(some[vector]), blocks.to_matrix(refs[centroid]), metric, p)
        found = pa.array(np.flatnonzero(best >= 0))
        return pa.table(
            [some["_row"].take(found), refs[centre_id].take(pa.array(best[best >= 0])), pa.array(dist).take(found)], names=schema.names
        )

    unit_of = [key, "_block", "_slice"]
    partial = left.groupBy(*unit_of).cogroup(right.groupBy(*unit_of)).applyInArrow(unit, schema)
    return best_of_units(written, partial)


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    *,
    query_id: str = "query_id",
    query_vector: str = "vector",
    item_id: str = "script_id",
    vector: str = "vector",
    metric: str = "euclidean",
    p: float = 2.0,
    key: str | None = None,
    prune_by: Sequence[str] = (),
    mode: str = "top_k",
    item_rank: str | None = None,
    max_distance: float | None = None,
    bound_sample: float | None = None,
    in_order: bool = False,
    limit_bytes: int | None = None,
) -> DataFrame:
    """Neighbours of every query: ``query_id, item_id, rank, distance``.

    * ``mode="top_k"``: the ``k`` smallest ``(distance, item_id)``.
    * ``mode="first_n"``: the first ``k`` items in ``item_rank`` order that are closer
      than ``max_distance``, then ranked by distance.

    With ``key`` a query only meets corpus rows of its own key; ``prune_by`` names
    further columns that both sides share (partition columns of a saved corpus).
    ``bound_sample`` scores that share of the corpus first: the k-th distance found in
    it is an upper bound of the true one, so tasks of the full pass need not report
    anything farther. It changes the work, never the result. ``in_order`` leaves out the last
    ranking by distance and returns ``query_id, item_id, distance, _order`` instead.
    """
    _check_metric(metric)
    if mode not in ("top_k", "first_n"):
        raise ValueError("mode must be top_k or first_n")
    if mode == "first_n" and (item_rank is None or max_distance is None):
        raise ValueError("first_n needs item_rank and max_distance")
    spark = queries.sparkSession
    shared_cols = list(dict.fromkeys([*([key] if key else []), *prune_by]))
    q = queries.filter(F.col(query_vector).isNotNull() & F.col(query_id).isNotNull()).select(query_id, query_vector, *shared_cols)
    columns = [item_id, vector] + ([key] if key else []) + ([item_rank] if mode == "first_n" else [])
    c = corpus.filter(F.col(vector).isNotNull() & F.col(item_id).isNotNull())
    schema = T.StructType(
        [
            q.schema[query_id],
            c.schema[item_id],
            T.StructField("distance", T.DoubleType()),
            T.StructField("_order", T.DoubleType()),
        ]
    )

    def one_block(table: pa.Table) -> DataFrame:
        scan = c
        for name in shared_cols:
            values = table[name].unique().to_pylist()
            if len(values) <= PRUNE_KEYS:
                scan = scan.filter(F.col(name).isin(values))
        scan = scan.select(*columns)
        bounds = np.full(table.num_rows, np.inf if max_distance is None else float(max_distance))
        if bound_sample and mode == "top_k":
            sampled = best(scan.sample(False, bound_sample, 17), table, bounds)
            kth = sampled.groupBy(query_id).agg(F.max("distance").alias("d"), F.count("*").alias("n"))
            known = {r[query_id]: r["d"] for r in kth.filter(F.col("n") == k).toLocalIterator()}
            ids = table[query_id].to_pylist()
            bounds = np.minimum(bounds, np.array([known.get(i, np.inf) for i in ids]))
        return best(scan, table, bounds)

    by_distance = mode == "top_k"

    def best(scan: DataFrame, table: pa.Table, bounds: np.ndarray) -> DataFrame:
        shared = spark.sparkContext.broadcast(
            (
                table[query_id].combine_chunks() if table.num_rows else None,
                blocks.to_matrix(table[query_vector]),
                _by_key(table[key]) if key else None,
                bounds,
            )
        )

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, matrix, groups, limits = shared.value
            if query_ids is None:
                return
            limits = limits.copy()
            held: tuple | None = None
            item_type = None
            for batch in batches:
                item_type = batch.column(item_id).type
                qi, vi, dist, place = scored(batch, matrix, groups, limits)
                if not len(qi):
                    continue
                items = _values(batch.column(item_id).take(pa.array(vi)))
                if held is not None:
                    qi, items = np.concatenate([held[0], qi]), np.concatenate([held[1], items])
                    dist, place = np.concatenate([held[2], dist]), np.concatenate([held[3], place])
                top = blocks.keep_first(qi, [place, items], k)
                held = qi[top], items[top], dist[top], place[top]
                if by_distance:
                    full, first, counts = np.unique(held[0], return_index=True, return_counts=True)
                    worst = np.maximum.reduceat(held[2], first)
                    limits[full[counts == k]] = np.minimum(limits[full], worst)[counts == k]
            if held is not None and len(held[0]):
                yield pa.RecordBatch.from_arrays(
                    [
                        query_ids.take(pa.array(held[0])),
                        pa.array(held[1].tolist(), item_type),
                        pa.array(held[2]),
                        pa.array(held[3]),
                    ],
                    names=schema.names,
                )

        partial = scan.mapInArrow(score, schema)
        return first_per_group(partial, [query_id], ["_order", item_id], k)

    def scored(rows, matrix: np.ndarray, groups: dict | None, limits: np.ndarray) -> tuple:
        """``query, row, distance, order`` of the first ``k`` rows of every query."""
        column = lambda name: rows.column(name).combine_chunks() if isinstance(rows, pa.Table) else rows.column(name)
        data = blocks.to_matrix(column(vector), matrix.shape[1])
        tie = pc.rank(column(item_id), tiebreaker="dense").to_numpy(zero_copy_only=False)
        ranks = None if by_distance else _values(column(item_rank)).astype(float)
        found = []
        if groups is None:
            found.append(blocks.within(data, matrix, metric, p, k, limits, tie, ranks, max_distance))
        else:
            for value, own in _by_key(column(key)).items():
                refs = groups.get(value)
                if refs is not None:
                    place = None if ranks is None else ranks[own]
                    r, v, d = blocks.within(data[own], matrix[refs], metric, p, k, limits[refs], tie[own], place, max_distance)
                    found.append((refs[r], own[v], d))
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        qi, vi, dist = (np.concatenate(parts) for parts in zip(*found, none))
        return qi, vi, dist, np.round(dist, blocks.TIE_DIGITS) if by_distance else ranks[vi]

    def paired(sample: pa.Table) -> DataFrame:
        """More queries than one block: blocks of queries meet slices of the corpus on the executors.

        The corpus goes to those blocks only that have its key, or to all of them without one. Each
        pair is a block and a slice of bounded size, so no query passes through the driver and the pairs
        of a task do not grow with the tables.
        """
        numbered = global_ordinals(q, [*shared_cols, query_id], "_position")
        side = _unit_rows(spark, numbered.count(), metric)
        rows = min(side, _block_rows(sample, query_vector, limit_bytes, k))
        left = numbered.withColumn("_block", F.floor(F.col("_position") / F.lit(rows))).drop("_position")
        left = materialise(left, "queries")
        if shared_cols:
            needed = materialise(left.select(*shared_cols, "_block").distinct(), "needed")
            right = c.join(broadcast_if_small(needed), shared_cols)
        else:
            last = left.agg(F.max("_block")).first()[0]
            right = c.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last))))
        right = right.select(*dict.fromkeys(columns), "_block")
        right, left = deal(right, left, ["_block"], [item_id], min(side, SLICE_ROWS))

        def unit(some: pa.Table, rows: pa.Table) -> pa.Table:
            matrix = blocks.to_matrix(some[query_vector]) if some.num_rows else np.zeros((0, 1))
            qi, vi, dist, place = (np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 2
            if some.num_rows and rows.num_rows:
                groups = _by_key(some[key]) if key else None
                bounds = np.full(len(matrix), np.inf if max_distance is None else float(max_distance))
                qi, vi, dist, place = scored(rows, matrix, groups, bounds)
            ids, items = some[query_id].take(pa.array(qi)), rows[item_id].take(pa.array(vi))
            return pa.table([ids, items, pa.array(dist), pa.array(place)], names=schema.names)

        units = left.groupBy("_block", "_slice").cogroup(right.groupBy("_block", "_slice"))
        return first_per_group(units.applyInArrow(unit, schema), [query_id], ["_order", item_id], k)

    # One job: limit() stops after the first few partitions of a large table.
    table = q.limit(HEAD_ROWS + 1).toArrow()
    small = table.num_rows <= min(HEAD_ROWS, _block_rows(table, query_vector, limit_bytes, k))
    out = one_block(table) if small else paired(table)
    if in_order:
        return out.select(query_id, item_id, "distance", "_order")
    if mode == "first_n":
        out = first_per_group(out.drop("rank"), [query_id], [F.round("distance", blocks.TIE_DIGITS), item_id], k)
    return out.select(query_id, item_id, "rank", "distance")
