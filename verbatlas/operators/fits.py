"""The steps of a k-means fit, flat or nested, with the centres as a table.

Points never move. Centres that fit one block are broadcast, and each task adds up its own points per
centre in the same pass that finds the closest; more centres go through the assignment by blocks. Only
sums per centre are shuffled, and merged in two rounds of Arrow groups. Centres that fit a block are set
anew by the driver, which has to broadcast them anyway, so a step is one job; more of them are joined with
their sums and written to the shared folder, and never pass through the driver.

A nested fit gives every centre a ``key`` (the cell it belongs to). All cells take their steps together:
the number of jobs depends on the number of steps alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatlas.functions import blocks
from verbatlas.operators.nearest import _by_key, assign, fits_block
from verbatlas.operators.ordering import first_per_group, global_ordinals
from verbatlas.operators.sampling import sample_exact, sample_key
from verbatlas.session import materialise

# Sums that a task holds before it hands them on.
HELD_BYTES = 32 * 1024 * 1024
FAN = 64  # sources merged in the first round go to so many groups


def _sums_schema(points: DataFrame, keys: list[str], label: T.DataType) -> T.StructType:
    fields = [T.StructField(k, label if k == "label" else points.schema[k].dataType) for k in keys]
    sums = T.StructField("sums", T.ArrayType(T.DoubleType()))
    return T.StructType([*fields, T.StructField("n", T.LongType()), sums, T.StructField("source", T.IntegerType())])


def _emit(keys: list[pa.Array], counts: np.ndarray, sums: np.ndarray, names: list[str]) -> pa.RecordBatch:
    source = pa.array(np.full(len(counts), TaskContext.get().partitionId()), pa.int32())
    return pa.RecordBatch.from_arrays([*keys, pa.array(counts, pa.int64()), blocks.to_lists(sums), source], names)


def _add_rows(matrix: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The codes that occur, and number and sum of the rows of each."""
    order = np.argsort(codes, kind="stable")
    used, starts = np.unique(codes[order], return_index=True)
    counts = np.diff(np.append(starts, len(codes)))
    return used, counts, np.add.reduceat(matrix[order], starts, axis=0) if len(used) else matrix[:0]


def _block_sums(points: DataFrame, table: pa.Table, vector: str, key: str | None, schema: T.StructType) -> DataFrame:
    """Closest centre and sums in one pass; the centres are in every task."""
    table = table.sort_by([(key, "ascending"), ("label", "ascending")] if key else "label").combine_chunks()
    names = [key, "label"] if key else ["label"]
    shared = points.sparkSession.sparkContext.broadcast(
        ([table[c].combine_chunks() for c in names], blocks.to_matrix(table["centroid"]), _by_key(table[key]) if key else None)
    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, centres, groups = shared.value
        totals, counts = np.zeros(centres.shape), np.zeros(len(centres), np.int64)
        for batch in batches:
            data = blocks.to_matrix(batch.column(vector), centres.shape[1])
            if groups is None:
                best, _ = blocks.nearest_ref(data, centres, "euclidean")
            else:
                best = np.full(len(data), -1, np.int64)
                for value, own in _by_key(batch.column(key)).items():
                    if value in groups:
                        at, _ = blocks.nearest_ref(data[own], centres[groups[value]], "euclidean")
                        best[own] = np.where(at >= 0, groups[value][at], -1)
            used, n, sums = _add_rows(data[best >= 0], best[best >= 0])
            totals[used] += sums
            counts[used] += n
        used = np.flatnonzero(counts)
        yield _emit([k.take(pa.array(used)) for k in keys], counts[used], totals[used], schema.names)

    return points.mapInArrow(add, schema)


def _codes(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """A number for every combination of some columns, and a row where each number occurs."""
    code = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        coded = column.dictionary_encode()
        code = code * max(1, len(coded.dictionary)) + coded.indices.to_numpy(zero_copy_only=False)
    _, rows, code = np.unique(code, return_index=True, return_inverse=True)
    return code, rows


def _labelled_sums(assigned: DataFrame, keys: list[str], vector: str, schema: T.StructType) -> DataFrame:
    """Sums of rows that have their centre already; a task hands on what it holds when it grows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        types = None

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(c), t) for c, t in zip(zip(*held), types, strict=True)]
            counts, sums = (np.array(c) for c in zip(*held.values()))
            held.clear()
            return _emit(columns, counts, sums, schema.names)

        for batch in batches:
            columns = [batch.column(k) for k in keys]
            types = [c.type for c in columns]
            code, rows = _codes(columns)
            data = blocks.to_matrix(batch.column(vector))
            _, counts, sums = _add_rows(data, code)
            for name, n, total in zip(zip(*[c.take(pa.array(rows)).to_pylist() for c in columns]), counts, sums):
                old = held.setdefault(name, [0, np.zeros(data.shape[1])])
                old[0] += int(n)
                old[1] = old[1] + total
            if held and len(held) * data.shape[1] * 8 > HELD_BYTES:
                yield out()
        if held:
            yield out()

    return assigned.select(*keys, vector).mapInArrow(add, schema)


def merge_sums(partial: DataFrame, keys: list[str]) -> DataFrame:
    """One row ``keys, n, sums`` per key; first per key and group of sources, then per key.

    Keys are dealt to as many groups as the session shuffles to, so a group adds up many keys at once
    and no key meets more than ``FAN`` rows in the second round.
    """
    groups = int(partial.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    schema = partial.schema

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by([*[(k, "ascending") for k in keys], ("source", "ascending")]).combine_chunks()
        code, rows = _codes([table[k] for k in keys])
        matrix = blocks.to_matrix(table["sums"])
        _, _, sums = _add_rows(matrix, code)
        counts = np.zeros(len(rows), np.int64)
        np.add.at(counts, code, table["n"].to_numpy())
        columns = [table[k].take(pa.array(rows)) for k in keys]
        source = pa.array(np.full(len(rows), table["source"][0].as_py()), pa.int32())
        return pa.table([*columns, pa.array(counts), blocks.to_lists(sums), source], names=schema.names)

    bucket = F.pmod(F.xxhash64(*keys), F.lit(groups))
    first = partial.groupBy(bucket.alias("_b"), F.pmod("source", F.lit(FAN)).alias("_s")).applyInArrow(add, schema)
    return first.groupBy(bucket.alias("_b")).applyInArrow(add, schema).drop("source")


def _points(points: DataFrame, vector: str, key: str | None) -> DataFrame:
    return points.filter(F.col(vector).isNotNull()).select(*([key] if key else []), vector)


def _block_step(points: DataFrame, table: pa.Table, vector: str, key: str | None, running: bool, schema: T.StructType) -> tuple[pa.Table, bool]:
    """One step of centres that fit a block, and whether one of them moved."""
    keys = [key, "label"] if key else ["label"]
    table = table.sort_by([(k, "ascending") for k in keys]).combine_chunks()
    won = merge_sums(_block_sums(points, table, vector, key, schema), keys).toArrow()
    place = {k: i for i, k in enumerate(zip(*(table[k].to_pylist() for k in keys), strict=True))}
    at = np.array([place[k] for k in zip(*(won[k].to_pylist() for k in keys), strict=True)], np.int64)
    old, seen = blocks.to_matrix(table["centroid"]), table["n"].to_numpy()
    counts, sums = won["n"].to_numpy(), blocks.to_matrix(won["sums"], old.shape[1])
    new, n = old.copy(), seen.copy() if running else np.zeros_like(seen)
    if running:
        new[at] = (old[at] * seen[at, None] + sums) / (seen[at] + counts)[:, None]
        n[at] += counts
    else:
        new[at], n[at] = sums / counts[:, None], counts
    columns = {**{k: table[k] for k in keys}, "centroid": blocks.to_lists(new), "n": pa.array(n)}
    return pa.table(columns), not np.array_equal(old, new)


def _table_sums(points: DataFrame, centres: DataFrame, vector: str, key: str | None, limit_bytes: int | None, schema: T.StructType) -> DataFrame:
    """Number and sum of the points that each of many centres wins."""
    keys = [key, "label"] if key else ["label"]
    placed = assign(
        points.withColumn("_none", F.lit(0)), centres.select(*keys, "centroid"), item_id="_none", vector=vector, centre_id="label", key=key,
        keep=[*([key] if key else []), vector], limit_bytes=limit_bytes,
    )
    return merge_sums(_labelled_sums(placed, keys, vector, schema), keys)


def _table_step(
    points: DataFrame, centres: DataFrame, vector: str, key: str | None, running: bool, limit_bytes: int | None, schema: T.StructType
) -> DataFrame:
    """One step of any number of centres, written, with the column ``moved``."""
    keys = [key, "label"] if key else ["label"]
    sums = _table_sums(points, centres, vector, key, limit_bytes, schema).withColumnRenamed("n", "won")
    both = centres.select(*keys, "centroid", "n").join(sums, keys, "left")
    if running:
        mean = F.zip_with("centroid", "sums", lambda c, s: (c * F.col("n") + s) / (F.col("n") + F.col("won")))
        n = F.col("n") + F.coalesce("won", F.lit(0))
    else:
        mean, n = F.transform("sums", lambda s: s / F.col("won")), F.coalesce("won", F.lit(0))
    new = F.when(F.col("won").isNull(), F.col("centroid")).otherwise(mean)
    out = both.select(*keys, new.alias("centroid"), n.cast("bigint").alias("n"), (new != F.col("centroid")).alias("moved"))
    return materialise(out, "centres")


class _State:
    """The centres between two steps: an Arrow table of at most one block, or a written table."""

    def __init__(self, points: DataFrame, centres: DataFrame, vector: str, key: str | None, limit_bytes: int | None):
        self.names = [*([key] if key else []), "label", "centroid", "n"]
        self.vector, self.key, self.limit, self.spark = vector, key, limit_bytes, points.sparkSession
        self.schema = _sums_schema(points, self.names[:-2], centres.schema["label"].dataType)
        self.centres = centres.select(*self.names)
        self.table = fits_block(self.centres, "centroid", limit_bytes)

    def step(self, points: DataFrame, running: bool) -> bool:
        """Every centre becomes the mean of all points it has won so far (``running``), or of those it wins now.

        One that wins nothing stays. Whether any has moved is returned.
        """
        points = _points(points, self.vector, self.key)
        if self.table is not None and self.table.num_rows:
            self.table, moved = _block_step(points, self.table, self.vector, self.key, running, self.schema)
            return moved
        self.centres = _table_step(points, self.centres, self.vector, self.key, running, self.limit, self.schema)
        return bool(self.centres.agg(F.bool_or("moved")).first()[0])

    def result(self) -> DataFrame:
        if self.table is not None and self.table.num_rows:
            return self.spark.createDataFrame(self.table.select(self.names), self.centres.schema)
        return self.centres.select(*self.names)


def start(vectors: DataFrame, k: int, init: DataFrame | None, item_id: str, vector: str, seed: int) -> DataFrame:
    """``label, centroid, n`` of ``k`` distinct starting vectors, numbered in id order: given, or an exact seeded sample."""
    if init is None:
        init = sample_exact(vectors.select(item_id, vector), k, item_id, seed)
    init = init.select(item_id, F.col(vector).cast("array<double>").alias("centroid"))
    table = fits_block(init, "centroid")
    if table is not None:
        table = table.sort_by(item_id)
        labels = pa.array(range(table.num_rows), pa.int32())
        found, rows = table.num_rows, vectors.sparkSession.createDataFrame(table.select(["centroid"]).append_column("label", labels))
    else:
        rows = global_ordinals(init, [item_id], "label").withColumn("label", F.col("label").cast("int"))
        found = rows.count()
    if found != k:
        raise ValueError(f"need {k} starting vectors, got {found}")
    return rows.select("label", "centroid", F.lit(0).cast("bigint").alias("n"))


def _draw(item_id: str, seed: int, number: int) -> Column:
    """A number from 0 up to 1 by the hash of seed, round and id: the first 52 bits."""
    text = F.concat(F.lit(f"{seed}:{number}:"), F.col(item_id).cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def candidates(
    vectors: DataFrame, k: int, *, rounds: int = 2, share: float = 2.0, item_id: str = "script_id", vector: str = "vector", seed: int = 0
) -> DataFrame:
    """``candidate, centroid, weight``: vectors drawn far from each other, and how many are nearest to each.

    The rounds of k-means||: from the vector with the smallest hash on, every vector is drawn with ``share * k``
    times its part of the sum of squared distances to the candidates so far. Draws are hashes of the ids,
    so the same vectors come out on every run. A round is one assignment; nothing is gathered.
    """
    points = vectors.filter(F.col(vector).isNotNull()).select(item_id, vector)
    first = points.orderBy(sample_key(item_id, seed), item_id).limit(1)
    found = materialise(first.select(F.col(item_id).alias("candidate"), F.col(vector).alias("centroid")), "candidates")
    for number in range(1, rounds + 1):
        near = assign(points, found, item_id=item_id, vector=vector, centre_id="candidate", keep=[vector])
        near = materialise(near.withColumn("square", F.col("distance") * F.col("distance")), "near")
        total = near.agg(F.sum("square")).first()[0]
        if not total:
            break
        drawn = near.filter(_draw(item_id, seed, number) < F.lit(share * k) * F.col("square") / F.lit(total))
        found = materialise(found.unionByName(drawn.select(F.col(item_id).alias("candidate"), F.col(vector).alias("centroid"))), "candidates")
    held = assign(points, found, item_id=item_id, vector=vector, centre_id="candidate").groupBy("candidate").agg(F.count(F.lit(1)).alias("weight"))
    return found.join(held, "candidate", "left").select("candidate", "centroid", F.coalesce("weight", F.lit(0)).alias("weight"))


def heaviest(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` candidates that most vectors are nearest to; the smaller id of equal ones."""
    return found.orderBy(F.desc("weight"), "candidate").limit(k)


def run(
    points: DataFrame,
    centres: DataFrame,
    steps: int,
    *,
    vector: str = "vector",
    key: str | None = None,
    ordinal: str | None = None,
    chunk_size: int | None = None,
    limit_bytes: int | None = None,
) -> DataFrame:
    """Full passes until ``steps`` or until no centre moves; with ``chunk_size`` one running step per chunk of ordinals."""
    state = _State(points, centres, vector, key, limit_bytes)
    if chunk_size:
        last = points.agg(F.max(ordinal)).first()[0]
        for low in range(0, 0 if last is None else last + 1, chunk_size):
            state.step(points.filter((F.col(ordinal) >= low) & (F.col(ordinal) < low + chunk_size)), True)
        return state.result()
    for _ in range(steps):
        if not state.step(points, False):
            break
    return state.result()


def fit_nested(
    vectors: DataFrame,
    k2: int,
    k1: int,
    *,
    coarse_steps: int = 20,
    steps: int = 20,
    chunk_size: int | None = None,
    ordinal: str = "ordinal",
    item_id: str = "script_id",
    vector: str = "vector",
    seed: int = 0,
    limit_bytes: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A fit of ``k2`` cells, and inside every cell one of up to ``k1`` centres: ``(level 1, level 2, cell of every vector)``.

    Level 1 has ``cell, label, centroid, n``; level 2 ``cell, centroid, n``; the last ``item_id, cell, vector``
    (and the ordinal, where chunks are asked for). A cell starts from those of its members that have the
    smallest seeded hashes of their ids, numbered in id order; one with fewer than ``k1`` members has as
    many centres. All cells are fitted at once, so the number of jobs depends neither on ``k1`` nor on ``k2``,
    and no set of centres larger than a block passes through the driver.
    """
    coarse = run(vectors, start(vectors, k2, None, item_id, vector, seed), coarse_steps, vector=vector, limit_bytes=limit_bytes)
    level2 = materialise(coarse.withColumnRenamed("label", "cell"), "level2")
    keep = [vector, *([ordinal] if chunk_size and ordinal != item_id else [])]
    placed = assign(vectors, level2, item_id=item_id, vector=vector, centre_id="cell", keep=keep, limit_bytes=limit_bytes)
    placed = materialise(placed.drop("distance"), "cells")

    keyed = placed.select("cell", item_id, F.col(vector).cast("array<double>").alias("centroid"), sample_key(item_id, seed).alias("_key"))
    chosen = materialise(first_per_group(keyed, ["cell"], ["_key", item_id], k1, "_place"), "starts")
    # A cell has at most k1 rows here.
    ordered = first_per_group(chosen, ["cell"], [item_id], k1, "_place").withColumn("label", (F.col("_place") - 1).cast("int"))
    centres = materialise(ordered.select("cell", "label", "centroid", F.lit(0).cast("bigint").alias("n")), "centres")
    level1 = run(
        placed, centres, steps, vector=vector, key="cell", ordinal=ordinal, chunk_size=chunk_size, limit_bytes=limit_bytes
    )
    return level1, level2, placed
