"""Principal components from moments that are kept and added to, chunk by chunk.

The moments of some vectors are their number, their sum, and the sum of the products of their components
about their own mean. Two sets of moments make those of all their vectors (Chan's formula), so tasks, chunks
and days can be added in any grouping, and a chunk is read once. A row of moments has width x width
numbers; rows are merged in groups of tasks, and one row comes back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatlas.functions import blocks
from verbatlas.operators.versions import batches, read_latest, write_version

MOMENTS = "n bigint, total array<double>, products array<double>, source bigint"
FAN = 16  # rows of moments merged at once


def _add(a: tuple | None, b: tuple) -> tuple:
    """The moments ``n, total, products`` of both together."""
    if a is None or a[0] == 0:
        return b
    if b[0] == 0:
        return a
    n = a[0] + b[0]
    apart = b[1] / b[0] - a[1] / a[0]
    return n, a[1] + b[1], a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def _batch(moments: tuple, source: int) -> pa.RecordBatch:
    n, total, products = moments
    lists = [pa.array([c], pa.list_(pa.float64())) for c in (total, products.ravel())]
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *lists, pa.array([source], pa.int64())], ["n", "total", "products", "source"])


def _unpack(table: pa.Table) -> tuple | None:
    """The sum of some rows of moments, always in the same order."""
    held = None
    for row in table.sort_by("source").to_pylist():
        total = np.array(row["total"])
        held = _add(held, (row["n"], total, np.array(row["products"]).reshape(len(total), len(total))))
    return held


def moments(vectors: DataFrame, vector: str = "vector") -> DataFrame:
    """One row of moments, or none where there are no vectors; null vectors do not count."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            data = blocks.to_matrix(batch.column(0))
            if len(data):
                centred = data - data.mean(axis=0)
                held = _add(held, (len(data), data.sum(axis=0), centred.T @ centred))
        if held is not None:
            yield _batch(held, TaskContext.get().partitionId())

    rows = vectors.filter(F.col(vector).isNotNull()).select(vector).mapInArrow(measure, MOMENTS)
    return merge_moments(rows)


def merge_moments(rows: DataFrame, count: int | None = None) -> DataFrame:
    """All rows of moments as one: in groups of sources, then the groups, so no task meets all rows of many tasks.

    ``count`` is a bound on the sources where one is known; few need no groups.
    """

    def merge(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_batch(_unpack(table), table["source"][0].as_py())])

    groups = [F.pmod(F.col("source"), F.lit(FAN**3)), F.pmod(F.col("source"), F.lit(FAN))]
    for group in [*(groups if count is None or count > FAN else []), F.lit(0)]:
        rows = rows.groupBy(group.alias("_g")).applyInArrow(merge, MOMENTS)
    return rows


def add_chunk(vectors: DataFrame, path: str, chunk: str, vector: str = "vector") -> None:
    """Keep the moments of one chunk in a table; a chunk that the table has already is not read again."""
    if chunk not in batches(vectors.sparkSession, path):
        write_version(moments(vectors, vector).withColumn("chunk", F.lit(chunk)), path, "chunk", [], batch=chunk)


def kept_moments(spark: SparkSession, path: str, chunks: list[str] | None = None) -> DataFrame:
    """One row of moments of all chunks kept, or of some."""
    rows = read_latest(spark, path, "chunk", MOMENTS + ", chunk string")
    if chunks is not None:
        rows = rows.filter(F.col("chunk").isin(chunks))
    # Chunks are numbered anew, so that equal sources do not decide their order.
    count = len(batches(spark, path)) if chunks is None else len(chunks)
    return merge_moments(rows.withColumn("source", F.crc32(F.col("chunk").cast("binary"))).drop("chunk"), count)


def components(row: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, the ``k`` main directions as columns, and the variances along them, falling.

    The largest entry of a direction is positive, so that its sign is the same on every run.
    """
    held = _unpack(row.toArrow())  # width x width numbers
    if held is None:
        raise ValueError("there are no vectors to reduce")
    n, total, products = held
    values, axes = np.linalg.eigh(products / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    return total / n, axes * signs, np.maximum(values, 0.0)


def project(vectors: DataFrame, mean: np.ndarray, axes: np.ndarray, *, vector: str = "vector", keep: list[str]) -> DataFrame:
    """``*keep, reduced``: every vector less the mean, along the directions."""
    shared = vectors.sparkSession.sparkContext.broadcast((mean, axes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, axes = shared.value
        for batch in batches:
            reduced = blocks.to_lists((blocks.to_matrix(batch.column(vector), len(mean)) - mean) @ axes)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], reduced], [*keep, "reduced"])

    rows = vectors.filter(F.col(vector).isNotNull()).select(*dict.fromkeys([*keep, vector]))
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("reduced", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(run, schema)
