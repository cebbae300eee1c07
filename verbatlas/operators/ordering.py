"""Dense ordinals, ranks, batches and positions without a one-task window.

``row_number()`` over the whole table, or over a group that holds a third of it,
sorts that many rows in one task. Here the rows are range-partitioned by the full
sort key instead, numbered inside each partition, and shifted by the number of rows
that lie in earlier partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from verbatlas.functions.ids import encode_id
from verbatlas.session import broadcast_if_small, materialise

_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row below


def _numbered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sorted range partitions, written once so that every later job sees the same split."""
    sorted_df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    mark = F.monotonically_increasing_id()
    written = materialise(sorted_df.withColumn("_mark", mark), "ordered")
    return written.withColumns(
        {
            "_part": F.shiftright("_mark", _LOCAL_BITS),
            "_row": F.col("_mark").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
        }
    )


def global_ordinals(df: DataFrame, order_by: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Append 0..n-1 in the order of ``order_by``, whose values must be unique together."""
    rows = _numbered(df, list(order_by))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition of the table, so this window stays small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_row"))
        .drop("_mark", "_part", "_row", "_before")
    )


def ranks_within(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], name: str = "rank"
) -> DataFrame:
    """Append 1..n per group; a group of any size is spread over many tasks."""
    group = list(group_by)
    rows = _numbered(df, group + list(order_by))
    runs = rows.groupBy("_part", *group).agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    runs = materialise(runs, "runs")
    # At most one row per partition and group.
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    runs = runs.select("_part", *group, "_first", "_before")
    return (
        rows.join(broadcast_if_small(runs), ["_part", *group])
        .withColumn(name, F.col("_before") + F.col("_row") - F.col("_first") + F.lit(1))
        .drop("_mark", "_part", "_row", "_first", "_before")
    )


def assign_ordinals(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Row n of the corpus gets ordinal n and the id made from it."""
    return global_ordinals(df, order_by).withColumn("script_id", encode_id(F.col("ordinal")))


def batch_number(ordinal: Column, size: int) -> Column:
    return F.floor(ordinal / F.lit(size))


def batch_window(
    df: DataFrame, size: int, resume: int | None = None, until: int | None = None, ordinal: str = "ordinal"
) -> DataFrame:
    """Rows of the batches ``resume <= batch < until``, as a range that the scan can prune by."""
    if resume is not None:
        df = df.filter(F.col(ordinal) >= F.lit(resume * size))
    if until is not None:
        df = df.filter(F.col(ordinal) < F.lit(until * size))
    return df.withColumn("batch_no", batch_number(F.col(ordinal), size))


def first_per_group(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[Column | str], n: int, name: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of every group, in two steps.

    Every map task keeps only its own first ``n`` rows of a group. A group that is
    present in very many tasks is merged in slices first, so no task ever gets more
    than ``n`` rows per slice or per map task of one slice.
    """
    group = list(group_by)
    slices = _slices(df)
    if slices > 1:
        rest = [c for c in df.columns if c not in group]
        df = df.withColumn("_slice", F.pmod(F.xxhash64(*rest), F.lit(slices)))
        window = Window.partitionBy(*group, "_slice").orderBy(*order_by)
        df = df.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") <= n)
        df = df.drop("_place", "_slice")
    window = Window.partitionBy(*group).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def _slices(df: DataFrame) -> int:
    """Grows with the shuffle width the session is set up for; 1 on a small one."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")) // 32)


def zip_positions(left: DataFrame, right: DataFrame, value: str, order_by: Sequence[str]) -> DataFrame:
    """Pair two lists by position and keep the positions that differ or exist once."""
    a = global_ordinals(left, order_by, "position").select("position", F.col(value).alias("left_value"))
    b = global_ordinals(right, order_by, "position").select("position", F.col(value).alias("right_value"))
    both = a.join(b, "position", "full_outer")
    return both.filter(~F.col("left_value").eqNullSafe(F.col("right_value")))


def value_grid(df: DataFrame, columns: Sequence[str], limit: int = 10_000) -> DataFrame:
    """Every combination of the distinct values of some columns.

    The combinations that occur are found first, with a partial aggregate per task; they
    bound every list. A grid above ``limit`` rows is refused, because its size would no
    longer be a property of small lists.
    """
    seen = materialise(df.select(*columns).distinct(), "seen")
    if seen.count() > limit:
        raise ValueError(f"more than {limit} combinations occur already")
    lists = materialise(seen.agg(*[F.collect_set(c).alias(c) for c in columns]), "lists")
    size = lists.select(math.prod([F.size(c) for c in columns], start=F.lit(1)).alias("n")).first()["n"]
    if size > limit:
        raise ValueError(f"the grid would have {size} rows; the limit is {limit}")
    for c in columns:
        lists = lists.withColumn(c, F.explode(c))
    return lists
