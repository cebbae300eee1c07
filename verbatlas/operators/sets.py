"""Distinct ids, reconciliation and checks between two sets of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatlas.session import broadcast_if_small


def dedup_first(df: DataFrame, value: str, position: str) -> DataFrame:
    """Every value once, with the position of its first occurrence; empty values go."""
    kept = df.filter(F.col(value).isNotNull() & (F.col(value).cast("string") != ""))
    return kept.groupBy(value).agg(F.min(position).alias(position))


def duplicate_check(df: DataFrame, value: str) -> DataFrame:
    """Rows, distinct values, and whether the two are the same number.

    Values are compared by SHA-256, so a long text costs 32 bytes in the shuffle, and
    copies of one text are merged within each task before it.
    """
    digest = F.sha2(F.col(value).cast("string").cast("binary"), 256)
    groups = df.filter(F.col(value).isNotNull()).groupBy(digest.alias("_digest")).agg(F.count("*").alias("_n"))
    totals = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n"), F.count("*").alias("n_distinct")
    )
    return totals.withColumn("unique", F.col("n") == F.col("n_distinct"))


def reconcile(expected: DataFrame, stored: DataFrame, item_id: str = "script_id") -> DataFrame:
    """Ids on one side only, tagged ``missing`` or ``unexpected``.

    Both sides meet in one aggregate with partial sums, so each id is shuffled once
    and repeated ids collapse before the shuffle.
    """
    tagged = expected.select(item_id, F.lit(1).alias("_e"), F.lit(0).alias("_s")).unionByName(
        stored.select(item_id, F.lit(0).alias("_e"), F.lit(1).alias("_s"))
    )
    sides = tagged.groupBy(item_id).agg(F.max("_e").alias("_e"), F.max("_s").alias("_s"))
    side = F.when(F.col("_e") == 1, "missing").otherwise("unexpected")
    return sides.filter(F.col("_e") != F.col("_s")).select(item_id, side.alias("side"))


def resolve(df: DataFrame, known: DataFrame, name: str, found: str, unresolved: str = "-") -> tuple[DataFrame, DataFrame]:
    """Look names up in a table of known ids: ``(resolved rows, rejected rows)``.

    ``known`` has one row per name. It is sent to the rows where its size allows, since one
    name may stand on a third of them.
    """
    joined = df.join(broadcast_if_small(known.select(name, found)), name, "left")
    bad = F.col(found).isNull() | (F.col(found) == unresolved)
    return joined.filter(~bad), joined.filter(bad).drop(found)


def distinct_characters(text: Column) -> Column:
    return F.size(F.array_distinct(F.split(text, "")))
