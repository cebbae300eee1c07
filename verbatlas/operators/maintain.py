"""Append, upsert, delete and backfill.

A table of segments, vectors or documents is laid out in blocks of ordinals (``ord_block``), one folder
each. A change writes new folders for the blocks it touches and no other, beside the old ones, and counts
from the moment it is finished (see `versions`); a job or driver that dies on the way changes nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from verbatlas.operators.encode import Encoder, embed
from verbatlas.operators.versions import read_latest, write_version
from verbatlas.session import BROADCAST_LIMIT_BYTES, broadcast_if_small, materialise
from verbatlas.sources.tables import pick

BLOCK_ROWS = 1 << 20
TASK_ROWS = 1 << 18


def with_block(df: DataFrame, block_rows: int = BLOCK_ROWS, ordinal: str = "ordinal") -> DataFrame:
    return df.withColumn("ord_block", F.floor(F.col(ordinal) / F.lit(block_rows)))


def save_blocks(df: DataFrame, path: str, block_rows: int = BLOCK_ROWS, ordinal: str = "ordinal") -> None:
    """Write in ordinal order, a folder per block; what was there before no longer counts."""
    write_version(with_block(df.drop("ord_block"), block_rows, ordinal), path, "ord_block", [ordinal], replace=True)


def read_blocks(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The table as it stands, with the column ``ord_block``."""
    return read_latest(spark, path, "ord_block", schema)


def overwrite_blocks(
    df: DataFrame, path: str, block_rows: int = BLOCK_ROWS, ordinal: str = "ordinal", gone: Sequence = (), batch: str | None = None
) -> None:
    """Replace exactly the blocks that occur in ``df``, and drop those in ``gone``."""
    laid_out = with_block(df.drop("ord_block"), block_rows, ordinal)
    write_version(laid_out, path, "ord_block", [ordinal], gone=gone, batch=batch)


def _by_key(rows: DataFrame, key: str) -> DataFrame:
    """Dealt by key to so many tasks that none sorts more rows when there are more of them."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(width, math.ceil(rows.count() / TASK_ROWS)), key)


def append_new(existing: DataFrame, arriving: DataFrame, key: str = "script_id") -> DataFrame:
    """The arriving rows whose key is not stored yet, each key once.

    The arriving keys are looked up in the store, so a short delivery does not make
    the keys of the whole store move. Of rows with one key the same one wins on every run.
    """
    arriving, stored = _by_key(arriving, key), existing.select(key)
    if arriving.count() * 64 > BROADCAST_LIMIT_BYTES:
        stored = _by_key(stored, key)
    known = pick(stored, arriving, key)
    return _one_per_key(arriving.join(known, key, "left_anti"), key, [])


def _content(field: T.StructField) -> Column:
    """A column as something that can be hashed; maps cannot, so what holds one goes as sorted JSON text."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(column)))
    return F.to_json(F.struct(column)) if "map<" in field.dataType.simpleString() else column


def _one_per_key(rows: DataFrame, key: str, order: list) -> DataFrame:
    """The first row of every key; what ties in ``order`` is decided by the content of the rows."""
    content = F.xxhash64(*[_content(f) for f in rows.schema.fields])
    window = Window.partitionBy(key).orderBy(*order, content)
    return rows.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def latest(versions: DataFrame, key: str, version: str) -> DataFrame:
    """The row with the highest version per key; equal versions are decided by content."""
    return _one_per_key(versions, key, [F.col(version).desc()])


def upsert(base: DataFrame, updates: DataFrame, key: str = "script_id", version: str = "version") -> DataFrame:
    """Last write wins: per key the update with the highest version, else the base row.

    The keys of the updates are written and counted first. If they are few, the base
    is filtered where it lies and neither sorted nor shuffled.
    """
    winners = latest(updates, key, version).select(*base.columns)
    touched = materialise(updates.select(key).distinct(), "touched")
    untouched = base.join(broadcast_if_small(touched), key, "left_anti").select(*base.columns)
    return untouched.unionByName(winners)


def upsert_blocks(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str = "script_id",
    version: str = "version",
    block_rows: int = BLOCK_ROWS,
) -> None:
    """Upsert into a saved table.

    The base is read where an update falls or a key of one is stored; keys are looked up by
    their column alone. One row per key remains.
    """
    base = read_blocks(spark, path)
    winners = materialise(latest(updates, key, version), "winners")
    # An update may carry another ordinal than the row it replaces: that row's block is rewritten, too.
    old = pick(base.select(key, "ord_block"), winners, key).select("ord_block")
    touched = with_block(winners, block_rows).select("ord_block").union(old).distinct()
    touched = materialise(touched, "blocks")
    affected = base.join(broadcast_if_small(touched), "ord_block", "left_semi").drop("ord_block")
    new = materialise(upsert(affected, winners, key, version), "rewritten")
    filled = with_block(new, block_rows).select("ord_block").distinct()
    emptied = [r["ord_block"] for r in touched.join(filled, "ord_block", "left_anti").toLocalIterator()]
    overwrite_blocks(new, path, block_rows, gone=emptied)


def delete_range(df: DataFrame, start: int, stop: int | None = None, ordinal: str = "ordinal") -> DataFrame:
    """Without the ordinals ``start <= n < stop``; ordinals that do not exist are no error."""
    gone = F.col(ordinal) >= start
    if stop is not None:
        gone = gone & (F.col(ordinal) < stop)
    return df.filter(~gone)


def delete_blocks(spark: SparkSession, path: str, start: int, stop: int | None = None, block_rows: int = BLOCK_ROWS) -> None:
    """Remove a range of ordinals from a saved table.

    Blocks inside the range are dropped; only the two at its ends are read and written anew.
    """
    base = read_blocks(spark, path)
    stored = [r["ord_block"] for r in base.select("ord_block").distinct().toLocalIterator()]
    low, high = start // block_rows, None if stop is None else (stop - 1) // block_rows
    hit = [b for b in stored if b >= low and (high is None or b <= high)]
    ends = [b for b in hit if b in (low, high)]
    kept = delete_range(base.filter(F.col("ord_block").isin(ends)), start, stop)
    kept = materialise(kept.drop("ord_block"), "kept")
    filled = {r["ord_block"] for r in with_block(kept, block_rows).select("ord_block").distinct().collect()}  # two at most
    overwrite_blocks(kept, path, block_rows, gone=[b for b in hit if b not in filled])


def reencode_range(
    segments: DataFrame, encoder: Encoder, start: int, stop: int, ordinal: str = "ordinal", text: str = "text"
) -> DataFrame:
    """New vectors for the texts of the ordinals ``start <= n < stop``."""
    window = segments.filter((F.col(ordinal) >= start) & (F.col(ordinal) < stop))
    return embed(window, encoder, text).drop(text)


def backfill(vectors: DataFrame, patch: DataFrame, key: str = "script_id") -> DataFrame:
    """Put re-encoded vectors in place of the stored ones, adding those that were absent."""
    return upsert(vectors, patch.withColumn("version", F.lit(1)), key)
