"""Keyed Parquet tables: scan, lookup, multi-get, and centroid models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatlas.functions.ids import decode_id, encode_id
from verbatlas.session import broadcast_if_small, materialise


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str, schema: str | None = None, columns: Sequence[str] = ()) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(path)
    return table.select(*columns) if columns else table


def lookup(df: DataFrame, item: str | int, key: str = "script_id") -> DataFrame:
    """The row of one id (or ordinal); raises ``KeyError`` when there is none."""
    wanted = encode_id(F.lit(item)) if isinstance(item, int) and key == "script_id" else F.lit(item)
    found = df.filter(F.col(key) == wanted)
    if found.isEmpty():
        raise KeyError(f"{key} {item!r} is not stored")
    return found


def pick(table: DataFrame, ids: DataFrame, key: str = "script_id", block_rows: int | None = None) -> DataFrame:
    """The rows of a big table whose key is listed in ``ids``.

    The list is written and counted first. A short one is broadcast, so the table is
    filtered where it lies instead of being shuffled; a long one is joined. If the
    table is laid out in folders of ``block_rows`` ordinals, the folder of an id follows
    from the id itself, and only the folders that occur are opened.
    """
    wanted = materialise(ids.select(key).distinct(), "wanted")
    if block_rows is not None and "ord_block" in table.columns:
        # A broadcast of the block numbers prunes folders at run time, however many there are.
        blocks = wanted.select(F.floor(decode_id(F.col(key)) / F.lit(block_rows)).alias("ord_block")).distinct()
        table = table.join(broadcast_if_small(materialise(blocks, "blocks")), "ord_block", "left_semi")
    return table.join(broadcast_if_small(wanted), key, "left_semi")


def multi_get(ids: DataFrame, table: DataFrame, key: str = "script_id", missing: bool = True) -> DataFrame:
    """Rows of the listed ids; with ``missing`` an absent id stays, with nulls."""
    found = pick(table, ids, key)
    return ids.join(found, key, "left" if missing else "inner")
