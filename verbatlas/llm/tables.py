"""Tables as the operators of this folder take them: only the columns they need, under their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatlas.operators.ordering import ranks_within
from verbatlas.session import BROADCAST_LIMIT_BYTES, materialise, spread

WORD = r"[^\x20\x09-\x0D]+"
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, item_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` (long) and ``body`` (string, null kept) of every row, however many other columns there are."""
    return spread(docs.select(F.col(item_id).cast("long").alias("id"), F.col(text).cast("string").alias("body")))


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(rows: DataFrame, by: list[str], order: list[Column], name: str = "number", counted: DataFrame | None = None) -> DataFrame:
    """Append 0, 1, ... among the rows that agree in ``by``, nulls included, in the order of ``order``.

    Rows that come once, nearly all of them as a rule, get 0 and are not shuffled. The others are ranked in
    range partitions, which split a value that very many rows share; rows that agree in everything are
    told apart by a draw, and any order of them is as good. ``counted`` may have ``by`` from a cheaper scan.
    """
    keys = [F.col(c).alias(f"_by{k}") for k, c in enumerate(by)]
    names = [f"_by{k}" for k in range(len(by))]
    several = (rows if counted is None else counted).select(*keys).groupBy(*names).agg(F.count(F.lit(1)).alias("_times"))
    several = materialise(several.where("_times > 1"), "several")
    n = several.count()
    if not n:
        return rows.withColumn(name, F.lit(0).cast("long"))
    same = F.lit(True)
    for c, key in zip(by, names, strict=True):
        same &= F.col(c).eqNullSafe(F.col(key))
    told = rows.join(F.broadcast(several) if n * 128 <= BROADCAST_LIMIT_BYTES else several, same, "left")
    once = told.where("_times is null").select(*rows.columns, F.lit(0).cast("long").alias(name))
    slot = F.to_json(F.struct(*names)).alias("_slot")  # never null
    many = told.where("_times is not null").select(*rows.columns, slot, *[c.alias(f"_o{k}") for k, c in enumerate(order)], F.rand(7).alias("_tie"))
    many = ranks_within(many, ["_slot"], [*[f"_o{k}" for k in range(len(order))], "_tie"], name)
    return once.union(many.select(*rows.columns, (F.col(name) - 1).cast("long").alias(name)))
