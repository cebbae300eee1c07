"""Subsets of a table, exact in size and the same on every run."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatlas.operators.ordering import global_ordinals
from verbatlas.session import broadcast_if_small, materialise

_HASH_DIGITS = 15  # hex digits of md5, compared as text


def sample_key(item_id: str, seed: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), F.col(item_id).cast("string"))
    return F.substring(F.md5(text.cast("binary")), 1, _HASH_DIGITS)


def sample_exact(df: DataFrame, n: int, item_id: str = "script_id", seed: int = 0) -> DataFrame:
    """``n`` rows without replacement: those with the smallest seeded hash of their id.

    Only the ids with a hash below an estimated cut are ordered, and what comes out
    of that is one boundary value. The rows themselves are then found by a filter, so
    the wide columns are neither sorted nor shuffled, whatever ``n`` is.
    """
    if n <= 0:
        return df.limit(0)
    keyed = df.select(sample_key(item_id, seed).alias("_key"), item_id)
    total = df.count()
    if n >= total:
        return df
    share = min(1.0, (n + 6 * math.sqrt(n) + 10) / total)
    cut = format(int(share * (16**_HASH_DIGITS - 1)), f"0{_HASH_DIGITS}x")
    below = materialise(keyed.filter(F.col("_key") <= F.lit(cut)), "below")
    if below.count() < n:
        below = keyed
    last = global_ordinals(below, ["_key", item_id], "_place").filter(F.col("_place") == n - 1).first()
    if below.filter((F.col("_key") == F.lit(last["_key"])) & (F.col(item_id) == F.lit(last[item_id]))).count() > 1:
        raise ValueError(f"{item_id} {last[item_id]!r} is not unique, so no exact number of rows can be drawn")
    key, edge = sample_key(item_id, seed), F.lit(last["_key"])
    return df.filter((key < edge) | ((key == edge) & (F.col(item_id) <= F.lit(last[item_id]))))


def sample_with_replacement(df: DataFrame, n: int, ordinal: str = "ordinal", seed: int = 0) -> DataFrame:
    """``n`` draws; a row comes out as often as its place was drawn.

    Places are 0..count-1 in the order of ``ordinal``, so gaps in the ordinals lose no draw. Draw i
    takes a place by the hash of seed and i, which is the same in every session.
    """
    total = df.count()
    if not total:
        return df.withColumn("draw", F.lit(None).cast("bigint")).limit(0)
    places = global_ordinals(df.select(ordinal), [ordinal], "_place")
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary")), 1, _HASH_DIGITS)
    place = F.conv(digits, 16, 10).cast("bigint") % F.lit(total)
    draws = df.sparkSession.range(n).select(F.col("id").alias("draw"), place.alias("_place"))
    drawn = materialise(draws.join(places, "_place").select("draw", ordinal), "draws")
    return broadcast_if_small(drawn).join(df, ordinal)


def prefix(df: DataFrame, n: int, ordinal: str = "ordinal") -> DataFrame:
    return df.filter(F.col(ordinal) < n)
