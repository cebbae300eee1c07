"""Dense ordinal <-> short opaque id, as column expressions.

An ordinal is mapped by ``x -> (x * MULTIPLIER + OFFSET) mod 36^7`` and written in
base 36, padded to seven characters. Ordinals from 36^7 on get the number of their
36^7-block as a prefix, so ids stay unique without a bound. All products stay below
2^63: one factor is cut into 18-bit pieces first, so no decimal arithmetic is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_LENGTH = 7
SPACE = 36**MIN_LENGTH
MULTIPLIER = 1580030173
INVERSE = 77586022261
OFFSET = 12345
_PIECE_BITS = 18


def _times_mod(value: Column, factor: int) -> Column:
    high = F.shiftright(value, _PIECE_BITS)
    low = value.bitwiseAND(F.lit((1 << _PIECE_BITS) - 1).cast("long"))
    shifted = F.shiftleft((high * F.lit(factor)) % F.lit(SPACE), _PIECE_BITS)
    return (shifted + low * F.lit(factor)) % F.lit(SPACE)


def _base36(value: Column) -> Column:
    return F.lower(F.conv(value.cast("string"), 10, 36))


def encode_id(ordinal: Column) -> Column:
    ordinal = ordinal.cast("long")
    mixed = (_times_mod(ordinal % F.lit(SPACE), MULTIPLIER) + F.lit(OFFSET)) % F.lit(SPACE)
    body = F.lpad(_base36(mixed), MIN_LENGTH, "0")
    block = F.floor(ordinal / F.lit(SPACE))
    return F.when(ordinal < F.lit(SPACE), body).otherwise(F.concat(_base36(block), body))


def decode_id(script_id: Column) -> Column:
    """The ordinal of an id, or null for a string that is no id."""
    well_formed = script_id.rlike(f"^[0-9a-z]{{{MIN_LENGTH},}}$")
    body = F.conv(F.right(script_id, F.lit(MIN_LENGTH)), 36, 10).cast("long")
    prefix = F.substring(script_id, F.lit(1), F.length(script_id) - MIN_LENGTH)
    block = F.when(prefix == "", F.lit(0)).otherwise(F.conv(prefix, 36, 10).cast("long"))
    unmixed = _times_mod((body + F.lit(SPACE - OFFSET)) % F.lit(SPACE), INVERSE)
    return F.when(well_formed, block * F.lit(SPACE) + unmixed)


def expected_ids(spark: SparkSession, start: int, stop: int) -> DataFrame:
    """The ids of the ordinals ``start .. stop-1``."""
    return spark.range(start, stop).select(
        F.col("id").alias("ordinal"), encode_id(F.col("id")).alias("script_id")
    )
