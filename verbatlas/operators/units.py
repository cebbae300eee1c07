"""Units of bounded size: slices of the rows of a block, each beside all partners of that block."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.session import broadcast_if_small, materialise


def deal(many: DataFrame, few: DataFrame, block: Sequence[str], by: Sequence[str], most: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_slice``; ``block`` and ``_slice`` are the unit of a row.

    The rows of ``many`` in a block are dealt over as many slices as keep each at about ``most``
    rows, by the hash of ``by``; every row of ``few`` goes to all slices of its block. Each block
    has its own number of slices, so a large one does not multiply the partners of the others.
    """
    counted = many.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"))
    sizes = counted.select(*block, F.ceil(F.col("_n") / F.lit(most)).cast("int").alias("_slices"))
    sizes = broadcast_if_small(materialise(sizes, "slices"))
    dealt = many.join(sizes, [*block]).withColumn("_slice", F.pmod(F.xxhash64(*by), F.col("_slices")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))
    return dealt.drop("_slices"), few.join(sizes, [*block]).withColumn("_slice", every).drop("_slices")
