"""Line lists: one string per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatlas.operators.ordering import global_ordinals
from verbatlas.schemas import LINES


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines; ``position`` counts them 0, 1, ... file after file, by path, and line after line.

    Spark starts with the largest splits, so the order of its partitions says nothing; path and place
    of the split, and the row in it, do.
    """
    split = F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_at")
    lines = spark.read.schema(LINES).text(path, lineSep="\n").select("value", *split)
    lines = lines.withColumn("_row", F.monotonically_increasing_id()).filter(F.col("value") != "")
    return global_ordinals(lines, ["_path", "_at", "_row"], "position").select("position", "value")


def write_lines(df: DataFrame, path: str, column: str = "value") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("append").text(path, lineSep="\n")
