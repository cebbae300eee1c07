"""Transcripts to the ``scripts`` table, and that table as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatlas.functions.ids import encode_id
from verbatlas.functions.text import clean_caption, repair_quotes
from verbatlas.operators.ordering import batch_window, global_ordinals
from verbatlas.schemas import SCRIPT_COLUMNS, SCRIPTS

# Longest list of captions in one row of a nested transcript.
PART_SIZE = 4096


def flatten_transcripts(transcripts: DataFrame, resume: int = 0, position: str | None = None) -> DataFrame:
    """One row per caption: ``video_id, text, timestamp, duration``.

    A video without segments gives no row. ``resume`` skips the videos at the first
    ``resume`` places of the ``position`` column.
    """
    if resume:
        if position is None:
            raise ValueError("resume needs the position column of the videos")
        transcripts = transcripts.filter(F.col(position) >= resume)
    rows = transcripts.select("video_id", F.explode("segments").alias("s"))
    return rows.select(
        "video_id",
        clean_caption(F.col("s.text")).alias("text"),
        F.col("s.start").alias("timestamp"),
        F.col("s.duration").alias("duration"),
    )


def nest_transcripts(rows: DataFrame, position: str, part_size: int = PART_SIZE) -> DataFrame:
    """Captions back to lists of captions: one row per video and ``part_size`` positions.

    ``position`` counts the captions of a video, so no list grows beyond ``part_size``.
    """
    segment = F.struct("text", F.col("timestamp").alias("start"), "duration")
    listed = F.array_sort(F.collect_list(F.struct(F.col(position).alias("_o"), segment.alias("s"))))
    part = F.floor(F.col(position) / F.lit(part_size)).alias("part")
    parts = rows.groupBy("video_id", part).agg(listed.alias("_l"))
    return parts.select("video_id", "part", F.col("_l.s").alias("segments"))


def write_scripts(df: DataFrame, path: str) -> None:
    """Append as CSV, all values quoted; every part file starts with the header."""
    df.select(*SCRIPT_COLUMNS).write.mode("append").option("header", True).option("quoteAll", True).option(
        "escape", '"'
    ).csv(path)


def read_scripts(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(SCRIPTS).option("header", True).option("escape", '"').option("mode", "FAILFAST").csv(path)
    )


def check_scripts(spark: SparkSession, path: str) -> int:
    """Number of rows; raises when a line does not parse."""
    scripts = read_scripts(spark, path)
    try:
        # The hash makes the scan parse every column; a bare count would need none.
        return scripts.agg(F.count("*").alias("n"), F.max(F.hash(*SCRIPT_COLUMNS))).first()["n"]
    except Exception as error:
        raise ValueError(f"{path} is not valid CSV for {SCRIPT_COLUMNS}") from error


def repair_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.withColumn(column, repair_quotes(F.col(column)))


def stringify_text(df: DataFrame, column: str = "text") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


def to_segments(
    scripts: DataFrame, order_by: list[str], *, batch_size: int | None = None, resume: int | None = None, until: int | None = None
) -> DataFrame:
    """Give every caption its ordinal and id: the ``segments`` table.

    With ``batch_size`` only the batches ``resume <= batch < until`` of ordinals are returned; the
    ordinals are those of the whole table.
    """
    numbered = global_ordinals(scripts, order_by)
    if batch_size is not None:
        numbered = batch_window(numbered, batch_size, resume, until)
    return numbered.select(
        "ordinal",
        encode_id(F.col("ordinal")).alias("script_id"),
        "video_id",
        F.col("timestamp").cast("double").alias("timestamp"),
        F.col("text").cast("string").alias("text"),
    )
