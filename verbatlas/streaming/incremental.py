"""Streams of arrivals: assigned to the clusters, added to an index, published; each file and key once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbatlas.operators.encode import Encoder, embed
from verbatlas.operators.maintain import BLOCK_ROWS, append_new
from verbatlas.operators.nearest import assign
from verbatlas.operators.versions import batches, read_latest, write_version
from verbatlas.plans.index import append_to_index
from verbatlas.session import materialise


def run_available(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    centres: DataFrame,
    out: str,
    checkpoint: str,
    *,
    encoder: Encoder | None = None,
    item_id: str = "script_id",
    vector: str = "vector",
    text: str = "text",
    metric: str = "euclidean",
    max_files: int | None = None,
) -> None:
    """Work off all files that arrived in ``source`` since the last call, then stop.

    The checkpoint remembers the files, so nothing is kept by hand. A batch is written
    to a folder named after its number and replaces it when the batch has to be run
    again after a failure; the result is the same as that of one large run.
    """

    def work(batch: DataFrame, number: int) -> None:
        rows = batch if encoder is None else embed(batch, encoder, text, vector)
        placed = assign(rows, centres, item_id=item_id, vector=vector, metric=metric)
        placed.write.mode("overwrite").parquet(f"{out}/batch_no={number}")

    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(source).writeStream.foreachBatch(work)
    stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_assigned(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("batch_no")


def _run(stream, work, checkpoint: str) -> None:
    stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _source(spark: SparkSession, source: str, schema: T.StructType, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).parquet(source)


def grow_available(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    index_path: str,
    checkpoint: str,
    encoder: Encoder,
    order_by: list[str],
    *,
    block_rows: int = BLOCK_ROWS,
    max_files: int | None = None,
    name: str = "stream",
) -> None:
    """Add all captions that arrived in ``source`` since the last call to a saved two-level index.

    Ordinals go on where the index ends. The number of a micro-batch is kept with the version of the segments
    that it wrote, so a batch that is run again after a failure, or with a lost checkpoint of its end,
    changes nothing.
    """

    def work(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            append_to_index(spark, index_path, batch, encoder, order_by, block_rows, batch=f"{name}-{number}")

    _run(_source(spark, source, schema, max_files), work, checkpoint)


def publish_available(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    *,
    key: str = "script_id",
    event_time: str | None = None,
    delay: str = "1 hour",
    max_files: int | None = None,
    name: str = "stream",
) -> None:
    """Publish all documents that arrived in ``source`` since the last call, every key once.

    Within a micro-batch one row per key is kept, keys that the store holds are looked up and left out, and
    the number of the batch is kept with what it wrote, so a batch that is run again writes nothing. With
    ``event_time`` repeated keys within ``delay`` are dropped by the stream's own state before they reach
    a batch, which spares the look-up; like every watermark it also drops rows that lag behind the newest
    by more than ``delay``. Without it nothing is dropped but repeated keys.
    """
    stream = _source(spark, source, schema, max_files)
    if event_time is not None:
        stream = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])

    def work(batch: DataFrame, number: int) -> None:
        label = f"{name}-{number}"
        if label in batches(spark, path):
            return
        # The files of a batch are fixed, so it can be read twice; only what passed the stream's own state is kept.
        arrived = batch if event_time is None else materialise(batch, "arrived")
        fresh = append_new(read_published(spark, path, schema), arrived, key)
        write_version(fresh.withColumn("delivery", F.lit(label)), path, "delivery", [key], batch=label)

    _run(stream, work, checkpoint)


def read_published(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The published documents."""
    with_part = T.StructType([*schema.fields, T.StructField("delivery", T.StringType())])
    return read_latest(spark, path, "delivery", with_part).drop("delivery")
