"""Document-shaped outputs: segments with their vector, clusters, member chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatlas.functions.ids import encode_id
from verbatlas.functions.text import chunk_key
from verbatlas.operators.maintain import BLOCK_ROWS, append_new, upsert_blocks
from verbatlas.operators.ordering import ranks_within

# Fixed value: the size of a member chunk.
CHUNK_SIZE = 16_384


def documents(info: DataFrame, vectors: DataFrame, key: str = "script_id") -> DataFrame:
    """``script_id, video_id, timestamp, text, vector`` for ids that have both parts."""
    left = info.select(key, "video_id", "timestamp", "text")
    return left.join(vectors.select(key, "vector"), key)


def publish_documents(stored: DataFrame | None, docs: DataFrame, path: str, key: str = "script_id") -> None:
    """Append what is not stored yet, so that running it twice changes nothing."""
    fresh = docs if stored is None else append_new(stored, docs, key)
    fresh.write.mode("append").parquet(path)


def upsert_documents(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    batch_size: int,
    resume: int = 0,
    stop: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> None:
    """Set every document from ordinal ``resume`` on in a stored table, or add it.

    ``docs`` carries the ordinal. With ``stop`` only the first batch is written.
    """
    window = docs.filter(F.col("ordinal") >= resume)
    if stop:
        window = window.filter(F.col("ordinal") < resume + batch_size)
    upsert_blocks(spark, path, window.withColumn("version", F.lit(1)), block_rows=block_rows)


def publish_json(docs: DataFrame, path: str) -> None:
    docs.write.mode("append").json(path)


def seed_document(docs: DataFrame, ordinal: int = 0, key: str = "script_id") -> DataFrame:
    """The one document that a new store starts with."""
    return docs.filter(F.col(key) == encode_id(F.lit(ordinal)))


def omitted_documents(difference: DataFrame, docs: DataFrame, key: str = "script_id") -> DataFrame:
    """The documents whose ids a reconciliation reported as missing."""
    missing = difference.filter(F.col("side") == "missing").select(key)
    return docs.join(missing, key, "left_semi")


def member_chunks(
    members: DataFrame,
    size: int = CHUNK_SIZE,
    cluster_id: str = "cluster_id",
    item_id: str = "script_id",
    rank: str | None = "rank",
) -> DataFrame:
    """Members of a cluster in lists of at most ``size``: ``chunk_id, cluster_id, chunk_no, n, members``.

    Without a rank column the members are numbered in id order first. A list never
    exceeds ``size``, so no task collects a whole cluster.
    """
    if rank is None:
        members, rank = ranks_within(members.select(cluster_id, item_id), [cluster_id], [item_id]), "rank"
    chunk_no = (F.floor((F.col(rank) - 1) / F.lit(size)) + 1).alias("chunk_no")
    rows = members.select(cluster_id, item_id, F.col(rank).alias("_rank"), chunk_no)
    listed = F.array_sort(F.collect_list(F.struct("_rank", F.col(item_id).alias("_id"))))
    chunks = rows.groupBy(cluster_id, "chunk_no").agg(listed.alias("_listed"))
    return chunks.select(
        chunk_key(F.col(cluster_id), F.col("chunk_no")).alias("chunk_id"),
        cluster_id,
        "chunk_no",
        F.size("_listed").cast("bigint").alias("n"),
        F.col("_listed._id").alias("members"),
    )


def reassemble(
    chunks: DataFrame,
    first: int | None = None,
    last: int | None = None,
    cluster_id: str = "cluster_id",
    item_id: str = "script_id",
) -> DataFrame:
    """Back from chunks to members with their stored position; absent chunks are no error."""
    if first is not None:
        chunks = chunks.filter(F.col("chunk_no") >= first)
    if last is not None:
        chunks = chunks.filter(F.col("chunk_no") <= last)
    return chunks.select(cluster_id, "chunk_no", F.posexplode("members").alias("place", item_id))


def cluster_documents(centres: DataFrame, chunks: DataFrame, cluster_id: str = "cluster_id") -> DataFrame:
    """``cluster_id, centroid, chunk_no, n, members``: a cluster, one document per chunk."""
    return chunks.join(centres.select(cluster_id, "centroid"), cluster_id).select(
        cluster_id, "centroid", "chunk_no", "n", "members"
    )


def centroid_documents(centres: DataFrame, cluster_id: str = "cluster_id") -> DataFrame:
    return centres.select(cluster_id, "centroid")


def level_documents(lv1: DataFrame, lv2: DataFrame) -> DataFrame:
    """Both cluster levels, one document each; a level-2 cluster lists its level-1 ids."""
    listed = F.array_sort(F.collect_list("cluster_id")).alias("members")
    upper = lv2.join(lv1.groupBy("lv2_id").agg(listed), "lv2_id")
    none = F.array().cast("array<string>").alias("members")
    return lv1.select(F.lit(1).alias("level"), F.col("cluster_id").alias("id"), "centroid", none).unionByName(
        upper.select(F.lit(2).alias("level"), F.col("lv2_id").alias("id"), "centroid", "members")
    )
