"""The cluster index: built once, saved as Parquet, loaded by every search.

Tables of a saved index:

* ``segments``  ordinal, script_id, video_id, timestamp, text; a folder per ordinal block and version
* ``postings``  lv2_id, cluster_id, script_id, rank, distance, vector; a folder per
  level-2 cluster and version, sorted by level-1 cluster, so a routed query opens one folder
  and skips the row groups of the other clusters in it
* ``lv1``, ``lv2``  centroids
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatlas import schemas
from verbatlas.functions.ids import encode_id
from verbatlas.functions.text import cluster_key
from verbatlas.operators import cluster, fits, maintain
from verbatlas.operators.encode import Encoder, embed
from verbatlas.operators.nearest import assign
from verbatlas.operators.ordering import batch_number, batch_window, global_ordinals, ranks_within
from verbatlas.operators.versions import batches, read_latest, write_version
from verbatlas.session import broadcast_if_small, materialise, spread

# Segments that are encoded as one batch; fixed value: the batch size of the original build.
ENCODE_BATCH = 1000


@dataclass(frozen=True)
class VectorIndex:
    segments: DataFrame
    postings: DataFrame
    lv1: DataFrame
    lv2: DataFrame | None = None
    block_rows: int | None = None  # layout of the segments, once they are saved
    in_order: bool = False  # postings already lie in the order in which they are saved

    @property
    def level2_ids(self) -> DataFrame:
        if self.lv2 is None:
            raise ValueError("this index has one level")
        return self.lv2.select("lv2_id")

    def save(self, path: str, block_rows: int = maintain.BLOCK_ROWS) -> None:
        maintain.save_blocks(self.segments, f"{path}/segments", block_rows)
        keys = [*(["lv2_id"] if self.lv2 is not None else []), "cluster_id", "rank"]
        names = ["cluster_id", "script_id", "rank", "distance", "vector"]
        postings = self.postings.withColumn("vector", F.col("vector").cast("array<float>"))
        postings = postings.select(*names, *(["lv2_id"] if self.lv2 is not None else []))
        if self.lv2 is not None:
            write_version(postings, f"{path}/postings", "lv2_id", keys[1:], replace=True, in_order=self.in_order)
        else:
            ordered = postings if self.in_order else postings.repartitionByRange(*keys)
            ordered.sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{path}/postings")
        self.lv1.write.mode("overwrite").parquet(f"{path}/lv1")
        if self.lv2 is not None:
            self.lv2.write.mode("overwrite").parquet(f"{path}/lv2")


def load_index(
    spark: SparkSession, path: str, levels: int = 2, block_rows: int = maintain.BLOCK_ROWS
) -> VectorIndex:
    """``block_rows`` must be the value the index was saved with."""
    def read(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{path}/{name}")

    upper = levels == 2
    by_level2 = read_latest(spark, f"{path}/postings", "lv2_id", schemas.POSTINGS_BY_LEVEL2) if upper else None
    return VectorIndex(
        maintain.read_blocks(spark, f"{path}/segments", schemas.SEGMENTS),
        by_level2 if upper else read("postings", schemas.POSTINGS),
        read("lv1", schemas.LV1_BY_LEVEL2 if upper else schemas.LV1),
        read("lv2", schemas.LV2) if upper else None,
        block_rows,
    )


def second_level(lv1: DataFrame, k2: int, **fit) -> tuple[DataFrame, DataFrame]:
    """Cluster the level-1 centroids: ``(lv1 with lv2_id, lv2)``."""
    points = lv1.select("cluster_id", F.col("centroid").alias("vector"))
    iterations = fit.pop("iterations", 20)
    centres = cluster.fit_lloyd(points, k2, iterations, item_id="cluster_id", **fit)
    lv2 = centres.select(cluster_key(F.col("label"), 2).alias("lv2_id"), "centroid")
    placed = assign(points, lv2, item_id="cluster_id", centre_id="lv2_id")
    with_parent = lv1.drop("lv2_id").join(placed.select("cluster_id", "lv2_id"), "cluster_id")
    used = with_parent.select("lv2_id").distinct()
    return with_parent.select("cluster_id", "lv2_id", "centroid"), lv2.join(used, "lv2_id", "left_semi")


def _encoded(segments: DataFrame, encoder: Encoder) -> DataFrame:
    """``ordinal, script_id, vector`` in single precision of every segment with a text."""
    vectors = embed(spread(segments.select("ordinal", "script_id", "text")), encoder).drop("text")
    return vectors.withColumn("vector", F.col("vector").cast("array<float>"))


def encode_batches(
    segments: DataFrame,
    encoder: Encoder,
    path: str,
    batch_size: int = ENCODE_BATCH,
    *,
    resume: int | None = None,
    until: int | None = None,
    at_once: int = 64,
) -> list[tuple[int, int]]:
    """Encode the batches ``resume <= batch < until`` of ordinals that the table at ``path`` does not hold yet.

    Up to ``at_once`` batches are one job and are committed together, so what a build that was stopped has
    finished is not encoded again. The ranges of batches encoded now are returned. All starts must
    use one ``batch_size``.
    """
    spark = segments.sparkSession
    last = segments.agg(F.max("ordinal")).first()[0]
    stop = 0 if last is None else last // batch_size + 1
    done: set[int] = set()
    for name in batches(spark, path):
        size, low, high = map(int, name.split(":"))
        if size != batch_size:
            raise ValueError(f"the table at {path} has batches of {size}")
        done.update(range(low, high))
    todo = [b for b in range(resume or 0, stop if until is None else min(until, stop)) if b not in done]
    ranges: list[tuple[int, int]] = []
    for b in todo:
        if ranges and ranges[-1][1] == b and b - ranges[-1][0] < at_once:
            ranges[-1] = (ranges[-1][0], b + 1)
        else:
            ranges.append((b, b + 1))
    for low, high in ranges:
        rows = _encoded(batch_window(segments, batch_size, low, high).drop("batch_no"), encoder)
        rows = rows.withColumn("batch_no", batch_number(F.col("ordinal"), batch_size))
        write_version(rows, path, "batch_no", ["ordinal"], batch=f"{batch_size}:{low}:{high}")
    return ranges


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The vectors of all batches that are committed, with ``batch_no``."""
    return read_latest(spark, path, "batch_no", "ordinal bigint, script_id string, vector array<float>, batch_no bigint")


def _nested_index(segments: DataFrame, vectors: DataFrame, k1: int, k2: int, chunk_size: int, seed: int) -> VectorIndex:
    each = -(-k1 // k2)
    level1, level2, cells = fits.fit_nested(vectors, k2, each, coarse_steps=5, chunk_size=chunk_size, seed=seed)
    name = cluster_key(F.col("cell") * F.lit(each) + F.col("label")).alias("cluster_id")
    cell = cluster_key(F.col("cell"), 2).alias("lv2_id")
    lv1 = materialise(level1.select(name, cell, "centroid"), "lv1")
    keyed = cells.select("script_id", "vector", cell)
    placed = materialise(assign(keyed, lv1, key="lv2_id", keep=["vector", "lv2_id"]), "placed")
    used = materialise(placed.select("cluster_id", "lv2_id").distinct(), "used")
    lv1 = materialise(lv1.join(used.select("cluster_id"), "cluster_id", "left_semi"), "lv1")
    lv2 = level2.select(cell, "centroid").join(used.select("lv2_id").distinct(), "lv2_id", "left_semi")
    postings = ranks_within(placed, ["lv2_id", "cluster_id"], ["distance", "script_id"])
    return VectorIndex(segments, postings, lv1.select("cluster_id", "lv2_id", "centroid"), materialise(lv2, "lv2"), in_order=True)


def build_index(
    segments: DataFrame,
    encoder: Encoder,
    k1: int,
    k2: int | None = None,
    *,
    chunk_size: int = cluster.MINIBATCH_CHUNK,
    seed: int = cluster.KMEANS_SEED,
    nested: bool = False,
    work: str | None = None,
    batch_size: int = ENCODE_BATCH,
) -> VectorIndex:
    """Encode, fit, assign, rank; with ``k2`` a second level over the centroids.

    ``nested`` turns the levels round: ``k2`` cells are fitted first and about ``k1 / k2`` centres inside
    each, all cells at once (see `fits`). With ``work`` the vectors are encoded into that table batch by
    batch, and a second start goes on behind the last batch of the first one (see `encode_batches`).
    """
    segments = materialise(segments, "segments")
    if work is not None:
        encode_batches(segments, encoder, work, batch_size)
        vectors = read_vectors(segments.sparkSession, work)
    else:
        vectors = materialise(_encoded(segments, encoder), "vectors")
    if nested:
        if k2 is None:
            raise ValueError("a nested fit needs k2")
        return _nested_index(segments, vectors, k1, k2, chunk_size, seed)
    centres = cluster.fit_minibatch(vectors, k1, chunk_size, seed=seed)
    lv1 = centres.select(cluster_key(F.col("label")).alias("cluster_id"), "centroid")
    lv2 = None
    # The dearest pass: written once, read by all that follows.
    placed = materialise(assign(vectors, lv1, keep=["vector"]), "placed")
    used = placed.select("cluster_id").distinct()
    lv1 = materialise(lv1.join(used, "cluster_id", "left_semi"), "lv1")
    if k2 is not None:
        lv1, lv2 = second_level(lv1, k2, seed=seed)
        lv1, lv2 = materialise(lv1, "lv1"), materialise(lv2, "lv2")
        placed = placed.join(broadcast_if_small(lv1.select("cluster_id", "lv2_id")), "cluster_id")
    # The range shuffle that ranks the members also brings them into the saved order.
    groups = ["lv2_id", "cluster_id"] if k2 is not None else ["cluster_id"]
    postings = ranks_within(placed, groups, ["distance", "script_id"])
    return VectorIndex(segments, postings, lv1, lv2, in_order=True)


def append_to_index(
    spark: SparkSession,
    path: str,
    arrivals: DataFrame,
    encoder: Encoder,
    order_by: list[str],
    block_rows: int = maintain.BLOCK_ROWS,
    batch: str | None = None,
) -> None:
    """Add captions (``video_id, timestamp, text`` and what orders them) to a saved two-level index.

    Ordinals go on where the index ends. New vectors join the cluster of the nearest level-1
    centroid, as in the build; the level-2 folders they fall into are ranked anew and replaced, all
    others stay as they are. Centroids do not move. Segments are written last: rows that a failed
    run left among the postings get the same ids, and so the same places, when it is run again. A
    ``batch`` that the index has already is not added twice.
    """
    if batch is not None and batch in batches(spark, f"{path}/segments"):
        return
    index = load_index(spark, path, block_rows=block_rows)
    last = index.segments.agg(F.max("ordinal")).first()[0]
    numbered = global_ordinals(arrivals, order_by, "_place")
    numbered = numbered.withColumn("ordinal", F.col("_place") + F.lit(0 if last is None else last + 1))
    rows = numbered.select("ordinal", encode_id(F.col("ordinal")).alias("script_id"), "video_id", "timestamp", "text")
    rows = materialise(rows, "arrivals")

    vectors = embed(spread(rows.select("script_id", "text")), encoder).drop("text")
    placed = assign(vectors.withColumn("vector", F.col("vector").cast("array<float>")), index.lv1, keep=["vector"])
    placed = placed.join(broadcast_if_small(index.lv1.select("cluster_id", "lv2_id")), "cluster_id")
    names = ["lv2_id", "cluster_id", "script_id", "distance", "vector"]
    placed = materialise(placed.select(*names), "placed")
    touched = broadcast_if_small(materialise(placed.select("lv2_id").distinct(), "touched"))
    stored = index.postings.join(touched, "lv2_id", "left_semi")
    stored = stored.join(broadcast_if_small(placed.select("script_id")), "script_id", "left_anti")
    ranked = ranks_within(stored.select(*names).unionByName(placed), ["lv2_id", "cluster_id"], ["distance", "script_id"])
    ranked = materialise(ranked.select("cluster_id", "script_id", "rank", "distance", "vector", "lv2_id"), "ranked")
    write_version(ranked, f"{path}/postings", "lv2_id", ["cluster_id", "rank"])
    # The block that the index ends in gets its old rows again.
    fresh = maintain.with_block(rows, block_rows)
    first = fresh.agg(F.min("ord_block")).first()[0]
    old = index.segments.filter(F.col("ord_block") == F.lit(first)).select(*rows.columns)
    maintain.overwrite_blocks(rows.unionByName(old), f"{path}/segments", block_rows, batch=batch)
