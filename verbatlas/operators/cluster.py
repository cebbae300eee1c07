"""k-means in three forms, members, medoids, inspection and reduction.

The steps of the fits are in `fits`: centres are a table between two steps, points never
move, and only sums per centre are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatlas.functions import blocks
from verbatlas.operators import fits, reduction
from verbatlas.operators.nearest import assign
from verbatlas.operators.ordering import ranks_within
from verbatlas.session import materialise, scratch_path

# Seeds and chunk sizes of the original fits.
KMEANS_SEED = 4526
ENSEMBLE_SEED = 153
MINIBATCH_CHUNK = 300_000
ENSEMBLE_CHUNKS = 5
SECOND_LEVEL_K = 100


def mean_vectors(
    df: DataFrame, group: str, vector: str = "vector", out: str = "centroid", width: int | None = None
) -> DataFrame:
    """Component-wise mean per group, as one hash aggregate with a slot per component.

    Map-side partial sums leave one row per group and task, however large a group is.
    The width of the vectors is looked up unless it is given; a vector of another width is
    an error. Null vectors count in ``n`` only.
    """
    if width is None:
        found = df.filter(F.col(vector).isNotNull()).agg(F.max(F.size(vector)).alias("n")).first()
        width = found["n"] or 0
    fits = F.col(vector).isNull() | (F.size(vector) == F.lit(width))
    wrong = F.raise_error(F.lit(f"every vector must have exactly {width} components"))
    rows = df.withColumn("_v", F.when(fits, F.col(vector)).otherwise(wrong))
    means = [F.avg(F.col("_v")[i].cast("double")).alias(f"_m{i}") for i in range(width)]
    sums = rows.groupBy(group).agg(F.count("*").alias("n"), *means)
    return sums.select(group, "n", F.array(*[F.col(f"_m{i}") for i in range(width)]).alias(out))


def _centre_table(spark: SparkSession, matrix: np.ndarray, counts: np.ndarray) -> DataFrame:
    table = pa.table(
        {
            "label": pa.array(np.arange(len(matrix)), pa.int32()),
            "centroid": blocks.to_lists(matrix),
            "n": pa.array(counts, pa.int64()),
        }
    )
    return spark.createDataFrame(table)


def fit_minibatch(
    vectors: DataFrame,
    k: int,
    chunk_size: int = MINIBATCH_CHUNK,
    *,
    init: DataFrame | None = None,
    ordinal: str = "ordinal",
    item_id: str = "script_id",
    vector: str = "vector",
    seed: int = KMEANS_SEED,
) -> DataFrame:
    """One update per chunk of ordinals: every centre becomes the running mean of all
    vectors it has won so far. A centre that wins nothing stays as it is.

    Returns ``label, centroid, n``. A chunk is a range filter on the ordinal, which a
    table written in ordinal order answers from a few files.
    """
    centres = fits.start(vectors, k, init, item_id, vector, seed)
    return fits.run(vectors, centres, 0, vector=vector, ordinal=ordinal, chunk_size=chunk_size)


def fit_lloyd(
    vectors: DataFrame,
    k: int,
    iterations: int,
    *,
    init: DataFrame | None = None,
    item_id: str = "script_id",
    vector: str = "vector",
    seed: int = KMEANS_SEED,
) -> DataFrame:
    """At most ``iterations`` full passes from given (or sampled) centres.

    It ends earlier when no centre moves any more, since further passes would then
    repeat the last one.
    """
    return fits.run(vectors, fits.start(vectors, k, init, item_id, vector, seed), iterations, vector=vector)


def fit_seeded(
    vectors: DataFrame, k: int, iterations: int = 20, *, item_id: str = "script_id", vector: str = "vector", seed: int = KMEANS_SEED
) -> DataFrame:
    """Full passes from the ``k`` heaviest candidates of the k-means|| rounds; ``label, centroid, n``, the same on every run."""
    chosen = fits.heaviest(fits.candidates(vectors, k, item_id=item_id, vector=vector, seed=seed), k)
    init = materialise(chosen.select(F.col("candidate").alias(item_id), F.col("centroid").alias(vector)), "starts")
    return fit_lloyd(vectors, k, iterations, init=init, item_id=item_id, vector=vector)


def fit_full(vectors: DataFrame, k: int, *, vector: str = "vector", seed: int = KMEANS_SEED, max_iter: int = 20) -> DataFrame:
    """MLlib k-means with parallel seeding; returns ``label, centroid, n``."""
    points = vectors.filter(F.col(vector).isNotNull()).select(array_to_vector(vector).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, initMode="k-means||").fit(points)
    centres = np.array(model.clusterCenters())
    return _centre_table(vectors.sparkSession, centres, np.array(model.summary.clusterSizes))


def members_ranked(
    assigned: DataFrame, cluster_id: str = "cluster_id", item_id: str = "script_id"
) -> DataFrame:
    """Rank the members of every cluster by their distance to its centre."""
    return ranks_within(assigned, [cluster_id], ["distance", item_id], "rank")


def distance_to_own_centre(
    members: DataFrame,
    centres: DataFrame,
    cluster_id: str = "cluster_id",
    item_id: str = "script_id",
    vector: str = "vector",
    metric: str = "euclidean",
) -> DataFrame:
    """Members keep the cluster they have; only the distance to its centre is added.

    The centres travel to the members in blocks of checked size. A join on the cluster
    would send all members of a large cluster to one task.
    """
    own = centres.select(cluster_id, "centroid", F.col(cluster_id).alias("_own"))
    keep = [c for c in members.columns if c != item_id]
    placed = assign(
        members,
        own,
        item_id=item_id,
        vector=vector,
        centre_id="_own",
        key=cluster_id,
        keep=keep,
        metric=metric,
    )
    return placed.drop("_own")


def cluster_sizes(members: DataFrame, cluster_id: str = "cluster_id") -> DataFrame:
    return members.groupBy(cluster_id).agg(F.count("*").alias("n"))


def medoids(assigned: DataFrame, cluster_id: str = "cluster_id", item_id: str = "script_id") -> DataFrame:
    """The member nearest its centre; partial aggregates keep one candidate per task."""
    best = F.min(F.struct("distance", item_id)).alias("_best")
    return assigned.groupBy(cluster_id).agg(best).select(cluster_id, f"_best.{item_id}", "_best.distance")


def show_clusters(members: DataFrame, cluster_ids: Sequence[str] | None = None, cluster_id: str = "cluster_id") -> DataFrame:
    """Members of the named clusters, or the list of all cluster ids."""
    if cluster_ids is None:
        return members.select(cluster_id).distinct()
    return members.filter(F.col(cluster_id).isin(list(cluster_ids)))


def reduce(vectors: DataFrame, components: int = 3, *, vector: str = "vector", keep: Sequence[str] = ()) -> DataFrame:
    """Principal components from one distributed pass, and the projection of every row."""
    points = vectors.filter(F.col(vector).isNotNull()).select(*keep, array_to_vector(vector).alias("features"))
    model = PCA(k=components, inputCol="features", outputCol="reduced").fit(points)
    return model.transform(points).select(*keep, vector_to_array("reduced").alias("reduced"))


def covariance(vectors: DataFrame, vector: str = "vector") -> np.ndarray:
    """Population covariance of the components; width x width sums come back from each task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, product = 0, 0.0, 0.0
        for batch in batches:
            data = blocks.to_matrix(batch.column(0))
            if len(data):
                n, total, product = n + len(data), total + data.sum(axis=0), product + data.T @ data
        if n:
            flat = np.concatenate(([float(n)], total, product.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["i", "x"])

    parts = vectors.filter(F.col(vector).isNotNull()).select(vector).mapInArrow(add, "i bigint, x double")
    rows = parts.groupBy("i").agg(F.sum("x").alias("x")).toPandas().sort_values("i")
    width = int((np.sqrt(4 * len(rows) - 3) - 1) / 2)
    flat = rows.x.to_numpy()
    mean = flat[1 : width + 1] / flat[0]
    return flat[width + 1 :].reshape(width, width) / flat[0] - np.outer(mean, mean)


def ensemble(
    vectors: DataFrame,
    k: int,
    components: int,
    *,
    chunk_size: int | None = None,
    chunks: int = ENSEMBLE_CHUNKS,
    iterations: int = 5,
    ordinal: str = "ordinal",
    item_id: str = "script_id",
    vector: str = "vector",
    seed: int = ENSEMBLE_SEED,
) -> DataFrame:
    """Reduce and cluster growing prefixes of the corpus: ``chunk_no, item_id, label``.

    Fit ``i`` covers the chunks ``0..i``, and the last fit the whole corpus: without
    ``chunk_size`` the corpus has ``chunks`` chunks, with it as many as it takes. The moments of
    each chunk are taken once and added up from fit to fit; a fit starts from the rows with the
    smallest seeded hashes, so its labels are the same on every run. Labels of different fits are
    not matched with each other.
    """
    vectors = vectors.filter(F.col(vector).isNotNull())
    n = vectors.agg(F.max(ordinal).alias("m")).first()["m"]
    if n is None:
        raise ValueError("there are no vectors to cluster")
    size = chunk_size or -(-(n + 1) // chunks)
    kept = scratch_path(vectors.sparkSession, "moments")
    out = None
    for i in range(n // size + 1):
        chunk = vectors.filter((F.col(ordinal) >= i * size) & (F.col(ordinal) < (i + 1) * size))
        reduction.add_chunk(chunk, kept, str(i), vector)
        mean, axes, _ = reduction.components(reduction.kept_moments(vectors.sparkSession, kept), components)
        prefix = vectors.filter(F.col(ordinal) < (i + 1) * size)
        points = materialise(reduction.project(prefix, mean, axes, vector=vector, keep=[item_id]), "ensemble")
        centres = fit_lloyd(points, k, iterations, item_id=item_id, vector="reduced", seed=seed)
        labels = assign(points, centres, item_id=item_id, vector="reduced", centre_id="label")
        labels = labels.select(F.lit(i).alias("chunk_no"), item_id, "label")
        out = labels if out is None else out.unionByName(labels)
    return out


def silhouette(labelled: DataFrame, label: str = "label", vector: str = "vector") -> float:
    points = labelled.select(F.col(label).cast("int").alias("prediction"), array_to_vector(vector).alias("features"))
    return ClusteringEvaluator().evaluate(points)
