"""Input tables and SQL fragments that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatlas.functions.ids import MULTIPLIER, OFFSET, SPACE, encode_id
from verbatlas.functions.text import cluster_key
from verbatlas.operators.cluster import distance_to_own_centre, mean_vectors, members_ranked
from verbatlas.operators.encode import HashedEncoder, embed
from verbatlas.plans.index import VectorIndex
from verbatlas.schemas import POSTINGS
from verbatlas.session import materialise, spread

ENCODER = HashedEncoder(64)
LEVEL2 = 3  # level-2 clusters of the labels: label mod 3


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """``vec_id, label, vector`` of every embedding."""
    e = table(spark, folder, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))


def as_queries(df: DataFrame) -> DataFrame:
    return df.select(F.col("vec_id").alias("query_id"), "vector")


def label_centres(spark: SparkSession, folder: str) -> DataFrame:
    """``cluster_id, label, lv2_id, centroid, n``: the mean vector of every label."""
    means = mean_vectors(vectors(spark, folder), "label", width=64)
    return means.select(
        cluster_key(F.col("label")).alias("cluster_id"),
        "label",
        cluster_key(F.col("label") % LEVEL2, 2).alias("lv2_id"),
        "centroid",
        "n",
    )


def label_members(spark: SparkSession, folder: str, centres: DataFrame) -> DataFrame:
    """``cluster_id, vec_id, vector, distance``: every vector in the cluster of its label."""
    v = vectors(spark, folder).withColumn("cluster_id", cluster_key(F.col("label")))
    return distance_to_own_centre(v, centres, item_id="vec_id").select("cluster_id", "vec_id", "vector", "distance")


def segments(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    return d.select(
        F.col("doc_id").alias("ordinal"),
        encode_id(F.col("doc_id")).alias("script_id"),
        F.col("source").alias("video_id"),
        (F.col("n_chars") * 0.25).alias("timestamp"),
        "text",
    )


def label_index(spark: SparkSession, folder: str) -> VectorIndex:
    """The index whose level-1 clusters are the labels and level-2 clusters label mod 3."""
    centres = materialise(label_centres(spark, folder), "centres")
    ranked = members_ranked(label_members(spark, folder, centres), item_id="vec_id")
    level2 = materialise(mean_vectors(centres.select("lv2_id", "centroid"), "lv2_id", "centroid", width=64), "lv2")
    postings = ranked.join(centres.select("cluster_id", "lv2_id"), "cluster_id")
    return VectorIndex(
        segments(spark, folder),
        postings.withColumn("script_id", encode_id(F.col("vec_id"))),
        centres.select("cluster_id", "lv2_id", "centroid"),
        level2.select("lv2_id", "centroid"),
    )


def label_levels(spark: SparkSession, folder: str) -> VectorIndex:
    """Only the two centroid tables of ``label_index``, which is all that routing reads."""
    centres = materialise(label_centres(spark, folder), "centres")
    level2 = mean_vectors(centres.select("lv2_id", "centroid"), "lv2_id", "centroid", width=64)
    none = spark.createDataFrame([], POSTINGS)
    lv1 = centres.select("cluster_id", "lv2_id", "centroid")
    return VectorIndex(segments(spark, folder), none, lv1, level2.select("lv2_id", "centroid"))


def text_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return embed(spread(segments(spark, folder)), ENCODER)


# --- SQL ------------------------------------------------------------------------

V = "v as (select vec_id, label, embedding::double[] as e from embeddings)"

MEANS = """
m as (select label, i, avg(e[i]) as x from v, range(1, 65) t(i) group by label, i),
cen as (select label, 'c' || label as cluster_id, 'cc' || (label % 3) as lv2_id,
               list(x order by i) as c from m group by label),
m2 as (select lv2_id, i, avg(c[i]) as x from cen, range(1, 65) t(i) group by lv2_id, i),
cen2 as (select lv2_id, list(x order by i) as c from m2 group by lv2_id)
"""

RANKED = """
ranked as (select cen.cluster_id, cen.lv2_id, v.vec_id, v.e, list_distance(v.e, cen.c) as cd,
                  row_number() over (partition by cen.cluster_id
                                     order by list_distance(v.e, cen.c), v.vec_id) as place
           from v join cen on cen.label = v.label)
"""


def cityblock(a: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, 65), lambda i: abs({a}[i] - {b}[i])))"


def encoded(ordinal: str) -> str:
    return f"lower(to_base((({ordinal} * {MULTIPLIER}::hugeint + {OFFSET}) % {SPACE})::bigint, 36, 7))"


def time_padded(seconds: str) -> str:
    return f"printf('%02d:%02d', floor(({seconds}) / 60)::bigint, floor(({seconds}) % 60)::bigint)"


def time_plain(seconds: str) -> str:
    return f"printf('%d:%d', floor(({seconds}) / 60)::bigint, floor(({seconds}) % 60)::bigint)"


def hashed(prefix: str, source: str, key: str = "id", text: str = "text") -> str:
    """CTEs ``<prefix>w(id, dim, weight)`` and ``<prefix>v(id, e)`` for the texts of ``source``."""
    return f"""
{prefix}t as (select {key} as id, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')) as t
              from {source}),
{prefix}h as (select id, ('0x' || substr(md5(t), 1, 7))::bigint as h from {prefix}t),
{prefix}s as (select id, h % 64 as dim,
                     sum(case when (h // 64) % 2 = 0 then 1 else -1 end)::double as w
              from {prefix}h group by 1, 2),
{prefix}w as (select id, dim, w / sqrt(sum(w * w) over (partition by id)) as weight
              from {prefix}s where w <> 0),
{prefix}v as (select k.id, list(coalesce(w.weight, 0.0) order by i.i) as e
              from (select {key} as id from {source}) k
              cross join range(0, 64) i(i)
              left join {prefix}w w on w.id = k.id and w.dim = i.i
              group by k.id)
"""
