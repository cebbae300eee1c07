"""Clustering: centres, assignment, members, fits, reduction, incremental assignment."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from verbatlas.functions.distance import norm
from verbatlas.functions.text import cluster_key
from verbatlas.operators import cluster as C
from verbatlas.operators import fits, reduction
from verbatlas.operators.nearest import assign
from verbatlas.operators.pruned import assign_pruned
from verbatlas.operators.publish import member_chunks, reassemble
from verbatlas.operators.sampling import sample_exact
from verbatlas.plans.index import build_index, load_index, second_level
from verbatlas.registry import query
from verbatlas.registry.common import (
    ENCODER,
    MEANS,
    RANKED,
    V,
    encoded,
    label_centres,
    label_members,
    segments,
    table,
    vectors,
)
from verbatlas.session import materialise, scratch_path
from verbatlas.streaming.incremental import read_assigned, run_available

SEED = C.KMEANS_SEED
K = 5


def _cells(centres, *keys):
    cells = centres.select(*keys, F.posexplode("centroid").alias("dim", "value"))
    return cells.select(*keys, F.col("dim").cast("bigint").alias("dim"), F.round("value", 5).alias("value"))


@query(f"with {V}, {MEANS} select label, (i - 1)::bigint as dim, round(x, 5) as value from m")
def centroids_by_label(spark, folder):
    return _cells(label_centres(spark, folder), "label")


_ASSIGNED = """select vec_id, cluster_id, round(d, 5) as distance from (
    select v.vec_id, cen.cluster_id, list_distance(v.e, cen.c) as d,
           row_number() over (partition by v.vec_id order by list_distance(v.e, cen.c), cen.cluster_id) as r
    from v, cen) where r = 1"""


@query(f"with {V}, {MEANS} {_ASSIGNED}")
def assign_nearest(spark, folder):
    placed = assign(vectors(spark, folder), label_centres(spark, folder), item_id="vec_id")
    return placed.select("vec_id", "cluster_id", F.round("distance", 5).alias("distance"))


@query(f"with {V}, {MEANS} {_ASSIGNED}")
def assign_saved_centres(spark, folder):
    """The fitted centres written, loaded and applied."""
    path = scratch_path(spark, "model")
    label_centres(spark, folder).select("cluster_id", "centroid").write.parquet(path)
    placed = assign(vectors(spark, folder), spark.read.parquet(path), item_id="vec_id")
    return placed.select("vec_id", "cluster_id", F.round("distance", 5).alias("distance"))


_NEAREST_DOCUMENT = """select vec_id, centre, round(d, 5) as distance from (
    select v.vec_id, c.vec_id as centre, list_distance(v.e, c.e) as d,
           row_number() over (partition by v.vec_id order by round(list_distance(v.e, c.e), 9), c.vec_id) as r
    from v, v c where c.vec_id % 5 = 0) where r = 1"""


@query(f"with {V} {_NEAREST_DOCUMENT}")
def assign_pruned_centres(spark, folder):
    """Every vector to the nearest of many centres, every fifth vector, by bounds through groups of them."""
    v = vectors(spark, folder)
    centres = v.filter(F.col("vec_id") % 5 == 0).select(F.col("vec_id").alias("centre"), F.col("vector").alias("centroid"))
    placed = assign_pruned(v, centres, item_id="vec_id", centre_id="centre")
    return placed.select("vec_id", "centre", F.round("distance", 5).alias("distance"))


@query(f"with {V}, {MEANS} {_ASSIGNED}")
def incremental_assign(spark, folder):
    """Vectors that arrive in two deliveries, each worked off by its own run."""
    root = scratch_path(spark, "arrivals")
    v = vectors(spark, folder)
    centres = materialise(label_centres(spark, folder), "centres")
    for delivery in (F.col("label") < 5, F.col("label") >= 5):
        v.filter(delivery).write.mode("append").parquet(f"{root}/in")
        run_available(spark, f"{root}/in", v.schema, centres, f"{root}/out", f"{root}/state", item_id="vec_id")
    placed = read_assigned(spark, f"{root}/out")
    return placed.select("vec_id", "cluster_id", F.round("distance", 5).alias("distance"))


@query(
    f"""with {V}, {MEANS}, {RANKED}
        select cluster_id, vec_id, place as rank, round(cd, 5) as distance from ranked"""
)
def members_ranked(spark, folder):
    members = label_members(spark, folder, label_centres(spark, folder)).drop("vector")
    ranked = C.members_ranked(members, item_id="vec_id")
    return ranked.select("cluster_id", "vec_id", "rank", F.round("distance", 5).alias("distance"))


@query("select 'c' || label as cluster_id, count(*) as n from embeddings group by label")
def cluster_sizes(spark, folder):
    return C.cluster_sizes(vectors(spark, folder).withColumn("cluster_id", cluster_key(F.col("label"))))


_CHUNKED = """select cluster_id || '_b' || chunk_no as chunk_id, cluster_id, chunk_no, count(*) as n,
    string_agg(vec_id::varchar, ',' order by place) as members
    from (select *, (place - 1) // {size} + 1 as chunk_no from ({source})) group by cluster_id, chunk_no"""
_BY_ID = """select 'c' || label as cluster_id, vec_id,
    row_number() over (partition by label order by vec_id) as place from embeddings"""


def _chunk_text(chunks):
    return chunks.select(
        "chunk_id", "cluster_id", "chunk_no", "n", F.array_join(F.col("members").cast("array<string>"), ",").alias("members")
    )


@query(_CHUNKED.format(size=16384, source=_BY_ID))
def members_grouped(spark, folder):
    """Ids per cluster in id order, in lists of bounded length."""
    members = vectors(spark, folder).select(cluster_key(F.col("label")).alias("cluster_id"), "vec_id")
    return _chunk_text(member_chunks(members, item_id="vec_id", rank=None))


def _ranked_chunks(spark, folder, size=16):
    members = label_members(spark, folder, label_centres(spark, folder)).drop("vector")
    return member_chunks(C.members_ranked(members, item_id="vec_id"), size, item_id="vec_id")


@query(f"with {V}, {MEANS}, {RANKED} " + _CHUNKED.format(size=16, source="select * from ranked"))
def member_chunks_written(spark, folder):
    path = scratch_path(spark, "chunks")
    _ranked_chunks(spark, folder).write.parquet(path)
    return _chunk_text(spark.read.parquet(path))


@query(
    f"""with {V}, {MEANS}, {RANKED} select cluster_id, vec_id, (place - 1) // 16 + 1 as chunk_no,
        (place - 1) % 16 as place from ranked"""
)
def chunk_reassembly(spark, folder):
    back = reassemble(_ranked_chunks(spark, folder), item_id="vec_id")
    return back.select("cluster_id", "vec_id", "chunk_no", F.col("place").cast("bigint").alias("place"))


@query(
    f"""with {V}, {MEANS}, {RANKED} select cluster_id, vec_id, (place - 1) // 16 + 1 as chunk_no,
        (place - 1) % 16 as place from ranked where (place - 1) // 16 + 1 between 2 and 3"""
)
def chunk_reassembly_range(spark, folder):
    """The members of some chunks only; clusters without such chunks are no error."""
    back = reassemble(_ranked_chunks(spark, folder), 2, 3, item_id="vec_id")
    return back.select("cluster_id", "vec_id", "chunk_no", F.col("place").cast("bigint").alias("place"))


@query(
    f"""with {V}, {MEANS}, {RANKED}
        select cluster_id, vec_id, round(cd, 5) as distance from ranked where place = 1"""
)
def medoid(spark, folder):
    members = label_members(spark, folder, label_centres(spark, folder))
    best = C.medoids(members, item_id="vec_id")
    return best.select("cluster_id", "vec_id", F.round("distance", 5).alias("distance"))


@query(
    f"""with {V}, {MEANS}, {RANKED} select cluster_id, vec_id, place as rank from ranked
        where cluster_id in ('c3', 'c7')"""
)
def cluster_lookup(spark, folder):
    members = label_members(spark, folder, label_centres(spark, folder)).drop("vector")
    return C.show_clusters(C.members_ranked(members, item_id="vec_id"), ["c3", "c7"]).select(
        "cluster_id", "vec_id", "rank"
    )


# Starting vectors: the five smallest seeded hashes, numbered in id order.
_START = f"""start as (select (row_number() over (order by vec_id) - 1)::int as label, e as c from (
    select *, row_number() over (order by ('0x' || substr(md5('{SEED}:' || vec_id), 1, 15))::bigint, vec_id) as r
    from v) where r <= {K})"""


def _win(name: str, points: str, centres: str) -> str:
    """CTE ``<name>(label, i, s, m)``: sum and number of the points each centre wins."""
    return f"""{name}_a as (select e, label from (select p.e, c.label, row_number() over (
            partition by p.vec_id order by list_distance(p.e, c.c), c.label) as r
        from {points} p, {centres} c) where r = 1),
    {name} as (select label, i, sum(e[i]) as s, count(*) as m from {name}_a, range(1, 65) t(i) group by 1, 2)"""


_STEP = """{out} as (select c.label, list(case when w.m is null then c.c[i.i]
        else ({n} * c.c[i.i] + w.s) / ({n} + w.m) end order by i.i) as c,
        any_value({n} + coalesce(w.m, 0)) as n
    from {centres} c cross join range(1, 65) i(i) left join {won} w on w.label = c.label and w.i = i.i
    group by c.label)"""
_FIT_OUT = "select label, (i - 1)::bigint as dim, round(c[i], 5) as value, n::bigint as n from {0}, range(1, 65) t(i)"


@query(
    f"""with {V}, size as (select ceil(count(*) / 2.0)::bigint as s from v),
        numbered as (select *, row_number() over (order by vec_id) - 1 as ord from v),
        part1 as (select * from numbered, size where ord < s),
        part2 as (select * from numbered, size where ord >= s),
        {_START}, {_win("w1", "part1", "start")},
        {_STEP.format(out="step1", centres="start", won="w1", n="0")},
        {_win("w2", "part2", "step1")},
        {_STEP.format(out="step2", centres="step1", won="w2", n="c.n")} {_FIT_OUT.format("step2")}"""
)
def minibatch_two_steps(spark, folder):
    v = vectors(spark, folder)
    half = math.ceil(v.count() / 2)
    fitted = C.fit_minibatch(v, K, half, ordinal="vec_id", item_id="vec_id")
    return _cells(fitted, "label", "n")


@query(
    f"""with {V}, {_START}, {_win("w1", "v", "start")},
        {_STEP.format(out="step1", centres="start", won="w1", n="0")}, {_win("w2", "v", "step1")},
        step2 as (select c.label, list(coalesce(w.s / w.m, c.c[i.i]) order by i.i) as c,
                         any_value(coalesce(w.m, 0)) as n
                  from step1 c cross join range(1, 65) i(i)
                  left join w2 w on w.label = c.label and w.i = i.i group by c.label)
        {_FIT_OUT.format("step2")}"""
)
def lloyd_two_steps(spark, folder):
    return _cells(C.fit_lloyd(vectors(spark, folder), K, 2, item_id="vec_id"), "label", "n")


@query(
    f"""with {V}, {MEANS}, p as (select cluster_id as vec_id, c as e from cen),
        start as (select (row_number() over (order by vec_id) - 1)::int as label, e as c from (
            select *, row_number() over (order by ('0x' || substr(md5('{SEED}:' || vec_id), 1, 15))::bigint, vec_id) as r
            from p) where r <= 3),
        {_win("w1", "p", "start")}, {_STEP.format(out="step1", centres="start", won="w1", n="0")},
        {_win("w2", "p", "step1")}, {_STEP.format(out="step2", centres="step1", won="w2", n="0")}
        select vec_id as cluster_id, lv2_id from (select p.vec_id, 'cc' || c.label as lv2_id, row_number() over (
            partition by p.vec_id order by list_distance(p.e, c.c), 'cc' || c.label) as r from p, step2 c) where r = 1"""
)
def second_level_clusters(spark, folder):
    lv1 = materialise(label_centres(spark, folder).select("cluster_id", "centroid"), "lv1")
    placed, _ = second_level(lv1, 3, iterations=2)
    return placed.select("cluster_id", "lv2_id")


def _nested_step(name: str, centres: str) -> str:
    """CTE ``<name>(cell, label, c, n)``: the centres of all cells after one more full pass."""
    return f"""{name}_a as (select cell, e, label from (select p.cell, p.e, c.label, row_number() over (
            partition by p.vec_id order by list_distance(p.e, c.c), c.label) as r
        from placed p join {centres} c on c.cell = p.cell) where r = 1),
    {name}_w as (select cell, label, i, sum(e[i]) as s, count(*) as m from {name}_a, range(1, 65) t(i) group by 1, 2, 3),
    {name} as (select c.cell, c.label, list(coalesce(w.s / w.m, c.c[i.i]) order by i.i) as c, any_value(coalesce(w.m, 0)) as n
        from {centres} c cross join range(1, 65) i(i)
        left join {name}_w w on w.cell = c.cell and w.label = c.label and w.i = i.i group by c.cell, c.label)"""


_SEEDED = f"('0x' || substr(md5('{SEED}:' || vec_id), 1, 15))::bigint, vec_id"


@query(
    f"""with {V}, {_START.replace(f"r <= {K}", "r <= 4")}, {_win("w1", "v", "start")},
        {_STEP.format(out="coarse", centres="start", won="w1", n="0")},
        placed as (select vec_id, e, cell from (select v.vec_id, v.e, c.label as cell, row_number() over (
            partition by v.vec_id order by list_distance(v.e, c.c), c.label) as r from v, coarse c) where r = 1),
        first as (select cell, (row_number() over (partition by cell order by vec_id) - 1)::int as label, e as c from (
            select *, row_number() over (partition by cell order by {_SEEDED}) as r from placed) where r <= 6),
        {_nested_step("s1", "first")}, {_nested_step("s2", "s1")}
        select cell, label, (i - 1)::bigint as dim, round(c[i], 5) as value, n::bigint as n from s2, range(1, 65) t(i)"""
)
def nested_fit_two_steps(spark, folder):
    """Four cells after one pass, and up to six centres inside each after two, all cells in the same jobs."""
    level1, _, _ = fits.fit_nested(vectors(spark, folder), 4, 6, coarse_steps=1, steps=2, item_id="vec_id", seed=SEED)
    return _cells(level1, "cell", "label", "n")


def _drawn(number: int, before: str) -> str:
    """CTE ``c<number>(candidate, e)``: the candidates ``before`` and those that this round draws."""
    return f"""d{number} as (select v.vec_id, any_value(v.e) as e, pow(min(list_distance(v.e, c.e)), 2) as square from v, {before} c group by v.vec_id),
    c{number} as (select * from {before} union all select vec_id, e from d{number}, (select sum(square) as total from d{number})
        where ('0x' || substr(md5('{SEED}:{number}:' || vec_id), 1, 13))::bigint / 4503599627370496.0 < 20 * square / total)"""


@query(
    f"""with {V}, c0 as (select vec_id as candidate, e from v order by {_SEEDED} limit 1), {_drawn(1, "c0")}, {_drawn(2, "c1")},
        near as (select candidate, count(*) as weight from (select c.candidate, row_number() over (
            partition by v.vec_id order by round(list_distance(v.e, c.e), 9), c.candidate) as r from v, c2 c) where r = 1 group by 1)
        select candidate, coalesce(weight, 0) as weight,
               row_number() over (order by coalesce(weight, 0) desc, candidate) <= 10 as chosen from c2 left join near using (candidate)"""
)
def kmeans_starts(spark, folder):
    """Candidates of two rounds of k-means|| for ten clusters, their weights, and the ten that a fit starts from."""
    found = materialise(fits.candidates(vectors(spark, folder), 10, item_id="vec_id", seed=SEED), "candidates")
    chosen = fits.heaviest(found, 10).select("candidate", F.lit(True).alias("chosen"))
    return found.join(chosen, "candidate", "left").select("candidate", "weight", F.coalesce("chosen", F.lit(False)).alias("chosen"))


@query()
def kmeans_mllib(spark, folder):
    """Random starting centres, so only the rows can be compared."""
    v = vectors(spark, folder)
    centres = C.fit_full(v, 10).select(cluster_key(F.col("label")).alias("cluster_id"), "centroid")
    return assign(v, centres, item_id="vec_id").select("vec_id", "cluster_id")


@query()
def pca_mllib(spark, folder):
    """Components have no fixed sign, so only the rows can be compared."""
    return C.reduce(vectors(spark, folder), 3, keep=["vec_id"])


@query(f"with {V} select vec_id, round(sqrt(list_dot_product(e, e)), 5) as length from v")
def pca_keeps_lengths(spark, folder):
    """All 64 components are a rotation: every vector keeps its length."""
    reduced = C.reduce(vectors(spark, folder), 64, keep=["vec_id"])
    return reduced.select("vec_id", F.round(norm(F.col("reduced")), 5).alias("length"))


@query(
    f"""with {V}, x as (select i, e[i] as c from v, range(1, 65) t(i))
        select round(sum(s), 4) as total_variance, 0.0::double as largest_covariance, true as descending
        from (select var_pop(c) as s from x group by i)"""
)
def pca_uncorrelated(spark, folder):
    """All components together keep the variance, do not vary with each other, and come in order.

    With the lengths kept (``pca_keeps_lengths``) this settles them up to their signs.
    """
    reduced = C.reduce(vectors(spark, folder), 64, keep=["vec_id"])
    cov = C.covariance(reduced, "reduced")
    own = np.diag(cov)
    apart = float(np.abs(cov - np.diag(own)).max())
    ordered = bool((np.diff(own) <= 1e-9).all())
    row = [(round(float(own.sum()), 4), abs(round(apart, 6)), ordered)]
    return spark.createDataFrame(row, "total_variance double, largest_covariance double, descending boolean")


@query(
    f"""with {V}, a as (select i, avg(e[i]) as x from v, range(1, 65) t(i) group by i),
        mean as (select list(x order by i) as c from a), x as (select i, var_pop(e[i]) as s from v, range(1, 65) t(i) group by i)
        select vec_id, round(list_distance(e, c), 5) as length, round(total, 5) as total_variance, true as descending
        from v, mean, (select sum(s) as total from x)"""
)
def pca_in_chunks(spark, folder):
    """All directions from three chunks of vectors, one of them sent twice; centred rows keep their lengths."""
    path = scratch_path(spark, "moments")
    v = vectors(spark, folder)
    for chunk in (0, 1, 0, 2):
        reduction.add_chunk(v.filter(F.col("vec_id") % 3 == chunk), path, str(chunk))
    mean, axes, variances = reduction.components(reduction.kept_moments(spark, path), 64)
    reduced = reduction.project(v, mean, axes, keep=["vec_id"])
    total, falling = F.lit(float(variances.sum())), F.lit(bool((np.diff(variances) <= 0).all()))
    return reduced.select(
        "vec_id", F.round(norm(F.col("reduced")), 5).alias("length"), F.round(total, 5).alias("total_variance"), falling.alias("descending")
    )


def _ensemble(spark, folder):
    v = vectors(spark, folder).withColumnRenamed("vec_id", "ordinal")
    return C.ensemble(v, 5, 8, item_id="ordinal")


@query()
def ensemble_chunks(spark, folder):
    """Labels of reduced vectors, for which SQL has no form; the tests hold them against NumPy."""
    return _ensemble(spark, folder)


@query(
    """select i as chunk_no, count(*) as n, count(distinct vec_id) as n_ids
       from embeddings, range(5) t(i), (select ceil(count(*) / 5.0) as size from embeddings)
       where vec_id < (i + 1) * size group by i"""
)
def ensemble_sizes(spark, folder):
    """Every fit covers one chunk more than the one before."""
    sizes = _ensemble(spark, folder).groupBy(F.col("chunk_no").cast("bigint").alias("chunk_no"))
    return sizes.agg(F.count("*").alias("n"), F.countDistinct("ordinal").alias("n_ids"))


@query(
    f"""with {V},
        p as (select a.vec_id, a.label, b.label as other, sum(pow(list_distance(a.e, b.e), 2)) as s, count(*) as n
              from v a, v b group by 1, 2, 3),
        own as (select vec_id, label, s / (n - 1) as x from p where label = other),
        near as (select vec_id, min(s / n) as y from p where label <> other group by 1),
        score as (select round(avg((y - x) / greatest(x, y)), 5) as silhouette from own join near using (vec_id)),
        sizes as (select label, count(*) as n from v group by 1)
        select label, n, silhouette from sizes, score"""
)
def silhouette(spark, folder):
    score = C.silhouette(vectors(spark, folder))
    sizes = C.cluster_sizes(vectors(spark, folder), "label")
    return sizes.withColumn("silhouette", F.round(F.lit(score), 5))


@query(
    f"""select {encoded("doc_id")} as script_id, 1::bigint as copies, true as placed
        from documents where text <> ''"""
)
def index_build(spark, folder):
    """Text to a saved two-level index; every segment lies once in one known cluster."""
    path = scratch_path(spark, "built")
    rows = table(spark, folder, "documents").count()
    build_index(segments(spark, folder), ENCODER, 8, 3, chunk_size=math.ceil(rows / 4)).save(path)
    index = load_index(spark, path)
    known = index.postings.join(index.lv1.select("cluster_id", F.lit(True).alias("placed")), "cluster_id", "left")
    return known.groupBy("script_id").agg(
        F.count("*").alias("copies"), F.bool_and(F.coalesce("placed", F.lit(False))).alias("placed")
    )
