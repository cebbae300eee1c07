"""Routing and search, over all embeddings and over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from verbatlas.operators.cluster import mean_vectors, members_ranked
from verbatlas.operators.nearest import assign, nearest
from verbatlas.operators.pivots import build_table, load_table, search_pivots
from verbatlas.operators.publish import member_chunks
from verbatlas.plans import search as S
from verbatlas.plans.index import VectorIndex, append_to_index, load_index
from verbatlas.registry import query
from verbatlas.registry.common import (
    ENCODER,
    MEANS,
    RANKED,
    V,
    as_queries,
    cityblock,
    encoded,
    hashed,
    label_centres,
    label_index,
    label_levels,
    label_members,
    segments,
    table,
    text_vectors,
    time_padded,
    time_plain,
    vectors,
)
from verbatlas.functions.ids import decode_id, encode_id
from verbatlas.functions.text import cluster_key
from verbatlas.session import materialise, scratch_path
from verbatlas.streaming.incremental import grow_available

THRESHOLD = 1.35


def _rounded(df, *keys):
    return df.select(*keys, F.col("rank").cast("bigint").alias("rank"), F.round("distance", 5).alias("distance"))


@query(
    f"""with {V}, p as (select q.vec_id as query_id, c.vec_id, list_distance(q.e, c.e) as d from v q, v c),
        r as (select *, row_number() over (partition by query_id order by round(d, 9), vec_id) as rank from p)
        select query_id, vec_id, rank, round(d, 5) as distance from r where rank <= 10"""
)
def exhaustive_topk(spark, folder):
    v = vectors(spark, folder)
    return _rounded(S.exhaustive(as_queries(v), v, 10, item_id="vec_id"), "query_id", "vec_id")


@query(
    f"""with {V}, {MEANS},
        p as (select cen.label as query_id, v.vec_id, list_distance(cen.c, v.e) as d from cen, v),
        r as (select *, row_number() over (partition by query_id order by round(d, 9), vec_id) as rank from p
              where d < 100)
        select query_id, vec_id, rank, round(d, 5) as distance from r where rank = 1"""
)
def exhaustive_nearest(spark, folder):
    centres = label_centres(spark, folder).select(F.col("label").alias("query_id"), F.col("centroid").alias("vector"))
    hits = S.exhaustive(centres, vectors(spark, folder), 1, item_id="vec_id", max_distance=S.EXHAUSTIVE_BOUND)
    return _rounded(hits, "query_id", "vec_id")


_ROUTE1 = """route as (select query_id, cluster_id, d, e from (
    select v.vec_id as query_id, v.e, cen.cluster_id, {0} as d,
           row_number() over (partition by v.vec_id order by {0}, cen.cluster_id) as r from v, cen) where r = 1)"""


def _route2(distance) -> str:
    d2, d1 = distance("v.e", "cen2.c"), distance("up.e", "cen.c")
    return f"""up as (select query_id, lv2_id, e from (
        select v.vec_id as query_id, v.e, cen2.lv2_id,
               row_number() over (partition by v.vec_id order by {d2}, cen2.lv2_id) as r from v, cen2) where r = 1),
    route as (select query_id, lv2_id, cluster_id, d, e from (
        select up.query_id, up.lv2_id, up.e, cen.cluster_id, {d1} as d,
               row_number() over (partition by up.query_id order by {d1}, cen.cluster_id) as r
        from up join cen on cen.lv2_id = up.lv2_id) where r = 1)"""


def _euclid(a: str, b: str) -> str:
    return f"list_distance({a}, {b})"


@query(
    f"""with {V}, {MEANS}, {_ROUTE1.format(_euclid("v.e", "cen.c"))}
        select query_id, cluster_id, round(d, 5) as distance from route"""
)
def route_one_level(spark, folder):
    routed = S.route(as_queries(vectors(spark, folder)), label_levels(spark, folder), 1, "euclidean")
    return routed.select("query_id", "cluster_id", F.round("distance", 5).alias("distance"))


@query(
    f"""with {V}, {MEANS}, {_route2(cityblock)}
        select query_id, lv2_id, cluster_id, round(d, 5) as distance from route"""
)
def route_two_level(spark, folder):
    routed = S.route(as_queries(vectors(spark, folder)), label_levels(spark, folder))
    return routed.select("query_id", "lv2_id", "cluster_id", F.round("distance", 5).alias("distance"))


@query(
    f"""with {V}, {MEANS}, {RANKED}, {_ROUTE1.format(_euclid("v.e", "cen.c"))},
        hit as (select r.query_id, k.vec_id, list_distance(r.e, k.e) as d, k.place
                from route r join ranked k on k.cluster_id = r.cluster_id),
        first as (select * from (select *, row_number() over (partition by query_id order by place) as n
                  from hit where d < {THRESHOLD}) where n <= 10)
        select query_id, vec_id, row_number() over (partition by query_id order by round(d, 9), vec_id) as rank,
               round(d, 5) as distance from first"""
)
def search_one_level_first_n(spark, folder):
    index = label_index(spark, folder)
    hits = S.ranked_ids(
        as_queries(vectors(spark, folder)), index, 10, 1, "euclidean", "euclidean", THRESHOLD, "first_n"
    )
    return _rounded(hits.withColumn("vec_id", decode_id(F.col("script_id"))), "query_id", "vec_id")


@query(
    f"""with {V}, {MEANS}, {RANKED}, {_route2(_euclid)},
        hit as (select r.query_id, k.vec_id, {cityblock("r.e", "k.e")} as d, k.place
                from route r join ranked k on k.cluster_id = r.cluster_id),
        first as (select * from (select *, row_number() over (partition by query_id order by place) as n
                  from hit where d < 8.6) where n <= 5)
        select query_id, vec_id, row_number() over (partition by query_id order by round(d, 9), {encoded("vec_id")}) as rank,
               round(d, 5) as distance from first"""
)
def search_first_n_waves(spark, folder):
    """Two levels, the first five members within a city-block distance, from a saved index in waves of eight ranks and more."""
    path = scratch_path(spark, "index")
    label_index(spark, folder).save(path)
    index = load_index(spark, path)
    asked = as_queries(vectors(spark, folder))
    hits = S.ranked_ids(asked, index, 5, 2, "euclidean", "cityblock", 8.6, "first_n", first_wave=8)
    return _rounded(hits.withColumn("vec_id", decode_id(F.col("script_id"))), "query_id", "vec_id")


_TOP = """top as (select * from (select r.query_id, k.vec_id, {0} as d,
               row_number() over (partition by r.query_id order by round({0}, 9), {1}) as rank
        from route r join ranked k on k.cluster_id = r.cluster_id) where rank <= 10)"""


@query(
    f"""with {V}, {MEANS}, {RANKED}, {_ROUTE1.format(_euclid("v.e", "cen.c"))},
        {_TOP.format(_euclid("r.e", "k.e"), "k.vec_id")}
        select query_id, vec_id, rank, round(d, 5) as distance from top"""
)
def search_one_level_topk(spark, folder):
    index = label_index(spark, folder)
    hits = S.ranked_ids(as_queries(vectors(spark, folder)), index, 10, 1, "euclidean")
    return _rounded(hits.withColumn("vec_id", decode_id(F.col("script_id"))), "query_id", "vec_id")


def _with_info(time) -> str:
    return f"""select t.query_id, t.rank, round(t.d, 5) as distance, {encoded("t.vec_id")} as script_id,
        s.source as video_id, {time("s.n_chars * 0.25")} as at, md5(s.text) as text_md5
        from top t left join documents s on s.doc_id = t.vec_id"""


def _published_shape(df):
    return df.select(
        "query_id",
        F.col("rank").cast("bigint").alias("rank"),
        F.round("distance", 5).alias("distance"),
        "script_id",
        "video_id",
        "at",
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
    )


@query(
    f"""with {V}, {MEANS}, {RANKED}, {_route2(cityblock)},
        {_TOP.format(_euclid("r.e", "k.e"), encoded("k.vec_id"))} {_with_info(time_padded)}"""
)
def search_two_level_served(spark, folder):
    return _published_shape(S.search(as_queries(vectors(spark, folder)), label_index(spark, folder), 10))


@query(
    f"""with {V}, {MEANS}, {RANKED}, {_route2(_euclid)},
        {_TOP.format(cityblock("r.e", "k.e"), encoded("k.vec_id"))} {_with_info(time_padded)}"""
)
def search_two_level_method(spark, folder):
    hits = S.search(
        as_queries(vectors(spark, folder)),
        label_index(spark, folder),
        10,
        route_metric="euclidean",
        rank_metric="cityblock",
    )
    return _published_shape(hits)


@query(
    f"""with {V}, {MEANS}, {RANKED}, {_route2(cityblock)},
        {_TOP.format(_euclid("r.e", "k.e"), encoded("k.vec_id"))} {_with_info(time_padded)}"""
)
def search_saved_index(spark, folder):
    """The served search over an index that was written and loaded again."""
    from verbatlas.plans.index import load_index

    path = scratch_path(spark, "index")
    label_index(spark, folder).save(path)
    return _published_shape(S.search(as_queries(vectors(spark, folder)), load_index(spark, path), 10))


@query(
    f"""with {V}, {MEANS}, {RANKED}, {_ROUTE1.format(_euclid("v.e", "cen.c"))},
        hit as (select r.query_id, k.vec_id, list_distance(r.e, k.e) as d, k.place
                from route r join ranked k on k.cluster_id = r.cluster_id
                join labels l on l.doc_id = k.vec_id join documents s on s.doc_id = k.vec_id),
        first as (select * from (select *, row_number() over (partition by query_id order by place) as n
                  from hit where d < {THRESHOLD}) where n <= 10),
        top as (select *, row_number() over (partition by query_id order by round(d, 9), {encoded("vec_id")}) as rank
                from first) {_with_info(time_plain)}"""
)
def search_published_docs(spark, folder):
    """Only vectors that have a quality label are published; the others are skipped."""
    centres = label_centres(spark, folder)
    ranked = members_ranked(label_members(spark, folder, centres), item_id="vec_id")
    members = ranked.withColumn("script_id", encode_id(F.col("vec_id")))
    published = table(spark, folder, "labels").select(encode_id(F.col("doc_id")).alias("script_id"))
    docs = members.select("script_id", "vector").join(published, "script_id", "left_semi")
    docs = docs.join(segments(spark, folder), "script_id")
    hits = S.search_published(
        as_queries(vectors(spark, folder)), centres, member_chunks(members, 16), docs, 10, THRESHOLD
    )
    return _published_shape(hits)


@query(
    f"""with {V}, a as (select i, avg(e[i]) as x from v, range(1, 65) t(i) group by i),
        ref as (select list(x order by i) as c from a)
        select v.vec_id as query_id, round(list_distance(v.e, ref.c), 5) as distance from v, ref"""
)
def distance_table(spark, folder):
    """The mean of all vectors against every vector, as a CSV report that is read back."""
    v = vectors(spark, folder)
    mean = mean_vectors(v.withColumn("all", F.lit(1)), "all").select(F.col("centroid").alias("vector"))
    path = scratch_path(spark, "report")
    S.write_report(S.distance_table(mean, as_queries(v)), path)
    report = spark.read.schema("query_id bigint, distance double").option("header", True).csv(path)
    return report.select("query_id", F.round("distance", 5).alias("distance"))


_TEXT = hashed("d", "documents", "doc_id") + "," + hashed("q", "(select item_id, replace(text, '_', ' ') as text from benchmark)", "item_id")


@query(
    f"""with {_TEXT},
        p as (select q.id as query_id, d.id as doc_id, list_distance(q.e, d.e) as x from qv q, dv d),
        r as (select *, row_number() over (partition by query_id order by round(x, 9), doc_id) as rank from p)
        select query_id, doc_id, rank, round(x, 5) as distance from r where rank <= 5"""
)
def text_search(spark, folder):
    """Every benchmark text against all documents, exact."""
    queries = table(spark, folder, "benchmark").withColumnRenamed("item_id", "query_id")
    hits = nearest(S.encode_queries(queries, ENCODER), text_vectors(spark, folder), 5, item_id="ordinal")
    return _rounded(hits.withColumnRenamed("ordinal", "doc_id"), "query_id", "doc_id")


@query(
    f"""with {_TEXT},
        p as (select q.id as query_id, d.id as doc_id, {cityblock("q.e", "d.e")} as x from qv q, dv d),
        r as (select *, row_number() over (partition by query_id order by round(x, 9), doc_id) as rank from p)
        select query_id, doc_id, rank, round(x, 5) as distance from r where rank <= 5"""
)
def exhaustive_pivots(spark, folder):
    """Every benchmark text against all documents by city block, skipping blocks by their bounds; the table is saved and loaded."""
    docs = text_vectors(spark, folder).select(F.col("ordinal").alias("doc_id"), "vector")
    path = scratch_path(spark, "pivots")
    build_table(docs, "cityblock", item_id="doc_id", block_rows=64).save(path)
    asked = S.encode_queries(table(spark, folder, "benchmark").withColumnRenamed("item_id", "query_id"), ENCODER)
    return _rounded(search_pivots(asked, load_table(spark, path, "cityblock", "doc_id"), 5), "query_id", "doc_id")


_TEXT_ROUTED = f"""with {_TEXT},
    src as (select doc_id, 'c' || substr(source, 4) as cluster_id,
                   'cc' || (substr(source, 4)::int % 3) as lv2_id from documents),
    tm as (select s.cluster_id, s.lv2_id, i, avg(d.e[i]) as x from dv d join src s on s.doc_id = d.id,
           range(1, 65) t(i) group by 1, 2, 3),
    cen as (select cluster_id, lv2_id, list(x order by i) as c from tm group by 1, 2),
    tm2 as (select lv2_id, i, avg(c[i]) as x from cen, range(1, 65) t(i) group by 1, 2),
    cen2 as (select lv2_id, list(x order by i) as c from tm2 group by 1),
    v as (select id as vec_id, e from qv),
    ranked as (select s.cluster_id, d.id as vec_id, d.e from dv d join src s on s.doc_id = d.id),
    {_route2(cityblock)}"""


@query(
    f"""{_TEXT_ROUTED}, {_TOP.format(_euclid("r.e", "k.e"), encoded("k.vec_id"))} {_with_info(time_padded)}"""
)
def text_search_served(spark, folder):
    """Query text to ranked segments: sources are level-1 clusters, source number mod 3 level 2."""
    number = F.substring("video_id", 4, 10).cast("int")
    docs = text_vectors(spark, folder).withColumns(
        {"cluster_id": cluster_key(number), "lv2_id": cluster_key(number % 3, 2)}
    )
    docs = materialise(docs.drop("text"), "docs")
    means = mean_vectors(docs, "cluster_id", width=ENCODER.dim)
    lv1 = materialise(means.join(docs.select("cluster_id", "lv2_id").distinct(), "cluster_id"), "lv1")
    lv2 = materialise(mean_vectors(lv1.select("lv2_id", "centroid"), "lv2_id", width=ENCODER.dim, vector="centroid"), "lv2")
    index = VectorIndex(segments(spark, folder), docs, lv1, lv2)
    queries = table(spark, folder, "benchmark").withColumnRenamed("item_id", "query_id")
    return _published_shape(S.search(S.encode_queries(queries, ENCODER), index, 10))


_GROWN = f"""{_TEXT_ROUTED}, near as (select * from (select d.id, c.cluster_id, c.lv2_id, row_number() over (
            partition by d.id order by round(list_distance(d.e, c.c), 9), c.cluster_id) as r from dv d, cen c) where r = 1)
        select {encoded("id")} as script_id, cluster_id, lv2_id, md5(text) as text_md5
        from near join documents on doc_id = id"""


@query(_GROWN)
def incremental_index(spark, folder):
    """An index of the first half of the documents, to which the second half is added."""
    return _grown(spark, folder, streamed=False)


def _grown(spark, folder, streamed):
    number = F.substring("video_id", 4, 10).cast("int")
    keys = {"cluster_id": cluster_key(number), "lv2_id": cluster_key(number % 3, 2)}
    docs = materialise(text_vectors(spark, folder).withColumns(keys), "docs")
    means = mean_vectors(docs, "cluster_id", width=ENCODER.dim)
    lv1 = means.join(docs.select("cluster_id", "lv2_id").distinct(), "cluster_id").select("cluster_id", "centroid", "lv2_id")
    lv1 = materialise(lv1, "lv1")
    lv2 = mean_vectors(lv1.select("lv2_id", "centroid"), "lv2_id", "centroid", width=ENCODER.dim).drop("n")
    rows = segments(spark, folder)
    half = rows.count() // 2
    first = assign(docs.filter(F.col("ordinal") < half).select("script_id", "vector"), lv1, keep=["vector"])
    first = first.join(lv1.select("cluster_id", "lv2_id"), "cluster_id")
    path = scratch_path(spark, "growing")
    index = VectorIndex(rows.filter(F.col("ordinal") < half), members_ranked(first), lv1, lv2)
    index.save(path, block_rows=300)
    late = rows.filter(F.col("ordinal") >= half).withColumnRenamed("ordinal", "arrival").drop("script_id")
    if streamed:
        for part in (F.col("arrival") < half + half // 2, F.col("arrival") >= half + half // 2):
            late.filter(part).write.mode("append").parquet(f"{path}-in")
            grow_available(spark, f"{path}-in", late.schema, path, f"{path}-state", ENCODER, ["arrival"], block_rows=300)
    else:
        append_to_index(spark, path, late, ENCODER, ["arrival"], block_rows=300)
    grown = load_index(spark, path, block_rows=300)
    texts = grown.segments.select("script_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))
    return grown.postings.select("script_id", "cluster_id", "lv2_id").join(texts, "script_id")


@query(_GROWN)
def streaming_index(spark, folder):
    """The same index grown by two deliveries of a stream."""
    return _grown(spark, folder, streamed=True)
