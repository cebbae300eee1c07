"""Keyed tables, sets, samples, maintenance, publishing and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from verbatlas.functions import text as X
from verbatlas.functions.distance import norm
from verbatlas.functions.ids import decode_id, encode_id
from verbatlas.operators import cluster as C
from verbatlas.operators import maintain as M
from verbatlas.operators import publish as P
from verbatlas.operators import quality as Q
from verbatlas.operators import sampling, sets
from verbatlas.operators.encode import embed
from verbatlas.operators.ordering import batch_number, batch_window, global_ordinals, value_grid, zip_positions
from verbatlas.registry import query
from verbatlas.registry.common import (
    ENCODER,
    MEANS,
    RANKED,
    V,
    encoded,
    hashed,
    label_centres,
    label_levels,
    label_members,
    segments,
    table,
    text_vectors,
)
from verbatlas.session import materialise, scratch_path, spread
from verbatlas.sources import tables as T
from verbatlas.streaming.incremental import publish_available, read_published


def _ids(df, column):
    return df.select(encode_id(F.col(column)).alias("script_id"))


# --- keyed tables -------------------------------------------------------------------


@query("select l_returnflag, count(*) as n, sum(l_quantity) as quantity from lineitem group by l_returnflag")
def keyed_scan(spark, folder):
    """A table written and scanned again with two of its columns."""
    path = scratch_path(spark, "scan")
    T.write_table(table(spark, folder, "lineitem"), path)
    rows = T.read_table(spark, path, columns=["l_returnflag", "l_quantity"])
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("select vec_id, len(embedding)::int as width, round(list_sum(embedding::double[]), 5) + 0.0 as total from embeddings")
def parquet_roundtrip(spark, folder):
    path = scratch_path(spark, "vectors")
    T.write_table(table(spark, folder, "embeddings").select("vec_id", "embedding"), path)
    v = T.read_table(spark, path)
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return v.select("vec_id", F.size("embedding").alias("width"), (F.round(total, 5) + 0.0).alias("total"))


@query(
    f"""select {encoded("doc_id")} as script_id, source as video_id, md5(text) as digest from documents
        where doc_id = (select count(*) - 1 from documents)"""
)
def point_lookup(spark, folder):
    """The document with the last ordinal."""
    last = table(spark, folder, "documents").count() - 1
    found = T.lookup(segments(spark, folder), last)
    return found.select("script_id", "video_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(
    f"""select {encoded("d.doc_id")} as script_id, e.vec_id is not null as found, e.label
        from documents d left join embeddings e on e.vec_id = d.doc_id"""
)
def multi_get(spark, folder):
    stored = table(spark, folder, "embeddings").select(
        encode_id(F.col("vec_id")).alias("script_id"), F.lit(True).alias("found"), "label"
    )
    got = T.multi_get(_ids(table(spark, folder, "documents"), "doc_id"), stored)
    return got.select("script_id", F.coalesce("found", F.lit(False)).alias("found"), "label")


# --- sets ---------------------------------------------------------------------------


@query("select user_id, min(event_id) as event_id from events group by user_id")
def dedup_first(spark, folder):
    return sets.dedup_first(table(spark, folder, "events"), "user_id", "event_id").select("user_id", "event_id")


@query(
    """select count(text) as n, count(distinct text) as n_distinct, count(text) = count(distinct text) as "unique"
       from documents"""
)
def dup_check(spark, folder):
    return sets.duplicate_check(table(spark, folder, "documents"), "text")


@query(
    f"""with a as (select vec_id as id from embeddings), b as (select doc_id as id from labels)
        select {encoded("id")} as script_id, side from (
            (select id, 'missing' as side from (select id from a except select id from b)) union all
            (select id, 'unexpected' as side from (select id from b except select id from a)))"""
)
def reconcile_ids(spark, folder):
    expected = _ids(table(spark, folder, "embeddings"), "vec_id")
    return sets.reconcile(expected, _ids(table(spark, folder, "labels"), "doc_id"))


@query(
    """with a as (select doc_id as v, row_number() over (order by doc_id) - 1 as p from documents),
            b as (select doc_id as v, row_number() over (order by doc_id) - 1 as p from labels)
       select p as position, a.v as left_value, b.v as right_value from a full join b using (p)
       where a.v is distinct from b.v"""
)
def zip_mismatch(spark, folder):
    left, right = table(spark, folder, "documents"), table(spark, folder, "labels")
    return zip_positions(left.select("doc_id"), right.select("doc_id"), "doc_id", ["doc_id"])


@query(
    """with f as (select distinct l_returnflag from lineitem), s as (select distinct l_linestatus from lineitem),
            n as (select distinct l_linenumber from lineitem) select * from f, s, n"""
)
def cartesian_three(spark, folder):
    """All combinations of three value lists found in the table."""
    return value_grid(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query(
    """select value, count(*) as n from (select unnest(string_split(text, ' ')) as value from documents)
       where value <> '' group by value"""
)
def flatten_lists(spark, folder):
    """Two blocks of word lists appended and flattened."""
    words = table(spark, folder, "documents").select("source", F.split("text", " ").alias("words"))
    first = words.filter("source < 'src2'").select(F.flatten(F.array("words")).alias("words"))
    second = words.filter("source >= 'src2'").select("words")
    flat = first.unionByName(second).select(F.explode("words").alias("value")).filter("value <> ''")
    return flat.groupBy("value").agg(F.count("*").alias("n"))


# --- batches and samples ------------------------------------------------------------


@query(
    """select ord // 1000 as batch_no, count(*) as n, min(o_orderkey) as first_key, max(o_orderkey) as last_key
       from (select o_orderkey, row_number() over (order by o_orderkey) - 1 as ord from orders) group by 1"""
)
def batch_layout(spark, folder):
    return _batches(spark, folder, None, None)


@query(
    """select ord // 1000 as batch_no, count(*) as n, min(o_orderkey) as first_key, max(o_orderkey) as last_key
       from (select o_orderkey, row_number() over (order by o_orderkey) - 1 as ord from orders)
       where ord // 1000 >= 3 and ord // 1000 < 7 group by 1"""
)
def batch_window_resume(spark, folder):
    """Processing resumed at batch 3 and stopped before batch 7."""
    return _batches(spark, folder, 3, 7)


def _batches(spark, folder, resume, until):
    keys = global_ordinals(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"])
    rows = batch_window(keys, 1000, resume, until)
    return rows.groupBy("batch_no").agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@query(
    """select doc_id from (select doc_id, row_number() over (
           order by ('0x' || substr(md5('11:' || doc_id), 1, 15))::bigint, doc_id) as r from documents) where r <= 100"""
)
def subset_sample(spark, folder):
    return sampling.sample_exact(table(spark, folder, "documents"), 100, "doc_id", seed=11).select("doc_id")


@query(
    """select o_orderkey, ord as ordinal from (
           select o_orderkey, row_number() over (order by o_orderkey) - 1 as ord from orders) where ord < 10000"""
)
def prefix_subset(spark, folder):
    keys = global_ordinals(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"])
    return sampling.prefix(keys, 10_000).select("o_orderkey", "ordinal")


@query(
    f"""select i as draw, doc_id as ordinal, {encoded("doc_id")} as script_id from
        (select i, ('0x' || substr(md5('3:' || i), 1, 15))::bigint % (select count(*) from documents) as place
         from range(100) t(i)) join
        (select doc_id, row_number() over (order by doc_id) - 1 as r from documents) on place = r"""
)
def with_replacement(spark, folder):
    d = segments(spark, folder).select("ordinal", "script_id")
    return sampling.sample_with_replacement(d, 100, seed=3)


# --- maintenance --------------------------------------------------------------------


@query("select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus <> 'F'")
def append_new(spark, folder):
    """All orders delivered twice to a store that has the finished ones."""
    o = table(spark, folder, "orders")
    fresh = M.append_new(o.filter("o_orderstatus = 'F'"), o.unionByName(o), "o_orderkey")
    return fresh.select("o_orderkey", "o_custkey", "o_totalprice")


_UPSERTED = """with changes as (
        select o_orderkey, o_totalprice * 2 as o_totalprice, 1 as version from orders where o_orderpriority = '1-URGENT'
        union all select o_orderkey, o_totalprice + 1, 2 from orders where o_orderstatus = 'O'
        union all select o_orderkey + 100000000, o_totalprice, 1 from orders where o_orderstatus = 'P'),
    w as (select o_orderkey, o_totalprice from changes
          qualify row_number() over (partition by o_orderkey order by version desc) = 1)
    select o_orderkey, round(o_totalprice, 2) as o_totalprice from w union all
    select o_orderkey, round(o_totalprice, 2) from orders where o_orderkey not in (select o_orderkey from w)"""


def _changes(o):
    price = F.col("o_totalprice")
    parts = [
        o.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", (price * 2).alias("o_totalprice"), F.lit(1).alias("version")),
        o.filter("o_orderstatus = 'O'").select("o_orderkey", (price + 1).alias("o_totalprice"), F.lit(2).alias("version")),
        o.filter("o_orderstatus = 'P'").select(
            (F.col("o_orderkey") + 100_000_000).alias("o_orderkey"), "o_totalprice", F.lit(1).alias("version")
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(_UPSERTED)
def upsert(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    changed = M.upsert(o, _changes(table(spark, folder, "orders")), "o_orderkey")
    return changed.select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


@query(_UPSERTED)
def upsert_in_blocks(spark, folder):
    """The same changes applied to a saved table, where only the touched blocks are rewritten."""
    path = scratch_path(spark, "blocks")
    o = table(spark, folder, "orders")
    base = o.select("o_orderkey", "o_totalprice", F.col("o_orderkey").alias("ordinal"))
    M.save_blocks(base, path, block_rows=5000)
    changes = _changes(o).withColumn("ordinal", F.col("o_orderkey"))
    M.upsert_blocks(spark, path, changes, "o_orderkey", block_rows=5000)
    stored = M.read_blocks(spark, path)
    return stored.select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


@query(
    """select o_orderkey, ord as ordinal from (select o_orderkey, row_number() over (order by o_orderkey) - 1 as ord
       from orders) where ord < (select count(*) // 2 from orders)"""
)
def delete_range(spark, folder):
    """Deleted from the middle on in a saved table, where one block is rewritten."""
    path = scratch_path(spark, "versions")
    o = table(spark, folder, "orders").select("o_orderkey")
    M.save_blocks(global_ordinals(o, ["o_orderkey"]), path, block_rows=2000)
    M.delete_blocks(spark, path, o.count() // 2, block_rows=2000)
    return M.read_blocks(spark, path).select("o_orderkey", "ordinal")


@query(
    f"""with n as (select count(*) // 4 as a, count(*) * 3 // 4 as b from documents),
        src as (select doc_id, case when doc_id >= a and doc_id < b then text else source end as text
                from documents, n), {hashed('s', 'src', 'doc_id')}
        select {encoded("id")} as script_id, dim, round(weight, 5) as weight from sw"""
)
def backfill(spark, folder):
    """Stale vectors in the middle half of the ordinals are encoded again and put in."""
    docs = segments(spark, folder)
    n = docs.count()
    stale = embed(docs.select("script_id", "ordinal", F.col("video_id").alias("text")), ENCODER).drop("text")
    patch = M.reencode_range(docs.select("script_id", "ordinal", "text"), ENCODER, n // 4, n * 3 // 4)
    stored = M.backfill(stale, patch)
    cells = stored.select("script_id", F.posexplode("vector").alias("dim", "weight")).filter("weight <> 0")
    return cells.select("script_id", F.col("dim").cast("bigint").alias("dim"), F.round("weight", 5).alias("weight"))


# --- publishing ---------------------------------------------------------------------

_DOC = f"""with {hashed("h", "documents", "doc_id")} select {encoded("d.doc_id")} as script_id, d.source as video_id,
    d.n_chars * 0.25::double as timestamp, md5(d.text) as text_md5, round(list_sum(hv.e), 5) + 0.0 as total
    from documents d join hv on hv.id = d.doc_id where d.text <> ''"""


def _docs(spark, folder):
    """Every document with its text, as segment and vector."""
    return P.documents(segments(spark, folder), text_vectors(spark, folder))


def _doc_shape(df):
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return df.select(
        "script_id",
        "video_id",
        "timestamp",
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
        (F.round(total, 5) + 0.0).alias("total"),
    )


@query(_DOC)
def publish_docs(spark, folder):
    """Published twice; the second time nothing is left to append."""
    path = scratch_path(spark, "published")
    docs = _docs(spark, folder)
    P.publish_documents(None, docs, path)
    P.publish_documents(spark.read.parquet(path), docs, path)
    return _doc_shape(spark.read.parquet(path))


@query(_DOC)
def publish_stream(spark, folder):
    """Three deliveries that overlap and repeat rows, each published by its own run of the stream."""
    root = scratch_path(spark, "published")
    docs = materialise(_docs(spark, folder), "docs")
    n = docs.count()
    number = decode_id(F.col("script_id"))
    for part in (number < n // 2, number >= n // 3, F.lit(True)):
        delivered = docs.filter(part)
        delivered.union(delivered.filter(number % 7 == 0)).write.mode("append").parquet(f"{root}/in")
        publish_available(spark, f"{root}/in", docs.schema, f"{root}/store", f"{root}/state")
    return _doc_shape(read_published(spark, f"{root}/store", docs.schema))


@query(_DOC)
def publish_docs_json(spark, folder):
    path = scratch_path(spark, "published")
    docs = _docs(spark, folder)
    P.publish_json(docs, path)
    return _doc_shape(spark.read.schema(docs.schema).json(path))


def _stale_store(spark, folder, docs):
    path = scratch_path(spark, "store")
    lang = table(spark, folder, "documents").select(F.col("doc_id").alias("ordinal"), F.col("lang").alias("text"))
    M.save_blocks(docs.drop("text").join(lang, "ordinal"), path, block_rows=500)
    return path


def _stored_shape(spark, path):
    stored = M.read_blocks(spark, path)
    return stored.select("script_id", "video_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(
    f"""select {encoded("doc_id")} as script_id, source as video_id,
            case when doc_id >= (select count(*) // 2 from documents) then md5(text) else md5(lang) end as text_md5
        from documents"""
)
def publish_docs_upsert(spark, folder):
    """A store with stale texts, set again document by document from the middle on."""
    docs = segments(spark, folder)
    path = _stale_store(spark, folder, docs)
    P.upsert_documents(spark, docs, path, batch_size=500, resume=docs.count() // 2, block_rows=500)
    return _stored_shape(spark, path)


@query(
    f"""select {encoded("doc_id")} as script_id, source as video_id,
            case when doc_id >= n // 2 and doc_id < n // 2 + n // 5 then md5(text) else md5(lang) end as text_md5
        from documents, (select count(*) as n from documents)"""
)
def publish_docs_one_batch(spark, folder):
    """As `publish_docs_upsert`, but it stops after one batch of a fifth of all documents."""
    docs = segments(spark, folder)
    path, n = _stale_store(spark, folder, docs), docs.count()
    P.upsert_documents(spark, docs, path, batch_size=n // 5, resume=n // 2, stop=True, block_rows=500)
    return _stored_shape(spark, path)


@query(f"{_DOC} and d.doc_id = 0")
def seed_one(spark, folder):
    return _doc_shape(P.seed_document(_docs(spark, folder)))


@query(f"{_DOC} and d.doc_id not in (select doc_id from labels)")
def publish_omitted(spark, folder):
    """Documents that a reconciliation found missing, and no others."""
    docs = _docs(spark, folder)
    difference = sets.reconcile(docs.select("script_id"), _ids(table(spark, folder, "labels"), "doc_id"))
    return _doc_shape(P.omitted_documents(difference, docs))


_NORM = "round(sqrt(list_dot_product(c, c)), 5)"


@query(
    f"""with {V}, {MEANS}, {RANKED} select r.cluster_id, (place - 1) // 16 + 1 as chunk_no, count(*) as n,
            string_agg(vec_id::varchar, ',' order by place) as members, any_value({_NORM}) as size
        from ranked r join cen on cen.cluster_id = r.cluster_id group by 1, 2"""
)
def publish_clusters(spark, folder):
    centres = label_centres(spark, folder)
    members = label_members(spark, folder, centres).drop("vector")
    chunks = P.member_chunks(C.members_ranked(members, item_id="vec_id"), 16, item_id="vec_id")
    path = scratch_path(spark, "clusters")
    T.write_table(P.cluster_documents(centres, chunks), path)
    return spark.read.parquet(path).select(
        "cluster_id",
        "chunk_no",
        "n",
        F.array_join(F.col("members").cast("array<string>"), ",").alias("members"),
        F.round(norm(F.col("centroid")), 5).alias("size"),
    )


@query(f"with {V}, {MEANS} select cluster_id, {_NORM} as size from cen")
def publish_centroids(spark, folder):
    path = scratch_path(spark, "centroids")
    T.write_table(P.centroid_documents(label_centres(spark, folder)), path)
    return spark.read.parquet(path).select("cluster_id", F.round(norm(F.col("centroid")), 5).alias("size"))


@query(
    f"""with {V}, {MEANS} select 1 as level, cluster_id as id, '' as members, {_NORM} as size from cen
        union all
        select 2, cen2.lv2_id, string_agg(cen.cluster_id, ',' order by cen.cluster_id),
               any_value(round(sqrt(list_dot_product(cen2.c, cen2.c)), 5))
        from cen2 join cen on cen.lv2_id = cen2.lv2_id group by cen2.lv2_id"""
)
def publish_levels(spark, folder):
    lv1 = label_centres(spark, folder)
    lv2 = C.mean_vectors(lv1.select("lv2_id", "centroid"), "lv2_id", "centroid")
    path = scratch_path(spark, "levels")
    T.write_table(P.level_documents(lv1, lv2), path)
    return spark.read.parquet(path).select(
        "level", "id", F.array_join("members", ",").alias("members"), F.round(norm(F.col("centroid")), 5).alias("size")
    )


@query("select distinct 'cc' || (label % 3) as lv2_id from embeddings")
def level2_keys(spark, folder):
    return label_levels(spark, folder).level2_ids


@query(f"select {encoded('doc_id')} as script_id, source as video_id, n_chars from documents")
def narrow_scan(spark, folder):
    """A scan of stored documents without their wide fields."""
    path = scratch_path(spark, "wide")
    docs = text_vectors(spark, folder).withColumn("n_chars", (F.col("timestamp") * 4).cast("bigint"))
    T.write_table(docs, path)
    return spark.read.parquet(path).drop("text", "vector", "ordinal", "timestamp")


# --- checks -------------------------------------------------------------------------


@query(
    f"""with a as (select unnest(range(count(*))) as id from documents), b as (select doc_id as id from labels)
        select {encoded("id")} as script_id, 'missing' as side from (select id from a except select id from b)
        union all
        select {encoded("id")}, 'unexpected' from (select id from b except select id from a)"""
)
def key_check(spark, folder):
    stored = _ids(table(spark, folder, "labels"), "doc_id")
    return Q.key_check(stored, table(spark, folder, "documents").count())


@query(
    f"""with a as (select {encoded("id")} as v from (select unnest(range(count(*))) as id from documents)),
        b as (select {encoded("doc_id")} as v from labels),
        l as (select v, row_number() over (order by v) - 1 as p from a),
        r as (select v, row_number() over (order by v) - 1 as p from b)
        select p as position, l.v as left_value, r.v as right_value from l full join r using (p)
        where l.v is distinct from r.v"""
)
def key_check_positions(spark, folder):
    stored = _ids(table(spark, folder, "labels"), "doc_id")
    return Q.key_check_by_position(stored, table(spark, folder, "documents").count())


_OTHER = "text"
for _old, _new in X.PUNCTUATION_STEPS:
    _OTHER = f"replace({_OTHER}, '{_old}', '{_new}')"


@query(
    f"""with changed as (select doc_id, {_OTHER} as text from documents),
        {hashed('old_', 'documents', 'doc_id')}, {hashed('new_', 'changed', 'doc_id')},
        t as (select d.doc_id, list_distance(old_v.e, new_v.e) < 1e-4 as v,
                len(list_distinct(string_split(d.text, ''))) = len(list_distinct(string_split(c.text, ''))) as x,
                d.text = c.text as s
              from documents d join changed c using (doc_id) join old_v on old_v.id = d.doc_id
                   join new_v on new_v.id = d.doc_id)
        select count(*) as n, count(*) filter (where v) as vector_passed, count(*) filter (where x) as text_passed,
               count(*) filter (where s) as text_equal, count(*) filter (where not (v and x)) as failed from t"""
)
def quality_tally(spark, folder):
    """Original texts against a store that kept them without punctuation."""
    d = spread(segments(spark, folder))
    stored = d.withColumn("text", X.normalise_punctuation(F.col("text")))
    v = materialise(embed(stored.select("script_id", "text"), ENCODER).drop("text"), "stored")
    return Q.tally(Q.sample_check(d.select("script_id", "text"), stored, v, ENCODER))


@query(
    f"""with drawn as (select doc_id, text from documents order by substr(md5('11:' || {encoded("doc_id")}), 1, 15), {encoded("doc_id")}
            limit (select greatest(count(*) // 10, 1) from documents)),
        changed as (select doc_id, {_OTHER} as text from drawn),
        {hashed('old_', 'drawn', 'doc_id')}, {hashed('new_', 'changed', 'doc_id')}
        select {encoded("d.doc_id")} as script_id, list_distance(old_v.e, new_v.e) < 1e-4 as vector_ok,
               len(list_distinct(string_split(d.text, ''))) = len(list_distinct(string_split(c.text, ''))) as text_ok,
               d.text = c.text as text_equal
        from drawn d join changed c using (doc_id) join old_v on old_v.id = d.doc_id join new_v on new_v.id = d.doc_id
        where d.text <> ''"""
)
def quality_sample(spark, folder):
    """A tenth of the original texts, drawn by hash, against the same store; only these are encoded."""
    d = segments(spark, folder)
    stored = d.withColumn("text", X.normalise_punctuation(F.col("text")))
    v = materialise(embed(spread(stored.select("script_id", "text")), ENCODER).drop("text"), "stored")
    return Q.drawn_check(d, stored, v, ENCODER, max(d.count() // 10, 1), 11)


@query("select count(*) as n from lineitem")
def row_count(spark, folder):
    return Q.row_count(table(spark, folder, "lineitem"))
