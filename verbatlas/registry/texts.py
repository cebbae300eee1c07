"""Text, ids, encoding and ingest."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from verbatlas.functions import text as X
from verbatlas.functions.ids import decode_id, encode_id, expected_ids
from verbatlas.operators import encode as E
from verbatlas.operators.encode import count_unusable, embed
from verbatlas.operators.ordering import assign_ordinals, global_ordinals
from verbatlas.operators.sets import resolve
from verbatlas.plans.index import encode_batches, read_vectors
from verbatlas.registry import query
from verbatlas.registry.common import ENCODER, encoded, hashed, segments, table, text_vectors, time_padded, time_plain
from verbatlas.session import materialise, scratch_path, spread
from verbatlas.sources import lines, pages, transcripts


PAGES_PER_TASK = 500  # saved pages that one task writes


def _md5(column: str):
    return F.md5(F.col(column).cast("binary"))


def _weights(df, key):
    cells = df.select(key, F.posexplode("vector").alias("dim", "weight")).filter("weight <> 0")
    return cells.select(key, F.col("dim").cast("bigint").alias("dim"), F.round("weight", 5).alias("weight"))


# --- encoding ---------------------------------------------------------------------


@query(f"with {hashed('d', 'documents', 'doc_id')} select id as doc_id, dim, round(weight, 5) as weight from dw")
def hashed_embedding(spark, folder):
    v = text_vectors(spark, folder).withColumnRenamed("ordinal", "doc_id")
    return _weights(v, "doc_id")


@query(f"with {hashed('q', 'benchmark', 'item_id')} select id as item_id, dim, round(weight, 5) as weight from qw")
def hashed_queries(spark, folder):
    return _weights(embed(table(spark, folder, "benchmark"), ENCODER), "item_id")


@query(
    """select count(*) as n, count(*) filter (where text is null) as n_null,
              count(*) filter (where text = '') as n_empty from documents"""
)
def unusable_texts(spark, folder):
    return count_unusable(table(spark, folder, "documents"))


# --- ids --------------------------------------------------------------------------


@query("select doc_id, row_number() over (order by text, doc_id) - 1 as ordinal from documents")
def assign_ordinals_by_text(spark, folder):
    """Dense ordinals in text order: copies of one text sit side by side."""
    return global_ordinals(table(spark, folder, "documents").select("doc_id", "text"), ["text", "doc_id"]).select(
        "doc_id", "ordinal"
    )


@query(
    f"""select o_orderkey, ordinal, {encoded("ordinal")} as script_id from (
        select o_orderkey, row_number() over (order by o_orderkey) - 1 as ordinal from orders)"""
)
def opaque_ids(spark, folder):
    keys = table(spark, folder, "orders").select("o_orderkey")
    return assign_ordinals(keys, ["o_orderkey"]).select("o_orderkey", "ordinal", "script_id")


_DIGIT = "(strpos('0123456789abcdefghijklmnopqrstuvwxyz', substr(script_id, {0}, 1)) - 1)::hugeint"


@query(
    f"""with ids as (select l_orderkey * 8 + l_linenumber as n,
            {encoded("(l_orderkey * 8 + l_linenumber)")} as script_id from lineitem),
        body as (select n, script_id, {" + ".join(f"{_DIGIT.format(i)} * {36 ** (7 - i)}" for i in range(1, 8))} as b
                 from ids)
        select distinct script_id, ((b + 78364164096 - 12345) % 78364164096 * 77586022261::hugeint % 78364164096)::bigint
               as ordinal from body"""
)
def decode_ids(spark, folder):
    """Ids of all lineitem keys, turned back into numbers."""
    rows = table(spark, folder, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("n"))
    ids = rows.select(encode_id(F.col("n")).alias("script_id")).distinct()
    return ids.select("script_id", decode_id(F.col("script_id")).alias("ordinal"))


@query(
    f"""select n as ordinal, {encoded("n")} as script_id from (select unnest(range(count(*))) as n from documents)"""
)
def expected_id_range(spark, folder):
    return expected_ids(spark, 0, table(spark, folder, "documents").count())


# --- text -------------------------------------------------------------------------

_PUNCT = "text"
for _old, _new in X.PUNCTUATION_STEPS:
    _PUNCT = f"replace({_PUNCT}, '{_old}', '{_new}')"


def _digest(df, column, key="doc_id"):
    return df.select(key, _md5(column).alias("digest"), F.length(column).cast("bigint").alias("length"))


@query(f"select doc_id, md5(t) as digest, length(t) as length from (select doc_id, {_PUNCT} as t from documents)")
def normalise_punct(spark, folder):
    d = spread(table(spark, folder, "documents"))
    return _digest(d.withColumn("t", X.normalise_punctuation(F.col("text"))), "t")


@query(
    """select doc_id, md5(t) as digest, length(t) as length from (
        select doc_id, replace(replace(text, chr(10), ' '), '"', ' ') as t from documents)"""
)
def clean_caption(spark, folder):
    return _digest(table(spark, folder, "documents").withColumn("t", X.clean_caption(F.col("text"))), "t")


@query(
    """select item_id, md5(t) as digest, length(t) as length from (
        select item_id, replace(replace(text, ' ', '_'), '_', ' ') as t from benchmark)"""
)
def query_normalise(spark, folder):
    """Queries as they arrive in a url, with underscores between the words."""
    b = table(spark, folder, "benchmark").withColumn("t", F.replace("text", F.lit(" "), F.lit("_")))
    return _digest(b.withColumn("t", X.normalise_query(F.col("t"))), "t", "item_id")


@query(
    """with l as (select event_id, '"u' || user_id || '","' || props || '","' || event_id || '","1"' as line
                 from events),
        r as (select event_id, replace(replace(replace(line, '","', chr(1)), '"', ' '), chr(1), '","') as line from l)
        select event_id, '"' || substr(line, 2, length(line) - 2) || '"' as line from r"""
)
def quote_repair(spark, folder):
    """CSV lines of all events; the JSON in ``props`` brings stray quotes."""
    line = F.concat(
        F.lit('"u'), F.col("user_id"), F.lit('","'), F.col("props"), F.lit('","'), F.col("event_id"), F.lit('","1"')
    )
    raw = table(spark, folder, "events").select("event_id", line.alias("line"))
    return transcripts.repair_lines(raw, "line")


@query(
    """with l as (select doc_id, '"' || source || '","' || replace(text, chr(10), ' ') || '","' || n_chars || '","1"'
                 as line from documents),
        r as (select doc_id, replace(replace(replace(line, '","', chr(1)), '"', ' '), chr(1), '","') as line from l),
        o as (select doc_id, '"' || substr(line, 2, length(line) - 2) || '"' as line from r)
        select doc_id, md5(line) as digest, length(line) as length from o"""
)
def quote_repair_texts(spark, folder):
    flat = F.translate("text", "\n", " ")
    line = F.concat(
        F.lit('"'), F.col("source"), F.lit('","'), flat, F.lit('","'), F.col("n_chars"), F.lit('","1"')
    )
    raw = table(spark, folder, "documents").select("doc_id", line.alias("line"))
    return _digest(transcripts.repair_lines(raw, "line"), "line")


def _stored_seconds(spark, folder):
    """Seconds stored as UTF-8 bytes, the way the keyed store keeps them."""
    seconds = (F.col("n_chars") * 0.25).cast("string").cast("binary")
    stored = table(spark, folder, "documents").select("doc_id", seconds.alias("raw"))
    return stored.select("doc_id", X.utf8(F.col("raw")).cast("double").alias("seconds"))


@query(f"select doc_id, {time_plain('n_chars * 0.25')} as at from documents")
def timestamp_plain(spark, folder):
    return _stored_seconds(spark, folder).select("doc_id", X.time_label(F.col("seconds"), False).alias("at"))


@query(f"select doc_id, {time_padded('n_chars * 0.25')} as at from documents")
def timestamp_padded(spark, folder):
    return _stored_seconds(spark, folder).select("doc_id", X.time_label(F.col("seconds")).alias("at"))


@query("select page_id, replace(link, '/c/', '/user/') as link from (select page_id, replace(url, '/en/', '/c/') || "
       "case when contains(url, '?') then '%20' else '' end as link from pages) "
       "where contains(link, '/c/') and not contains(link, '%')")
def url_normalise(spark, folder):
    """Page urls with their English part written as a channel part, some percent-encoded."""
    link = F.concat(
        F.replace("url", F.lit("/en/"), F.lit("/c/")), F.when(F.col("url").contains("?"), "%20").otherwise("")
    )
    made = table(spark, folder, "pages").select("page_id", link.alias("link"))
    return pages.channel_urls(made, "socialblade", needle="/c/")


@query("select page_id, substr(md5(url), 1, 11) as video_id from pages")
def share_id(spark, folder):
    url = F.concat(F.lit("https://youtu.be/"), F.substring(_md5("url"), 1, 11))
    shared = table(spark, folder, "pages").select("page_id", url.alias("share"))
    return shared.select("page_id", X.share_id(F.col("share")).alias("video_id"))


@query(
    """select vec_id, 'c' || label as lv1, 'cc' || label as lv2, 'c' || label || '_b' || vec_id as chunk,
              label || '_' || vec_id as page from embeddings where regexp_matches('c' || label, '(?i)^.*')"""
)
def key_build(spark, folder):
    label, n = F.col("label"), F.col("vec_id")
    keys = table(spark, folder, "embeddings").select(
        "vec_id",
        X.cluster_key(label).alias("lv1"),
        X.cluster_key(label, 2).alias("lv2"),
        X.chunk_key(X.cluster_key(label), n).alias("chunk"),
        X.page_file_key(label.cast("string"), n.cast("string")).alias("page"),
    )
    return pages.matching(keys, "lv1")


# --- ingest -----------------------------------------------------------------------


@query(
    """select page_id, unnest(range(len(l))) as place, unnest(l) as link
       from (select page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) as l from pages)"""
)
def link_harvest(spark, folder):
    links = pages.harvest_links(table(spark, folder, "pages"), "html", "page_id")
    return links.select("page_id", F.col("place").cast("bigint").alias("place"), "link")


@query(
    """select line as value, count(*) as n from (select unnest(string_split(text, chr(10))) as line from documents)
       where line <> '' group by line"""
)
def line_list(spark, folder):
    """All document lines as a text file, read back without the empty ones."""
    path = scratch_path(spark, "lines")
    lines.write_lines(table(spark, folder, "documents"), path, "text")
    return lines.read_lines(spark, path).groupBy("value").agg(F.count("*").alias("n"))


def _captions(spark, folder):
    c = table(spark, folder, "conversations")
    return c.select(
        F.concat(F.lit("v"), F.col("conv_id")).alias("video_id"),
        "text",
        (F.col("turn") * 37.5).alias("timestamp"),
        F.lit(37.5).alias("duration"),
        "turn",
    )


_FLAT = """select 'v' || conv_id as video_id, md5(replace(replace(text, chr(10), ' '), '"', ' ')) as digest,
    (turn * 37.5)::double as timestamp, 37.5::double as duration from conversations"""


def _script_digest(df):
    return df.select("video_id", _md5("text").alias("digest"), "timestamp", "duration")


@query(_FLAT)
def segments_flatten(spark, folder):
    """Conversations as transcripts with a list of captions, flattened again."""
    nested = transcripts.nest_transcripts(_captions(spark, folder), "turn")
    return _script_digest(transcripts.flatten_transcripts(nested))


@query(
    f"{_FLAT} where conv_id >= (select count(distinct conv_id) // 2 from conversations)"
)
def segments_resumed(spark, folder):
    """Transcripts flattened from the middle of the videos on, as after a break."""
    nested = transcripts.nest_transcripts(_captions(spark, folder), "turn")
    nested = nested.withColumn("place", F.substring("video_id", 2, 20).cast("long"))
    half = nested.select("video_id").distinct().count() // 2
    return _script_digest(transcripts.flatten_transcripts(nested, half, "place"))


@query(
    """select position - 1 as position, value from (
        select value, row_number() over (order by part, doc_id) as position from (
            select o_orderkey as doc_id, o_orderkey % 3 as part, o_orderkey || ' ' || o_orderstatus as value
            from orders))"""
)
def line_positions(spark, folder):
    """Lists in three files, read back in the order of files and lines."""
    path = scratch_path(spark, "lists")
    o = table(spark, folder, "orders")
    value = F.concat(F.col("o_orderkey").cast("string"), F.lit(" "), F.col("o_orderstatus"))
    for part in range(3):
        own = o.where(F.col("o_orderkey") % 3 == part).orderBy("o_orderkey").coalesce(1)
        own.select(value.alias("value")).write.text(f"{path}/part={part}")
    return lines.read_lines(spark, f"{path}/*")


@query(_FLAT)
def csv_roundtrip(spark, folder):
    """Captions written as quoted CSV in two appends, checked and read back."""
    path = scratch_path(spark, "scripts")
    cleaned = _captions(spark, folder).withColumn("text", X.clean_caption(F.col("text")))
    transcripts.write_scripts(cleaned.filter("turn < 2"), path)
    transcripts.write_scripts(cleaned.filter("turn >= 2"), path)
    if transcripts.check_scripts(spark, path) != cleaned.count():
        raise ValueError("rows were lost on the way")
    return _script_digest(transcripts.read_scripts(spark, path))


@query("select order_key, text from (select o_orderkey as order_key, o_custkey::varchar as text from orders)")
def stringify_text(spark, folder):
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("text"))
    return transcripts.stringify_text(o)


@query(
    f"""with c as (select row_number() over (order by 'v' || conv_id, turn * 37.5) - 1 as ordinal,
                replace(replace(text, chr(10), ' '), '"', ' ') as text from conversations),
        {hashed('c', 'c', 'ordinal')}
        select id as ordinal, {encoded("id")} as script_id, dim, round(weight, 5) as weight from cw"""
)
def build_tables(spark, folder):
    """Transcripts to the two keyed tables: captions, CSV, ordinals, ids, vectors."""
    path = scratch_path(spark, "scripts")
    nested = transcripts.nest_transcripts(_captions(spark, folder), "turn")
    transcripts.write_scripts(transcripts.flatten_transcripts(nested), path)
    info = transcripts.to_segments(transcripts.read_scripts(spark, path), ["video_id", "timestamp"])
    v = embed(info, ENCODER)
    cells = v.select("ordinal", "script_id", F.posexplode("vector").alias("dim", "weight")).filter("weight <> 0")
    return cells.select(
        "ordinal", "script_id", F.col("dim").cast("bigint").alias("dim"), F.round("weight", 5).alias("weight")
    )


@query(
    f"""with n as (select ceil(count(*) / 6.0)::bigint as size from documents), {hashed("d", "documents", "doc_id")}
        select doc_id // size as batch_no, count(*) as n, min({encoded("doc_id")}) as first_id, max(doc_id) as last_ordinal,
               round(sum(list_sum(e)), 3) + 0.0 as total
        from documents join dv on id = doc_id, n where text <> '' group by 1"""
)
def build_tables_window(spark, folder):
    """A build of six batches that is stopped before the fourth, and a second start that encodes the rest only."""
    path = scratch_path(spark, "vectors")
    rows = segments(spark, folder)
    size = -(-rows.count() // 6)
    encode_batches(rows, ENCODER, path, size, until=3, at_once=2)
    late = encode_batches(rows, ENCODER, path, size)
    if late[0][0] != 3:
        raise ValueError(f"batches {late} were encoded by the second start")
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return read_vectors(spark, path).groupBy(F.col("batch_no").cast("bigint").alias("batch_no")).agg(
        F.count("*").alias("n"),
        F.min("script_id").alias("first_id"),
        F.max("ordinal").alias("last_ordinal"),
        (F.round(F.sum(total), 3) + 0.0).alias("total"),
    )


@query(
    f"""with {hashed("d", "documents", "doc_id")}, half as (select count(*) // 2 as h from documents),
        one as (select count(distinct text) as first_run from documents, half where doc_id < h and text <> ''),
        every as (select count(distinct text) as n from documents where text <> '')
        select d.doc_id, round(list_sum(e), 4) + 0.0 as total, first_run, n - first_run as second_run, 0::bigint as third_run
        from documents d join dv on dv.id = d.doc_id, one, every where d.text <> ''"""
)
def encode_missing(spark, folder):
    """Half of the documents, all of them, all of them again: every different text is encoded once."""
    path = scratch_path(spark, "store")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    half = docs.count() // 2
    runs = [E.encode_missing(rows, path, ENCODER) for rows in (docs.filter(F.col("doc_id") < half), docs, docs)]
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    found = E.with_vectors(docs, path).select("doc_id", (F.round(total, 4) + 0.0).alias("total"))
    names = ("first_run", "second_run", "third_run")
    return found.select("*", *[F.lit(n).cast("bigint").alias(name) for n, name in zip(runs, names, strict=True)])


def _saved_pages(spark, folder):
    """Saved API pages of 50 items, one JSON file each, next to files cut off in the middle."""
    root = scratch_path(spark, "api")
    rows = table(spark, folder, "conversations").select("conv_id", "turn")
    numbered = global_ordinals(rows, ["conv_id", "turn"]).withColumn("page", F.floor(F.col("ordinal") / 50))
    video = F.concat(F.lit("v"), F.col("conv_id"), F.lit("_"), F.col("turn"))
    item = F.struct(F.struct(F.struct(video.alias("videoId")).alias("resourceId")).alias("snippet"))
    page = numbered.groupBy("page").agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("value"))
    page = materialise(page, "pages")
    # The files are many and small: a number of tasks of its own keeps them from being merged into a few by their
    # bytes, and the second commit algorithm moves the files of a task in that task, not all of them in the driver.
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(page.count() / PAGES_PER_TASK))
    for kind, value in (("whole", F.col("value")), ("cut", F.expr("left(value, length(value) - 3)"))):
        files = page.select("page", value.alias("value")).repartition(tasks, "page")
        writer = files.write.partitionBy("page").option("mapreduce.fileoutputcommitter.algorithm.version", 2)
        writer.text(f"{root}/{kind}", compression="none")
    return root


@query("select 'v' || conv_id || '_' || turn as video_id from conversations")
def json_pages(spark, folder):
    """Ids of the whole pages; the others give none."""
    return pages.read_api_pages(spark, _saved_pages(spark, folder), "*.txt")


@query(
    """select 'cut' as kind, unnest(range(0, (count(*) + 49) // 50))::bigint as page
        from (select conv_id, turn from conversations)"""
)
def json_pages_broken(spark, folder):
    """The report of pages that could not be read."""
    broken = pages.broken_api_pages(spark, _saved_pages(spark, folder), "*.txt")
    told = F.regexp_extract("file", "/([a-z]+)/page=[0-9]+/", 1), F.regexp_extract("file", "/page=([0-9]+)/", 1)
    return broken.select(told[0].alias("kind"), told[1].cast("long").alias("page"))


@query(
    """with h as (select page_id, regexp_extract(url, '//([^/]*)/', 1) as host from pages),
        k as (select distinct host, case when md5(host) < '8' then '-' else substr(md5(host), 1, 8) end as channel_id
              from h)
        select page_id, host, case when channel_id = '-' then null else channel_id end as channel_id
        from h left join k using (host)"""
)
def resolve_ids(spark, folder):
    """Hosts looked up in a table of channel ids, some of which are not resolved."""
    p = table(spark, folder, "pages")
    hosts = p.select("page_id", F.regexp_extract("url", "//([^/]*)/", 1).alias("host"))
    digest = _md5("host")
    found = F.when(digest < "8", F.lit("-")).otherwise(F.substring(digest, 1, 8))
    known = hosts.select("host").distinct().withColumn("channel_id", found)
    good, rejected = resolve(hosts, known, "host", "channel_id")
    return good.select("page_id", "host", "channel_id").unionByName(
        rejected.select("page_id", "host"), allowMissingColumns=True
    )
