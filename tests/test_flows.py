"""Sources, index, search and streaming from end to end."""

import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from verbatlas import session
from verbatlas.functions import blocks
from verbatlas.functions.ids import encode_id
from verbatlas.operators import cluster, maintain, publish
from verbatlas.operators.encode import HashedEncoder, embed
from verbatlas.operators.nearest import assign
from verbatlas.operators.sets import resolve
from verbatlas.plans import index as index_module
from verbatlas.plans import search
from verbatlas.plans.index import VectorIndex, append_to_index, build_index, encode_batches, load_index, read_vectors
from verbatlas.sources import lines, pages, tables, transcripts
from verbatlas.streaming.incremental import grow_available, publish_available, read_assigned, read_published, run_available

ENCODER = HashedEncoder(32)
WORDS = "sun moon star sea wind rain snow leaf root tree bird fish wolf bear fox".split()


@pytest.fixture(scope="module")
def segments(spark):
    rng = np.random.default_rng(3)
    rows = [
        (i, f"v{i % 9}", float(i) * 12.5, " ".join(rng.choice(WORDS, size=rng.integers(2, 9)))) for i in range(240)
    ]
    df = spark.createDataFrame(rows, "ordinal long, video_id string, timestamp double, text string")
    return df.withColumn("script_id", encode_id(F.col("ordinal"))).repartition(4)


@pytest.fixture(scope="module")
def queries(spark):
    rows = [(1, "sun and moon"), (2, "wolf_bear_fox"), (3, "tree root leaf")]
    return search.encode_queries(spark.createDataFrame(rows, "query_id long, text string"), ENCODER)


@pytest.fixture(scope="module")
def index(segments):
    return build_index(segments, ENCODER, 6, 2, chunk_size=100)


# --- session ------------------------------------------------------------------------


class _Fake:
    """Stands in for a cluster session without a checkpoint folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://somewhere:7077"

        @staticmethod
        def getConf():
            return _Fake.conf

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(_Fake)


def test_the_named_folder_is_used(spark):
    class Named(_Fake):
        class conf:
            @staticmethod
            def get(key, default=None):
                return "hdfs://shared/scratch/" if key == session.CHECKPOINT_KEY else default

    assert session.scratch_root(Named) == "hdfs://shared/scratch"
    assert session.scratch_path(Named, "t").startswith("hdfs://shared/scratch/t-")
    kept = session.materialise(spark.range(5), "five")
    assert kept.count() == 5 and session.scratch_root(spark) in kept.inputFiles()[0]


def test_broadcast_hint_depends_on_the_count(spark, monkeypatch):
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(session.broadcast_if_small(spark.range(10)))
    monkeypatch.setattr(session, "BROADCAST_LIMIT_BYTES", 100)
    assert not hinted(session.broadcast_if_small(spark.range(10)))


# --- sources ------------------------------------------------------------------------


def test_lines_keep_order_and_repeats(spark, tmp_path):
    (tmp_path / "list.txt").write_text("b\n\na\nb\n\n")
    got = lines.read_lines(spark, str(tmp_path / "list.txt")).orderBy("position").collect()
    assert [r.value for r in got] == ["b", "a", "b"]


def test_api_pages_skip_a_broken_file(spark, tmp_path):
    item = lambda v: {"snippet": {"resourceId": {"videoId": v}}}
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "one.json").write_text(json.dumps({"items": [item("a"), item("b")], "nextPageToken": "t"}, indent=1))
    (tmp_path / "two.json").write_text('{"items": [')
    assert sorted(r[0] for r in pages.read_api_pages(spark, str(tmp_path)).collect()) == ["a", "b"]
    broken = [r.file for r in pages.broken_api_pages(spark, str(tmp_path)).collect()]
    assert len(broken) == 1 and broken[0].endswith("two.json")


def test_harvest_modes(spark):
    html = '<a href="https://www.youtube.com/user/x">x</a><a href="https://h/youtube/c/n">n</a><a href="https://h/youtube/c/n%20m">m</a>'
    links = pages.harvest_links(spark.createDataFrame([(html,)], "html string"))
    assert links.count() == 3 and pages.channel_urls(links, "manual").count() == 3
    assert [r.link for r in pages.channel_urls(links, "feedspot").collect()] == ["https://www.youtube.com/user/x"]
    assert [r.link for r in pages.channel_urls(links, "socialblade").collect()] == ["https://h/youtube/user/n"]
    with pytest.raises(ValueError):
        pages.channel_urls(links, "other")


def test_transcripts_and_csv(spark, tmp_path):
    rows = [("v1", [('say "hi"\nnow', 0.5, 2.0), ("bye", 2.5, 1.0)], 0), ("v2", [], 1), ("v3", [("x", 1.0, 1.0)], 2)]
    nested = spark.createDataFrame(
        rows, "video_id string, segments array<struct<text:string,start:double,duration:double>>, n int"
    )
    flat = transcripts.flatten_transcripts(nested)
    assert flat.count() == 3 and flat.filter("text = 'say  hi  now'").count() == 1
    assert transcripts.flatten_transcripts(nested, 1, "n").count() == 1
    transcripts.write_scripts(flat, str(tmp_path / "csv"))
    assert transcripts.check_scripts(spark, str(tmp_path / "csv")) == 3
    info = transcripts.to_segments(transcripts.read_scripts(spark, str(tmp_path / "csv")), ["video_id", "timestamp"])
    assert [r.text for r in info.orderBy("ordinal").collect()] == ["say  hi  now", "bye", "x"]


def test_malformed_csv_is_refused(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('"video_id","text","timestamp","duration"\n"v","t","not a number","1"\n')
    with pytest.raises(ValueError):
        transcripts.check_scripts(spark, str(tmp_path / "bad.csv"))


def test_repaired_lines_parse(spark, tmp_path):
    raw = spark.createDataFrame([('"a","x "y" z","1.5","2"',)], "value string")
    lines.write_lines(transcripts.repair_lines(raw), str(tmp_path / "fixed"))
    row = spark.read.csv(str(tmp_path / "fixed")).first()
    assert list(row) == ["a", "x  y  z", "1.5", "2"]


def test_lookup_and_multi_get(spark, segments):
    assert tables.lookup(segments, 17).first().ordinal == 17
    with pytest.raises(KeyError):
        tables.lookup(segments, 9999)
    wanted = segments.filter("ordinal < 3").select("script_id").unionByName(
        spark.createDataFrame([("zzzzzzz",)], "script_id string")
    )
    assert tables.multi_get(wanted, segments).count() == 4
    assert tables.multi_get(wanted, segments, missing=False).count() == 3


def test_unresolved_names_are_rejected(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    known = spark.createDataFrame([("a", "1"), ("b", "-")], "name string, id string")
    good, bad = resolve(names, known, "name", "id")
    assert [r.name for r in good.collect()] == ["a"] and sorted(r.name for r in bad.collect()) == ["b", "c"]


# --- index and search -----------------------------------------------------------------


def test_every_segment_is_in_one_cluster(index, segments):
    p = index.postings.toPandas()
    assert p.script_id.is_unique and len(p) == segments.count()
    for _, part in p.groupby("cluster_id"):
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, len(part) + 1)) and part.distance.is_monotonic_increasing
    lv1 = index.lv1.toPandas()
    assert set(p.cluster_id) == set(lv1.cluster_id) and set(lv1.lv2_id) == {r.lv2_id for r in index.level2_ids.collect()}


def test_saved_index_answers_alike(spark, index, queries, tmp_path):
    index.save(str(tmp_path / "ix"), block_rows=50)
    loaded = load_index(spark, str(tmp_path / "ix"), block_rows=50)
    keys = ["query_id", "rank"]
    a = search.search(queries, index, 7).toPandas().sort_values(keys).reset_index(drop=True)
    b = search.search(queries, loaded, 7).toPandas().sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)
    assert list(a.columns) == ["query_id", "rank", "distance", "script_id", "video_id", "at", "text"]


def test_saved_index_is_pruned_by_cluster(spark, index, queries, tmp_path):
    index.save(str(tmp_path / "ix"))
    loaded = load_index(spark, str(tmp_path / "ix"))
    plan = search.ranked_ids(queries, loaded, 5)._jdf.queryExecution().executedPlan().toString()
    assert "lv2_id" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "cluster_id" in plan.split("PushedFilters:")[1]


def test_routed_hits_are_candidates_of_the_routed_cluster(index, queries):
    routed = {r.query_id: r.cluster_id for r in search.route(queries, index).collect()}
    home = {r.script_id: r.cluster_id for r in index.postings.collect()}
    hits = search.ranked_ids(queries, index, 20).collect()
    assert hits and all(home[h.script_id] == routed[h.query_id] for h in hits)


def test_one_big_cluster_is_the_exhaustive_search(index, queries):
    whole = VectorIndex(
        index.segments,
        index.postings.withColumn("cluster_id", F.lit("c0")).withColumn("lv2_id", F.lit("cc0")),
        index.lv1.limit(1).withColumn("cluster_id", F.lit("c0")).withColumn("lv2_id", F.lit("cc0")),
        index.lv2.limit(1).withColumn("lv2_id", F.lit("cc0")),
    )
    keys = ["query_id", "rank"]
    routed = search.ranked_ids(queries, whole, 9).toPandas().sort_values(keys).reset_index(drop=True)
    exact = search.exhaustive(queries, index.postings, 9).toPandas().sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(routed, exact)


def test_routing_bound_leaves_a_query_unanswered(index, queries):
    assert search.route(queries, index, 1, "euclidean", max_distance=1e-9).count() == 0
    assert search.search(queries, index, 5, max_distance=1e-9).count() == 0


def test_published_search_reads_chunks_and_skips_missing(spark, index, queries, segments):
    members = index.postings.select("cluster_id", "script_id", "rank")
    chunks = publish.member_chunks(members, 8)
    docs = publish.documents(segments, index.postings).filter("video_id <> 'v4'")
    hits = search.search_published(queries, index.lv1, chunks, docs, 6, max_distance=5.0).toPandas()
    assert len(hits) and "v4" not in set(hits.video_id) and hits.groupby("query_id").size().max() <= 6
    few = search.search_published(queries, index.lv1, chunks, docs, 50, 5.0, first_chunk=1, last_chunk=1).toPandas()
    assert few.groupby("query_id").size().max() <= 8
    routed = {r.query_id: r.cluster_id for r in search.route(queries, index, 1, "euclidean").collect()}
    order = index.postings.toPandas().set_index("script_id")
    for q, part in hits.groupby("query_id"):
        mine = order[(order.cluster_id == routed[q])].sort_values("rank")
        stored = [s for s in mine.index if s in set(docs.toPandas().script_id)][:6]
        assert set(part.script_id) == set(stored)


def test_distance_table(queries):
    one = queries.filter("query_id = 1")
    table = search.distance_table(one, queries).collect()
    assert table[0].query_id == 1 and table[0].distance == 0.0
    with pytest.raises(ValueError):
        search.distance_table(queries, queries)


# --- streaming ----------------------------------------------------------------------


def test_deliveries_equal_one_run(spark, index, segments, tmp_path):
    v = embed(segments, ENCODER).select("script_id", "vector")
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in v.randomSplit([0.5, 0.5], seed=2):
        part.write.mode("append").parquet(source)
        run_available(spark, source, v.schema, index.lv1, out, state, max_files=1)
    run_available(spark, source, v.schema, index.lv1, out, state)  # nothing new
    got = read_assigned(spark, out).toPandas().sort_values("script_id").reset_index(drop=True)
    want = assign(v, index.lv1).toPandas().sort_values("script_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got[want.columns], want)


def test_streamed_texts_are_encoded(spark, index, segments, tmp_path):
    texts = segments.select("script_id", "text")
    texts.write.parquet(str(tmp_path / "in"))
    run_available(
        spark, str(tmp_path / "in"), texts.schema, index.lv1, str(tmp_path / "out"), str(tmp_path / "state"), encoder=ENCODER
    )
    assert read_assigned(spark, str(tmp_path / "out")).count() == 240


def test_medoid_is_the_closest_member(index):
    best = {r.cluster_id: r.distance for r in cluster.medoids(index.postings).collect()}
    first = {r.cluster_id: r.distance for r in index.postings.filter("rank = 1").collect()}
    assert best == first


def test_exhaustive_agrees_with_numpy(queries, segments):
    v = embed(segments, ENCODER)
    rows = v.select("script_id", "vector").toPandas()
    data = np.array(rows.vector.tolist())
    for q in queries.collect():
        d = blocks.row_distance(data, np.broadcast_to(np.array(q.vector), data.shape), "cityblock")
        hit = search.exhaustive(queries.filter(F.col("query_id") == q.query_id), v, 1, "cityblock").first()
        ties = rows.script_id[np.round(d, 9) == np.round(d.min(), 9)]
        assert hit.script_id == ties.min()


def test_lines_keep_the_order_of_their_files(spark, tmp_path):
    sizes = {"a.txt": 2, "b.txt": 500, "c.txt": 30}
    for name, n in sizes.items():
        (tmp_path / name).write_text("".join(f"{name}-{k}\n" for k in range(n)))
    got = [r.value for r in lines.read_lines(spark, str(tmp_path)).orderBy("position").collect()]
    assert got == [f"{name}-{k}" for name, n in sizes.items() for k in range(n)]


def test_scope_leaves_no_intermediate_tables(spark, segments, tmp_path):
    root = session.scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    with session.scratch_scope(spark):
        build_index(segments, ENCODER, 4, 2, chunk_size=120).save(str(tmp_path / "index"), block_rows=100)
    assert set(os.listdir(root)) == before
    assert load_index(spark, str(tmp_path / "index"), block_rows=100).postings.count() == 240


def test_added_segments_are_found(spark, segments, tmp_path):
    """Two deliveries give the postings of one assignment, and a search finds the late rows."""
    path = str(tmp_path / "grown")
    whole = build_index(segments, ENCODER, 4, 2, chunk_size=120)
    early = VectorIndex(
        segments.filter("ordinal < 100"),
        cluster.members_ranked(whole.postings.drop("rank").join(segments.filter("ordinal < 100").select("script_id"), "script_id", "left_semi")),
        whole.lv1,
        whole.lv2,
    )
    early.save(path, block_rows=64)
    late = segments.filter("ordinal >= 100").drop("script_id").withColumnRenamed("ordinal", "arrival")
    append_to_index(spark, path, late, ENCODER, ["arrival"], block_rows=64)
    grown = load_index(spark, path, block_rows=64)
    pick = ["cluster_id", "script_id", "rank"]
    assert sorted(map(tuple, grown.postings.select(pick).collect())) == sorted(map(tuple, whole.postings.select(pick).collect()))
    assert grown.segments.orderBy("ordinal").select("text").collect() == segments.orderBy("ordinal").select("text").collect()


def test_a_batch_of_captions_is_added_once(spark, segments, tmp_path):
    """A micro-batch that is run again, because its end was not recorded, leaves the index as it is."""
    path = str(tmp_path / "grown")
    build_index(segments.filter("ordinal < 100"), ENCODER, 4, 2, chunk_size=50).save(path, block_rows=64)
    late = segments.filter("ordinal >= 100").drop("script_id").withColumnRenamed("ordinal", "arrival")
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    late.filter("arrival < 170").write.mode("append").parquet(source)
    grow_available(spark, source, late.schema, path, state, ENCODER, ["arrival"], block_rows=64)
    grown = load_index(spark, path, block_rows=64)
    assert grown.segments.count() == 170 and grown.postings.count() == 170
    append_to_index(spark, path, late.filter("arrival < 170"), ENCODER, ["arrival"], block_rows=64, batch="stream-0")
    late.filter("arrival >= 170").write.mode("append").parquet(source)
    grow_available(spark, source, late.schema, path, state, ENCODER, ["arrival"], block_rows=64)
    grow_available(spark, source, late.schema, path, state, ENCODER, ["arrival"], block_rows=64)  # nothing new
    grown = load_index(spark, path, block_rows=64)
    assert grown.segments.orderBy("ordinal").select("text").collect() == segments.orderBy("ordinal").select("text").collect()
    assert grown.postings.count() == 240 and grown.postings.select("script_id").distinct().count() == 240
    text = segments.filter("ordinal = 200").select(F.lit(1).cast("long").alias("query_id"), "text")
    hits = search.search(search.encode_queries(text, ENCODER), grown, 1).collect()
    assert [h.text for h in hits] == [text.first().text]


def test_a_growth_that_dies_between_its_tables_is_made_again(spark, segments, tmp_path, monkeypatch):
    path = str(tmp_path / "grown")
    build_index(segments.filter("ordinal < 100"), ENCODER, 4, 2, chunk_size=50).save(path, block_rows=64)
    late = segments.filter("ordinal >= 100").drop("script_id").withColumnRenamed("ordinal", "arrival")

    def died(*args, **options):
        raise RuntimeError("died")

    with monkeypatch.context() as m:
        m.setattr(maintain, "write_version", died)  # the postings are written, the segments are not
        with pytest.raises(RuntimeError, match="died"):
            append_to_index(spark, path, late, ENCODER, ["arrival"], block_rows=64, batch="b")
    append_to_index(spark, path, late, ENCODER, ["arrival"], block_rows=64, batch="b")
    grown = load_index(spark, path, block_rows=64)
    assert grown.segments.count() == 240 and grown.postings.select("script_id").distinct().count() == grown.postings.count() == 240


def test_a_delivery_sent_twice_is_published_once(spark, segments, tmp_path):
    docs = segments.withColumn("arrived_at", F.timestamp_seconds(F.col("ordinal") + 1_000_000)).select("script_id", "text", "arrived_at")
    source, store, state = (str(tmp_path / n) for n in ("in", "store", "state"))
    part = docs.filter("script_id < 'm'")
    part.union(part).write.mode("append").parquet(source)
    publish_available(spark, source, docs.schema, store, state, event_time="arrived_at")
    part.write.mode("append").parquet(source)
    publish_available(spark, source, docs.schema, store, state, event_time="arrived_at")
    docs.write.mode("append").parquet(source)
    publish_available(spark, source, docs.schema, store, state, event_time="arrived_at")
    got = read_published(spark, store, docs.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))
    # A stream that starts again without its checkpoint meets its own batches and the stored keys.
    publish_available(spark, source, docs.schema, store, str(tmp_path / "other"), name="other")
    assert read_published(spark, store, docs.schema).count() == docs.count()


def test_a_build_goes_on_where_it_stopped(spark, segments, tmp_path, monkeypatch):
    work = str(tmp_path / "vectors")
    assert encode_batches(segments, ENCODER, work, 40, until=3, at_once=2) == [(0, 2), (2, 3)]
    assert read_vectors(spark, work).agg(F.max("ordinal")).first()[0] == 119
    real, calls = index_module.write_version, []

    def dying(*args, **options):
        calls.append(options["batch"])
        if len(calls) == 2:
            raise RuntimeError("died")
        return real(*args, **options)

    with monkeypatch.context() as m:
        m.setattr(index_module, "write_version", dying)
        with pytest.raises(RuntimeError, match="died"):
            encode_batches(segments, ENCODER, work, 40, at_once=1)
    assert calls == ["40:3:4", "40:4:5"]
    built = build_index(segments, ENCODER, 4, 2, chunk_size=120, work=work, batch_size=40)
    whole = build_index(segments, ENCODER, 4, 2, chunk_size=120)
    pick = ["cluster_id", "script_id", "rank"]
    assert sorted(map(tuple, built.postings.select(pick).collect())) == sorted(map(tuple, whole.postings.select(pick).collect()))
    assert encode_batches(segments, ENCODER, work, 40) == []
    with pytest.raises(ValueError):
        encode_batches(segments, ENCODER, work, 50)
    assert encode_batches(segments.limit(0), ENCODER, str(tmp_path / "none"), 40) == []


def test_windows_of_segments_keep_their_ordinals(spark, segments):
    scripts = segments.select("video_id", "timestamp", "text")
    whole = transcripts.to_segments(scripts, ["video_id", "timestamp", "text"])
    some = transcripts.to_segments(scripts, ["video_id", "timestamp", "text"], batch_size=50, resume=1, until=3)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.filter("ordinal between 50 and 149").collect()))


def test_nested_index_finds_its_texts(spark, segments, tmp_path):
    path = str(tmp_path / "nested")
    build_index(segments, ENCODER, 9, 3, chunk_size=80, nested=True).save(path, block_rows=64)
    index = load_index(spark, path, block_rows=64)
    assert index.postings.count() == 240 and index.lv2.count() <= 3 and index.lv1.count() <= 9
    parents = {r.cluster_id: r.lv2_id for r in index.lv1.collect()}
    assert all(parents[r.cluster_id] == r.lv2_id for r in index.postings.select("cluster_id", "lv2_id").distinct().collect())
    own = embed(segments, ENCODER).select(F.col("ordinal").alias("query_id"), "vector").limit(5)
    hits = search.search(own, index, 1, route_metric="euclidean").collect()
    assert len(hits) == 5 and all(h.distance < 1e-3 for h in hits)


def test_a_delivery_is_not_copied_before_it_is_published(spark, tmp_path, monkeypatch):
    from verbatlas.streaming import incremental

    written, plain = [], incremental.materialise
    monkeypatch.setattr(incremental, "materialise", lambda df, name: (written.append(name), plain(df, name))[1])
    rows = spark.createDataFrame([(f"k{i % 40}", "text") for i in range(60)] + [(None, "x")], "script_id string, text string")
    for part in range(2):
        rows.filter(f"{part} = 1 or script_id < 'k3'").write.mode("append").parquet(f"{tmp_path}/in")
        incremental.publish_available(spark, f"{tmp_path}/in", rows.schema, f"{tmp_path}/store", f"{tmp_path}/state")
    got = [r.script_id for r in incremental.read_published(spark, f"{tmp_path}/store", rows.schema).collect() if r.script_id]
    assert sorted(got) == sorted(f"k{i}" for i in range(40)) and written == []
