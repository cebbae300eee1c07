import hashlib
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from verbatlas.functions import blocks
from verbatlas.operators import nearest as nearest_module
from verbatlas.operators import cluster, encode, fits, maintain, pivots, pruned, publish, quality, reduction, sampling, sets, versions
from verbatlas.operators.encode import HashedEncoder, ModelEncoder, count_unusable, embed
from verbatlas.operators.nearest import assign, nearest
from verbatlas.operators.ordering import (
    assign_ordinals,
    batch_window,
    first_per_group,
    global_ordinals,
    ranks_within,
    value_grid,
    zip_positions,
)
from verbatlas.operators.pruned import assign_pruned
from verbatlas.operators.waves import first_n_waves


def frame(spark, matrix, id_name="script_id", **extra):
    data = {id_name: np.arange(len(matrix)), "vector": matrix.tolist(), **extra}
    return spark.createDataFrame(pd.DataFrame(data)).repartition(5)


@pytest.fixture(scope="module")
def points():
    return np.random.default_rng(5).normal(size=(300, 6))


# --- ordering ---------------------------------------------------------------------


def test_ordinals_are_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(7)
    got = global_ordinals(df, ["k"]).toPandas().sort_values("k")
    assert got.ordinal.tolist() == list(range(1000))


def test_ranks_with_a_hot_group(spark):
    # One group holds more than a third of all rows and spreads over partitions.
    df = spark.range(5000).select(
        F.when(F.col("id") < 2500, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        (F.col("id") * 7919 % 5003).alias("v"),
        "id",
    )
    got = ranks_within(df.repartition(9), ["g"], ["v", "id"]).toPandas()
    want = got.sort_values(["g", "v", "id"]).groupby("g").cumcount() + 1
    assert len(got) == 5000 and (got["rank"] == want.reindex(got.index)).all()


def test_empty_table_gets_no_ordinals(spark):
    assert global_ordinals(spark.range(0), ["id"]).count() == 0


def test_first_per_group_in_slices(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.hash("id").alias("v"), "id")
    small = first_per_group(df, ["g"], ["v", "id"], 5).toPandas()
    spark.conf.set("spark.sql.shuffle.partitions", "128")
    try:
        sliced = first_per_group(df, ["g"], ["v", "id"], 5).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    keys = ["g", "rank"]
    pd.testing.assert_frame_equal(
        small.sort_values(keys).reset_index(drop=True), sliced.sort_values(keys).reset_index(drop=True)
    )


def test_batch_window(spark):
    df = spark.range(95).withColumnRenamed("id", "ordinal")
    got = batch_window(df, 10, 3, 7).groupBy("batch_no").count().toPandas().sort_values("batch_no")
    assert got.batch_no.tolist() == [3, 4, 5, 6] and (got["count"] == 10).all()
    assert batch_window(df, 10, resume=9).count() == 5


def test_zip_reports_differences_and_the_longer_end(spark):
    a = spark.createDataFrame([(x,) for x in "abcd"], "v string")
    b = spark.createDataFrame([(x,) for x in "abx"], "v string")
    got = {tuple(r) for r in zip_positions(a, b, "v", ["v"]).collect()}
    assert got == {(2, "c", "x"), (3, "d", None)}


def test_grid(spark):
    df = spark.createDataFrame([(1, "x", True), (2, "y", True)], "a int, b string, c boolean")
    assert value_grid(df, ["a", "b", "c"]).count() == 4
    with pytest.raises(ValueError):
        value_grid(df, ["a", "b", "c"], limit=3)


# --- nearest ----------------------------------------------------------------------


def brute(queries, corpus, k, metric):
    d = np.array([[blocks.row_distance(q[None], c[None], metric)[0] for c in corpus] for q in queries])
    return np.argsort(np.round(d, 9), axis=1, kind="stable")[:, :k]


@pytest.mark.parametrize("metric", ["euclidean", "cityblock", "cosine", "chebyshev", "sqeuclidean"])
@pytest.mark.parametrize("limit", [None, 8 * 6 * 7])
def test_nearest_is_exact(spark, points, metric, limit):
    q = frame(spark, points[:20], "query_id")
    got = nearest(q, frame(spark, points), 4, metric=metric, limit_bytes=limit).toPandas()
    got = got.sort_values(["query_id", "rank"])
    assert (got.script_id.to_numpy().reshape(20, 4) == brute(points[:20], points, 4, metric)).all()


def test_nearest_with_copies_and_sampled_bound(spark, points):
    copied = np.vstack([points[:50]] * 4)  # every vector four times: ties by id
    q = frame(spark, points[:10], "query_id")
    plain = nearest(q, frame(spark, copied), 6).toPandas().sort_values(["query_id", "rank"])
    bounded = nearest(q, frame(spark, copied), 6, bound_sample=0.4).toPandas().sort_values(["query_id", "rank"])
    assert (plain.script_id.to_numpy().reshape(10, 6) == brute(points[:10], copied, 6, "euclidean")).all()
    assert plain.script_id.tolist() == bounded.script_id.tolist()


@pytest.mark.parametrize("limit", [None, 8 * 9 * 4])
def test_nearest_keyed_with_hot_key(spark, points, monkeypatch, limit):
    monkeypatch.setattr(nearest_module, "SLICE_ROWS", 40)
    keys = np.where(np.arange(300) % 3 == 0, "hot", (np.arange(300) % 7).astype(str))
    q = frame(spark, points[:30], "query_id", key=keys[:30])
    got = nearest(q, frame(spark, points, key=keys), 3, key="key", limit_bytes=limit).toPandas()
    for i in range(30):
        mine = np.flatnonzero(keys == keys[i])
        want = mine[brute(points[i : i + 1], points[mine], 3, "euclidean")[0]]
        assert got[got.query_id == i].sort_values("rank").script_id.tolist() == want.tolist()


def test_first_n_takes_stored_order(spark, points):
    rank = np.arange(300)[::-1]
    q = frame(spark, points[:5], "query_id")
    got = nearest(
        q, frame(spark, points, place=rank), 4, mode="first_n", item_rank="place", max_distance=4.0
    ).toPandas()
    for i in range(5):
        d = blocks.row_distance(points, np.broadcast_to(points[i], points.shape), "euclidean")
        first = [j for j in np.argsort(rank) if d[j] < 4.0][:4]
        want = sorted(first, key=lambda j: (d[j], j))
        assert got[got.query_id == i].sort_values("rank").script_id.tolist() == want


def test_waves_stop_at_the_last_hit(spark):
    """Clusters of very different size, queries with many, few and no hits."""
    rng = np.random.default_rng(8)
    sizes = {"a": 400, "b": 30, "c": 3}
    name = np.repeat(list(sizes), list(sizes.values()))
    rank = np.concatenate([np.arange(1, n + 1) for n in sizes.values()])
    members = rng.normal(size=(len(name), 4))
    members[(name == "a") & (rank > 20)] += 50.0  # only the first of this cluster are near
    asked = rng.normal(size=(12, 4))
    asked[3] += 1000.0
    where = np.array(["a", "b", "c", "a"] * 3)
    q = frame(spark, asked, "query_id", cluster_id=where)
    store = frame(spark, members, cluster_id=name, rank=rank)

    def run(first, report):
        fetch = lambda _, low, high: store.filter((F.col("rank") > low) & (F.col("rank") <= high))
        got = first_n_waves(q, fetch, lambda r: store.filter(F.col("rank") == r), 4, 3.0, first=first, report=report)
        return got.toPandas().sort_values(["query_id", "rank"])

    report = []
    got = run(4, report)
    for i in range(12):
        mine = np.flatnonzero(name == where[i])
        d = blocks.row_distance(members[mine], np.broadcast_to(asked[i], (len(mine), 4)), "euclidean")
        hits = [j for j in np.argsort(rank[mine]) if d[j] < 3.0][:4]
        want = [mine[j] for j in sorted(hits, key=lambda j: (round(d[j], 9), mine[j]))]
        assert got[got.query_id == i].script_id.tolist() == want
    assert [(r["low"], r["high"]) for r in report] == [(0, 4), (4, 20), (20, 84), (84, 340), (340, 1364)]
    asked_of = [r["queries"] for r in report]
    assert asked_of[0] == 12 and asked_of[-1] >= 1 and asked_of == sorted(asked_of, reverse=True) and asked_of[2] < 12
    once = []
    pd.testing.assert_frame_equal(got.reset_index(drop=True), run(400, once).reset_index(drop=True))
    assert len(once) == 1


@pytest.mark.parametrize("metric", ["euclidean", "cityblock", "chebyshev"])
def test_pivots_skip_blocks_and_lose_nothing(spark, metric, monkeypatch):
    monkeypatch.setattr(pivots, "QUERIES", 7)  # more slices than one for a block
    rng = np.random.default_rng(4)
    data = clustered(rng, 12, 30)
    data = np.vstack([data, data[:40], data[:1]])  # ties
    asked = np.vstack([data[::20], rng.normal(size=(3, 5)) * 20])
    table = pivots.build_table(frame(spark, data), metric, pivots=6, block_rows=10)
    report = {}
    got = pivots.search_pivots(frame(spark, asked, "query_id"), table, 5, report=report).toPandas().sort_values(["query_id", "rank"])
    assert (got.script_id.to_numpy().reshape(len(asked), 5) == brute(asked, data, 5, metric)).all()
    assert report["all"] == len(asked) * 41 and report["compared"] < 0.3 * report["all"]


def test_pairs_of_queries_and_blocks_come_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(pivots, "PAIRS", 16)
    part = pa.RecordBatch.from_pydict({"query_id": list(range(9)), "vector": [[float(i)] for i in range(9)]})
    wanted = np.random.default_rng(1).random((9, 12)) < 0.7
    got = list(pivots._met(part, wanted, np.arange(100, 112, dtype=np.int32)))
    assert len(got) > 3 and max(b.num_rows for b in got) == 16
    rows = pa.Table.from_batches(got).to_pylist()
    assert [(r["query_id"], r["vector"][0], r["block"] - 100) for r in rows] == [(q, float(q), b) for q, b in zip(*np.nonzero(wanted))]


def test_pivots_of_few_and_undefined_rows(spark, points):
    rows = frame(spark, points[:3])
    bad = spark.createDataFrame([(10, None), (11, [float("nan")] * 6), (12, [None] * 6)], "script_id long, vector array<double>")
    table = pivots.build_table(rows.union(bad))
    got = pivots.search_pivots(frame(spark, points[:2], "query_id"), table, 9).toPandas()
    assert got.groupby("query_id").script_id.apply(sorted).tolist() == [[0, 1, 2]] * 2
    assert pivots.search_pivots(frame(spark, points[:2], "query_id").limit(0), table, 2).count() == 0
    empty = pivots.build_table(rows.limit(0))
    assert pivots.search_pivots(frame(spark, points[:2], "query_id"), empty, 2).count() == 0
    with pytest.raises(ValueError):
        pivots.build_table(rows, "cosine")


def test_max_distance_and_bad_arguments(spark, points):
    q, c = frame(spark, points[:5], "query_id"), frame(spark, points)
    assert (nearest(q, c, 50, max_distance=2.0).toPandas().distance < 2.0).all()
    with pytest.raises(ValueError):
        nearest(q, c, 5, mode="first_n")
    with pytest.raises(ValueError):
        nearest(q, c, 5, metric="unknown")


def test_fewer_rows_than_asked_for(spark, points):
    q = frame(spark, points[:3], "query_id")
    assert nearest(q, frame(spark, points[:2]), 10).count() == 6
    assert nearest(q, frame(spark, points).limit(0), 10).count() == 0
    assert nearest(q.limit(0), frame(spark, points), 10).count() == 0


@pytest.mark.parametrize("limit", [None, 8 * 6 * 3])
def test_assign_in_blocks_with_tie(spark, points, limit):
    centres = np.vstack([points[:7], points[:1]])
    c = spark.createDataFrame([(f"c{i}", row.tolist()) for i, row in enumerate(centres)], "cluster_id string, centroid array<double>")
    got = assign(frame(spark, points), c, limit_bytes=limit).toPandas().sort_values("script_id")
    full = np.array([[blocks.row_distance(p[None], r[None], "euclidean")[0] for r in centres] for p in points])
    assert got.cluster_id.tolist() == [f"c{i}" for i in full.argmin(axis=1)]


def clustered(rng, groups, each, width=5):
    return np.vstack([rng.normal(size=width) * 20 + rng.normal(size=(each, width)) for _ in range(groups)])


def centre_frame(spark, matrix):
    rows = [(f"c{i:04d}", row.tolist()) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "cluster_id string, centroid array<double>")


@pytest.mark.parametrize("metric", ["euclidean", "cityblock", "chebyshev", "minkowski", "cosine", "sqeuclidean"])
@pytest.mark.parametrize("limit", [None, 8 * 5 * 30])
def test_pruned_assignment_equals_the_plain_one(spark, metric, limit):
    rng = np.random.default_rng(3)
    centres = clustered(rng, 20, 10)
    centres = np.vstack([centres, centres[:15], np.repeat(centres[:1], 40, axis=0)])  # ties, and a group above a block
    data = np.vstack([clustered(rng, 5, 40), centres[:60]])
    c, v = centre_frame(spark, centres), frame(spark, data, tag=["x"] * len(data))
    p = 3.0 if metric == "minkowski" else 2.0
    want = assign(v, c, metric=metric, p=p).toPandas().sort_values("script_id")
    got = assign_pruned(v, c, metric=metric, p=p, keep=["tag"], limit_bytes=limit).toPandas().sort_values("script_id")
    assert got.cluster_id.tolist() == want.cluster_id.tolist() and np.allclose(got.distance, want.distance)
    assert set(got.tag) == {"x"} and len(got) == len(data)
    if metric in pruned.METRICS:
        assert got.compared.mean() < 0.6 * len(centres)  # sixteen pivots and few groups
    else:
        assert (got.compared >= len(centres)).all()


def test_pruned_assignment_of_few_rows(spark, points):
    c = centre_frame(spark, points[:1])
    assert assign_pruned(frame(spark, points[:5]), c).toPandas().cluster_id.tolist() == ["c0000"] * 5
    assert assign_pruned(frame(spark, points[:5]), c.limit(0)).count() == 0
    assert assign_pruned(frame(spark, points).limit(0), c).count() == 0
    same = centre_frame(spark, np.repeat(points[:1], 9, axis=0))
    got = assign_pruned(frame(spark, points[:5]), same, limit_bytes=8 * points.shape[1] * 2).toPandas()
    assert got.cluster_id.tolist() == ["c0000"] * 5


@pytest.mark.parametrize("limit", [None, 8 * 6 * 3])
def test_keyed_assignment_in_blocks(spark, points, limit, monkeypatch):
    monkeypatch.setattr(nearest_module, "SLICE_ROWS", 40)
    keys = np.where(np.arange(300) % 3 == 0, "hot", (np.arange(300) % 7).astype(str))
    c = centre_frame(spark, points[:40]).toPandas()
    c["key"] = keys[:40]
    got = assign(frame(spark, points, key=keys), spark.createDataFrame(c), key="key", limit_bytes=limit).toPandas().sort_values("script_id")
    for i, name in zip(got.script_id, got.cluster_id):
        mine = np.flatnonzero(keys[:40] == keys[i])
        assert int(name[1:]) == mine[brute(points[i : i + 1], points[mine], 1, "euclidean")[0][0]]
    assert len(got) == 300


# --- clustering -------------------------------------------------------------------


def test_minibatch_is_a_running_mean(spark, points):
    v = frame(spark, points).withColumn("ordinal", F.col("script_id"))
    init = v.filter("script_id < 4")
    got = cluster.fit_minibatch(v, 4, 100, init=init).toPandas().sort_values("label")
    centres, seen = points[:4].copy(), np.zeros(4)
    for part in (points[:100], points[100:200], points[200:]):
        best = ((part[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        for j in range(4):
            won = part[best == j]
            if len(won):
                centres[j] = (centres[j] * seen[j] + won.sum(0)) / (seen[j] + len(won))
                seen[j] += len(won)
    assert np.allclose(np.array(got.centroid.tolist()), centres) and got.n.tolist() == seen.tolist()


def plain_lloyd(data, centres, steps):
    centres, n = centres.copy(), np.zeros(len(centres), int)
    for _ in range(steps):
        best = ((data[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        n = np.bincount(best, minlength=len(centres))
        for j in np.flatnonzero(n):
            centres[j] = data[best == j].mean(axis=0)
    return centres, n


@pytest.mark.parametrize("limit", [None, 8 * 6 * 2])
def test_nested_fit_is_a_fit_in_every_cell(spark, points, limit):
    """Above and below a block: the centres of all cells go through the assignment by blocks there."""
    v = frame(spark, points)
    level1, level2, placed = fits.fit_nested(v, 3, 4, coarse_steps=2, steps=3, seed=7, limit_bytes=limit)
    level1, level2, placed = (t.toPandas() for t in (level1, level2, placed))
    first = sorted(range(len(points)), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest()[:15])
    coarse, _ = plain_lloyd(points, points[sorted(first[:3])], 2)
    assert np.allclose(np.array(level2.sort_values("cell").centroid.tolist()), coarse)
    cells = ((points[:, None] - coarse[None]) ** 2).sum(-1).argmin(1)
    assert placed.sort_values("script_id").cell.tolist() == cells.tolist()
    for cell in range(3):
        mine = np.flatnonzero(cells == cell)
        start = sorted([i for i in first if cells[i] == cell][:4])
        centres, n = plain_lloyd(points[mine], points[start], 3)
        own = level1[level1.cell == cell].sort_values("label")
        assert np.allclose(np.array(own.centroid.tolist()), centres) and own.n.tolist() == n.tolist()


@pytest.mark.parametrize("limit", [None, 8 * 6 * 2])
def test_running_steps_above_and_below_a_block(spark, points, limit):
    v = frame(spark, points).withColumn("ordinal", F.col("script_id"))
    c = spark.createDataFrame([(i, points[i].tolist(), 0) for i in range(4)], "label int, centroid array<double>, n bigint")
    got = fits.run(v, c, 0, ordinal="ordinal", chunk_size=100, limit_bytes=limit).toPandas().sort_values("label")
    want = cluster.fit_minibatch(v, 4, 100, init=v.filter("script_id < 4")).toPandas().sort_values("label")
    assert np.allclose(np.array(got.centroid.tolist()), np.array(want.centroid.tolist())) and got.n.tolist() == want.n.tolist()


def test_nested_fit_by_chunks_and_with_small_cells(spark, points):
    data = np.vstack([points[:60], points[:1] + 1000.0])  # the last vector may be alone in its cell
    v = frame(spark, data).withColumn("ordinal", F.col("script_id"))
    level1, level2, placed = fits.fit_nested(v, 2, 5, chunk_size=20, seed=1)
    level1 = level1.toPandas()
    assert level1.n.sum() == 61 and level1.groupby("cell").size().max() <= 5 and placed.count() == 61
    assert {f.name for f in level2.schema} == {"cell", "centroid", "n"}


def test_jobs_of_a_nested_fit_do_not_grow_with_its_size(spark, points):
    v = frame(spark, points)

    def jobs(k2, k1):
        spark.sparkContext.setJobGroup(f"fit-{k2}-{k1}", "")
        fits.fit_nested(v, k2, k1, coarse_steps=1, steps=1, seed=7)
        count = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{k2}-{k1}"))
        spark.sparkContext.setJobGroup("rest", "")
        return count

    assert abs(jobs(2, 2) - jobs(12, 9)) <= 3  # adaptive execution may split a job


def test_sums_of_many_sources_and_small_memory(spark, points, monkeypatch):
    """Sums that leave a task early, from more sources than one round merges."""
    monkeypatch.setattr(fits, "HELD_BYTES", 8 * points.shape[1] * 2)
    v = frame(spark, points).repartition(70)
    c = spark.createDataFrame([(i, points[i].tolist(), 0) for i in range(6)], "label int, centroid array<double>, n bigint")
    got = fits.run(v, c, 1, limit_bytes=8 * points.shape[1] * 4).toPandas().sort_values("label")
    centres, n = plain_lloyd(points, points[:6], 1)
    assert np.allclose(np.array(got.centroid.tolist()), centres) and got.n.tolist() == n.tolist()


def test_lloyd_stops_when_nothing_moves(spark, points):
    v = frame(spark, points[:40])
    init = v.filter("script_id < 3")
    some = cluster.fit_lloyd(v, 3, 60, init=init).toPandas()
    more = cluster.fit_lloyd(v, 3, 61, init=init).toPandas()
    assert some.n.sum() == 40 and np.array_equal(np.array(some.centroid.tolist()), np.array(more.centroid.tolist()))


def test_starting_vectors_must_be_k(spark, points):
    v = frame(spark, points)
    with pytest.raises(ValueError):
        cluster.fit_lloyd(v, 5, 1, init=v.filter("script_id < 3"))


def test_reduce_spans_the_main_directions(spark, points):
    skewed = points * np.array([9.0, 5.0, 3.0, 0.1, 0.1, 0.1])
    got = cluster.reduce(frame(spark, skewed), 3, keep=["script_id"]).toPandas().sort_values("script_id")
    centred = skewed - skewed.mean(axis=0)
    directions = np.linalg.svd(centred, full_matrices=False)[2][:3]
    mine = np.array(got.reduced.tolist())
    assert np.allclose(np.abs(mine), np.abs(skewed @ directions.T), atol=1e-6)


def test_show_clusters(spark):
    df = spark.createDataFrame([("c1", 1), ("c2", 2), ("c1", 3)], "cluster_id string, script_id int")
    assert {r[0] for r in cluster.show_clusters(df).collect()} == {"c1", "c2"}
    assert cluster.show_clusters(df, ["c1"]).count() == 2


# --- encoding ---------------------------------------------------------------------


def test_hashed_vectors_are_unit_and_case_blind(spark):
    df = spark.createDataFrame([(1, "Good developer"), (2, "good  DEVELOPER!"), (3, "..."), (4, ""), (5, None)], "i int, text string")
    rows = {r.i: np.array(r.vector) for r in embed(df, HashedEncoder(16)).collect()}
    assert set(rows) == {1, 2, 3} and np.array_equal(rows[1], rows[2])
    assert np.isclose(np.linalg.norm(rows[1]), 1) and not rows[3].any()
    assert tuple(count_unusable(df).first()) == (5, 1, 1)


def test_encoder_works_on_slices_of_a_batch(spark, monkeypatch):
    texts = ["", "é " * 9, "alpha beta", "x" * 70, "beta, gamma"] * 5
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    want = {r.i: r.vector for r in embed(df, HashedEncoder(8)).collect()}
    got = pa.array([*texts, None])
    for size in (1, 30, 10**6):
        monkeypatch.setattr(encode, "SLICE_BYTES", size)
        ranges = list(encode._slices(got))
        assert [a for a, _ in ranges] == [0, *[b for _, b in ranges[:-1]]] and ranges[-1][1] == len(got)
        assert all(sum(len(t.encode()) for t in [*texts, ""][a:b]) <= size or b == a + 1 for a, b in ranges)
    assert all(want[i] == want[i % 5] for i in want) and len(want) == 20


def test_model_encoder_gets_batches(spark):
    def load():
        return lambda texts: np.array([[len(t), t.count("a")] for t in texts], dtype=float)

    df = spark.createDataFrame([("banana",), ("fig",)], "text string")
    got = {r.text: list(r.vector) for r in embed(df, ModelEncoder(load, 2)).collect()}
    assert got == {"banana": [6.0, 3.0], "fig": [3.0, 0.0]}


# --- sampling and sets --------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 17, 400, 1000, 2000])
def test_sample_has_the_exact_size(spark, n):
    df = spark.range(1000).withColumnRenamed("id", "script_id").repartition(6)
    got = [r[0] for r in sampling.sample_exact(df, n, seed=4).collect()]
    assert len(got) == len(set(got)) == min(n, 1000)
    assert sorted(got) == sorted(r[0] for r in sampling.sample_exact(df.repartition(3), n, seed=4).collect())


def test_draws(spark):
    df = spark.range(50).withColumnRenamed("id", "ordinal")
    got = sampling.sample_with_replacement(df, 200, seed=1).toPandas()
    assert len(got) == 200 and got.ordinal.nunique() < 51 and got.draw.is_unique


def test_dedup_keeps_first_order(spark):
    df = spark.createDataFrame(list(enumerate(["b", "a", "b", "", "c", "a", None])), "p int, v string")
    got = sets.dedup_first(df, "v", "p").orderBy("p").collect()
    assert [r.v for r in got] == ["b", "a", "c"]


def test_duplicate_check(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "v string")
    assert tuple(sets.duplicate_check(df, "v").first()) == (3, 2, False)
    assert tuple(sets.duplicate_check(df.limit(0), "v").first()) == (0, 0, True)


def test_reconcile(spark):
    expected = spark.range(100).withColumnRenamed("id", "script_id")
    stored = expected.filter("script_id % 7 <> 0").unionByName(spark.range(500, 501).withColumnRenamed("id", "script_id"))
    got = sets.reconcile(expected, stored).groupBy("side").count().collect()
    assert {r.side: r["count"] for r in got} == {"missing": 15, "unexpected": 1}


# --- maintenance ------------------------------------------------------------------


def test_upsert_last_write_wins(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "script_id string, x int")
    updates = spark.createDataFrame([("b", 5, 1), ("b", 6, 2), ("c", 7, 1)], "script_id string, x int, version int")
    got = {r.script_id: r.x for r in maintain.upsert(base, updates).collect()}
    assert got == {"a": 1, "b": 6, "c": 7}


def test_append_is_idempotent(spark):
    stored = spark.createDataFrame([("a",), ("b",)], "script_id string")
    arriving = spark.createDataFrame([("b",), ("c",), ("c",)], "script_id string")
    assert [r[0] for r in maintain.append_new(stored, arriving).collect()] == ["c"]


@pytest.mark.parametrize("limit", [maintain.BLOCK_ROWS, 64])
def test_append_deals_rows_to_tasks_by_their_number(spark, monkeypatch, limit):
    monkeypatch.setattr(maintain, "TASK_ROWS", 500, raising=False)
    monkeypatch.setattr(maintain, "BROADCAST_LIMIT_BYTES", limit * 64, raising=False)
    arriving = spark.range(20_000).select(F.col("id").alias("script_id"), F.lit("x").alias("text"))
    got = maintain.append_new(spark.range(0, 20_000, 2).toDF("script_id"), arriving.unionByName(arriving))
    sizes = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.min(F.col("script_id") % 2).alias("odd")).collect()
    assert sum(r.n for r in sizes) == 10_000 and max(r.n for r in sizes) <= 250 and all(r.odd for r in sizes)


def test_block_upsert_leaves_other_blocks_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(100).select(F.col("id").alias("ordinal"), F.col("id").alias("script_id"), F.lit(0).alias("x"))
    maintain.save_blocks(base, path, block_rows=10)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    updates = spark.createDataFrame([(42, 42, 9, 1), (205, 205, 9, 1)], "ordinal long, script_id long, x int, version int")
    maintain.upsert_blocks(spark, path, updates, block_rows=10)
    got = {r.script_id: r.x for r in maintain.read_blocks(spark, path).collect()}
    assert len(got) == 101 and got[42] == 9 and got[205] == 9 and got[41] == 0
    assert all(p.exists() and p.stat().st_mtime_ns == before[p] for p in before)
    written = {p.parent.name for p in tmp_path.rglob("*.parquet") if p not in before}
    assert written == {"ord_block=4", "ord_block=20"}
    assert versions.vacuum(spark, path, "ord_block") == 1 and maintain.read_blocks(spark, path).count() == 101
    assert len([p for p in before if p.exists()]) < len(before)


@pytest.mark.parametrize("step", ["while the blocks are written", "before the version is finished"])
def test_a_write_that_dies_loses_nothing(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    base = spark.range(30).select(F.col("id").alias("ordinal"), F.col("id").alias("script_id"), F.lit(0).alias("x"))
    maintain.save_blocks(base, path, block_rows=10)
    updates = spark.createDataFrame([(12, 12, 9, 1)], "ordinal long, script_id long, x int, version int")

    class Died(Exception):
        pass

    real = versions._files

    def dying(session, name):
        if step.startswith("before") and name.endswith("table_version=1/_done"):
            raise Died
        return real(session, name)

    def no_write(*args, **options):
        raise Died

    with monkeypatch.context() as m:
        if step.startswith("before"):
            m.setattr(versions, "_files", dying)
        else:
            (tmp_path / "t" / "table_version=1" / "ord_block=1").mkdir(parents=True)  # half written
            m.setattr(maintain, "write_version", no_write)
        with pytest.raises(Died):
            maintain.upsert_blocks(spark, path, updates, block_rows=10)
    assert {r.x for r in maintain.read_blocks(spark, path).collect()} == {0} and maintain.read_blocks(spark, path).count() == 30
    maintain.upsert_blocks(spark, path, updates, block_rows=10)
    got = {r.script_id: r.x for r in maintain.read_blocks(spark, path).collect()}
    assert len(got) == 30 and got[12] == 9 and sum(got.values()) == 9


def test_delete_touches_the_ends_of_a_range_only(spark, tmp_path):
    path = str(tmp_path / "t")
    maintain.save_blocks(spark.range(100).toDF("ordinal"), path, block_rows=10)
    before = set(tmp_path.rglob("*.parquet"))
    maintain.delete_blocks(spark, path, 25, 58, block_rows=10)
    assert sorted(r.ordinal for r in maintain.read_blocks(spark, path).collect()) == [*range(25), *range(58, 100)]
    assert {p.parent.name for p in set(tmp_path.rglob("*.parquet")) - before} == {"ord_block=2", "ord_block=5"}
    maintain.delete_blocks(spark, path, 60, block_rows=10)
    maintain.delete_blocks(spark, path, 500, 700, block_rows=10)
    assert sorted(r.ordinal for r in maintain.read_blocks(spark, path).collect()) == [*range(25), 58, 59]
    maintain.delete_blocks(spark, path, 0, block_rows=10)
    assert maintain.read_blocks(spark, path, "ordinal long, ord_block long").count() == 0


def test_ties_are_decided_with_maps_and_nested_columns(spark):
    rows = [("a", {"x": 1}, [{"y": 2}]), ("a", {"x": 2}, [{"y": 1}]), ("b", None, None)]
    df = spark.createDataFrame(rows, "script_id string, m map<string,int>, l array<map<string,int>>")
    got = maintain.append_new(df.limit(0), df).collect()
    again = maintain.append_new(df.limit(0), df.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == 2


def test_delete_range_ignores_missing(spark):
    df = spark.range(10).withColumnRenamed("id", "ordinal")
    assert maintain.delete_range(df, 4, 7).count() == 7
    assert maintain.delete_range(df, 8, 900).count() == 8
    assert maintain.delete_range(df, 3).count() == 3


# --- publishing -------------------------------------------------------------------


@pytest.mark.parametrize("count, sizes", [(16384, [16384]), (16385, [16384, 1]), (32768, [16384, 16384])])
def test_chunk_sizes(spark, count, sizes):
    members = spark.range(count).select(F.lit("c0").alias("cluster_id"), F.col("id").alias("script_id"))
    chunks = publish.member_chunks(members, rank=None).orderBy("chunk_no").select("chunk_id", "n").collect()
    assert [r.n for r in chunks] == sizes and chunks[0].chunk_id == "c0_b1"


def test_chunks_come_back_in_order(spark):
    members = spark.range(100).select(F.lit("c0").alias("cluster_id"), F.col("id").alias("script_id"), (100 - F.col("id")).alias("rank"))
    chunks = publish.member_chunks(members, 16)
    back = publish.reassemble(chunks).orderBy("chunk_no", "place").toPandas()
    assert back.script_id.tolist() == list(range(99, -1, -1))
    assert publish.reassemble(chunks, 1, 2).count() == 32


def test_quality_checks(spark):
    info = spark.createDataFrame([("a", "good day"), ("b", "bad day")], "script_id string, text string")
    vectors = embed(info, HashedEncoder(16)).select("script_id", "vector")
    changed = info.withColumn("text", F.when(F.col("script_id") == "b", "other words").otherwise(F.col("text")))
    tally = quality.tally(quality.sample_check(changed, info, vectors, HashedEncoder(16))).first().asDict()
    assert tally == {"n": 2, "vector_passed": 1, "text_passed": 1, "text_equal": 1, "failed": 1}
    ids = assign_ordinals(spark.range(20), ["id"]).select("script_id")
    assert quality.key_check(ids, 20).count() == 0 and quality.key_check(ids, 22).count() == 2


def test_draws_survive_gaps(spark):
    df = spark.range(100).filter("id % 2 = 0").withColumnRenamed("id", "ordinal")
    got = sampling.sample_with_replacement(df, 300, seed=2).toPandas()
    assert len(got) == 300 and (got.ordinal % 2 == 0).all() and got.ordinal.max() > 90
    again = sampling.sample_with_replacement(df.repartition(7), 300, seed=2).toPandas()
    assert sorted(zip(got.draw, got.ordinal)) == sorted(zip(again.draw, again.ordinal))


def test_upsert_moves_a_key_to_another_block(spark, tmp_path):
    path = str(tmp_path / "moved")
    rows = [(str(k), k, "old") for k in range(20)] + [("95", 95, "old")]
    maintain.save_blocks(spark.createDataFrame(rows, "script_id string, ordinal long, text string"), path, 10)
    updates = [("3", 25, "new", 1), ("95", 8, "new", 1), ("7", 7, "b", 2), ("7", 7, "a", 2)]
    updates = spark.createDataFrame(updates, "script_id string, ordinal long, text string, version int")
    maintain.upsert_blocks(spark, path, updates, block_rows=10)
    got = {r.script_id: (r.ordinal, r.text) for r in maintain.read_blocks(spark, path).collect()}
    assert maintain.read_blocks(spark, path).count() == 21 and got["3"] == (25, "new") and got["95"] == (8, "new")
    assert 9 not in {r.ord_block for r in maintain.read_blocks(spark, path).collect()}


def test_ensemble_labels_every_vector(spark):
    rows = [(k, [float(k % 7), float(k % 5), 1.0]) for k in range(120)]
    df = spark.createDataFrame(rows, "ordinal long, vector array<double>")
    for size, fits in ((None, 5), (20, 6)):
        got = cluster.ensemble(df, 2, 2, chunk_size=size, item_id="ordinal").toPandas()
        assert got.chunk_no.nunique() == fits and len(got[got.chunk_no == fits - 1]) == 120


def test_mean_of_null_and_mixed_vectors(spark):
    rows = [(1, None), (1, [1.0, 2.0]), (1, [3.0, 4.0])]
    got = cluster.mean_vectors(spark.createDataFrame(rows, "g int, vector array<double>"), "g").first()
    assert got.centroid == [2.0, 3.0] and got.n == 3
    mixed = spark.createDataFrame([(1, [1.0]), (1, [1.0, 2.0])], "g int, vector array<double>")
    with pytest.raises(Exception, match="exactly 2 components"):
        cluster.mean_vectors(mixed, "g").collect()


def test_within_holds_k_per_reference():
    rng = np.random.default_rng(1)
    data, refs = rng.normal(size=(3000, 8)), rng.normal(size=(400, 8))
    tie = np.arange(3000)
    old, blocks.CELLS = blocks.CELLS, 20_000
    try:
        r, v, d = blocks.within(data, refs, "euclidean", 2.0, 7, np.full(400, np.inf), tie)
        place = rng.permutation(3000).astype(float)
        r2, v2, _ = blocks.within(data, refs, "cityblock", 2.0, 3, np.full(400, 5.0), tie, place, 5.0)
    finally:
        blocks.CELLS = old
    full = np.sqrt(((data[None] - refs[:, None]) ** 2).sum(2))
    assert len(r) == 2800
    for i in range(400):
        assert sorted(v[r == i].tolist()) == sorted(np.argsort(full[i])[:7].tolist())
    near = np.abs(data[None] - refs[:, None]).sum(2) < 5.0
    for i in range(400):
        close = np.flatnonzero(near[i])
        assert sorted(v2[r2 == i].tolist()) == sorted(close[np.argsort(place[close])][:3].tolist())


def _peak_mb(call):
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_memory_of_a_unit_of_pairs():
    rng = np.random.default_rng(3)
    data, refs = rng.normal(size=(6000, 16)), rng.normal(size=(6000, 16))
    assert _peak_mb(lambda: blocks.within(data, refs, "euclidean", 2.0, 10, np.full(6000, np.inf), np.arange(6000))) < 40


@pytest.mark.parametrize("metric", ["euclidean", "sqeuclidean", "cityblock", "chebyshev"])
@pytest.mark.parametrize("shift, scale", [(0.0, 1.0), (1e4, 1e-3), (0.0, 1e-15), (0.0, 1e20), (3.0, 1e6)])
def test_screening_in_single_precision_loses_nothing(metric, shift, scale):
    rng = np.random.default_rng(5)
    data = rng.integers(-3, 4, size=(400, 3)) * scale + shift  # many ties
    refs = data[::9] + scale / 7
    full = np.array([blocks.row_distance(data, np.broadcast_to(r, data.shape), metric) for r in refs])
    want = np.argsort(np.round(full, 9), axis=1, kind="stable")[:, :6]
    r, v, _ = blocks.within(data, refs, metric, 2.0, 6, np.full(len(refs), np.inf), np.arange(400))
    assert v[np.lexsort((v, np.round(full, 9)[r, v], r))].reshape(-1, 6).tolist() == want.tolist()


def test_units_do_not_grow_with_the_tables(spark):
    cores = spark.sparkContext.defaultParallelism
    sides = [nearest_module._unit_rows(spark, n, "cityblock") for n in (20_000, 100_000, 10**6, 10**9)]
    assert sides == sorted(sides) and sides[-1] ** 2 <= 2**28
    assert (100_000 / sides[1]) ** 2 >= 4 * cores * 0.99  # several units for every core, not one block of all


@pytest.mark.parametrize("limit", [None, 8 * 9 * 4])
def test_first_n_by_either_way(spark, points, monkeypatch, limit):
    """Few queries as one broadcast block, many as pairs of blocks and slices: the same first n."""
    monkeypatch.setattr(nearest_module, "SLICE_ROWS", 40)
    rank = np.random.default_rng(2).permutation(300)
    q = frame(spark, points[:20], "query_id")
    corpus = frame(spark, points, place=rank)
    got = nearest(q, corpus, 5, mode="first_n", item_rank="place", max_distance=2.5, limit_bytes=limit).toPandas()
    d = np.sqrt(((points[None] - points[:20, None]) ** 2).sum(2))
    for i in range(20):
        close = np.flatnonzero(d[i] < 2.5)
        first = close[np.argsort(rank[close])][:5]
        want = first[np.lexsort((first, np.round(d[i][first], 9)))]
        assert got[got.query_id == i].sort_values("rank").script_id.tolist() == want.tolist()


def test_moments_of_chunks_are_those_of_all(spark, tmp_path):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(400, 5)) @ rng.normal(size=(5, 5)) + 1e6  # a mean that drowns plain sums of products
    v = frame(spark, data)
    path = str(tmp_path / "moments")
    for k, cond in enumerate(("script_id < 30", "script_id between 30 and 299", "script_id >= 300")):
        reduction.add_chunk(v.filter(cond).repartition(k * 20 + 1), path, str(k))
    reduction.add_chunk(v, path, "1")  # sent again
    mean, axes, variances = reduction.components(reduction.kept_moments(spark, path), 5)
    values, want = np.linalg.eigh(np.cov(data.T, bias=True))
    assert np.allclose(mean, data.mean(axis=0)) and np.allclose(variances, values[::-1], rtol=1e-6)
    assert np.allclose(np.abs((axes * want[:, ::-1]).sum(axis=0)), 1, atol=1e-6)
    assert (axes[np.abs(axes).argmax(axis=0), range(5)] > 0).all()
    some = reduction.components(reduction.kept_moments(spark, path, ["0"]), 2)
    assert np.allclose(some[0], data[:30].mean(axis=0)) and some[1].shape == (5, 2)
    got = reduction.project(v, mean, axes, keep=["script_id"]).toPandas().sort_values("script_id")
    assert np.allclose(np.array(got.reduced.tolist()), (data - mean) @ axes, atol=1e-4)
    with pytest.raises(ValueError):
        reduction.components(reduction.moments(v.limit(0)), 2)


def test_ensemble_labels_equal_numpy(spark):
    rng = np.random.default_rng(6)
    data = clustered(rng, 4, 20, 6)[rng.permutation(80)]
    got = cluster.ensemble(frame(spark, data, "ordinal"), 3, 2, chunks=2, item_id="ordinal", iterations=4).toPandas()
    for i, n in enumerate((40, 80)):
        rows = data[:n]
        values, axes = np.linalg.eigh(np.cov(rows.T, bias=True))
        axes = axes[:, ::-1][:, :2]
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), range(2)])
        points = (rows - rows.mean(axis=0)) @ axes
        first = sorted(range(n), key=lambda r: (hashlib.md5(f"{cluster.ENSEMBLE_SEED}:{r}".encode()).hexdigest()[:15], r))[:3]
        centres, _ = plain_lloyd(points, points[sorted(first)], 4)
        want = ((points[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        assert got[got.chunk_no == i].sort_values("ordinal").label.tolist() == want.tolist()


def test_each_text_is_encoded_once(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([(1, "sun moon"), (2, "sun moon"), (3, ""), (4, None), (5, "sea")], "k int, text string")
    assert encode.encode_missing(rows, path, HashedEncoder(8)) == 2
    assert encode.encode_missing(rows.union(spark.createDataFrame([(6, "sky")], rows.schema)), path, HashedEncoder(8)) == 1
    assert encode.encode_missing(rows.limit(0), path, HashedEncoder(8)) == 0
    got = {r.k: r.vector for r in encode.with_vectors(rows, path).collect()}
    want = {r.k: r.vector for r in embed(rows, HashedEncoder(8)).collect()}
    assert set(got) == {1, 2, 5} and all(np.allclose(got[k], want[k]) for k in got)
    assert encode.stored_vectors(spark, path).count() == 3


def test_draws_refuse_repeated_ids_and_take_any_name(spark):
    twice = spark.range(50).union(spark.range(50)).toDF("script_id")
    with pytest.raises(ValueError):
        sampling.sample_exact(twice, 9)
    assert sampling.sample_exact(spark.range(50).toDF("ordinal"), 9, "ordinal").count() == 9


def test_seeded_starts_find_the_clusters(spark):
    rng = np.random.default_rng(12)
    data = np.vstack([clustered(rng, 4, 40, 4), np.full((3, 4), 500.0)])
    v = frame(spark, data)
    found = fits.candidates(v, 5, seed=3).toPandas()
    again = fits.candidates(v.repartition(9), 5, seed=3).toPandas()
    assert sorted(found.candidate) == sorted(again.candidate) and found.weight.sum() == len(data) and 5 <= len(found) < 60
    got = cluster.fit_seeded(v, 5, 10, seed=3).toPandas()
    assert got.n.sum() == len(data) and got.n.max() <= 83
    same = frame(spark, np.ones((6, 4)))
    assert fits.candidates(same, 2).toPandas().weight.tolist() == [6]
    with pytest.raises(ValueError):
        cluster.fit_seeded(same, 2)
