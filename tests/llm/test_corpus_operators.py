"""Operators on pairs and sources, and the pipeline."""

import itertools
import os
import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from verbatlas import session
from verbatlas.llm import chaining, components, mixing, ngram_join, pigeonhole, queries, suffixes


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 60)] + [(200, 200), (None, 3), (300, 299), (299, 300)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expect = brute.components(range(400), [e for e in edges if None not in e])
    assert got == {k: c for k, c in expect.items() if k in got}
    assert set(got) == {*range(100, 141), *range(7, 60), 299, 300}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_random_graphs_and_hubs(spark):
    """Hubs that are the least, the greatest or neither of their neighbours, long chains, dense groups."""
    draw = random.Random(5)
    hubs = [(0, k) for k in range(1000, 1400)] + [(5000, k) for k in range(2000, 2400)] + [(3200, k) for k in range(3000, 3400)]
    chain = list(range(10_000, 10_300))
    draw.shuffle(chain)
    dense = [(draw.randrange(20_000, 20_060), draw.randrange(20_000, 20_060)) for _ in range(400)]
    sparse = [(draw.randrange(30_000, 31_000), draw.randrange(30_000, 31_000)) for _ in range(450)]
    for edges in (hubs, list(zip(chain, chain[1:])), dense + sparse, hubs + [(1399, 2000), (3399, 2399)] + dense):
        got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        nodes = {x for a, b in edges if a != b for x in (a, b)}
        expect = brute.components(nodes, edges)
        assert got == {k: expect[k] for k in nodes}


# --- mixing ---


def test_mix_meets_its_targets(spark, folder, documents):
    got = {r.doc_id: r for r in queries.op2_mixing(spark, folder).collect()}
    rows = [(r.doc_id, r.source, len(brute.words(r.text))) for r in documents.collect()]
    sizes = Counter()
    for _, source, n in rows:
        sizes[source] += n
    targets, taken, largest = brute.source_targets(sizes), Counter(), Counter()
    for i, source, n in rows:
        assert got[i].size == n and got[i].source_size == sizes[source]
        assert got[i].target == pytest.approx(targets[source]) and got[i].taken in (0, n, 2 * n)
        taken[source] += got[i].taken
        largest[source] = max(largest[source], n)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= largest[source] / 2
    again = {r.doc_id: r.taken for r in queries.op2_mixing(spark, folder).collect()}
    assert again == {i: r.taken for i, r in got.items()}


def test_tilt_is_the_dual_solution(documents):
    """Newton's tilts meet the constraints before rounding."""
    counted = mixing.cells(mixing.sized(documents)).cache()
    solved = mixing.tilts(counted, mixing.targets(counted))
    rates = counted.join(solved, "key").selectExpr(
        "key", "target", "source_size", "n * size * least(2, exp(least(30, tilt * size * n_all / source_size))) as words"
    )
    for r in rates.groupBy("key", "target", "source_size").sum("words").collect():
        assert r["sum(words)"] == pytest.approx(r.target, rel=1e-6)


def test_mix_of_odd_rows(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count() and all(r.copies in (0, 1, 2) for r in got)
    assert {r.size for r in got if r.id in (1, 2, 3)} == {0}
    assert mixing.mix(none).count() == 0
    rows = mixing.apply(odd, mixing.plan(odd), column="_told")
    assert rows.columns == [*odd.columns, "_told"]


def test_rows_with_one_id_move_one_by_one(spark):
    """Null ids and repeated ids: each source ends within half a document of its target, on every run."""
    rows = [(None, "a", f"{k} " * 10) for k in range(300)] + [(7, "b", "same words " * 5)] * 200 + [(k, "c", "x " * 10) for k in range(500)]
    df = spark.createDataFrame([r + ({"k": 1},) for r in rows], "doc_id long, source string, text string, extra map<string, int>")
    runs = []
    for _ in range(2):
        got = mixing.apply(df, mixing.plan(df)).selectExpr("source", "doc_id", "text", "_mixed.*").collect()
        assert len(got) == len(rows)
        taken, target = Counter(), {}
        for r in got:
            taken[r.source] += r.copies * r["size"]
            target[r.source] = r.target
        assert all(abs(taken[s] - t) <= 5 for s, t in target.items()) and len(target) == 3
        runs.append(Counter((r.source, r.text, r.copies) for r in got))
    assert runs[0] == runs[1]
    assert Counter((r.source, r.copies) for r in mixing.mix(df.select("doc_id", "source", "text")).join(
        df.selectExpr("doc_id as id", "source").distinct(), "id").collect() if r.source == "b") == Counter({(s, c): n for (s, _, c), n in runs[0].items() if s == "b"})


# --- n-gram join ---


def test_join_of_texts_with_one_id(spark):
    """Ids shared by different texts lose no link, held against brute force over rows."""
    a, b = " ".join(f"a{k}" for k in range(200)), " ".join(f"b{k}" for k in range(200))
    docs = [(1, a), (1, b), (2, a), (3, b), (4, a + " x"), (5, b + " y"), (6, b), (6, b), (6, "c d")]
    expect = brute.jaccard_classes([(k, t) for k, (_, t) in enumerate(docs)])
    ids = [i for i, _ in docs]
    named = {c: min(ids[k] for k, (d, _) in expect.items() if d == c) for c, _ in expect.values()}
    want = Counter((ids[k], named[c], n) for k, (c, n) in expect.items())
    got = ngram_join.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert Counter((r.id, r.class_id, r.n_links) for r in got) == want
    assert len({r.class_key for r in got}) == 3

def test_join_equals_brute_force(spark, folder, plain):
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.op3_ngram_join(spark, folder).collect()}
    assert got == brute.jaccard_classes(plain)


def test_large_groups_are_cut_into_blocks(spark):
    """Near copies in number, with blocks so small that many units share the group."""
    base = [f"w{k}" for k in range(120)]
    docs = []
    for k in range(90):
        w = list(base)
        w[(7 * k) % 120] = f"x{k}"
        docs.append((k, " ".join(w)))
    docs += [(100 + k, docs[k][1]) for k in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.id: (r.class_id, r.n_links) for r in ngram_join.join(df, block=8).collect()}
    assert got == brute.jaccard_classes(docs)


def test_bands_reach_the_recall():
    for recall in (0.9, 0.999):
        count, rows = ngram_join.bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** count >= recall and count * rows <= ngram_join.MOST_HASHES


def test_join_of_odd_rows(odd, none):
    got = defaultdict(set)
    for r in ngram_join.join(odd).collect():
        got[r.id].add((r.class_id, r.n_links))
    assert got[1] == {(1, 0)} and got[2] == {(2, 0)} and got[None] == {(None, 0)}
    assert {c for k in (4, 5, 6) for c, _ in got[k]} == {4} and got[8] == {(7, 1)}
    assert got[9] == {(9, 0)} and got[10] == {(10, 0)}
    assert ngram_join.join(none).count() == 0


# --- embeddings ---


def near_brute(rows, cosine=0.95):
    ids, flat = [i for i, _ in rows], np.array([v for _, v in rows], float)
    unit = flat / np.linalg.norm(flat, axis=1)[:, None]
    a, b = np.nonzero(np.triu(unit @ unit.T >= cosine, 1))
    pairs = [(ids[x], ids[y]) for x, y in zip(a, b)]
    links = Counter(x for p in pairs for x in p)
    found = brute.components(ids, pairs)
    return {i: (links[i], found[i]) for i in ids}


@pytest.mark.parametrize("chunk", [2048, 16])
def test_near_vectors_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(pigeonhole, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 24))
    points = np.concatenate([c + rng.normal(size=(30, 24)) * s for c, s in zip(centres, np.linspace(0.05, 0.5, 12))])
    points = np.concatenate((points, points[:5], 3.0 * points[7:9]))
    rows = [(int(k) * 3, p.tolist()) for k, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.id: (r.n_links, r.component_id) for r in pigeonhole.near(df).collect()}
    assert got == near_brute(rows)


def test_vectors_are_not_sent_again_for_each_unit(spark, monkeypatch):
    """Many small chunks, a block at a time: nothing is shuffled for the units, and the pairs are those of brute force."""
    for name, value in (("CHUNK", 16), ("PACK", 1), ("TILE", 8), ("PASS_BYTES", 1), ("EDGES", 20)):
        monkeypatch.setattr(pigeonhole, name, value, raising=False)
    plans, real = [], pigeonhole.materialise

    def spy(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)

    monkeypatch.setattr(pigeonhole, "materialise", spy)
    rng = np.random.default_rng(11)
    points = np.concatenate([c + rng.normal(size=(40, 20)) * 0.15 for c in rng.normal(size=(6, 20))])
    points = np.concatenate((points, points[:9], -points[:3])).astype(np.float32)
    rows = [(int(k) * 5, p.tolist()) for k, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.id: (r.n_links, r.component_id) for r in pigeonhole.near(df).collect()}
    assert got == near_brute(rows)
    units = [p for name, p in plans if name == "links"]
    assert len(units) == 3 and not any("Exchange" in p for p in units)


def test_forest_spans_what_the_edges_join():
    rng = np.random.default_rng(3)
    i, j = rng.integers(0, 6000, (2, 5000))
    parent, kept = pigeonhole._hung(np.arange(6000), i, j)
    whole, part = (brute.components(range(6000), list(zip(i[n].tolist(), j[n].tolist()))) for n in (slice(None), kept))
    assert whole == part and len(kept) == 6000 - len(set(whole.values()))


def test_rotation_is_orthogonal():
    for width in (1, 3, 64):
        q = pigeonhole.rotation(width)
        assert np.allclose(q @ q.T, np.eye(width))
    assert sum(pigeonhole.radii(20, 0.95)) == pytest.approx(0.1)


def test_near_of_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, v), (2, v), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 3.0]), (6, [1.0, float("nan"), 3.0]), (7, [1.0, float("inf"), 3.0]), (8, [1.0]), (None, v), (9, [-1.0, -2.0, -3.0])]
    df = spark.createDataFrame([r + ("x", "y", "z") for r in rows], "vec_id long, embedding array<double>, id string, vector string, member string")
    got = Counter((r.id, r.n_links, r.component_id, r.kept) for r in pigeonhole.near(df).collect())
    alone = {(i, 0, i, True): 1 for i in (3, 4, 5, 6, 7, 8, 9)}
    assert got == Counter({(1, 1, 1, True): 1, (2, 1, 1, False): 2, (None, 0, None, False): 1, **alone})
    assert pigeonhole.near(df.limit(0)).count() == 0


def test_near_vectors_of_any_size_and_width(spark):
    v = np.array([1.0, 2.0, 3.0])
    sizes = [1.0, 1e-25, 1e25, 1e200, 1e-200, 5e-324, 1.7e308 / 3]
    rows = [(k, (v * s).tolist()) for k, s in enumerate(sizes)]  # the smallest double keeps the direction, roughly
    rows += [(10, [3.0, -1.0, 0.0]), (11, [2e-30, 1e-30]), (12, [4.0, 2.0]), (13, [7.0]), (14, [1e-9]), (15, [-7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.id: (r.n_links, r.component_id) for r in pigeonhole.near(df).collect()}
    near = {k: (6, 0) for k in range(7)}
    assert got == {**near, 10: (0, 10), 11: (1, 11), 12: (1, 11), 13: (1, 13), 14: (1, 13), 15: (0, 15)}
    small = spark.createDataFrame([(1, [1e-25, 2e-25]), (2, [1.0, 2.0]), (3, [1e25, 2e25]), (4, [2.0, -1.0])], "vec_id long, embedding array<float>")
    assert {r.id: (r.n_links, r.component_id) for r in pigeonhole.near(small).collect()} == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}


def test_embeddings_query(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.op8_pigeonhole(spark, folder).collect()}
    assert got == near_brute(rows)


# --- suffixes ---


def test_suffixes_equal_brute_force(spark, folder, plain):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op9_suffixes(spark, folder).collect()}
    assert got == dict(zip([i for i, _ in plain], brute.removed([t for _, t in plain])))


@pytest.mark.parametrize("bucket", [2000, 1])
def test_suffixes_by_either_way(spark, monkeypatch, bucket):
    """Periodic, overlapping and embedded repeats, with buckets sorted in tasks and dealt by suffix."""
    monkeypatch.setattr(suffixes, "BUCKET", bucket)
    rng = np.random.default_rng(3)
    noise = ["".join(chr(97 + c) for c in rng.integers(0, 26, 900)) for _ in range(8)]
    docs = ["ab" * 300, noise[0] + noise[1][:450] + noise[2], noise[3] + noise[1][100:700], noise[4][:399], noise[4][:400], noise[4][:401], "é" * 350, noise[5] + "é" * 220, noise[6] + noise[1][:450], noise[7] + noise[7]]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.dedup(df).collect()}
    assert got == dict(enumerate(brute.removed(docs)))


@pytest.mark.parametrize("size", [60, 390, 430])
def test_suffixes_of_a_string_that_many_texts_share(spark, monkeypatch, size):
    """One bucket above the limit, whose rows grow by a few per piece and not by the bytes of a window."""
    made = []
    monkeypatch.setattr(suffixes, "BUCKET", 20)
    monkeypatch.setattr(suffixes, "_large_buckets", lambda f, n, w, real=suffixes._large_buckets: (made.append(f.count()), real(f, n, w))[1])
    rng = np.random.default_rng(size)
    text = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 26, n))
    shared = text(size)
    docs = [text(int(rng.integers(300, 700))) + shared + text(int(rng.integers(300, 700))) for _ in range(60)]
    docs += [docs[3][100:800], text(200) + docs[5][:500]]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.dedup(df).collect()}
    assert got == dict(enumerate(brute.removed(docs))) and made


def test_halves_are_few_rows(spark):
    """Pieces around a long shared string give about two rows a round, not one per suffix."""
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 123, 390).astype(np.uint8).tobytes()
    rows = [(k, rng.integers(97, 123, 190).astype(np.uint8).tobytes() + shared + rng.integers(97, 123, 190).astype(np.uint8).tobytes()) for k in range(50)]
    # The anchor in the middle of the shared string, and all windows that hold it.
    level = [(0, k, 0, 7, k, 371, 376, 0, 377, data) for k, data in rows]
    total = 0
    for _ in range(9):
        level = list(suffixes._halves(level, 400))
        total += len(level)
        kinds = Counter(r[3] for r in level)
        level = [r for r in level if kinds[r[3]] > 1]
    assert not level and total <= 50 * 2 * 9


def test_difference_cover_reaches_every_pair():
    cover = set(suffixes.difference_cover(64).tolist())
    shift = suffixes.shifts(64)
    assert all((i + shift[i, j]) % 64 in cover and (j + shift[i, j]) % 64 in cover for i in range(64) for j in range(64))


def test_suffixes_of_odd_rows(odd, none):
    got = suffixes.dedup(odd, keep_text=True).collect()
    assert len(got) == odd.count() and suffixes.dedup(none).count() == 0
    told = Counter((r.id, r.n_removed == r.n_bytes) for r in got)
    assert told[(7, True)] == told[(8, True)] == 1 and told[(4, False)] == 2
    assert all(bytes(r.kept) == b"" for r in got if r.id in (1, 2, 7, 8))


# --- chaining ---


def test_passages_cover_exact_repeats(spark, folder, plain):
    inside = defaultdict(set)
    for r in queries.op10_chaining(spark, folder).collect():
        assert r.end - r.start >= 50 and r.equal >= 0.8 * (r.end - r.start) - 1 and r.doc_id != r.partner_id
        inside[r.doc_id] |= set(range(r.start, r.end))
    for i, places in brute.shared_stretches(plain).items():
        assert not places - inside[i]


def test_fuzzy_passage_in_clean_texts(spark):
    rng = np.random.default_rng(11)
    prose = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    passage = prose(90)
    changed = list(passage)
    changed[30] = "other"
    changed[60:62] = ["put", "some", "words", "in"]
    docs = [(1, prose(200) + passage + prose(100)), (2, prose(50) + changed + prose(70)), (3, prose(300)), (4, prose(10) + passage[:40] + prose(200))]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    (one,) = chaining.passages(df).where("id = 2").collect()
    assert (one.partner, one.partner_start, one.partner_end, one.start, one.end) == (1, 200, 290, 50, 142)
    assert {r.id for r in chaining.passages(df).collect()} == {1, 2}


def test_passages_of_separately_frequent_sentences(spark):
    rng = np.random.default_rng(12)
    prose = lambda n: [f"w{x}" for x in rng.integers(0, 50000, n)]
    passage = prose(72)
    lines = [passage[k : k + 30] for k in range(0, 72, 12)]  # every seed of the passage is in one of these
    docs = [(10 * n + m, prose(60) + line + prose(60)) for n, line in enumerate(lines) for m in range(10)]
    docs += [(i, prose(70) + passage + prose(80)) for i in (136, 139, 178)]  # neither the least ids nor the least hashes
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    got = chaining.passages(df).collect()
    assert {r.id for r in got} == {136, 139, 178}
    for i in (136, 139, 178):
        assert any(r.id == i and r.start <= 70 and r.end >= 142 for r in got)
    assert len(set(got)) == len(got)


def test_passages_that_one_text_holds_twice(spark):
    rng = np.random.default_rng(13)
    prose = lambda n: [f"w{x}" for x in rng.integers(0, 50000, n)]
    passage = prose(60)
    for once, twice in ((1, 2), (2, 1)):
        docs = [(once, prose(70) + passage + prose(80)), (twice, prose(40) + passage + prose(90) + passage + prose(30)), (3, prose(200))]
        got = chaining.passages(spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")).collect()
        assert {(r.start, r.end) for r in got if r.id == twice} == {(40, 100), (190, 250)}
        assert {(r.id, r.partner) for r in got} == {(1, 2), (2, 1)}


@pytest.mark.parametrize("copies", [1, 9, 34])
def test_fuzzy_passages_that_no_reference_holds(spark, copies):
    """Every two parts of the passage stand together in ``copies`` other texts, all of them references before the two that hold it all."""
    rng = np.random.default_rng(14)
    prose = lambda n: [f"w{x}" for x in rng.integers(0, 50000, n)]
    parts = [prose(12) for _ in range(5)]
    text = lambda held: [w for k in range(5) for w in (parts[k] if k in held else prose(12)) + prose(1)]
    docs = [(n, prose(30) + text(held) + prose(30)) for n, held in enumerate(sorted([*itertools.combinations(range(5), 2)] * copies))]
    last = [r.id for r in spark.range(1000, 1300).orderBy(F.xxhash64("id").desc()).limit(2).collect()]
    docs += [(i, prose(50) + text(range(5)) + prose(40)) for i in last]
    got = chaining.passages(spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")).collect()
    assert sorted((r.id, r.partner, r.start, r.end) for r in got) == sorted((i, j, 50, 114) for i, j in (last, last[::-1]))


def test_pairs_are_joined_in_slices(spark, monkeypatch):
    """Texts of one passage meet by a line too short to be one; slices give the rows of one join, and shuffle files go with their job."""
    rng = np.random.default_rng(15)
    prose = lambda n: [f"w{x}" for x in rng.integers(0, 50000, n)]
    passage, line = prose(80), prose(26)
    docs = [(i, prose(20) + passage + prose(30) + line + prose(20 * i)) for i in range(12)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    key, made = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before = spark.conf.get(key, None)
    monkeypatch.setattr(chaining, "_anchors", lambda p, h, s, real=chaining._anchors: [made.append(spark.conf.get(key)) or a for a in real(p, h, s)])
    whole = chaining.passages(df).collect()
    assert made == ["true"] and spark.conf.get(key, None) == before
    assert {(r.id, r.partner) for r in whole} == {(i, j) for i in range(12) for j in range(12) if i != j}
    sliced = chaining.passages(df, settings=chaining.Settings(beside=1)).collect()
    assert len(made) > 3 and Counter(whole) == Counter(sliced)


def test_tables_of_steps_go_with_them(spark, monkeypatch):
    """The strings around open seeds are written for some seeds at a time, with the rows of one table, and no step leaves its tables."""
    rng = np.random.default_rng(16)
    prose = lambda n: [f"w{x}" for x in rng.integers(0, 50000, n)]
    passage, line, frame = prose(80), prose(26), prose(12)
    docs = [(i, prose(20) + passage + prose(30) + line + prose(25) + frame + prose(20 * i)) for i in range(12)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    root, names = session.scratch_root(spark), []
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    monkeypatch.setattr(chaining, "materialised", lambda df, name, real=session.materialised: names.append(name) or real(df, name))
    whole = chaining.passages(df, settings=chaining.Settings(group=2, around=1000))
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(root)) - before}
    assert names.count("edges") == 1 and not left & {"seeds", "chains", "stretches", "windows", "sizes", "hot", "edges", "edge_sizes", "hot_edges", "frames", "contents"}
    whole = whole.collect()
    assert {r.id for r in whole} == set(range(12))
    sliced = chaining.passages(df, settings=chaining.Settings(group=2, around=1)).collect()
    assert names.count("edges") > 3 and Counter(whole) == Counter(sliced)


def test_chains_pay_for_gaps():
    s = chaining.Settings()
    here = np.array([0, 10, 20, 30, 300, 310])
    there = np.array([5, 15, 900, 35, 305, 315])
    assert sorted(chaining.chains(here, there, s)) == [[0, 1, 3], [4, 5]]


def test_passages_of_odd_rows(odd, none):
    got = chaining.passages(odd).collect()
    assert {(r.id, r.partner) for r in got} == {(7, 8), (8, 7)}
    assert chaining.passages(none).count() == 0


# --- pipeline ---


def test_pipeline_stage_by_stage(spark, folder, documents):
    docs = documents
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        kept.append(docs)
    for stage in kept[:-1]:
        assert stage.columns == list(corpus_pipeline.DOCUMENTS) and dict(stage.dtypes) == dict(documents.dtypes)
    clean, single, safe, mixed, packed = kept
    texts = [(r.doc_id, r.text) for r in clean.collect()]
    classes = brute.jaccard_classes(texts)
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for c, _ in classes.values()})
    before = {r.doc_id: r for r in single.collect()}
    for r in safe.collect():
        assert not brute.base_spans(r.text) and (r.text == before[r.doc_id].text or "[SECRET]" in r.text)
    words = {r.doc_id: len(brute.words(r.text)) for r in safe.collect()}
    copies = Counter(r.doc_id for r in mixed.collect())
    total = sum(words.values())
    assert max(copies.values()) <= 2 and abs(sum(words[i] * n for i, n in copies.items()) - 1.5 * total) < 0.05 * total
    got = packed.groupBy("doc_id").sum("size").collect()
    assert {r.doc_id: r["sum(size)"] for r in got} == {i: words[i] * n for i, n in copies.items()}


def test_pipeline_on_odd_rows(spark, folder, odd, none):
    for docs in (odd, none):
        rows = docs
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, folder).cache()
        assert (rows.count() > 0) == (docs is odd)


def test_one_row_of_each_class_stays(spark, folder):
    """Ids shared by texts of different classes, and repeated rows."""
    a, b = " ".join(f"a{k}" for k in range(200)), " ".join(f"b{k}" for k in range(200))
    rows = [(1, a, "x"), (1, b, "x"), (2, a, "x"), (2, a + " z", "y"), (3, b, None), (4, "c d", "x"), (4, "c d", "y"), (5, "", "x"), (5, "", "x"), (None, a, "x"), (6, None, None)]
    docs = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r.doc_id, r.text, r.source) for r in corpus_pipeline.drop_near_duplicates(spark, docs, folder).collect())
    assert got == Counter({(1, a, "x"): 1, (1, b, "x"): 1, (4, "c d", "x"): 1, (5, "", "x"): 2, (None, a, "x"): 1, (6, None, None): 1})
