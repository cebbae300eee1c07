"""Whitening, periodic runs and language ID."""

import math
import random
import zlib
from decimal import Decimal

import brute
import numpy as np
import pyarrow as pa
import pytest

from verbatlas.llm import language, periods, queries, tokens, whitening

# --- whitening ---

RNG = np.random.default_rng(5)
ROTATION = np.linalg.qr(RNG.standard_normal((64, 64)))[0]
OTHER = np.linalg.qr(RNG.standard_normal((64, 64)))[0]
MATRICES = {
    "one column": RNG.standard_normal((30, 1)),
    "two columns": RNG.standard_normal((30, 2)),
    "normal": RNG.standard_normal((500, 64)),
    "wide": RNG.standard_normal((300, 150)),
    "graded": RNG.standard_normal((300, 64)) * np.logspace(0, -12, 64),
    "equal values": ROTATION * 3,
    "identity": np.eye(20),
    "groups of equal values": OTHER @ np.diag(np.r_[np.full(5, 2.0), np.full(59, 1.0)]) @ ROTATION,
    "close values": OTHER @ np.diag(np.r_[2 + 1e-13 * np.arange(5), 1 + 1e-12 * np.arange(59)]) @ ROTATION,
    "few rows": RNG.standard_normal((3, 64)),
    "one value": np.eye(10)[[2] * 4],
    "large": RNG.standard_normal((100, 12)) * 1e150,
    "small": RNG.standard_normal((100, 12)) * 1e-150,
}


@pytest.mark.parametrize("name", MATRICES)
def test_qd_solver(name):
    a = MATRICES[name]
    values, axes = whitening.directions(np.linalg.qr(a, mode="r"))
    true = np.linalg.svd(a, compute_uv=False)
    true = np.square(true[true > 1e-13 * true[0]] / true[0])[:8] * true[0] ** 2
    assert len(values) == len(true) and np.allclose(values, true, rtol=1e-12, atol=0)
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13
    b = a / np.sqrt(values[0])
    assert np.abs(b.T @ (b @ axes) - axes * (values / values[0])).max() < 1e-13


def test_qd_solver_without_rank():
    for a in (np.zeros((4, 3)), np.zeros((0, 3))):
        values, axes = whitening.directions(a)
        assert len(values) == 0 and axes.shape == (3, 0)


def plain_whitening(vectors):
    x = np.floor(1024 * np.array(vectors, float)).astype(int) + 100000
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    return centred @ axes / np.sqrt(values), values / np.square(centred).sum() * n, np.square(n * x - total).sum(axis=1)


def test_whitening_equals_the_eigenvectors_of_the_covariance(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    got = queries.op11_whitening(spark, folder).toPandas()
    assert len(got) == 8 * len(rows) and set(got.n) == {len(rows)}
    white, shares, deviations = plain_whitening(np.stack(rows.embedding))
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[rows.vec_id].to_numpy()
    signs = np.sign((table * white).sum(axis=0))
    assert np.abs(table * signs - white).max() < 1e-9
    assert np.allclose(got[got.vec_id == rows.vec_id[0]].sort_values("component").explained, shares, rtol=1e-10)
    exact = got.drop_duplicates("vec_id").set_index("vec_id").deviation
    assert (exact.loc[rows.vec_id].to_numpy() == deviations).all()
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10


def test_whitening_does_not_depend_on_the_partitions(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    one, many = whitening.fit(rows.coalesce(1)), whitening.fit(rows.repartition(40))
    a, b = one[64], many[64]
    assert a.n == b.n and (a.base == b.base).all() and (a.rest == b.rest).all()
    assert np.allclose(a.values, b.values, rtol=1e-12) and np.allclose(np.abs((a.axes * b.axes).sum(axis=0)), 1, atol=1e-12)


def test_whitening_of_odd_rows(spark):
    good = [[0.5, -0.25, 0.1], [0.1, 0.2, -0.3], [0.4, 0.9, 0.0], [0.4, 0.9, 0.0], [-0.1, 0.3, 0.7]]
    bad = [None, [0.1, None, 0.2], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1e300, 0.0, 0.0], []]
    rows = [(k if k else None, v, "x", "y", 1) for k, v in enumerate(good + bad)]
    rows += [(20 + k, v, "x", "y", 1) for k, v in enumerate([[1.0, 2.0], [3.0, 5.0], [2.0, 2.0]])]
    rows += [(30, [7.0], "x", "y", 1), (31, [7.0], "x", "y", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string, entries string, width int")
    fits = whitening.fit(df)
    got = whitening.whiten(df, fits).toPandas()
    errors = whitening.identity_errors(df, fits)
    three = got[got.width == 3]
    assert len(three) == 15 and set(three.n) == {5} and three.id.isna().sum() == 3 and errors[3] < 1e-12
    white, shares, deviations = plain_whitening(good)
    assert sorted(three[three.component == 1].deviation) == sorted(deviations.tolist())
    assert np.allclose(sorted(three.whitened.abs()), sorted(np.abs(white).ravel()), atol=1e-9)
    assert set(got[got.width == 2].id) == {20, 21, 22} and len(got[got.width == 2]) == 6
    assert not len(got[got.width == 1])  # equal rows have no direction
    none = df.limit(0)
    assert whitening.fit(none) == {} and whitening.whiten(none, {}).count() == 0 and whitening.whiten(df, {}).count() == 0


def test_deviations_are_exact_up_to_the_largest_long():
    x = np.array([[3_037_000_499, 0], [3_037_000_500, 0], [10**15, 5], [-4, 7]])
    f = whitening.Fit(1, np.zeros(2, np.int64), np.zeros(2, np.int64), np.zeros((2, 0)), np.zeros(0), np.zeros(0))
    exact, fits = f.deviations(x)
    assert fits.tolist() == [True, False, False, True]
    assert exact[fits].tolist() == [3_037_000_499**2, 65]


def test_large_entries_keep_their_sums(spark):
    rows = [(k, [2.0**50 + k, -(2.0**51)]) for k in range(300)]
    fits = whitening.fit(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    f, total = fits[2], sum(1024 * (2**50 + k) + 100000 for k in range(300))
    assert int(f.base[0]) * 300 + int(f.rest[0]) == total and len(f.values) == 1
    assert Decimal(int(f.base[1])) == -(2**61) + 100000 and int(f.rest[1]) == 0


# --- periodic runs ---


def found_runs(docs):
    names = sorted({w for d in docs for w in d})
    codes = tokens.mix(np.arange(len(names) + 1, dtype=np.uint64))
    words = np.array([codes[names.index(w)] for d in docs for w in d], np.uint64)
    offsets = np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype(np.int64)
    text, start, length, period = periods.find(words, offsets)
    return [list(zip(start[text == k].tolist(), length[text == k].tolist(), period[text == k].tolist())) for k in range(len(docs))]


@pytest.mark.parametrize("seed", range(30))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    docs = []
    for _ in range(8):
        w = []
        for _ in range(draw.randint(0, 5)):
            period = draw.choice([1, 2, 3, 5, 7, 8, 9, 10, 15, 16, 17, 20, 31, 32, 33, 40, 64, 65, 70])
            block = [draw.randint(0, draw.choice([1, 2, 60])) for _ in range(period)]
            w += (block * 7)[: draw.randint(0, 7 * period)]
        docs.append(w)
    assert found_runs(docs) == [brute.word_runs(w) for w in docs]


def test_runs_of_long_periods():
    draw = random.Random(9)
    block = [draw.randint(0, 400) for _ in range(700)]
    docs = [[1, 2] + block * 4 + [7], block * 3 + block[:-1], [5] * 3000, (block[:300] * 9)[:-1] + [-1]]
    assert found_runs(docs) == [[(2, 2800, 700)], [], [(0, 3000, 1)], [(0, 2699, 300)]]


def test_strings_known_for_their_repetitions():
    odd_even = [bin(i).count("1") % 2 for i in range(4096)]  # no cube at all
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a  # no fourth power
    nested = ([1, 2] * 20 + [3]) * 4
    assert found_runs([odd_even, b, nested]) == [[], [], brute.word_runs(nested)]
    assert len(brute.word_runs(nested)) == 5


def test_strongest_run_is_compared_exactly():
    n = 10**15
    best = periods.strongest(np.array([5, 3, 3]), np.array([4 * n + 1, 4 * n, 8 * n]), np.array([n, n, 2 * n]))
    assert best == 0
    assert periods.strongest(np.array([5, 3, 3]), np.array([8, 8, 16]), np.array([2, 2, 4])) == 1


def test_runs_of_odd_rows(odd, none):
    got = periods.runs(odd).collect()
    assert len(got) == odd.count() and periods.runs(none).count() == 0
    for r in got:
        text = {q.doc_id: q.text for q in odd.collect()}.get(r.id)
        w = brute.words(text)
        assert r.n_words == len(w) and [tuple(x) for x in r.runs] == brute.word_runs(w) if len(w) < 1000 else True
        assert r.collapsed == brute.collapsed(w, [tuple(x) for x in r.runs])
        assert (r.strongest is None) == (not r.runs)


def test_planted_periods_follow_the_rule(spark, folder, plain):
    got = {r.doc_id: r.text for r in queries.with_planted_periods(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    for i, text in plain:
        h = zlib.crc32(str(i).encode())
        w = brute.words(text)
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert got[i].split(" ") == [w[k if k < a else a + (k - a) % p] for k in range(n)]
        else:
            assert got[i] == text


# --- language ---

VOCABULARY = [b" a", b"ab", b"b", b"aba", b" ab", b"\xc3\xa9", b"ba"]


@pytest.fixture(scope="module")
def small_model():
    pieces = language.Pieces(VOCABULARY)
    uses = np.random.default_rng(1).random((2, len(pieces)))
    return language.Model(["x", "y"], pieces, (uses / uses.sum(axis=1, keepdims=True)).astype(np.float32))


@pytest.mark.parametrize("unit", ["ab", "ababab", "é", "abéba", "q"])
def test_scores_sum_all_segmentations(small_model, unit):
    raw = b" " + unit.encode()
    names = small_model.pieces.names
    ways = list(brute.segmentations(raw, names))
    true = [sum(math.prod(float(row[names.index(p)]) for p in way) for way in ways) for row in small_model.chances]
    logs = small_model.logs(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert np.allclose(logs[0], np.log(true), rtol=1e-12)


def test_training_expects_the_uses_of_all_segmentations(spark):
    rows = [("x", "abab ab"), ("x", "ab"), ("y", "ba é"), (None, "ab"), ("y", None)]
    model = language.train(spark.createDataFrame(rows, "lang string, text string"), VOCABULARY, rounds=1)
    names = model.pieces.names
    uses = np.zeros((2, len(names)))
    for k, units in enumerate(([b" abab", b" ab", b" ab"], [b" ba", " é".encode()])):
        for unit in units:
            ways = list(brute.segmentations(unit, names))
            chance = [len(names) ** -float(len(way)) for way in ways]
            for way, c in zip(ways, chance):
                for p in way:
                    uses[k, names.index(p)] += c / sum(chance)
    assert model.languages == ["x", "y"]
    assert np.allclose(model.chances, language._smoothed(uses), rtol=1e-3)
    assert np.allclose(model.chances.sum(axis=1), 1, atol=1e-5)


def test_languages_of_held_out_rows(spark, folder, documents):
    got = queries.op13_language(spark, folder).join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == documents.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out & (got.lang_pred != "und")]
    assert len(held) > 20 and (held.lang_pred == held.lang).mean() > 0.95


def test_languages_of_odd_rows(spark, odd, none):
    model = language.train(odd, VOCABULARY)
    assert model.languages == ["de", "en"]
    got = language.predict(odd, model).toPandas()
    assert len(got) == odd.count()
    pred = {None if r.id != r.id else int(r.id): r.lang_pred for r in got.itertuples()}
    assert pred[1] == pred[2] == pred[3] == "und" and pred[11] == "de" and pred[7] == "en" and None in pred
    assert set(got[got.lang_pred == "und"].score) == {0.0}
    assert language.predict(none, model).count() == 0
    digits = spark.createDataFrame([(1, "123 --- 4"), (2, "中"), (3, "a" * 100_000)], "doc_id long, text string")
    assert {r.id: r.lang_pred == "und" for r in language.predict(digits, model).collect()} == {1: True, 2: False, 3: False}
    nothing = language.train(none, VOCABULARY)
    assert nothing.languages == [] and {r.lang_pred for r in language.predict(odd, nothing).collect()} == {"und"}


def test_long_units_are_cut_and_never_underflow():
    data, starts, ends, docs = language._units(pa.array(["x" * 70 + " Yz", None, "é" * 20]))
    assert (ends - starts).tolist() == [31, 31, 8, 2, 31, 9] and docs.tolist() == [0, 0, 0, 0, 2, 2]
    pieces = language.Pieces([])
    model = language.Model(["x"], pieces, np.full((1, len(pieces)), language.FLOOR, np.float32))
    raw = b" " + b"x" * language.UNIT
    assert np.isfinite(model.logs(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))).all()
