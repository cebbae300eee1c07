import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verbatlas.functions import blocks
from verbatlas.functions import distance as D
from verbatlas.functions import ids, text


def _one(spark, value, function):
    return spark.createDataFrame([(value,)], "v string").select(function(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "given_text, expected",
    [
        ("well-known!", "well known"),
        ("a" + " " * 5 + "b", "a" + " " * 2 + "b"),
        ("a" + " " * 24 + "b", "a b"),
        ("[Music] so: (yes)", " Music so yes "),
        ("one. two", "one.two"),
        ("x_y;z", "x y z"),
        (" -- ", " "),
    ],
)
def test_punctuation(spark, given_text, expected):
    assert _one(spark, given_text, text.normalise_punctuation) == expected


def test_caption_and_query(spark):
    assert _one(spark, 'a\n"b" c', text.clean_caption) == "a  b  c"
    assert _one(spark, "what_is_this", text.normalise_query) == "what is this"


def test_quote_repair(spark):
    assert _one(spark, '"a","x "y" z","1.5","2"', text.repair_quotes) == '"a","x  y  z","1.5","2"'


@pytest.mark.parametrize("seconds, plain, padded", [("3725.9", "62:5", "62:05"), ("5.0", "0:5", "00:05")])
def test_time_labels(spark, seconds, plain, padded):
    assert _one(spark, seconds, lambda c: text.time_label(c, padded=False)) == plain
    assert _one(spark, seconds, text.time_label) == padded


def test_urls(spark):
    assert _one(spark, "https://youtu.be/dQw4w9WgXcQ", text.share_id) == "dQw4w9WgXcQ"
    assert _one(spark, "https://h/c/name", text.normalise_url) == "https://h/user/name"
    assert _one(spark, "https://h/c/na%20me", text.normalise_url) is None


def test_keys(spark):
    assert _one(spark, "7", text.cluster_key) == "c7"
    assert _one(spark, "7", lambda c: text.cluster_key(c, 2)) == "cc7"
    assert _one(spark, "c7", lambda c: text.chunk_key(c, F.lit(3))) == "c7_b3"


def test_id_goldens(spark):
    rows = ids.expected_ids(spark, 0, 3).collect()
    assert [r.script_id for r in rows] == ["00009ix", "0q4psly", "1g9fboz"]


def test_ids_are_a_bijection(spark):
    n = ids.SPACE
    spread = spark.range(0, 20000).select((F.col("id") * 3_918_207 % n).alias("ordinal"))
    edges = spark.createDataFrame([(x,) for x in (n - 1, n, n + 1, 5 * n + 7, 40 * n)], "ordinal long")
    df = spread.unionByName(edges).distinct().withColumn("script_id", ids.encode_id(F.col("ordinal")))
    df = df.withColumn("back", ids.decode_id(F.col("script_id"))).toPandas()
    assert (df.ordinal == df.back).all() and df.script_id.is_unique
    assert (df.script_id.str.len() >= 7).all() and (df.ordinal.lt(n) == df.script_id.str.len().eq(7)).all()
    assert _one(spark, "no id!", ids.decode_id) is None


GOLDENS = {
    "euclidean": 2.23607,
    "sqeuclidean": 5,
    "cityblock": 3,
    "chebyshev": 2,
    "minkowski": 2.08008,
    "braycurtis": 0.2,
    "canberra": 0.66667,
    "cosine": 0.05705,
    "correlation": 0.5,
    "hamming": 0.66667,
    "jensenshannon": 0.11984,
}


@pytest.mark.parametrize("metric, expected", GOLDENS.items())
def test_metric_goldens(spark, metric, expected):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [2.0, 4.0, 3.0])], "a array<double>, b array<double>")
    got = df.select(D.distance(F.col("a"), F.col("b"), metric, p=3.0)).first()[0]
    assert got == pytest.approx(expected, abs=6e-6)
    x, y = np.array([[1.0, 2.0, 3.0]]), np.array([[2.0, 4.0, 3.0]])
    assert blocks.row_distance(x, y, metric, 3.0)[0] == pytest.approx(expected, abs=6e-6)


def test_metric_edges(spark):
    df = spark.createDataFrame([([0.0, 0.0], [0.0, 0.0], [-1.0, 2.0])], "z array<double>, y array<double>, n array<double>")
    z, y, n = F.col("z"), F.col("y"), F.col("n")
    row = df.select(
        D.canberra(z, y), D.cosine(z, n), D.braycurtis(z, y), D.jensenshannon(n, n), D.same_vector(n, n)
    ).first()
    assert row[0] == 0.0 and row[1] is None and row[2] is None and row[3] is None and row[4] is True
    with pytest.raises(ValueError):
        D.distance(z, y, "nothing")


vectors = st.lists(st.floats(-100, 100, allow_nan=False, width=32), min_size=6, max_size=6)


@settings(max_examples=50, deadline=None)
@given(a=vectors, b=vectors, metric=st.sampled_from(["euclidean", "sqeuclidean", "cityblock", "chebyshev", "hamming", "canberra"]))
def test_metric_properties(a, b, metric):
    x, y = np.array([a]), np.array([b])
    there, back = blocks.row_distance(x, y, metric)[0], blocks.row_distance(y, x, metric)[0]
    assert there == back and there >= 0 and blocks.row_distance(x, x, metric)[0] == 0


@settings(max_examples=50, deadline=None)
@given(seed=st.integers(0, 10_000), metric=st.sampled_from(["euclidean", "cosine", "cityblock"]), scale=st.sampled_from([1e-3, 1.0, 1e4]))
def test_screening_never_changes_the_winner(seed, metric, scale):
    rng = np.random.default_rng(seed)
    data, refs = rng.normal(size=(40, 5)) * scale, rng.normal(size=(9, 5)) * scale
    refs[4] = refs[1]  # a tie: the first one must win
    best, dist = blocks.nearest_ref(data, refs, metric)
    full = np.array([[blocks.row_distance(d[None], r[None], metric)[0] for r in refs] for d in data])
    assert (best == full.argmin(axis=1)).all() and np.array_equal(dist, full.min(axis=1))


def test_vector_width_is_checked():
    import pyarrow as pa

    with pytest.raises(ValueError):
        blocks.to_matrix(pa.array([[1.0, 2.0], [1.0]]))


def test_keep_first_orders_groups():
    group = np.array([1, 0, 1, 1, 0])
    value = np.array([3.0, 1.0, 1.0, 2.0, 0.5])
    kept = blocks.keep_first(group, [value], 2)
    assert [(group[i], value[i]) for i in kept] == [(0, 0.5), (0, 1.0), (1, 1.0), (1, 2.0)]
    assert math.isclose(sum(value[kept]), 4.5)
