"""Every registered query against its SQL; the others against what must hold for them."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, folder, duck, name):
    got = QUERIES[name](spark, folder).toPandas()
    assert difference(got, duck.execute(SQL[name]).df()) is None


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0


def test_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_kmeans_places_every_vector_once(spark, folder):
    rows = QUERIES["kmeans_mllib"](spark, folder).toPandas()
    assert rows.vec_id.is_unique and len(rows) == 500 and rows.cluster_id.nunique() <= 10


def test_ensemble_covers_growing_prefixes(spark, folder):
    rows = QUERIES["ensemble_chunks"](spark, folder).toPandas()
    assert rows.groupby("chunk_no").size().tolist() == [100, 200, 300, 400, 500]
    assert (rows.groupby("chunk_no").label.nunique() <= 5).all()


def test_draws_repeat_and_stay_inside(spark, folder):
    rows = QUERIES["with_replacement"](spark, folder).toPandas()
    assert len(rows) == 100 and rows.draw.is_unique and rows.ordinal.between(0, 199).all()


def test_silhouette_is_a_score(spark, folder):
    assert QUERIES["silhouette"](spark, folder).toPandas().silhouette.between(-1, 1).all()
