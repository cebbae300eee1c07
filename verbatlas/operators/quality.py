"""Checks of stored tables against what they should hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.functions.distance import same_vector
from verbatlas.functions.ids import expected_ids
from verbatlas.operators.encode import Encoder, embed
from verbatlas.operators.ordering import zip_positions
from verbatlas.operators.sampling import sample_exact
from verbatlas.operators.sets import distinct_characters, reconcile
from verbatlas.session import materialise
from verbatlas.sources.tables import pick


def key_check(stored: DataFrame, count: int, item_id: str = "script_id") -> DataFrame:
    """Stored ids against the ids of ``0 .. count-1``: what is missing or unexpected."""
    return reconcile(expected_ids(stored.sparkSession, 0, count).select(item_id), stored, item_id)


def key_check_by_position(stored: DataFrame, count: int, item_id: str = "script_id") -> DataFrame:
    """The same check as two sorted lists compared place by place, to the longer end."""
    expected = expected_ids(stored.sparkSession, 0, count).select(item_id)
    return zip_positions(expected, stored.select(item_id), item_id, [item_id])


def sample_check(
    sample: DataFrame, info: DataFrame, vectors: DataFrame, encoder: Encoder, key: str = "script_id"
) -> DataFrame:
    """Encode original texts again and compare with what is stored, row by row.

    ``sample`` has the key and the original ``text``. A text passes the loose check when
    the numbers of distinct characters agree, and the strict one when it is equal.
    """
    fresh = embed(sample.select(key, F.col("text").alias("original")), encoder, "original", "fresh")
    stored = info.select(key, F.col("text").alias("stored")).join(vectors.select(key, "vector"), key)
    both = fresh.join(stored, key, "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    return both.select(
        key,
        yes(same_vector(F.col("fresh"), F.col("vector"))).alias("vector_ok"),
        yes(distinct_characters(F.col("original")) == distinct_characters(F.col("stored"))).alias("text_ok"),
        yes(F.col("original") == F.col("stored")).alias("text_equal"),
    )


def drawn_check(
    texts: DataFrame, info: DataFrame, vectors: DataFrame, encoder: Encoder, n: int, seed: int = 0, key: str = "script_id"
) -> DataFrame:
    """The check of ``n`` original texts drawn by the seeded hash of their keys, the same ones on every run.

    Only the drawn texts are encoded, and only their rows are looked up in the store.
    """
    drawn = materialise(sample_exact(texts.select(key, "text"), n, key, seed), "drawn")
    return sample_check(drawn, pick(info.select(key, "text"), drawn, key), pick(vectors.select(key, "vector"), drawn, key), encoder, key)


def tally(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.count("*").alias("n"),
        F.count_if("vector_ok").alias("vector_passed"),
        F.count_if("text_ok").alias("text_passed"),
        F.count_if("text_equal").alias("text_equal"),
        F.count_if(~(F.col("vector_ok") & F.col("text_ok"))).alias("failed"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))
