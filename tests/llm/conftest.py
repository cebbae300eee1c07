import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

PROSE = "the quick brown fox jumps over a lazy dog while rain falls on seven grey roofs and nobody hears the small clock strike"
LONG = " ".join(f"{w}{k % 97}" for k in range(6000) for w in ("alpha", "beta", "gamma"))


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").cache()


@pytest.fixture(scope="session")
def plain(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n ", None, None, 4),
        (4, PROSE, "en", "a", None),
        (4, PROSE, "en", "a", None),
        (5, PROSE, "en", "b", len(PROSE)),
        (6, PROSE + " again.", "en", "b", 1),
        (7, LONG, "en", "c", 1),
        (8, LONG, "en", "c", 1),
        (None, PROSE, None, None, None),
        (9, "one two", "en", "a", 7),
        (10, "two one", "en", "a", 7),
        (11, "ünïcödé 漢字 😀 token = 'abcDEF123456'", "de", "é", 30),
    ]
    clash = ("id", "key", "body", "size", "member", "place", "row", "_mixed", "kept", "n", "label", "weight")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clash)
    return spark.createDataFrame([r + ("x",) * len(clash) for r in rows], schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
