"""Text to vector: an encoder is anything that turns a text column into a vector column."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from verbatlas.functions import blocks
from verbatlas.operators.versions import read_latest, versions, write_version
from verbatlas.session import broadcast_if_small, materialise, spread

# Tokens are runs of letters and digits.
TOKEN_BREAK = r"[^\p{L}\p{N}]+"

# Bytes of text that the hashed encoder cuts into words at once.
SLICE_BYTES = 8 * 1024 * 1024


class Encoder(Protocol):
    dim: int

    def column(self, text: Column) -> Column: ...


class HashedEncoder:
    """Signed bag of words: every token adds +1 or -1 to one of ``dim`` components.

    Works on slices of Arrow batches of about ``SLICE_BYTES`` of text, so memory does not grow with the
    batch: the texts are cut by one vectorised call, each distinct word of a slice is hashed
    once, and one ``bincount`` adds everything up.
    The row stays in its partition; no tokens are exploded or shuffled.
    """

    def __init__(self, dim: int = 64):
        self.dim = dim

    def column(self, text: Column) -> Column:
        dim = self.dim

        def some(texts: pa.Array) -> np.ndarray:
            words = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), pattern=TOKEN_BREAK)
            used = words.flatten().dictionary_encode()
            hashes = np.array([_hash(w) for w in used.dictionary.to_pylist()], dtype=np.int64)
            signs = np.where((hashes // dim) % 2 == 0, 1.0, -1.0) * (hashes >= 0)
            at = used.indices.to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy(zero_copy_only=False)))
            cells = np.bincount(rows * dim + (hashes % dim)[at], weights=signs[at], minlength=len(texts) * dim)
            matrix = cells.reshape(len(texts), dim)
            length = np.sqrt(np.square(matrix).sum(axis=1, keepdims=True))
            return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)

        @arrow_udf("array<double>")
        def encode(texts: pa.Array) -> pa.Array:
            parts = [some(texts.slice(low, high - low)) for low, high in _slices(texts)]
            return blocks.to_lists(np.concatenate(parts) if parts else np.zeros((0, dim)))

        return _once(encode)(text)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE_BYTES`` together; a longer text is a range of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low, before = 0, 0
    while low < len(ends):
        high = max(low + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield low, high
        low, before = high, int(ends[high - 1])


def _once(udf):
    """Keep the optimizer from copying the call into filters on its result.

    Encoding is the dearest step; a null check pushed below the projection would run
    it a second time for every row.
    """
    return udf.asNondeterministic()


def _hash(word: str) -> int:
    """First seven hex digits of the MD5; -1 for the empty piece beside a break."""
    return int(hashlib.md5(word.encode()).hexdigest()[:7], 16) if word else -1


class ModelEncoder:
    """Any model with a batch call ``model(list[str]) -> (n, dim)``; loaded once per task."""

    def __init__(self, load: Callable[[], Callable[[Sequence[str]], np.ndarray]], dim: int):
        self.load, self.dim = load, dim

    def column(self, text: Column) -> Column:
        load, dim = self.load, self.dim

        @arrow_udf("array<double>")
        def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = load()
            for part in parts:
                texts = part.to_pylist()
                matrix = np.asarray(model(texts), dtype=np.float64) if texts else np.zeros((0, dim))
                yield blocks.to_lists(matrix.reshape(len(texts), dim))

        return _once(run)(text)


def embed(df: DataFrame, encoder: Encoder, text: str = "text", vector: str = "vector") -> DataFrame:
    """Append the vector of every text; rows without a text are left out."""
    usable = df.filter(F.col(text).isNotNull() & (F.col(text) != ""))
    return usable.withColumn(vector, encoder.column(F.col(text)))


def text_digest(text: str = "text") -> Column:
    return F.sha2(F.col(text).cast("binary"), 256)


def encode_missing(rows: DataFrame, path: str, encoder: Encoder, text: str = "text") -> int:
    """Encode the texts that the store at ``path`` does not hold yet, each different text once; how many.

    The store is keyed by the digest of the text, so a repeated text, a later build and a backfill find the
    vector that is there. Only digests are compared with the store; texts move only if they are new.
    """
    spark = rows.sparkSession
    usable = rows.filter(F.col(text).isNotNull() & (F.col(text) != "")).select(text_digest(text).alias("digest"), F.col(text).alias("text"))
    wanted = materialise(usable.select("digest").distinct(), "wanted")
    missing = materialise(wanted.join(stored_vectors(spark, path).select("digest"), "digest", "left_anti"), "missing")
    count = missing.count()
    if count:
        new = usable.join(broadcast_if_small(missing, 128), "digest", "left_semi")
        once = spread(materialise(new.groupBy("digest").agg(F.min("text").alias("text")), "texts"))
        vectors = embed(once, encoder).select("digest", "vector")
        number = F.lit(max(versions(spark, path), default=-1) + 1)
        write_version(vectors.withColumn("delivery", number), path, "delivery", ["digest"])
    return count


def stored_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``digest, vector`` of every text encoded so far."""
    return read_latest(spark, path, "delivery", "digest string, vector array<double>, delivery int").drop("delivery")


def with_vectors(rows: DataFrame, path: str, text: str = "text", vector: str = "vector") -> DataFrame:
    """The rows whose text is in the store, with its vector."""
    found = stored_vectors(rows.sparkSession, path).withColumnRenamed("vector", vector)
    return rows.withColumn("digest", text_digest(text)).join(found, "digest").drop("digest")


def count_unusable(df: DataFrame, text: str = "text") -> DataFrame:
    return df.agg(
        F.count("*").alias("n"),
        F.count_if(F.col(text).isNull()).alias("n_null"),
        F.count_if(F.col(text) == "").alias("n_empty"),
    )
