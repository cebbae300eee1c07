"""The queries opN_<name>: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatlas.llm import (
    chaining,
    html_text,
    language,
    mixing,
    ngram_join,
    packing,
    periods,
    pigeonhole,
    repetition,
    secrets,
    suffixes,
    toxicity,
    whitening,
)
from verbatlas.llm.tables import WORD, read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = toxicity.train(toxicity.with_labels(docs, read(spark, folder, "labels")))
    scored = toxicity.score(docs, model)
    held_out = F.coalesce(F.crc32(F.col("id").cast("string")) % 3 == 1, F.lit(False))
    predicted = (F.col("score") >= 0.7).cast("int")
    return scored.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "score", predicted.alias("predicted"))


@query
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken, "rate", "copies")


@query
def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.join(read(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", "representative")


@query
def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(read(spark, folder, "pages")).withColumnRenamed("id", "page_id")


@query
def op5_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.coverage(read(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_texts(read(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query
def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return secrets.scan(docs, secrets.model_of(docs)).withColumnRenamed("id", "doc_id")


@query
def op8_pigeonhole(spark: SparkSession, folder: str) -> DataFrame:
    return pigeonhole.near(read(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op9_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.dedup(read(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query
def op10_chaining(spark: SparkSession, folder: str) -> DataFrame:
    found = chaining.passages(read(spark, folder, "documents"))
    return found.withColumnsRenamed({"id": "doc_id", "partner": "partner_id"})


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings")
    fits = whitening.fit(rows)
    errors = whitening.identity_errors(rows, fits)
    error = F.lit(None).cast("double")
    for width, value in errors.items():
        error = F.when(F.col("width") == width, F.lit(value)).otherwise(error)
    out = whitening.whiten(rows, fits)
    names = ["component", "n", "deviation", "whitened", "explained"]
    return out.select(F.col("id").alias("vec_id"), *names, error.alias("identity_error"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """The documents as the contract has them read: every tenth one, by a hash of its id, repeats its end.

    A null id plants nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    planted = docs.withColumn("_h", h).withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
    n, g = F.size("_w"), F.floor(F.col("_h") / 10)
    planted = planted.withColumn("_n", n).withColumn("_a", F.when(n > 0, (g % n).cast("int")))
    period = 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + g % 8))
    planted = planted.withColumn("_p", period.cast("int"))
    a, p = F.col("_a"), F.col("_p")
    place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
    moved = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.get("_w", place(i)))
    text = F.when(F.col("_n") > 0, F.array_join(moved, " ")).otherwise(F.col("text"))
    return planted.select("doc_id", text.alias("text"))


@query
def op12_periods(spark: SparkSession, folder: str) -> DataFrame:
    found = periods.runs(with_planted_periods(read(spark, folder, "documents")))
    best = F.col("strongest")
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op13_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    found = language.predict(docs, language.train(docs.where(~held_out)))
    return found.withColumnRenamed("id", "doc_id").withColumn("held_out", held_out)
