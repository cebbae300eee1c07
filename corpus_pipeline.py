"""The training-data pipeline: filter, deduplicate, clean, mix and pack the documents.

Each stage takes the session, the documents its predecessor kept, and the folder of the other tables,
and returns documents with the same columns; the last returns the places of their pieces. Between two
stages the documents are written as Parquet and read again.

1. ``toxicity``: documents whose score is 0.7 or more go.
2. ``near_duplicates``: one row of each class of the n-gram Jaccard join stays, the one with the least id;
   among rows with this id and text the least by the other columns. Rows without a word or an id stay.
3. ``secrets``: every span found is replaced by a mark; ``n_chars`` follows where the length changes.
4. ``mixing``: each document is repeated as often as the mix takes it, which may be never.
5. ``packing``: the words of all copies are packed into sequences.

Nulls in any column, empty texts, repeated rows and empty tables are treated as the operators say;
no stage drops a row for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatlas.llm import mixing, ngram_join, packing, secrets, toxicity
from verbatlas.llm.tables import DOCUMENTS, read, word_count
from verbatlas.session import scratch_path, scratch_scope

TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(toxicity.with_labels(docs, read(spark, sf_dir, "labels")))
    return toxicity.keep_below(docs.select(*DOCUMENTS), model, TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*DOCUMENTS)
    classes = ngram_join.join(docs).where("class_key is not null")
    first = classes.groupBy("class_key").agg(F.min(F.struct("id", "digest")).alias("first"))
    first = first.select(F.col("first.id").alias("_id"), F.col("first.digest").alias("_digest"))
    told = docs.withColumn("_words", word_count(F.col("text")) > 0).withColumn("_text", ngram_join.body_digest(F.col("text")))
    # Copies of one text under one id are merged before they meet, so a hot one is reduced in every task.
    one = F.min(F.struct("text", *[c for c in DOCUMENTS if c not in ("doc_id", "text")])).alias("_row")
    found = told.where("_words and doc_id is not null").groupBy("doc_id", "_text").agg(one)
    found = found.join(first, (F.col("doc_id") == F.col("_id")) & (F.col("_text") == F.col("_digest")))
    found = found.select("doc_id", "_row.*").select(*DOCUMENTS)
    return found.union(told.where("not (_words and doc_id is not null)").select(*DOCUMENTS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*DOCUMENTS)
    clean = secrets.redact(docs.withColumn("_was", F.length("text")), secrets.model_of(docs))
    now = F.length("text")
    n_chars = F.when(now != F.col("_was"), now.cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars).select(*DOCUMENTS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*DOCUMENTS)
    mixed = mixing.apply(docs, mixing.plan(docs)).where("_mixed.copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mixed.copies")))
    return mixed.withColumn("_copy", copies).select(*DOCUMENTS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_texts(docs).withColumnRenamed("id", "doc_id")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# FTRL, Markov models and best-fit packing have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_scope(spark):  # what a stage wrote for itself goes when its result stands
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
