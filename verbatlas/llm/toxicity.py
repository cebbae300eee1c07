"""Operator 1, toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

The features of a text are the hashes of its lower-cased words, of the first 4, 5 and 6 bytes of
longer words (a crude stem), of pairs of neighbouring words and of pairs with one word between. A
feature counts once per text. Learning uses a bounded sample of labelled rows (``Settings.rows``):
FTRL-proximal takes them one by one, with a rate of its own for every coordinate and an L1 term that
leaves most weights at exactly zero. The rest, at most ``Settings.weights`` of them, is broadcast, and
scoring is one pass over all texts without a shuffle.

Defined results: a null or empty text gets the score of the bias alone; rows without label, id or
text are not learned from; equal texts get equal scores; without any labelled row every score is 0.5;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.llm import tokens
from verbatlas.llm.tables import texts


@dataclass(frozen=True)
class Settings:
    rows: int = 6000  # most labelled rows to learn from: those with the smallest hash of the id
    passes: int = 3
    alpha: float = 1.0  # rate of a coordinate before its gradients are counted
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.01
    bits: int = 40  # of a feature's hash
    seen: int = 3  # texts of the sample that must hold a feature
    weights: int = 200_000  # most weights kept, the largest ones


@dataclass(frozen=True)
class Model:
    """Non-zero weights in the order of their features, and the bias: a few MB at most."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``text number, feature`` of every text, with repeats."""
    data, offsets = tokens.text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    starts, ends, docs = tokens.spans(data, offsets, tokens.LETTERS)
    prints = tokens.Fingerprints(data)
    words = prints.of(starts, ends)
    found, owners = [words], [docs]
    for size in (4, 5, 6):
        longer = np.flatnonzero(ends - starts > size)
        found.append(tokens.mix(prints.of(starts[longer], starts[longer] + size) + np.uint64(size)))
        owners.append(docs[longer])
    for skip in (0, 1):
        grams, at = tokens.ngrams(words, docs, 2, skip)
        found.append(grams)
        owners.append(docs[at])
    return np.concatenate(owners), np.concatenate(found) >> np.uint64(64 - bits)


def _featured(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tokens.slices(batch, "body"):
            docs, found = features(part.column("body"), bits)
            order = np.lexsort((found, docs))
            docs, found = docs[order], found[order]
            keep = np.ones(len(docs), bool)
            keep[1:] = (docs[1:] != docs[:-1]) | (found[1:] != found[:-1])
            docs, found = docs[keep], found[keep]
            at = np.searchsorted(docs, np.arange(part.num_rows + 1))
            blobs = [found[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            columns = [part.column("place"), part.column("label"), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["place", "label", "features"])


def _learn(rows: pd.DataFrame, s: Settings) -> pd.DataFrame:
    """FTRL-proximal over one bounded sample, in the order of the hash."""
    rows = rows.sort_values(["place", "label"], kind="stable")
    lists = [np.frombuffer(b, np.uint64) for b in rows.features]
    labels = rows.label.to_numpy(float)
    known, counts = np.unique(np.concatenate([*lists, np.zeros(0, np.uint64)]), return_counts=True)
    known = known[counts >= s.seen]
    ids = []
    for one in lists:
        at = np.searchsorted(known, one)
        at[at == len(known)] = 0
        ids.append(at[known[at] == one] + 1 if len(known) else np.zeros(0, np.int64))
    z, n = np.zeros(len(known) + 1), np.zeros(len(known) + 1)  # coordinate 0 is the bias
    positive = max(1.0, labels.sum())
    weight = np.where(labels > 0, min(4.0, max(1.0, (len(labels) - positive) / positive / 2)), 1.0)

    def weights(z, n, bias):
        l1 = np.full(len(z), s.l1)
        if bias:
            l1[0] = 0.0
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    for _ in range(s.passes):
        for k, at in enumerate(ids):
            at = np.concatenate(([0], at))
            zs, ns = z[at], n[at]
            w = weights(zs, ns, True)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = (p - labels[k]) * weight[k]
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / s.alpha * w
            n[at] = ns + g * g
    w = weights(z, n, True)
    some = np.flatnonzero(w[1:]) + 1
    some = np.sort(some[np.argsort(-np.abs(w[some]), kind="stable")[: s.weights]])
    out = [(-1, float(w[0])), *zip(known[some - 1].astype(np.int64).tolist(), w[some].tolist(), strict=True)]
    return pd.DataFrame(out, columns=["feature", "weight"])


def train(labelled: DataFrame, settings: Settings = Settings(), text: str = "text", label: str = "label", item_id: str = "doc_id") -> Model:
    """Fit on the rows of ``labelled`` (id, text, label 0 or 1), at most ``settings.rows`` of them."""
    known = labelled.select(
        F.xxhash64(F.col(item_id).cast("string")).alias("place"),
        F.col(label).cast("int").alias("label"),
        F.col(text).cast("string").alias("body"),
    ).where("place is not null and label in (0, 1) and body is not null")
    sample = known.orderBy("place", "label", F.xxhash64("body")).limit(settings.rows)
    bits = settings.bits
    blobs = sample.mapInArrow(lambda it: _featured(it, bits), "place long, label int, features binary")
    fitted = blobs.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(lambda rows: _learn(rows, settings), "feature long, weight double")
    rows = fitted.toPandas().sort_values("feature")
    bias = rows.weight[rows.feature == -1]
    rows = rows[rows.feature >= 0]
    return Model(rows.feature.to_numpy(np.uint64), rows.weight.to_numpy(float), float(bias.sum()))


def scores(column: pa.Array, model: Model, settings: Settings) -> np.ndarray:
    docs, found = features(column, settings.bits)
    total = np.full(len(column), model.bias)
    if len(model.features):
        # A table of 2**20 marks sends nearly all features away before the search among the weights.
        marks = np.zeros(1 << 20, bool)
        marks[(model.features & np.uint64(0xFFFFF)).astype(np.int64)] = True
        some = marks[(found & np.uint64(0xFFFFF)).astype(np.int64)]
        docs, found = docs[some], found[some]
        at = np.minimum(np.searchsorted(model.features, found), len(model.features) - 1)
        hit = model.features[at] == found
        pairs = np.unique(np.stack((docs[hit], at[hit])), axis=1)  # a feature counts once per text
        np.add.at(total, pairs[0], model.weights[pairs[1]])
    return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def score(docs: DataFrame, model: Model, settings: Settings = Settings(), item_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, score`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in tokens.slices(batch, "body"):
                out = pa.array(scores(part.column("body"), sent.value, settings))
                yield pa.RecordBatch.from_arrays([part.column("id"), out], ["id", "score"])

    return texts(docs, item_id, text).mapInArrow(run, "id long, score double")


def keep_below(docs: DataFrame, model: Model, limit: float, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below ``limit``, with all their columns, in one pass."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for part in tokens.slices(batch, batch.schema.names[at]):
                yield part.filter(pa.array(scores(part.column(at), sent.value, settings) < limit))

    return docs.mapInArrow(run, docs.schema)


def with_labels(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, text, label`` of the rows to learn from: those of two of three folds, bounded first.

    The third fold (crc32 of the id modulo 3 is 1) stays unseen. The bound is put on the small label
    table, so the join brings few texts.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    learn = labels.where((fold != 1) & F.col("toxic").isNotNull())
    learn = learn.select(F.col("doc_id").alias("known"), F.col("toxic").cast("int").alias("label"))
    learn = learn.orderBy(F.xxhash64(F.col("known").cast("string")), "label", "known").limit(settings.rows)
    body = docs.select("doc_id", "text")
    return body.join(F.broadcast(learn), body["doc_id"] == learn["known"]).select("doc_id", "text", "label")
