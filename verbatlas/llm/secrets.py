"""Operator 7, secret scans: character Markov models of random strings and of ordinary identifiers.

Three plain patterns find assignments, access keys and long hexadecimal runs. Beside them every run of
[A-Za-z0-9+/_=-] of 16 characters or more, outside of those spans, is scored by two first-order
Markov models of its characters: one trained on random strings, one on ordinary identifiers. It counts
as a secret if the log-likelihood ratio is above a threshold, in sum and per character.

Labelled samples: the words of a bounded number of different texts, as they stand, in capitals and joined in
camel case, as paths and as names of constants, and decimal numbers and times as ordinary identifiers; random strings, drawn by hashing numbers, in four alphabets; own labelled rows can be given to ``train``. A
model is a table of 65 x 65 log probabilities, whatever the size of the corpus.

Defined results: null and empty texts have no spans; equal texts have equal spans; offsets count code
points of the whole text, ends are exclusive; without ordinary samples all bigrams are equally likely;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.llm import tokens
from verbatlas.llm.tables import texts

KINDS = ("assign", "access", "hex", "markov")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODES = np.zeros(128, np.int64)
_CODES[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio of every pair of characters, and the thresholds."""

    ratio: np.ndarray
    total: float = 16.0
    mean: float = 1.0


def random_strings(df: DataFrame) -> DataFrame:
    """``string, label = 1``: digests of the numbers in ``id``, written in four alphabets."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    base64 = F.base64(F.unhex(digest))
    text = (
        F.when(F.col("id") % 4 == 0, F.substring(digest, 1, 40))
        .when(F.col("id") % 4 == 1, F.substring(base64, 1, 40))
        .when(F.col("id") % 4 == 2, F.regexp_replace(F.substring(base64, 1, 40), "[+/=]", ""))
        .otherwise(F.upper(F.regexp_replace(F.substring(base64, 1, 40), "[+/=]", "")))
    )
    return df.select(text.alias("string"), F.lit(1).alias("label"))


def ordinary_words(docs: DataFrame, rows: int = 500, text: str = "text") -> DataFrame:
    """``string, label = 0``: the words of at most ``rows`` different texts, those with the smallest hash, as
    they stand, in capitals, in camel case, and joined as paths and names of constants are.

    Words with a digit, and what stands behind a colon or an equals sign, may be secrets and are left out.
    """
    some = docs.select(F.col(text).cast("string").alias("body")).where("body is not null")
    some = some.withColumn("place", F.xxhash64("body"))
    last = some.select("place").distinct().orderBy("place").limit(rows).agg(F.max("place")).first()[0]
    some = some.where(F.col("place") <= F.lit(last))
    some = some.groupBy("place").agg(F.min("body").alias("body"))  # equal texts teach once
    found = F.regexp_extract_all("body", F.lit(r"(?:^|[\s])([A-Za-z_-]{4,})(?=[\s.,;]|$)"), 1)
    words = some.select(F.explode(found).alias("string"))
    low, high = F.lower("string"), F.upper("string")
    forms = [
        F.col("string"), high, F.concat("string", F.initcap("string")), F.concat_ws("_", high, high), F.concat_ws("_", low, low),
        F.concat(F.lit("/"), low, F.lit("/"), low), F.concat_ws("-", low, low), F.concat(low, F.length("string").cast("string")),
    ]
    return words.select(F.explode(F.array(*forms)).alias("string"), F.lit(0).alias("label"))


def ordinary_numbers(df: DataFrame) -> DataFrame:
    """``string, label = 0``: a decimal number and a time, as ordinary records carry them, for each ``id``."""
    number = F.abs(F.xxhash64("id"))
    when = F.timestamp_seconds(F.pmod(number, F.lit(2_000_000_000)))
    forms = F.array(number.cast("string"), *[F.date_format(when, p) for p in ("yyyy-MM-dd", "yyyy_MM_dd_HH_mm_ss", "yyyyMMdd-HHmmss")])
    return df.select(F.explode(forms).alias("string"), F.lit(0).alias("label"))


def train(samples: DataFrame, total: float = 16.0, mean: float = 1.0) -> Model:
    """Count neighbouring characters per label; 2 x 65 x 65 counts at most come back."""
    size = len(ALPHABET)

    def pairs(batches):
        for batch in batches:
            counts = np.zeros((2, size, size), np.int64)
            for string, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                known = [ALPHABET.find(c) for c in string or ""]
                if label in (0, 1) and len(known) > 1 and min(known) >= 0:
                    np.add.at(counts[label], (known[:-1], known[1:]), 1)
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.reshape(-1)[at])], ["cell", "n"])

    counted = samples.select("string", "label").mapInArrow(pairs, "cell long, n long")
    rows = counted.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.full(2 * size * size, 0.2)
    counts[rows.cell.to_numpy(np.int64)] += rows.n.to_numpy(float)
    logs = np.log(counts.reshape(2, size, size))
    logs -= np.log(np.exp(logs).sum(2, keepdims=True))
    return Model(logs[1] - logs[0], total, mean)


def model_of(docs: DataFrame, text: str = "text", strings: int = 4000) -> Model:
    spark = docs.sparkSession
    drawn = random_strings(spark.range(0, strings, 1, 4))
    numbers = ordinary_numbers(spark.range(0, strings, 1, 4))
    return train(drawn.unionByName(ordinary_words(docs, text=text)).unionByName(numbers))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the plain patterns."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def score(strings: list[str], model: Model) -> np.ndarray:
    """Log-likelihood ratio in sum of every string of two or more characters of the alphabet."""
    codes = _CODES[np.frombuffer("".join(strings).encode("ascii"), np.uint8)]
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    ends = np.cumsum(lengths)
    steps = np.zeros(len(codes))
    steps[1:] = model.ratio[codes[:-1], codes[1:]]
    steps[ends - lengths] = 0.0  # no step from one string to the next
    return np.add.reduceat(steps, ends - lengths)


def find(texts_: list[str | None], model: Model) -> list[list[tuple[int, int, int]]]:
    """All spans of every text, base ones and those of the models, in order."""
    found = [base_spans(t or "") for t in texts_]
    strings, owners = [], []
    for k, text in enumerate(texts_):
        for m in _CANDIDATE.finditer(text or ""):
            if all(m.end() <= a or m.start() >= b for a, _, b in found[k]):
                strings.append(m[0])
                owners.append((k, m.start(), m.end()))
    if strings:
        sums = score(strings, model)
        lengths = np.fromiter(map(len, strings), float, len(strings))
        for i in np.flatnonzero((sums >= model.total) & (sums >= model.mean * lengths)):
            k, start, end = owners[i]
            found[k].append((start, 3, end))
    return [sorted(f) for f in found]


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, model: Model, item_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_assign, n_access, n_hex, n_markov, base_sha256, spans`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    counts = [f"n_{k}" for k in KINDS]
    schema = f"id long, {', '.join(f'{c} long' for c in counts)}, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "body"):
                found = find(part.column("body").to_pylist(), sent.value)
                columns = [part.column("id")]
                columns += [pa.array([sum(s[1] == k for s in f) for f in found], pa.int64()) for k in range(len(KINDS))]
                base = [listed([s for s in f if s[1] < 3]) for f in found]
                columns.append(tokens.strings([hashlib.sha256(b.encode()).hexdigest() for b in base]))
                columns.append(tokens.strings([listed(f) for f in found]))
                yield pa.RecordBatch.from_arrays(columns, ["id", *counts, "base_sha256", "spans"])

    return texts(docs, item_id, text).mapInArrow(run, schema)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every span, or run of overlapping spans, replaced."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The same rows and columns with the secrets in ``text`` replaced; null stays null."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, text):
                values = part.column(at).to_pylist()
                found = find(values, sent.value)
                new = [v if v is None else redacted(v, f) for v, f in zip(values, found, strict=True)]
                columns = list(part.columns)
                columns[at] = tokens.strings(new)
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return docs.mapInArrow(run, docs.schema)
