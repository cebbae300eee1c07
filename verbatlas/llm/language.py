"""Operator 13, language ID: unigram models of vocabulary pieces, summed over all segmentations.

A text is cut into units, runs of letters in lower case with a leading blank; a run of more than
``UNIT`` bytes makes several units. A model gives every piece of a fixed public vocabulary a probability per
language. The probability of a unit is the sum over all ways to put it together from pieces, which a
forward pass over its bytes adds up, and that of a text is the product over its units. Single bytes are
pieces, so every unit has a segmentation.

Training counts the units of all labelled texts per language, map side first, and then runs ``ROUNDS`` of
expectation and maximisation over the different units: forward and backward passes in tasks give the
expected number of uses of every piece, and only these, at most languages x vocabulary, are added up. Nothing
is sampled; the tables grow with the different units. The model (as many numbers) is broadcast; with
``LANGUAGES`` languages and 50,000 pieces it has 51 MB. Of more languages those with the most units are
learned. Prediction is one scan; each unit is worked out once per slice of texts.

Defined results: a text that is null, has no letter or meets a model without languages gets ``und`` and score
0; the score is the posterior probability of the language under equal priors, ties go to the language that
sorts first; equal texts get equal results; texts of any length are taken whole; null and repeated ids are all
returned; rows without a language or text teach nothing; an empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.llm import tokens
from verbatlas.llm.tables import texts
from verbatlas.session import materialise, spread

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
UNKNOWN = "und"
LONGEST = 16  # bytes of the longest piece used
UNIT = 31  # bytes of a unit behind its blank; with FLOOR no product leaves the range of a double
FLOOR = 1e-9
ROUNDS = 3
LANGUAGES = 256
PRIOR = 50.0  # uses of pieces as in all languages together, added to what a language shows
EVEN = 0.1  # share of the uniform distribution in those
SLICE_BYTES = 8 * 1024 * 1024
CELLS = 2_000_000  # numbers in the table of a forward pass
FRACTIONS = 1 << 20  # expected uses are added up in these parts, so that their order does not matter

_LETTERS = np.zeros(256, bool)
for _low, _high in ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _LETTERS[_low : _high + 1] = True


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """The pieces of a rank file (a base64 piece and its rank per line)."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class Pieces:
    """Pieces of a vocabulary, found in bytes by their fingerprints; single bytes are always among them."""

    def __init__(self, vocabulary: list[bytes], longest: int = LONGEST):
        self.names = sorted({p for p in vocabulary if 0 < len(p) <= longest} | {bytes([b]) for b in range(256)})
        self.lengths = sorted({len(p) for p in self.names})

    def __len__(self) -> int:
        return len(self.names)

    @cached_property
    def _table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(p) for p in self.names])
        ends = np.cumsum(sizes)
        prints = tokens.Fingerprints(np.frombuffer(b"".join(self.names), np.uint8)).of(ends - sizes, ends)
        order = np.argsort(prints)
        present = np.zeros(1 << 20, bool)
        present[prints >> np.uint64(44)] = True
        return prints[order], order, present

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}

    def matches(self, data: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``start, end, piece`` of all pieces in ``data`` that lie in one unit."""
        sorted_prints, order, present = self._table
        prints = tokens.Fingerprints(data)
        out = []
        for length in self.lengths:
            windows = prints.windows(length)
            at = np.flatnonzero(present[windows >> np.uint64(44)] & (unit[: len(windows)] == unit[length - 1 :]))
            place = np.searchsorted(sorted_prints, windows[at])
            hit = sorted_prints[np.minimum(place, len(order) - 1)] == windows[at]
            out.append((at[hit], at[hit] + length, order[place[hit]]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


class Lattice:
    """All pieces in some units, ordered for passes over all units at once, place by place."""

    def __init__(self, pieces: Pieces, data: np.ndarray, offsets: np.ndarray):
        self.sizes = np.diff(offsets)
        self.units = len(self.sizes)
        owner = np.repeat(np.arange(self.units), self.sizes)
        start, end, piece = pieces.matches(data, owner)
        unit = owner[start]
        start, end = start - offsets[unit], end - offsets[unit]
        order = np.argsort(end, kind="stable")
        self.unit, self.start, self.end, self.piece = unit[order], start[order], end[order], piece[order]
        self.most = int(self.sizes.max(initial=0))
        self.by_end = np.searchsorted(self.end, np.arange(1, self.most + 2))
        self.rows = np.arange(self.units)

    def forward(self, chances: np.ndarray) -> np.ndarray:
        """Probability of the bytes before each place, as (place, unit); ``chances`` per match."""
        sums = np.zeros((self.most + 1, self.units))
        sums[0] = 1.0
        for place in range(1, self.most + 1):
            some = slice(self.by_end[place - 1], self.by_end[place])
            weight = sums[self.start[some], self.unit[some]] * chances[some]
            sums[place] = np.bincount(self.unit[some], weight, self.units)
        return sums

    def backward(self, chances: np.ndarray) -> np.ndarray:
        """Probability of the bytes behind each place."""
        order = np.argsort(self.start, kind="stable")
        bounds = np.searchsorted(self.start[order], np.arange(self.most + 1))
        sums = np.zeros((self.most + 1, self.units))
        sums[self.sizes, self.rows] = 1.0
        for place in range(self.most - 1, -1, -1):
            some = order[bounds[place] : bounds[place + 1]]
            weight = sums[self.end[some], self.unit[some]] * chances[some]
            sums[place] += np.bincount(self.unit[some], weight, self.units)
        return sums

    def totals(self, sums: np.ndarray) -> np.ndarray:
        return sums[self.sizes, self.rows]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    pieces: Pieces
    chances: np.ndarray  # (language, piece)

    def logs(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(unit, language) logarithms of the probabilities of some units."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        step = max(1, CELLS // (UNIT + 2))
        for low in range(0, len(out), step):
            high = min(low + step, len(out))
            first, last = offsets[low], offsets[high]
            lattice = Lattice(self.pieces, data[first:last], offsets[low : high + 1] - first)
            for k, row in enumerate(self.chances):
                out[low:high, k] = np.log(lattice.totals(lattice.forward(row[lattice.piece])))
        return out


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``data, starts, ends, texts`` of the units of a text column, in lower case, without their blanks."""
    data, offsets = tokens.text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    starts, ends, docs = tokens.spans(data, offsets, _LETTERS)
    parts = -(-(ends - starts) // UNIT)
    if (parts > 1).any():
        place = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, docs = np.repeat(starts, parts) + place * UNIT, np.repeat(docs, parts)
        ends = np.minimum(starts + UNIT, np.repeat(ends, parts))
    return data, starts, ends, docs


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column in a row, and the offset of each value."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, blank: bool) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some units one after another, each behind a blank or not, and their offsets."""
    sizes = ends - starts + blank
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts + blank, sizes)
    out = data[np.maximum(at, 0)]
    if blank:
        out[offsets[:-1]] = 0x20
    return out, offsets


def count_units(docs: DataFrame, language: str = "lang", text: str = "text") -> DataFrame:
    """``lang, unit, n``: how often each unit occurs in the texts of a language; ``unit`` with its blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "body", SLICE_BYTES):
                data, starts, ends, docs = _units(part.column("body"))
                coded = part.column("lang").dictionary_encode()
                names, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)[docs]
                keys = tokens.Fingerprints(data).of(starts, ends) ^ tokens.mix(codes.astype(np.uint64) + np.uint64(1))
                _, first, n = np.unique(keys, return_index=True, return_counts=True)
                units, offsets = _gather(data, starts[first], ends[first], True)
                buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(units)]
                unit = pa.Array.from_buffers(pa.binary(), len(first), buffers)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(codes[first])), unit, pa.array(n, pa.int64())], ["lang", "unit", "n"])

    known = docs.where(F.col(language).isNotNull() & F.col(text).isNotNull())
    known = spread(known.select(F.col(language).cast("string").alias("lang"), F.col(text).cast("string").alias("body")))
    parts = known.mapInArrow(run, "lang string, unit binary, n long")
    return parts.groupBy("lang", "unit").agg(F.sum("n").alias("n"))


def _smoothed(uses: np.ndarray) -> np.ndarray:
    """Probabilities from expected uses; a piece that one language lacks gets a share of what all show."""
    totals = uses.sum(axis=1, keepdims=True)
    common = (uses / np.maximum(totals, 1.0)).mean(axis=0)
    common = (1.0 - EVEN) * common / max(common.sum(), 1e-300) + EVEN / uses.shape[1]
    return np.maximum((uses + PRIOR * common) / (totals + PRIOR), FLOOR)


def train(docs: DataFrame, vocabulary: list[bytes] | None = None, language: str = "lang", text: str = "text", rounds: int = ROUNDS) -> Model:
    """Learn from all rows that have a language and a text."""
    spark = docs.sparkSession
    pieces = Pieces(read_vocabulary() if vocabulary is None else vocabulary)
    counted = materialise(count_units(docs, language, text), "units")
    ranked = counted.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    languages = sorted((r["lang"] for r in ranked), key=str.encode)
    if not languages:
        return Model([], pieces, np.zeros((0, len(pieces)), np.float32))
    chances = np.full((len(languages), len(pieces)), 1.0 / len(pieces))
    number = {name: k for k, name in enumerate(languages)}
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((pieces, number, chances.astype(np.float32)))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            pieces, number, chances = shared.value
            uses: dict[int, np.ndarray] = {}
            step = max(1, CELLS // (UNIT + 2))
            for batch in batches:
                for name in pc.unique(batch.column("lang")).to_pylist():
                    k = number.get(name)
                    if k is None:
                        continue
                    rows = batch.filter(pc.equal(batch.column("lang"), name))
                    total = uses.setdefault(k, np.zeros(len(pieces)))
                    for low in range(0, rows.num_rows, step):
                        part = rows.slice(low, step)
                        data, offsets = _bytes(part.column("unit"))
                        lattice = Lattice(pieces, data, offsets)
                        own = chances[k].astype(float)[lattice.piece]
                        ahead, behind = lattice.forward(own), lattice.backward(own)
                        weight = part.column("n").to_numpy() / lattice.totals(ahead)
                        use = ahead[lattice.start, lattice.unit] * own * behind[lattice.end, lattice.unit] * weight[lattice.unit]
                        total += np.bincount(lattice.piece, use, len(pieces))
            for k, total in uses.items():
                seen = np.flatnonzero(total)
                parts = np.rint(total[seen] * FRACTIONS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), k)), pa.array(seen), pa.array(parts)], ["k", "piece", "parts"])

        found = counted.mapInArrow(expect, "k long, piece long, parts long")
        # At most one row per language and piece.
        rows = found.groupBy("k", "piece").agg(F.sum(F.col("parts").cast("decimal(38,0)")).cast("double").alias("parts")).toArrow()
        uses = np.zeros_like(chances)
        uses[rows["k"].to_numpy(), rows["piece"].to_numpy()] = rows["parts"].to_numpy() / FRACTIONS
        chances = _smoothed(uses)
        shared.unpersist()
    return Model(languages, pieces, chances.astype(np.float32))


def predict(docs: DataFrame, model: Model, item_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, lang_pred, score`` of every row, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for part in tokens.slices(batch, "body", SLICE_BYTES):
                rows = part.num_rows
                lettered = part.column("lettered").to_numpy(zero_copy_only=False) & bool(model.languages)
                best, score = np.full(rows, len(model.languages)), np.zeros(rows)
                data, starts, ends, docs = _units(part.column("body"))
                if lettered.any() and len(docs):
                    keys = tokens.Fingerprints(data).of(starts, ends)
                    _, first, each = np.unique(keys, return_index=True, return_inverse=True)
                    logs = model.logs(*_gather(data, starts[first], ends[first], True))
                    sums = np.stack([np.bincount(docs, column[each], rows) for column in logs.T], axis=1)
                    top = sums.argmax(axis=1)
                    chance = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                    best, score = np.where(lettered, top, best), np.where(lettered, chance, 0.0)
                columns = [part.column("id"), pa.array(names[best].tolist(), pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "lang_pred", "score"])

    lettered = F.coalesce(F.col("body").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    return texts(docs, item_id, text).select("id", "body", lettered).mapInArrow(run, "id long, lang_pred string, score double")
