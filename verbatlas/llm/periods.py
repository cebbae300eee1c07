"""Operator 12, periodic run detection in the words of a text by multi-scale minimizers.

A run is a stretch of words with smallest period ``q`` and at least ``max(6, 4 q)`` words that no neighbour
extends keeping that period. Words are runs of anything but ASCII white space, compared by fingerprints.

Scale ``w`` (16, 32, ...) looks for the periods above ``w / 2`` up to ``w``. Strings of ``w`` words are hashed,
the hash of twice the length from two of half of it, and a place is kept where its hash is the least of some
``w`` consecutive places. Inside a run the strings at ``q`` consecutive places differ, so the least of them
comes again just ``q`` words on: two consecutive kept places with equal hashes at a distance of the scale are
a seed. Seeds of a run overlap and merge, and are extended on the words themselves to both sides; a stretch
whose first period is itself periodic belongs to a smaller one. Periods of at most 8 words are too short
for that and are scanned for directly, lag by lag. All texts of a slice are worked off at once; a scale takes
only the texts that are long enough for it. Every run is found, whatever the text holds.

Defined results: a null or empty text has no words and no runs; a text of any length is taken whole; equal
texts get equal results; null and repeated ids and repeated rows are all returned; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from verbatlas.llm import tokens
from verbatlas.llm.tables import texts

SHORTEST = 6  # words of a run
COPIES = 4  # periods in a run
DIRECT = 8  # longest period that is scanned for lag by lag; half of the first scale

SCHEMA = (
    "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "strongest struct<start: long, length: long, period: long>, collapsed string"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _least_words(period: int) -> int:
    return max(SHORTEST, COPIES * period)


def _sliding(values: np.ndarray, size: int, better: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every ``size`` consecutive values, from running ones of blocks."""
    n = len(values)
    if n < size:
        return values[:0]
    blocks = np.pad(values, (0, -n % size), mode="edge").reshape(-1, size)
    ahead = better.accumulate(blocks, axis=1).ravel()
    behind = better.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return better(behind[: n - size + 1], ahead[size - 1 : n])


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of true values."""
    change = np.diff(np.concatenate(([0], same.view(np.int8), [0])))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def _primitive(block: np.ndarray) -> bool:
    """Whether a period is not itself made of equal parts."""
    n, rest, p = len(block), len(block), 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            part = n // p
            if np.array_equal(block[part:], block[:-part]):
                return False
            while rest % p == 0:
                rest //= p
        p += 1
    return True


def _agreeing(words: np.ndarray, at: int, stop: int, period: int, step: int) -> int:
    """How many places from ``at`` towards ``stop`` hold the word that stands a period further on."""
    done, size = 0, 64
    total = (stop - at) * step
    while done < total:
        size = min(size, total - done)
        low = at + done if step > 0 else at - done - size + 1
        same = words[low : low + size] == words[low + period : low + period + size]
        if not same.all():
            return done + int((~same if step > 0 else ~same[::-1]).argmax())
        done, size = done + size, size * 2
    return total


def _from_seeds(words: np.ndarray, first: int, last: int, period: int, seeds: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """Stretches ``start, end`` of one text with a period, around places where strings of ``width`` words repeat."""
    cuts = np.flatnonzero(np.diff(seeds) > width) + 1
    done = first
    for part in np.split(seeds, cuts):
        low, high = int(part[0]), int(part[-1]) + width  # lags of these places agree
        if high <= done:
            continue
        if not np.array_equal(words[low:high], words[low + period : high + period]):
            # Different strings with one hash: the whole text is compared at this lag.
            for a, b in zip(*_stretches(words[first : last - period] == words[first + period : last]), strict=True):
                yield first + int(a), first + int(b) + period
            return
        low -= _agreeing(words, low - 1, first - 1, period, -1)
        high += _agreeing(words, high, last - period, period, 1)
        done = high
        yield low, high + period


def find(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``text, start, length, period`` of every run of some texts, in the order of the texts, starts and periods.

    ``words`` are the fingerprints of all words, ``offsets`` where each text begins in them.
    """
    found: set[tuple[int, int, int]] = set()
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)

    def add(low: int, high: int, period: int) -> None:
        if high - low >= _least_words(period) and _primitive(words[low : low + period]):
            found.add((low, high, period))

    for period in range(1, DIRECT + 1):
        if len(words) > period:
            same = (words[period:] == words[:-period]) & (owner[period:] == owner[:-period])
            starts, ends = _stretches(same)
            long = ends - starts >= _least_words(period) - period
            for low, high in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
                add(low, high + period, period)

    hashes, places, width = tokens.mix(words), np.arange(len(words)), 1
    while len(hashes) > width:
        with np.errstate(over="ignore"):
            hashes = tokens.mix(hashes[:-width] * np.uint64(0x9E3779B97F4A7C15) + hashes[width:])
        places, width = places[: len(hashes)], 2 * width
        if width <= DIRECT:
            continue
        # Four periods of this scale are more than two widths.
        large = sizes[owner[places]] > 2 * width
        if not large.any():
            break
        if np.count_nonzero(large) < 0.7 * len(large):
            hashes, places = hashes[large], places[large]
        lowest = _sliding(hashes, width, np.minimum)
        around = np.zeros(width - 1, np.uint64)
        kept = np.flatnonzero(_sliding(np.concatenate((around, lowest, around)), width, np.maximum) == hashes) if len(lowest) else []
        if not len(kept):
            continue
        order = kept[np.argsort(hashes[kept], kind="stable")]
        a, b = order[:-1], order[1:]
        lag = places[b] - places[a]
        seed = (hashes[a] == hashes[b]) & (owner[places[a]] == owner[places[b]]) & (lag > width // 2) & (lag <= width)
        if not seed.any():
            continue
        at, lag = places[a[seed]], lag[seed]
        order = np.lexsort((at, lag, owner[at]))
        at, lag = at[order], lag[order]
        text = owner[at]
        cuts = np.flatnonzero((np.diff(lag) != 0) | (np.diff(text) != 0)) + 1
        for part in np.split(np.arange(len(at)), cuts):
            k, period = int(text[part[0]]), int(lag[part[0]])
            for low, high in _from_seeds(words, int(offsets[k]), int(offsets[k + 1]), period, at[part], width):
                add(low, high, period)

    rows = np.array(sorted((low, q, high) for low, high, q in found), np.int64).reshape(-1, 3)
    text = np.searchsorted(offsets, rows[:, 0], side="right") - 1
    return text, rows[:, 0] - offsets[text], rows[:, 2] - rows[:, 0], rows[:, 1]


def strongest(starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> int:
    """The run with the most periods, exactly; the first of equal ones."""
    values = zip(starts.tolist(), lengths.tolist(), periods.tolist(), strict=True)
    ranked = [(-Fraction(length, period), start, period, i) for i, (start, length, period) in enumerate(values)]
    return min(ranked)[3]


def _collapsed(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> pa.Array:
    """The given words of every text, joined by single spaces."""
    follows = np.zeros(len(docs), bool)
    follows[:-1] = docs[1:] == docs[:-1]
    mask = np.zeros(len(data) + 1, np.int8)
    np.add.at(mask, starts, 1)
    np.add.at(mask, ends + follows, -1)  # with the white space behind a word that another follows
    kept = np.cumsum(mask[:-1]).astype(bool)
    out = data.copy()
    out[ends[follows]] = 0x20
    places = np.concatenate(([0], np.cumsum(kept)))[offsets].astype(np.int64)
    buffers = [None, pa.py_buffer(places), pa.py_buffer(out[kept])]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers).cast(pa.string())


def _batch(part: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = tokens.text_bytes(part.column("body"))
    starts, ends, docs = tokens.spans(data, offsets, tokens.VISIBLE)
    prints = tokens.Fingerprints(data).of(starts, ends)
    at = np.searchsorted(docs, np.arange(part.num_rows + 1))
    text, start, length, period = find(prints, at)

    gone = np.zeros(len(docs) + 1, np.int64)
    low = at[text] + start
    np.add.at(gone, low + period, 1)
    np.add.at(gone, low + length, -1)
    kept = np.cumsum(gone[:-1]) == 0
    collapsed = _collapsed(data, offsets, starts[kept], ends[kept], docs[kept])

    each = np.searchsorted(text, np.arange(part.num_rows + 1))
    runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], fields=list(_RUN))
    best = [
        None if a == b else a + strongest(start[a:b], length[a:b], period[a:b])
        for a, b in zip(each[:-1].tolist(), each[1:].tolist(), strict=True)
    ]
    columns = [
        part.column("id"),
        pa.array(np.diff(at), pa.int64()),
        pa.ListArray.from_arrays(pa.array(each, pa.int32()), runs),
        runs.take(pa.array(best, pa.int64())),
        collapsed,
    ]
    return pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "strongest", "collapsed"])


def runs(docs: DataFrame, item_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_words, runs, strongest, collapsed`` of every text.

    ``runs`` are ordered by start and period; ``strongest`` is the one with the most periods (null without
    runs); ``collapsed`` leaves out each word that a run contains after its first period.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "body"):
                yield _batch(part)

    return texts(docs, item_id, text).mapInArrow(run, SCHEMA)
