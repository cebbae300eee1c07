"""NumPy helpers for the texts of one Arrow batch: bytes, words and hashes, without a loop per word.

A batch is worked off in slices of bounded size (`slices`), so memory depends on the slice
and on the longest single text, never on the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 * 1024 * 1024

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
VISIBLE = ~SPACES  # the bytes of [^\x20\x09-\x0D]+

# Bytes of a word for the language models: ASCII letters and digits and all of UTF-8 beyond ASCII.
LETTERS = np.zeros(256, bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    LETTERS[_low : _high + 1] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(size: int) -> None:
    """Tables of base**i and base**-i modulo 2**64, as long as the longest slice so far."""
    global _powers, _inverses
    if size <= len(_powers):
        return
    size = max(size, 1 << 16)
    _powers = np.full(size, _BASE, np.uint64)
    _inverses = np.full(size, _INVERSE, np.uint64)
    _powers[0] = _inverses[0] = 1
    np.cumprod(_powers, out=_powers)
    np.cumprod(_inverses, out=_inverses)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection), so that any bits of them may be compared or cut off."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Fingerprints:
    """64-bit fingerprints of any substring of ``data`` after one pass over it."""

    def __init__(self, data: np.ndarray):
        _grow(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * _powers[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * _inverses[starts])

    def windows(self, length: int) -> np.ndarray:
        """Of every window of ``length`` bytes, by its start."""
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * _inverses[:n]) if n > 0 else np.zeros(0, np.uint64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in a row, and the offset of each text; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch after about ``limit`` bytes of one column; a single row is never cut."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths.astype(np.int64)) // limit
    at = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *at.tolist()], [*at.tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes in the table ``inside`` that do not cross texts: start, end, text number."""
    mask = inside[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # the first byte of a text, and the place behind the last one
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = mask[:-1]
    starts = np.flatnonzero(mask & (~before | first[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = mask[1:]
    ends = np.flatnonzero(mask & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def ngrams(words: np.ndarray, docs: np.ndarray, n: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` following words of one text (every ``skip + 1``-th), and where each starts."""
    reach = (n - 1) * (skip + 1)
    if len(words) <= reach:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = len(words) - reach
    with np.errstate(over="ignore"):
        seed = (n * 0x632BE59BD9B4E019 + skip * 0xD6E8FEB86659FD93) % (1 << 64)
        total = np.full(size, seed, np.uint64)
        for k in range(n):
            total = total * np.uint64(_BASE) + words[k * (skip + 1) : k * (skip + 1) + size]
    at = np.flatnonzero(docs[:size] == docs[reach:])
    return mix(total[at]), at


def strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())
