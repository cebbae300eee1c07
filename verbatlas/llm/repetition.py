"""Operator 5, quality rules: repetition coverage.

For each text, characters inside duplicated word n-grams of several lengths and inside duplicated lines
are measured against all characters in words. An n-gram or line is a duplicate if it has occurred
before in the same text; a word covered by several duplicates of one length counts once. n-grams are
compared by hashes of the words they hold, all texts of a slice at once in numpy, without a loop per
word. A text fails when one share is above its limit, or when it fails the base rule (too few words, or
more than half of them in three-word windows found twice).

Defined results: null and empty texts have no words and fail the base rule; equal texts get equal
results; a text of any length is taken whole; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from verbatlas.llm import tokens
from verbatlas.llm.tables import texts

# Largest share of the characters in words that may stand in repeated n-grams and in repeated lines.
# The limits published for this family of rules.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20
LEAST_WORDS = 50

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_NO_BREAK = np.ones(256, bool)
_NO_BREAK[0x0A] = False


def _per_text(docs: np.ndarray, values: np.ndarray | None, n: int) -> np.ndarray:
    """Whole numbers summed by text."""
    return np.bincount(docs, values, n).astype(np.int64)


def _repeats(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of items in the order of the texts: whether it is a later one of equal items, and whether it has an equal."""
    n = len(keys)
    later, shared = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        salted = keys ^ tokens.mix(docs.astype(np.uint64) + np.uint64(1))
        order = np.argsort(salted, kind="stable")
        same = salted[order][1:] == salted[order][:-1]
        later[order[1:][same]] = True
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
    return later, shared


def _covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in the n-grams that start at ``at``."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, at, 1)
    np.add.at(change, at + n, -1)
    return np.cumsum(change[:-1]) > 0


def measure(column: pa.Array, lengths: tuple = tuple(NGRAM_LIMITS)) -> dict[str, np.ndarray]:
    """All counts of every text of a column."""
    data, offsets = tokens.text_bytes(column)
    rows = len(column)
    starts, ends, docs = tokens.spans(data, offsets, tokens.VISIBLE)
    points = np.zeros(len(data) + 1, np.int64)  # code points before each byte
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    sizes = points[ends] - points[starts]
    prints = tokens.Fingerprints(data)
    words = prints.of(starts, ends)

    out = {"n_words": _per_text(docs, None, rows), "word_chars": _per_text(docs, sizes, rows)}
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(SYMBOLS[data], out=symbols[1:])
    out["n_symbols"] = symbols[offsets[1:]] - symbols[offsets[:-1]]

    # Lines: runs between line breaks that hold a word. An empty run holds none.
    first, last, owner = tokens.spans(data, offsets, _NO_BREAK)
    held = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last, owner = first[held], last[held], owner[held]
    later, _ = _repeats(prints.of(first, last), owner)
    out["n_dup_lines"] = _per_text(owner, later, rows)
    in_words = np.zeros(len(words) + 1, np.int64)
    np.cumsum(sizes, out=in_words[1:])
    chars = in_words[np.searchsorted(starts, last)] - in_words[np.searchsorted(starts, first)]
    out["line_chars"] = _per_text(owner, chars * later, rows)

    grams, at = tokens.ngrams(words, docs, 3)
    _, shared = _repeats(grams, docs[at])
    out["n_repeat_words"] = _per_text(docs, _covered(at[shared], 3, len(words)), rows)
    for n in lengths:
        grams, at = tokens.ngrams(words, docs, n)
        later, _ = _repeats(grams, docs[at])
        out[f"chars_{n}"] = _per_text(docs, sizes * _covered(at[later], n, len(words)), rows)
    return out


def verdict(m: dict[str, np.ndarray], limits: dict = NGRAM_LIMITS, line_limit: float = LINE_LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """``base_failed, kept`` of every text."""
    failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    good = m["line_chars"] <= line_limit * m["word_chars"]
    for n, limit in limits.items():
        good &= m[f"chars_{n}"] <= limit * m["word_chars"]
    return failed, good & ~failed


def coverage(docs: DataFrame, item_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All counts, ``base_failed`` and ``kept`` of every row, in one pass without a shuffle."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars"]
    counts += [f"chars_{n}" for n in NGRAM_LIMITS]
    names = ["id", *counts, "base_failed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "body"):
                found = measure(part.column("body"))
                columns = [part.column("id"), *[pa.array(found[c]) for c in counts], *map(pa.array, verdict(found))]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id long, {', '.join(f'{c} long' for c in counts)}, base_failed boolean, kept boolean"
    return texts(docs, item_id, text).mapInArrow(run, schema)
