"""Operator 9, suffix-array dedup: blockwise suffix sorting with a difference cover.

A byte is removed if a string of ``length`` bytes that covers it starts at another place, too. Two
suffixes matter to each other only if they share that many bytes, so any function of a suffix's first
``length`` bytes may name its bucket. Here it is the least hash among the ``ANCHOR``-byte strings in
them: neighbouring suffixes mostly share it, so a run of suffixes with one anchor travels as one piece,
and buckets are small and even, which those by leading bytes are not.

1. One pass cuts every text into pieces (anchor, fingerprint of the piece, place). Anchors that occur
   once are dropped; equal pieces are repeats as a whole and count as one from here on.
2. For anchors with several different pieces, one copy of each piece is fetched and the pieces are dealt
   to tasks by anchor. A task sorts block after block of whole buckets. First the cover sample is
   ranked: the places p with p mod 64 in a difference cover, by the ``length - 64`` bytes from there.
   Then all suffixes of the block are sorted by their first and last 64 bytes, and ties, the long ones,
   are resolved by the ranks of the sample at the least shift that puts both suffixes on the cover. So
   memory is a few numbers per suffix of one block.
3. Buckets with more than ``BUCKET`` different pieces, as a string makes that very many texts share, are
   cut again by what stands beside the anchor, in halves, until each is small or holds one piece.

Orders are those of 64-bit fingerprints, not alphabetic: repeats need equal prefixes side by side, no
more. Strings are taken for equal when the fingerprints of head, tail and sample agree.

Defined results: null and empty texts have no bytes; matches never cross texts; repeated rows are
repeats of each other; rows are told apart by id and text, so ids may be null or repeated; other
columns are not looked at. A text of more than 256 MB raises.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.llm import tokens
from verbatlas.llm.tables import texts
from verbatlas.session import materialise

LENGTH = 400
ANCHOR = 24
PERIOD = 64  # of the difference cover, a square
BLOCK_BYTES = 1024 * 1024
SLICE_BYTES = 1024 * 1024
BUCKET = 2000

_PLACE_BITS = np.uint64(28)


def difference_cover(period: int) -> np.ndarray:
    """Numbers below k*k whose differences reach every residue: 0..k-1 and the multiples of k."""
    k = int(period**0.5)
    return np.unique(np.concatenate((np.arange(k), np.arange(0, period, k))))


def shifts(period: int) -> np.ndarray:
    """For residues i and j, the least d that puts both i + d and j + d on the cover."""
    cover = np.zeros(period, bool)
    cover[difference_cover(period)] = True
    d = np.arange(period)
    out = np.zeros((period, period), np.int64)
    for i in range(period):
        both = cover[(i + d) % period] & cover[(np.arange(period)[:, None] + d) % period]
        out[i] = np.argmax(both, axis=1)
    return out


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from running minima inside blocks of that width."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def pieces(column: pa.Array, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Runs of suffixes with one anchor: ``text, start, suffixes, anchor hash, fingerprint``."""
    data, offsets = tokens.text_bytes(column)
    nothing = np.zeros(0, np.int64)
    if len(data) < length:
        return nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    prints = tokens.Fingerprints(data)
    grams = prints.windows(anchor)
    place = np.arange(len(grams), dtype=np.uint64)
    mask = np.uint64((1 << int(_PLACE_BITS)) - 1)
    if len(grams) > int(mask):
        raise ValueError("a single text may have 256 MB at most")
    least = window_minima((grams & ~mask) | place, length - anchor + 1)  # the first of equal ones
    owner = np.repeat(np.arange(len(column)), np.diff(offsets))[: len(least)]
    valid = np.arange(len(least)) + length <= offsets[1:][owner]
    first = valid.copy()
    first[1:] &= (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(first)
    sizes = np.add.reduceat(valid.astype(np.int64), starts) if len(starts) else nothing
    at = (least[starts] & mask).astype(np.int64)
    print_ = prints.of(starts, starts + sizes + length - 1)
    return owner[starts], starts - offsets[owner[starts]], sizes, grams[at], print_


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Pieces of every text; equal ones of a text, as periodic text has by the hundred, share a row."""
    names = ["anchor", "piece", "id", "key", "n", "starts"]
    for batch in batches:
        for part in tokens.slices(batch, "body", SLICE_BYTES):
            owner, start, sizes, anchors, prints = pieces(part.column("body"), length)
            order = np.lexsort((start, prints, anchors, owner))
            owner, start, sizes, anchors, prints = (x[order] for x in (owner, start, sizes, anchors, prints))
            new = np.ones(len(owner), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (anchors[1:] != anchors[:-1]) | (prints[1:] != prints[:-1])
            first = np.flatnonzero(new)
            bounds = pa.array(np.append(first, len(owner)), pa.int32())
            rows = pa.array(owner[first])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchors[first].view(np.int64)), pa.array(prints[first].view(np.int64)),
                    part.column("id").take(rows), part.column("key").take(rows), pa.array(sizes[first]),
                    pa.ListArray.from_arrays(bounds, pa.array(start, pa.int64())),
                ],
                names,
            )


def repeated(bodies: list[bytes], sizes: np.ndarray, buckets: np.ndarray, length: int = LENGTH, period: int = PERIOD) -> np.ndarray:
    """Which suffixes of the pieces of one block have an equal in their bucket, as a mask over all bytes.

    Piece k has ``sizes[k]`` suffixes, those at its first ``sizes[k]`` bytes.
    """
    data = np.frombuffer(b"".join(bodies), np.uint8)
    lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    owner = np.repeat(np.arange(len(bodies)), lengths)
    inside = np.arange(len(data)) - offsets[owner]
    suffix = np.flatnonzero(inside < sizes[owner])
    prints = tokens.Fingerprints(data)

    # Ranks of the cover sample.
    reach = length - period
    on = np.zeros(period, bool)
    on[difference_cover(period)] = True
    sample = np.flatnonzero(on[np.arange(len(data)) % period] & (inside + reach <= lengths[owner]))
    _, ranks = np.unique(prints.of(sample, sample + reach), return_inverse=True)
    rank = np.full(len(data) + period, -1, np.int32)
    rank[sample] = ranks

    # Sort by bucket, head and tail; what ties is compared with the first of its class.
    head, tail = prints.of(suffix, suffix + period), prints.of(suffix + reach, suffix + length)
    key = tokens.mix(tokens.mix(head ^ tokens.mix(buckets[owner[suffix]].astype(np.uint64))) + tail)
    order = np.argsort(key, kind="stable")
    key, at = key[order], suffix[order]
    out = np.zeros(len(data), bool)
    shift = shifts(period)
    while len(at) > 1:
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(new)
        leader = first[np.cumsum(new) - 1]
        d = shift[at % period, at[leader] % period]
        equal = rank[at + d] == rank[at[leader] + d]
        own = np.arange(len(at)) == leader
        out[at[equal & ~own]] = True
        out[at[leader[equal & ~own]]] = True
        rest = ~equal & ~own
        key, at = key[rest], at[rest]
    return out


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    change = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def _sorted_blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """``anchor, piece, low, high``: the repeated suffixes of every piece; rows of a bucket follow each other."""

    def done(rows: list) -> pa.RecordBatch:
        anchors = np.array([r[0] for r in rows], np.int64)
        bodies = [r[3] for r in rows]
        mask = repeated(bodies, np.array([r[2] for r in rows], np.int64), anchors, length)
        ends = np.cumsum([len(b) for b in bodies])
        low, high = _runs(mask)  # a run ends with its piece: the last bytes of a piece start no suffix
        at = np.searchsorted(ends, low, side="right")
        base = ends[at] - np.array([len(b) for b in bodies])[at] if len(at) else at
        names = pa.array([r[1] for r in rows], kind).take(pa.array(at))
        columns = [pa.array(anchors[at]), names, pa.array(low - base), pa.array(high - base)]
        return pa.RecordBatch.from_arrays(columns, ["anchor", "piece", "low", "high"])

    rows, size, last, kind = [], 0, None, pa.int64()
    for batch in batches:
        kind = batch.column("piece").type
        columns = (batch.column(c).to_pylist() for c in ("anchor", "piece", "n", "bytes"))
        for row in zip(*columns, strict=True):
            if size >= BLOCK_BYTES and row[0] != last:
                yield done(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[3])
            last = row[0]
    if rows:
        yield done(rows)


_RECUT = "of_anchor long, of_piece long, base long, anchor long, piece long, n long, place long, low long, high long, bytes binary"
_RECUT_NAMES = [field.split()[0] for field in _RECUT.split(", ")]


def _halves(rows: list[tuple], length: int) -> Iterator[tuple]:
    """Pieces of one bucket cut once more, by where the anchor stands in the windows of their suffixes.

    A row allows the anchor at the places ``low .. high - 1`` of a window. Windows of either half share
    the bytes around the anchor that lie in all windows of that half, so the fingerprint of these names
    the new bucket. Equal windows hold their anchor at one place and get one bucket.
    """
    for of_anchor, of_piece, base, anchor, _, n, place, low, high, data in rows:
        middle = (low + high) // 2
        prints = tokens.Fingerprints(np.frombuffer(data, np.uint8))
        for a, b in ((low, middle), (middle, high)):
            first, last = max(0, place - b + 1), min(n, place - a + 1)  # suffix j has the anchor at place - j
            if first >= last:
                continue
            ends = np.array([place - a, first]), np.array([place + length - b + 1, last + length - 1])
            context, piece = prints.of(*ends)
            key = np.array([anchor, a, b], np.int64).view(np.uint64)
            key = tokens.mix(tokens.mix(tokens.mix(key[:1] ^ context) + key[1:2]) + key[2:3])
            body = data[first : last + length - 1]
            yield (
                of_anchor, of_piece, base + first, int(key.view(np.int64)[0]), int(np.uint64(piece).view(np.int64)),
                last - first, place - first, a, b, body,
            )


def _recut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(_halves(list(zip(*(c.to_pylist() for c in batch.columns), strict=True)), length))
        if rows:
            yield _batch(rows, _RECUT_NAMES)


def _anchored(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Fetched pieces as rows that may be cut again: the anchor is the least of the first window."""
    mask = np.uint64((1 << int(_PLACE_BITS)) - 1)
    for batch in batches:
        rows = []
        for anchor, piece, n, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "piece", "n", "bytes")), strict=True):
            grams = tokens.Fingerprints(np.frombuffer(data[:length], np.uint8)).windows(ANCHOR)
            place = int(((grams & ~mask) | np.arange(len(grams), dtype=np.uint64)).argmin())
            rows.append((anchor, piece, 0, anchor, piece, n, place, 0, length - ANCHOR + 1, data))
        if rows:
            yield _batch(rows, _RECUT_NAMES)


def _large_buckets(fetched: DataFrame, length: int, width: int) -> DataFrame:
    """``anchor, piece, low, high``: the repeated suffixes of pieces in buckets too large for one task.

    Such a bucket is cut in two, and those of its parts that are still too large again. Of a string that very
    many texts share, only the windows around its middle stay together from one round to the next, so a
    piece makes a row or two more per round, and after as many rounds as halve a window's places, nine
    of them, a bucket holds one string.
    """
    found = None
    rest = fetched.mapInArrow(lambda it: _anchored(it, length), _RECUT)
    while True:
        cut = materialise(rest.mapInArrow(lambda it: _recut(it, length), _RECUT), "recut")
        often = cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("anchor")
        kept = cut.join(often, "anchor", "left_semi")
        # Equal pieces are repeats as a whole; one of them stays for the others of the bucket.
        same = kept.drop("bytes").groupBy("anchor", "piece").agg(
            F.count(F.lit(1)).alias("times"), F.min(F.struct("of_anchor", "of_piece", "base")).alias("one")
        )
        same = materialise(same, "same")
        kinds = same.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
        kinds = materialise(kinds.where("kinds > 1"), "kinds")
        copies = kept.join(same.where("times > 1").select("anchor", "piece"), ["anchor", "piece"])
        whole = copies.select("of_anchor", "of_piece", "base", (F.col("base") + F.col("n")).alias("end"))
        firsts = same.join(kinds, "anchor").select("anchor", "piece", "one.*", "kinds")
        firsts = kept.join(firsts, ["anchor", "piece", "of_anchor", "of_piece", "base"])
        small = firsts.where(F.col("kinds") <= BUCKET).repartition(width, "anchor").sortWithinPartitions("anchor", "piece")
        sorted_ = small.select("anchor", F.struct("of_anchor", "of_piece", "base").alias("piece"), "n", "bytes")
        sorted_ = sorted_.mapInArrow(
            lambda it: _sorted_blocks(it, length), "anchor long, piece struct<of_anchor: long, of_piece: long, base: long>, low long, high long"
        )
        base = F.col("piece.base")
        sorted_ = sorted_.select("piece.of_anchor", "piece.of_piece", (base + F.col("low")).alias("base"), (base + F.col("high")).alias("end"))
        part = materialise(whole.union(sorted_), "found")
        found = part if found is None else found.union(part)
        if kinds.where(F.col("kinds") > BUCKET).isEmpty():
            return found.toDF("anchor", "piece", "low", "high")
        rest = materialise(firsts.where(F.col("kinds") > BUCKET).select(*_RECUT_NAMES), "large")


def _fetch(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted pieces of each text."""
    names = ["anchor", "piece", "n", "large", "bytes"]
    for batch in batches:
        found: list[tuple] = []
        for body, wanted in zip(batch.column("body").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            data = (body or "").encode()
            found += [(w["anchor"], w["piece"], w["n"], w["large"], data[w["start"] : w["start"] + w["n"] + length - 1]) for w in wanted]
            if len(found) > 4000:
                yield _batch(found, names)
                found = []
        if found:
            yield _batch(found, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.binary())], names)


def _merged(ranges: list, size: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted((r["low"], min(r["high"], size)) for r in ranges or []):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _removed(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", *(["kept"] if keep_text else [])]
    for batch in batches:
        for part in tokens.slices(batch, "body"):
            rows = []
            for body, ranges in zip(part.column("body").to_pylist(), part.column("ranges").to_pylist(), strict=True):
                data, at, kept = (body or "").encode(), 0, []
                spans = _merged(ranges, len(data))
                for low, high in spans:
                    kept.append(data[at:low])
                    at = high
                rest = b"".join([*kept, data[at:]])
                gone = len(data) - len(rest)
                rows.append((len(data), gone, len(spans), hashlib.sha256(rest).hexdigest(), [f"{a}:{b}" for a, b in spans], rest))
            sizes, gone, n, digest, spans, rest = zip(*rows, strict=True)
            columns = [part.column("id"), *[pa.array(c, pa.int64()) for c in (sizes, gone, n)]]
            columns += [tokens.strings(list(digest)), tokens.strings([",".join(s) for s in spans])]
            columns += [pa.array(rest, pa.binary())] if keep_text else []
            yield pa.RecordBatch.from_arrays(columns, names)


def repeated_ranges(plain: DataFrame, length: int = LENGTH) -> DataFrame:
    """``id, key, ranges``: the bytes to remove of each text that has any, as arrays of ``low, high``."""
    spark = plain.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "anchor long, piece long, id long, key long, n long, starts array<long>"
    cut = plain.mapInArrow(lambda it: _cut(it, length), schema)
    often = cut.groupBy("anchor").agg(F.sum(F.size("starts")).alias("times")).where("times > 1").select("anchor")
    cut = materialise(cut.join(often, "anchor", "left_semi"), "pieces")

    one = F.min(F.struct("id", "key", F.col("starts")[0].alias("start"), "n")).alias("one")
    distinct = cut.groupBy("anchor", "piece").agg(F.sum(F.size("starts")).alias("times"), one)
    distinct = materialise(distinct, "distinct")
    several = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    large = (F.col("kinds") > BUCKET).cast("long").alias("large")
    wanted = distinct.join(several, "anchor").select("anchor", "piece", large, "one.*")

    fetched = materialise(_bytes_of(plain, wanted, length), "bytes")
    small = fetched.where("large = 0").repartition(width, "anchor").sortWithinPartitions("anchor", "piece")
    found = small.mapInArrow(lambda it: _sorted_blocks(it, length), "anchor long, piece long, low long, high long")
    whole = distinct.where("times > 1").select("anchor", "piece", F.lit(0).cast("long").alias("low"), F.col("one.n").alias("high"))
    found = found.union(whole)
    large = fetched.where("large = 1")
    if not large.isEmpty():
        found = found.union(_large_buckets(large, length, width))

    marked = cut.join(found, ["anchor", "piece"]).select("id", "key", "low", "high", F.explode("starts").alias("start"))
    at = (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high") + length - 1).alias("high")
    return marked.groupBy("id", "key").agg(F.collect_set(F.struct(*at)).alias("ranges"))


def _bytes_of(plain: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``anchor, piece, n, large, bytes``: each text comes once, with all that is wanted of it."""
    lists = wanted.groupBy("id", "key").agg(F.collect_list(F.struct("anchor", "piece", "start", "n", "large")).alias("wanted"))
    lists = lists.withColumnsRenamed({"id": "of", "key": "of_key"})
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    fetched = plain.join(lists, same).select("body", "wanted")
    return fetched.mapInArrow(lambda it: _fetch(it, length), "anchor long, piece long, n long, large long, bytes binary")


def dedup(docs: DataFrame, item_id: str = "doc_id", text: str = "text", length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256, spans`` of every row; ``keep_text`` adds the bytes left.

    ``spans`` lists the maximal runs of removed bytes as ``start:end``.
    """
    plain = texts(docs, item_id, text).withColumn("key", F.xxhash64(F.coalesce("body", F.lit(""))))
    ranges = repeated_ranges(plain, length).withColumnsRenamed({"id": "of", "key": "of_key"})
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    both = plain.join(ranges, same, "left").select("id", "body", "ranges")
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans string"
    return both.mapInArrow(lambda it: _removed(it, keep_text), schema + (", kept binary" if keep_text else ""))
