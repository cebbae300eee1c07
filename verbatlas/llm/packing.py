"""Operator 6, best-fit packing: variable-capacity best-fit.

Texts are packed into sequences whose length is one of several permitted ones. A text longer than the
longest is cut into pieces, so nothing is lost. Pieces are dealt by the hash of their id, and of a number
among the rows with this id, into shards of a bounded number of rows, and each shard is packed on its own, largest piece first. A piece goes to the
open bin that it leaves fullest. If none has room, a bin is opened: for every permitted length that
holds the piece, the pieces still to come that would fill it are looked up, largest first, and the
length with the least cost per token wins. A bin costs its length plus ``overhead``. In the end each
bin shrinks to the shortest permitted length that holds its contents.

All permitted lengths compete for each bin, so they are chosen jointly rather than one after the other.

Defined results: null and empty texts have one piece of length 0 without bin; equal rows get places of
their own; the order of ties is that of id and piece; an empty table gives an empty result; other
columns are not looked at. The number of shards follows the number of rows, so that work in one task is
bounded; at most one bin per shard and length is left badly filled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.llm.tables import numbered, word_count

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 16
SHARD_ROWS = 50_000

_SCHEMA = "id long, piece long, start long, size long, bin_id string, capacity long, offset long"


class _Stock:
    """Pieces still to be placed: their number by size, and a bit for each size that exists."""

    def __init__(self, sizes: np.ndarray, longest: int):
        self.count = np.bincount(sizes, minlength=longest + 1).tolist()
        self.bits = sum(1 << s for s in set(sizes.tolist()))

    def take(self, size: int) -> None:
        self.count[size] -= 1
        if not self.count[size]:
            self.bits &= ~(1 << size)

    def fill(self, room: int) -> int:
        """Tokens that go into ``room`` if the largest pieces that fit are taken one after the other."""
        room_left, used, at = room, {}, room
        while room_left > 0:
            below = self.bits & ((1 << (min(at, room_left) + 1)) - 1)
            if not below:
                break
            size = below.bit_length() - 1
            n = min(self.count[size] - used.get(size, 0), room_left // size)
            used[size] = n
            room_left -= n * size
            at = size - 1
        return room - room_left


def pack(sizes: np.ndarray, lengths: tuple = LENGTHS, overhead: int = OVERHEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``bin, offset`` of every piece, and the capacity of every bin. Sizes: 1 to the longest length."""
    longest = max(lengths)
    stock = _Stock(sizes, longest)
    place, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    filled: list[int] = []
    opened: list[int] = []
    rooms: dict[int, list[int]] = {}  # bins by room left
    bits = 0  # a bit for each room that some bin has
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        stock.take(size)
        fits = bits >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1  # the least room that is enough
            chosen = rooms[room].pop()
            if not rooms[room]:
                bits &= ~(1 << room)
        else:
            costs = [((c + overhead) / (size + stock.fill(c - size)), c) for c in lengths if c >= size]
            chosen, room = len(filled), min(costs)[1]
            filled.append(0)
            opened.append(room)
        place[k], offset[k] = chosen, filled[chosen]
        filled[chosen] += size
        room -= size
        if room:
            rooms.setdefault(room, []).append(chosen)
            bits |= 1 << room
    steps = np.sort(np.asarray(lengths))
    return place, offset, steps[np.searchsorted(steps, filled)] if filled else np.zeros(0, np.int64)


def pack_sizes(sizes: DataFrame, lengths: tuple = LENGTHS, overhead: int = OVERHEAD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``id, piece, start, size, bin_id, capacity, offset`` from ``id, size`` rows."""
    longest, names = max(lengths), [c.split()[0] for c in _SCHEMA.split(", ")]
    pieces = F.greatest(F.ceil(F.col("size") / longest), F.lit(1)).cast("long")
    rows = sizes.agg(F.sum(pieces)).first()[0] or 0
    shards = max(1, -(-rows // shard_rows))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "id", "piece"], ascending=[False, True, True], kind="stable")
        some = rows["size"].to_numpy() > 0
        place, offset, capacity = pack(rows["size"].to_numpy()[some], lengths, overhead)
        shard = int(rows["shard"].iloc[0]) if len(rows) else 0
        out = rows.assign(bin_id=None, capacity=pd.array([None] * len(rows), "Int64"), offset=pd.array([None] * len(rows), "Int64"))
        out.loc[some, "bin_id"] = [f"{shard}-{b}" for b in place.tolist()]
        out.loc[some, "capacity"], out.loc[some, "offset"] = capacity[place], offset
        return out[names]

    sizes = numbered(sizes.select("id", "size"), ["id"], [F.col("size")])
    cut = sizes.select("id", "number", "size", F.posexplode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("n", "piece"))
    start = F.col("piece") * longest
    cut = cut.select("id", "number", "piece", start.alias("start"), F.least(F.col("size") - start, F.lit(longest)).alias("size"))
    # The number is left out of the hash where it is 0, and so are null ids by the hash itself.
    told = F.when(F.col("number") > 0, F.col("number"))
    shard = F.pmod(F.xxhash64("id", "piece", F.lit("shard"), told), F.lit(shards))
    return cut.withColumn("shard", shard).groupBy("shard").applyInPandas(run, _SCHEMA)


def pack_texts(docs: DataFrame, item_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Pack every text by its number of words."""
    return pack_sizes(docs.select(F.col(item_id).cast("long").alias("id"), word_count(F.col(text)).alias("size")), **options)
