"""Operator 3, n-gram Jaccard join: MinHash banding, then verification on the full n-gram sets.

1. Every text becomes the set of its five-word shingles (all words, if there are fewer). Texts with
   equal sets form one member, which gets a number; only its least id and that row's text go on.
2. ``bands`` picks rows and bands for a target recall at the threshold. Band hashes are shuffled
   together with one byte of each MinHash value.
3. Within a bucket, members whose bytes agree as often as a similarity little below the threshold would
   make them are tied together by a forest, so a bucket gives fewer ties than it has members. A bucket
   is held as some 100 bytes for each of its members, which all differ in their shingles.
4. Members tied together form groups. Groups are cut into blocks, each pair of blocks is one unit of
   work, to which the texts of both come, and all pairs in it are verified exactly. Out come the number
   of links of each member and a spanning forest, not the pairs.
5. The forest's components are the classes.

Defined results: null and empty texts have no shingles, link with nothing and are classes of their own;
rows without an id have no class and no links; rows with one id and different texts are documents of
their own, so no link of either is lost, and two classes may have one name; texts of any length are
read whole; white space does not matter, letter case does; a class is named by its least id; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatlas.llm import tokens
from verbatlas.llm.components import components
from verbatlas.llm.tables import texts
from verbatlas.operators.ordering import global_ordinals
from verbatlas.session import materialise

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
MOST_HASHES = 128
BLOCK = 128  # members of a group that are compared as a block
MARGIN = 0.17  # four standard deviations of a similarity estimated from 90 bytes


def bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """``bands, rows``: the most selective banding that finds a pair at the threshold with this probability."""
    best = None
    for rows in range(1, most + 1):
        count = ceil(log(1 - recall) / log(1 - threshold**rows))
        if count * rows > most:
            break
        best = (count, rows)
    if best is None:
        raise ValueError("no banding with so few hashes reaches this recall")
    return best


def _multipliers(n: int) -> np.ndarray:
    """Odd 32-bit numbers."""
    return (tokens.mix(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingles(column: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """``hashes, bounds``: the distinct shingles of text i, sorted, are ``hashes[bounds[i]:bounds[i + 1]]``."""
    data, offsets = tokens.text_bytes(column)
    starts, ends, docs = tokens.spans(data, offsets, tokens.VISIBLE)
    words = tokens.Fingerprints(data).of(starts, ends)
    grams, at = tokens.ngrams(words, docs, n)
    owners = docs[at]
    counts = np.bincount(docs, minlength=len(column))
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        first = np.searchsorted(docs, short)
        whole = [int(tokens.ngrams(words[a : a + counts[d]], docs[a : a + counts[d]], int(counts[d]))[0][0]) for d, a in zip(short, first, strict=True)]
        grams = np.concatenate((grams, np.array(whole, np.uint64)))
        owners = np.concatenate((owners, short))
    order = np.lexsort((grams, owners))
    grams, owners = grams[order], owners[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (owners[1:] != owners[:-1])
    grams, owners = grams[keep], owners[keep]
    return grams, np.searchsorted(owners, np.arange(len(column) + 1))


def _signatures(batches: Iterator[pa.RecordBatch], n: int, count: int, rows: int) -> Iterator[pa.RecordBatch]:
    """``id, digest, k1, k2, sketch, keys`` of every text; k1 and k2 name the set and are null without shingles."""
    factors = _multipliers(count * rows)
    for batch in batches:
        for part in tokens.slices(batch, "body"):
            hashes, bounds = shingles(part.column("body"), n)
            some = np.flatnonzero(np.diff(bounds))
            least = np.zeros((len(some), count * rows), np.uint32)
            if len(some):
                narrow = (hashes >> np.uint64(32)).astype(np.uint32)
                for j, factor in enumerate(factors):
                    least[:, j] = np.minimum.reduceat(narrow * factor, bounds[some])
                k1 = np.add.reduceat(hashes, bounds[some])
                k2 = np.add.reduceat(tokens.mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), bounds[some])
            else:
                k1 = k2 = np.zeros(0, np.uint64)
            wide = least.astype(np.uint64).reshape(len(some), count, rows)
            keys = np.zeros((len(some), count), np.uint64) + np.arange(1, count + 1, dtype=np.uint64)
            for j in range(rows):
                keys = tokens.mix(keys * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, j])
            sketch = (tokens.mix(least.astype(np.uint64)) & np.uint64(255)).astype(np.uint8)

            at = np.full(part.num_rows, -1)
            at[some] = np.arange(len(some))
            columns = [part.column("id"), part.column("digest")]
            for k in (k1, k2):
                columns.append(pa.array([None if a < 0 else int(v) for a, v in zip(at.tolist(), _signed(k, at), strict=True)], pa.int64()))
            columns.append(pa.array([None if a < 0 else sketch[a].tobytes() for a in at.tolist()], pa.binary()))
            columns.append(pa.array([None if a < 0 else keys[a].view(np.int64).tolist() for a in at.tolist()], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["id", "digest", "k1", "k2", "sketch", "keys"])


def _signed(values: np.ndarray, at: np.ndarray) -> list:
    return (values.view(np.int64)[at] if len(values) else np.zeros(len(at), np.int64)).tolist()


def tie(ids: np.ndarray, sketches: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a forest that connects the members of one bucket whose sketches are alike.

    Found breadth first: a member is compared with those that nothing has reached yet, so a group of near
    copies is connected by its first member, and the edges are fewer than the members.
    """
    free = np.arange(len(ids))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    waiting: list[int] = []
    while len(free):
        if not waiting:
            waiting, free = [int(free[0])], free[1:]
        k = waiting.pop()
        alike = ((sketches[free] == sketches[k]).mean(axis=1) - 1 / 256) / (1 - 1 / 256) >= least
        found, free = free[alike], free[~alike]
        waiting += found.tolist()
        left.append(ids[found])
        right.append(np.full(len(found), ids[k]))
    return np.concatenate(left), np.concatenate(right)


def _ties(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Ties ``a, b`` of the buckets, whose rows follow each other."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    current = None

    def done() -> Iterator[pa.RecordBatch]:
        if sum(len(i) for i, _ in held) > 1:
            a, b = tie(np.concatenate([i for i, _ in held]), np.concatenate([s for _, s in held]), least)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, ids = batch.column("key").to_numpy(), batch.column("id").to_numpy()
        flat = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(len(keys), -1)
        at = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if keys[a] != current:
                yield from done()
                current, held = keys[a], []
            if held or b - a > 1 or b == len(keys):  # else alone in its bucket
                held.append((ids[a:b], flat[a:b]))
    yield from done()


def _union(parent: dict, a: int, b: int) -> bool:
    """Join two sets; False if they were one already."""
    roots = []
    for x in (a, b):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        roots.append(x)
    parent[max(roots)] = min(roots)
    return roots[0] != roots[1]


def _verify(ids: list, sides: list, weights: list, bodies: pa.Array, n: int, threshold: float) -> list[tuple]:
    """Rows ``id, other, links`` of one unit: links of each member, and the edges of a forest.

    Side 0 is compared with side 1; if there is no side 1, side 0 with itself.
    """
    hashes, bounds = shingles(bodies, n)
    names, ranks = np.unique(hashes, return_inverse=True)
    sizes = np.diff(bounds)
    mark = np.zeros(len(names) + 1, bool)
    side = np.asarray(sides)
    two = bool((side == 1).any())
    weight = np.asarray(weights, np.int64)
    links, forest, parent = np.zeros(len(ids), np.int64), [], {}
    for i in np.flatnonzero(side == 0).tolist():
        own = ranks[bounds[i] : bounds[i + 1]]
        mark[own] = True
        shared = np.add.reduceat(np.append(mark[ranks], False), bounds[:-1], dtype=np.int64)
        mark[own] = False
        alike = shared >= threshold * (sizes + sizes[i] - shared) - 1e-9
        alike &= side == 1 if two else np.arange(len(ids)) > i
        for j in np.flatnonzero(alike & (sizes > 0)).tolist():
            if ids[i] != ids[j]:
                links[i] += weight[j]
                links[j] += weight[i]
                if _union(parent, ids[i], ids[j]):
                    forest.append((ids[i], ids[j], 0))
    return forest + [(ids[k], None, int(v)) for k, v in enumerate(links.tolist()) if v]


def _verified(batches: Iterator[pa.RecordBatch], n: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Verify unit after unit; their rows follow each other."""

    def done(rows: list) -> pa.RecordBatch | None:
        ids, sides, weights, bodies = zip(*rows, strict=True)
        found = _verify(list(ids), list(sides), list(weights), tokens.strings(list(bodies)), n, threshold) if len(ids) > 1 else []
        if not found:
            return None
        columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["id", "other", "links"])

    current, rows = None, []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("group", "left", "right", "id", "side", "weight", "body"))
        for group, left, right, *row in zip(*columns, strict=True):
            if (group, left, right) != current:
                if rows and (out := done(rows)) is not None:
                    yield out
                current, rows = (group, left, right), []
            rows.append(tuple(row))
    if rows and (out := done(rows)) is not None:
        yield out


def units(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """Deal ``id, group`` to units ``group, left, right, side``: every pair of blocks of a group, each once."""
    counts = members.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = members.join(counts.where("blocks > 1"), "group", "left").fillna(1, "blocks")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left, right = F.least("own", "with").alias("left"), F.greatest("own", "with").alias("right")
    return dealt.select(*members.columns, left, right, (F.col("own") > F.col("with")).cast("int").alias("side"))


def join(
    docs: DataFrame,
    item_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """``id, class_id, n_links, representative, class_key, digest`` of every row.

    ``class_id`` is the least id that can be reached by links, ``n_links`` the number of other documents
    with a Jaccard similarity of ``threshold`` or more, copies included, and ``representative`` the least
    id with the same set of shingles. ``class_key`` tells classes apart even if ids are repeated, and is
    null for rows without shingles or id; ``digest`` is ``body_digest`` of the row's text.
    """
    count, rows = bands(threshold, recall)
    plain = texts(docs, item_id, text).withColumn("digest", body_digest(F.col("body")))
    schema = "id long, digest long, k1 long, k2 long, sketch binary, keys array<long>"
    signed = materialise(plain.mapInArrow(lambda it: _signatures(it, words, count, rows), schema), "signatures")
    named = signed.where("id is not null and k1 is not null")
    members = named.groupBy("k1", "k2").agg(
        F.min(F.struct("id", "digest")).alias("least"), F.count(F.lit(1)).alias("copies"), F.first("sketch").alias("sketch"), F.first("keys").alias("keys")
    )
    members = members.select("k1", "k2", F.col("least.id").alias("name"), F.col("least.digest").alias("digest"), "copies", "sketch", "keys")
    members = materialise(global_ordinals(members, ["k1", "k2"], "member"), "members")

    dealt = members.select(F.explode("keys").alias("key"), F.col("member").alias("id"), "sketch")
    width = _width(docs.sparkSession)
    dealt = dealt.repartition(width, "key").sortWithinPartitions("key", "id")
    ties = dealt.mapInArrow(lambda it: _ties(it, threshold - MARGIN), "a long, b long")
    groups = components(ties).toDF("member", "group")

    told = members.select("member", "name", "digest", F.col("copies").alias("weight"))
    dealt = units(groups.join(told, "member").withColumnRenamed("member", "id"), block)
    bodies = plain.withColumnRenamed("id", "name").where("body is not null")
    bodies = bodies.join(dealt.select("name", "digest").distinct(), ["name", "digest"], "left_semi")
    bodies = bodies.groupBy("name", "digest").agg(F.max("body").alias("body"))
    dealt = dealt.join(bodies, ["name", "digest"]).repartition(width, "group", "left", "right")
    dealt = dealt.sortWithinPartitions("group", "left", "right", "side", "id")
    found = dealt.mapInArrow(lambda it: _verified(it, words, threshold), "id long, other long, links long")
    found = materialise(found, "links")

    classes = components(found.where("other is not null"), "id", "other").toDF("member", "class_key")
    least = classes.join(members.select("member", "name"), "member").groupBy("class_key").agg(F.min("name").alias("class_id"))
    classes = classes.join(least, "class_key")
    links = found.where("other is null").groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "member")
    told = members.select("k1", "k2", "member", "name", "copies").join(classes, "member", "left").join(links, "member", "left")
    told = told.select(
        "k1", "k2", "name", F.coalesce("class_id", "name").alias("class_id"), F.coalesce("class_key", "member").alias("class_key"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    out = signed.select("id", "digest", "k1", "k2").join(told, ["k1", "k2"], "left")
    known = F.col("id").isNotNull()
    return out.select(
        "id",
        F.when(known, F.coalesce("class_id", "id")).alias("class_id"),
        F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.when(known, F.coalesce("name", "id")).alias("representative"),
        F.when(known, F.col("class_key")).alias("class_key"),
        "digest",
    )


def body_digest(body: Column) -> Column:
    """A text among those of one id."""
    return F.xxhash64(body)


def _width(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
