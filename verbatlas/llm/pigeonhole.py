"""Operator 8, embedding near-dedup: a pigeonhole join over subspaces.

Vectors are scaled to length 1, so that a cosine of at least c means a squared distance of at most
2 - 2c. A fixed random rotation spreads the variance evenly, and the rotated coordinates are cut into
blocks of ``DIMS``. If two vectors are near, the squared distance of at least one block is within that
block's share of the budget, in proportion to its dimensions: the pigeonhole principle. So a range join
is made for each block, and every pair that passes one of them is verified on the full vectors in
double precision.

The range join of a block orders the vectors by their cells, on a grid as wide as the block's radius in
all its coordinates, and cuts them into chunks of a bounded number of rows with their bounds. Each pair of
chunks with bounds within the radius is one unit of work: the block distances of its pairs come from
matrix products of tiles, which have bounds as well, and the few that pass are verified. A pair counts in
the first block that lets it pass, so it counts once. Tasks give the links of each vector and a spanning
forest, never the pairs.

Chunks are written once for each block, a few blocks at a time, and the tasks of a pass read them from
there: the product of the chunks with themselves is not shuffled, so the disk in use is a few times the
vectors, however many units there are.

Vectors equal in every component are one member; only their number goes on.

Vectors are multiplied by a power of two first, which changes no cosine, so their size does not matter.
Each width has blocks of its own; vectors of different widths have no cosine.

Defined results: vectors that are null, zero or with null or non-finite components link with nothing,
those of one width only with each other; rows without an id have no component; rows with the same id count as one
vector; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.llm import tokens
from verbatlas.llm.components import components
from verbatlas.session import BROADCAST_LIMIT_BYTES, conf, materialise, materialised, shuffles_dropped, spread

COSINE = 0.95
DIMS = 8
CHUNK = 2048  # vectors that are written and sent as one, times PACK
PACK = 4
TILE = 512
SLACK = 1e-5  # of the single-precision screening; verification is exact

SIDE_BYTES = 32 * 1024 * 1024  # of chunks that one task holds on either side
PASS_BYTES = BROADCAST_LIMIT_BYTES  # of vectors in their blocks that one pass writes, if one block alone has no more
EDGES = 100_000  # of the forest that a task keeps before it thins it


def rotation(width: int, seed: int = 7) -> np.ndarray:
    """An orthogonal matrix, the same on every machine: Householder reflections of hashed vectors."""
    out = np.eye(width)
    raw = tokens.mix(np.arange(1 + seed * 100_003, 1 + seed * 100_003 + 3 * width * width, dtype=np.uint64))
    raw = (raw[: 3 * width * width] >> np.uint64(11)).astype(float) / (1 << 53)
    normal = (raw.reshape(3, width, width).sum(0) - 1.5) * 2  # near enough to a normal variable
    for v in normal:
        v = v / np.linalg.norm(v)
        out -= 2.0 * np.outer(out @ v, v)
    return out


def cuts(width: int, dims: int = DIMS) -> list[tuple[int, int]]:
    return [(a, min(width, a + dims)) for a in range(0, width, dims)]


def radii(width: int, cosine: float, dims: int = DIMS) -> np.ndarray:
    """Squared radius of each block."""
    return np.array([(2 - 2 * cosine) * (b - a) / width for a, b in cuts(width, dims)])


def scaled(flat: np.ndarray) -> np.ndarray:
    """Rows in double precision, times the power of two that brings their largest component below 1."""
    flat = flat.astype(float)
    _, exponent = np.frexp(np.abs(flat).max(axis=1, keepdims=True))
    return np.ldexp(flat, -exponent)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten() if isinstance(column, (pa.ListArray, pa.LargeListArray)) else column
    return values.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _box(dims: int) -> list[str]:
    return [f"{end}{k}" for end in ("low", "high") for k in range(dims)]


def _binary(rows: np.ndarray) -> pa.Array:
    """Every row of a matrix as its bytes."""
    rows = np.ascontiguousarray(rows)
    step = rows.shape[1] * rows.itemsize
    offsets = np.arange(0, step * (len(rows) + 1), step, dtype=np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)]).cast(pa.binary())


def _cells(batches: Iterator[pa.RecordBatch], cosine: float, dims: int, kind: str, blocks: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """``width, block, cell, id, weight, vector`` of every vector in some of the blocks; the vector as its bytes.

    The cell is the numbers on a grid as wide as the block's radius, one for each coordinate, as bytes in their order.
    """
    known: dict[int, tuple] = {}
    for batch in batches:
        widths = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
        for width in np.unique(widths).tolist():
            if width not in known:
                known[width] = rotation(width), np.sqrt(radii(width, cosine, dims) + SLACK)
            turn, sizes = known[width]
            part = batch.filter(pa.array(widths == width))
            flat = _matrix(part.column("vector")).astype(kind)
            vectors = _binary(flat)
            unit = scaled(flat)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            for k, (a, b) in list(enumerate(cuts(width, dims)))[slice(*blocks)]:
                grid = np.clip(np.floor(unit @ turn[:, a:b] / sizes[k]) + 32768, 0, 65535).astype(">u2")
                of = pa.array(np.full(len(grid), width, np.int32)), pa.array(np.full(len(grid), k, np.int32))
                columns = [*of, _binary(grid), part.column("id"), part.column("weight"), vectors]
                yield pa.RecordBatch.from_arrays(columns, ["width", "block", "cell", "id", "weight", "vector"])


def _cut(batches: Iterator[pa.RecordBatch], cosine: float, dims: int, kind: str, chunk: int) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their cells, cut into chunks: their bounds in the block, and ids, weights and vectors as bytes."""
    turns: dict[int, np.ndarray] = {}
    names = ["width", "block", "reach", *_box(dims), "ids", "weights", "vectors"]

    def done(width: int, block: int, parts: list) -> pa.RecordBatch:
        if width not in turns:
            turns[width] = rotation(width)
        vectors = b"".join(v for p in parts for v in p.column("vector").to_pylist())
        flat = scaled(np.frombuffer(vectors, kind).reshape(-1, width))
        a, b = cuts(width, dims)[block]
        part = flat / np.linalg.norm(flat, axis=1, keepdims=True) @ turns[width][:, a:b]
        low, high = np.zeros(dims), np.zeros(dims)
        low[: b - a], high[: b - a] = part.min(0), part.max(0)
        ids, weights = (np.concatenate([p.column(c).to_numpy() for p in parts]).tobytes() for c in ("id", "weight"))
        reach = float(radii(width, cosine, dims)[block]) + SLACK
        columns = [pa.array([v], pa.int32()) for v in (width, block)] + [pa.array([v], pa.float64()) for v in (reach, *low.tolist(), *high.tolist())]
        return pa.RecordBatch.from_arrays([*columns, *[pa.array([v], pa.binary()) for v in (ids, weights, vectors)]], names)

    held: list[pa.RecordBatch] = []
    n, last = 0, None
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in ("width", "block")], axis=1)
        at = [*(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        a = 0
        for b in at if batch.num_rows else []:
            while a < b:
                key = tuple(keys[a].tolist())
                most = min(chunk, max(1, 8 * 1024 * 1024 // (key[0] * np.dtype(kind).itemsize)))
                if held and (key != last or n >= most):
                    yield done(*last, held)
                    held, n = [], 0
                c = min(b, a + most - n)
                held.append(batch.slice(a, c - a))
                n, last, a = n + c - a, key, c
    if held:
        yield done(*last, held)


class _Side:
    """One chunk: what the screening needs, and the links found."""

    def __init__(self, part: np.ndarray, ids: np.ndarray, weights: np.ndarray):
        self.ids, self.weights, self.links = ids, weights, np.zeros(len(ids), np.int64)
        square = (part * part).sum(1, keepdims=True) / -2
        # The product of a left and a right row is minus half their squared distance.
        self.left = np.concatenate((part, square, np.ones_like(square)), axis=1).astype(np.float32)
        self.right = np.concatenate((part, np.ones_like(square), square), axis=1).astype(np.float32)
        at = np.arange(0, len(part), TILE)
        self.low, self.high = np.minimum.reduceat(part, at), np.maximum.reduceat(part, at)


def _compressed(parent: np.ndarray) -> np.ndarray:
    while not np.array_equal(up := parent[parent], parent):
        parent = up
    return parent


def _hung(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The roots after the edges ``i, j``, and the numbers of edges that make a spanning forest of what they join."""
    kept: list[int] = []
    for c in range(0, len(i), 4096):
        parent = _compressed(parent)
        for n in (c + np.flatnonzero(parent[i[c : c + 4096]] != parent[j[c : c + 4096]])).tolist():
            roots = []
            for x in (i[n], j[n]):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                roots.append(x)
            if roots[0] != roots[1]:
                parent[max(roots)] = min(roots)
                kept.append(n)
    return parent, kept


class _Joined:
    """Pairs of two chunks (or within one) in their block; links and forest of all pairs of chunks of a task."""

    def __init__(self, cosine: float, dims: int, kind: str):
        self.cosine, self.dims, self.kind = cosine, dims, kind
        self.turns: dict[int, np.ndarray] = {}
        self.sides: dict[int, _Side] = {}
        self.edges: list[np.ndarray] = []
        self.n_edges = 0

    def side(self, number: int, width: int, block: int, ids: bytes, weights: bytes, flat: np.ndarray) -> _Side:
        if number not in self.sides:
            if width not in self.turns:
                self.turns[width] = rotation(width)
            a, b = cuts(width, self.dims)[block]
            flat = scaled(flat)
            part = flat / np.linalg.norm(flat, axis=1, keepdims=True) @ self.turns[width][:, a:b]
            self.sides[number] = _Side(part, np.frombuffer(ids, np.int64), np.frombuffer(weights, np.int64))
        return self.sides[number]

    def __call__(self, width: int, block: int, one: tuple, other: tuple) -> None:
        """``one`` and ``other`` are ``number, ids, weights, vectors``."""
        same = one[0] == other[0]
        x, y = (np.frombuffer(c[3], self.kind).reshape(-1, width) for c in (one, other))
        left = self.side(one[0], width, block, one[1], one[2], x)
        right = left if same else self.side(other[0], width, block, other[1], other[2], y)
        reach = radii(width, self.cosine, self.dims)[block] + SLACK
        parent = np.arange(len(x) + len(y))
        for p in range(len(left.low)):
            gaps = np.maximum(np.maximum(left.low[p] - right.high, right.low - left.high[p]), 0.0)
            for q in np.flatnonzero((gaps * gaps).sum(1) <= reach).tolist():
                if same and q < p:
                    continue
                near = left.left[p * TILE : (p + 1) * TILE] @ right.right[q * TILE : (q + 1) * TILE].T >= reach / -2
                rows = np.flatnonzero(near.any(1))
                i, j = np.nonzero(near[rows])
                i = rows[i]
                if same and p == q:
                    i, j = i[i < j], j[i < j]
                i, j = i + p * TILE, j + q * TILE
                for c in range(0, len(i), 20_000):
                    parent = self.pairs(width, block, i[c : c + 20_000], j[c : c + 20_000], left, right, x, y, parent)

    def pairs(self, width: int, block: int, i, j, left: _Side, right: _Side, x, y, parent) -> np.ndarray:
        """Verify candidates, count those that no earlier block lets pass, and join their ends."""
        (some, at), (others, of) = (np.unique(n, return_inverse=True) for n in (i, j))
        flat, other = scaled(x[some]), scaled(y[others])
        dots = np.einsum("ij,ij->i", flat[at], other[of])
        norms = np.sqrt(np.einsum("ij,ij->i", flat, flat))[at] * np.sqrt(np.einsum("ij,ij->i", other, other))[of]
        good = np.flatnonzero((dots / norms >= self.cosine) & (left.ids[i] != right.ids[j]))
        if not len(good):
            return parent
        turned, back = (f / np.linalg.norm(f, axis=1, keepdims=True) @ self.turns[width] for f in (flat, other))
        gaps = (turned[at[good]] - back[of[good]]) ** 2
        limits = radii(width, self.cosine, self.dims)
        passed = np.stack([gaps[:, a:b].sum(1) <= r + SLACK / 2 for (a, b), r in zip(cuts(width, self.dims), limits, strict=True)], axis=1)
        good = good[np.argmax(passed, axis=1) == block]
        i, j = i[good], j[good]
        np.add.at(left.links, i, right.weights[j])
        np.add.at(right.links, j, left.weights[i])
        parent, kept = _hung(parent, i, j if left is right else j + len(x))
        if kept:
            self.edges.append(np.stack((left.ids[i[kept]], right.ids[j[kept]]), axis=1))
            self.n_edges += len(kept)
        return parent

    def thinned(self) -> None:
        """Leave a spanning forest of the edges found so far."""
        edges = np.concatenate(self.edges)
        ids, ends = np.unique(edges, return_inverse=True)
        i, j = ends.reshape(-1, 2).T
        self.edges = [edges[_hung(np.arange(len(ids)), i, j)[1]]]
        self.n_edges = len(self.edges[0])

    def out(self) -> Iterator[pa.RecordBatch]:
        """``id, other, 0`` of the forest, and ``id, null, links``; what has been found so far is forgotten."""
        if self.edges:
            self.thinned()
            a, b = self.edges[0].T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.zeros(len(a), np.int64))], ["id", "other", "links"])
        for side in self.sides.values():
            n = np.flatnonzero(side.links)
            if len(n):
                yield pa.RecordBatch.from_arrays([pa.array(side.ids[n]), pa.nulls(len(n), pa.int64()), pa.array(side.links[n])], ["id", "other", "links"])
        self.sides, self.edges, self.n_edges = {}, [], 0


def _joined(batches: Iterator[pa.RecordBatch], cosine: float, dims: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Work off pair after pair of chunks."""
    join = _Joined(cosine, dims, kind)
    for batch in batches:
        width, block = batch.column("width").to_pylist(), batch.column("block").to_pylist()
        ends = [[batch.column(side + c) for c in ("number", "ids", "weights", "vectors")] for side in ("", "other_")]
        for n in range(batch.num_rows):
            one, other = ((c[0][n].as_py(), c[1][n].as_buffer(), c[2][n].as_buffer(), c[3][n].as_buffer()) for c in ends)
            join(width[n], block[n], one, other)
            if join.n_edges > EDGES:
                join.thinned()
            if join.n_edges > EDGES or sum(len(s.ids) for s in join.sides.values()) > 10 * EDGES:
                yield from join.out()
    yield from join.out()


def _found(members: DataFrame, blocks: tuple[int, int], size: int, cosine: float, dims: int, chunk: int) -> DataFrame:
    """``id, other, links`` of the pairs of some of the blocks; ``size`` is about the bytes of the vectors in them.

    Vectors in the order of their cells are cut into chunks, and every pair of chunks with bounds within the
    radius is a unit. Tasks read both chunks of a unit from what was written once, so nothing is sent twice.
    """
    spark = members.sparkSession
    kind = "float32" if members.schema["vector"].dataType.simpleString() == "array<float>" else "float64"
    cores = spark.sparkContext.defaultParallelism
    cells = spread(members).select(F.col("member").alias("id"), F.col("copies").alias("weight"), "vector")
    cells = cells.mapInArrow(lambda it: _cells(it, cosine, dims, kind, blocks), "width int, block int, cell binary, id long, weight long, vector binary")
    order = ["width", "block", "cell", "id"]
    dealt = cells.repartitionByRange(max(cores, math.ceil(2 * size / SIDE_BYTES)), *order).sortWithinPartitions(*order)
    box = ", ".join(f"{c} double" for c in _box(dims))
    schema = f"width int, block int, reach double, {box}, ids binary, weights binary, vectors binary"
    chunks = dealt.mapInArrow(lambda it: _cut(it, cosine, dims, kind, chunk), schema).withColumn("number", F.monotonically_increasing_id())
    with materialised(chunks, "chunks") as chunks:
        sides = max(math.ceil(size / SIDE_BYTES), min(math.ceil(chunks.count() / 4), math.ceil(math.sqrt(8 * cores))))
        one = chunks.coalesce(sides)
        other = one.toDF(*[f"other_{c}" for c in one.columns])
        gaps = [F.greatest(F.col(f"low{k}") - F.col(f"other_high{k}"), F.col(f"other_low{k}") - F.col(f"high{k}"), F.lit(0.0)) for k in range(dims)]
        near = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= F.col("reach")
        units = one.hint("shuffle_replicate_nl").join(other, (F.col("width") == F.col("other_width")) & (F.col("block") == F.col("other_block")) & (F.col("number") <= F.col("other_number")) & near)
        units = units.select("width", "block", *[side + c for side in ("", "other_") for c in ("number", "ids", "weights", "vectors")])
        with conf(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(16 * 1024 * 1024)):
            return materialise(units.mapInArrow(lambda it: _joined(it, cosine, dims, kind), "id long, other long, links long"), "links")


def _passes(members: DataFrame, dims: int) -> Iterator[tuple[tuple[int, int], int]]:
    """The blocks, some at a time, with the bytes of the vectors in them."""
    item = 4 if members.schema["vector"].dataType.simpleString() == "array<float>" else 8
    sizes = members.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each width
    each = [sum(r.n * (r.width * item + 40) for r in sizes if len(cuts(r.width, dims)) > k) for k in range(max((len(cuts(r.width, dims)) for r in sizes), default=0))]
    low = 0
    for high in range(1, len(each) + 1):
        if high == len(each) or sum(each[low : high + 1]) > PASS_BYTES:
            yield (low, high), sum(each[low:high])
            low = high


def near(vectors: DataFrame, item_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, dims: int = DIMS) -> DataFrame:
    """``id, n_links, component_id, kept`` of every row."""
    with shuffles_dropped(vectors.sparkSession):
        return _near(vectors, item_id, vector, cosine, dims)


def _near(vectors: DataFrame, item_id: str, vector: str, cosine: float, dims: int) -> DataFrame:
    rows = vectors.select(F.col(item_id).cast("long").alias("id"), F.col(vector).alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = F.col("id").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0)
    usable = spread(rows).where(fit)
    members = usable.groupBy("vector").agg(F.min("id").alias("member"), F.countDistinct("id").alias("copies"))
    members = materialise(members, "members")
    # From here on vectors are only read; what is kept of the rows is their member.
    hashed = F.xxhash64("vector").alias("hash")  # sorts faster than vectors
    owned = usable.select("id", "vector", hashed).join(members.select("*", hashed), ["hash", "vector"])
    owned = materialise(owned.select("id", "member", "copies"), "owned")

    found = [_found(members, blocks, size, cosine, dims, CHUNK * PACK) for blocks, size in _passes(members, dims)]
    found = reduce(DataFrame.union, found) if found else vectors.sparkSession.createDataFrame([], "id long, other long, links long")
    classes = components(found.where("other is not null"), "id", "other").toDF("member", "component_id")
    links = found.where("other is null").groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "member")
    told = owned.join(classes, "member", "left").join(links, "member", "left")
    named = told.groupBy("id").agg(
        F.min(F.coalesce("component_id", "member")).alias("component_id"), F.max(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = rows.select("id").join(named, "id", "left")
    component = F.coalesce("component_id", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
