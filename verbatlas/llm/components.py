"""Connected components of a graph given as edges, by large-star and small-star rounds.

Each round hangs every vertex under the least of its neighbours; chains shrink geometrically, and the
rounds end when all edges are stars around the least vertex of their component. A round is two
aggregations and two joins on the edges and is written to the shared folder, so a lost executor costs one
round. Nothing is gathered: a vertex with very many neighbours is reduced by partial aggregation, and its
edges meet what was found in as many pieces as it has 256ths of all edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatlas.session import materialise

PIECES = 256  # no task gets more than this part of all edges for one vertex


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number of edges, and of vertices that keep them from being stars: with two centres, or centre and ray."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    n, wrong = ends.agg(F.sum("up"), F.count_if(F.col("up") + F.col("down") > 1)).first()
    return n or 0, wrong


def _least(edges: DataFrame, at: str, other: str, total: int) -> DataFrame:
    """``edges`` with ``m``, the least ``other`` of all edges that share ``at``.

    ``total`` is no less than the number of edges, so fewer than ``PIECES`` vertices have more than one
    piece, and the table of them may be broadcast however large the graph is.
    """
    pieces = F.ceil(F.col("times") * PIECES / F.lit(total)).cast("int")
    least = edges.groupBy(at).agg(F.min(other).alias("m"), F.count(F.lit(1)).alias("times")).select(at, "m", pieces.alias("pieces"))
    hot = least.where("pieces > 1").select(at, "pieces")
    dealt = edges.join(F.broadcast(hot), at, "left")
    dealt = dealt.withColumn("piece", F.coalesce(F.pmod(F.xxhash64(other), F.col("pieces")).cast("int"), F.lit(0))).drop("pieces")
    least = least.select(at, "m", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    return dealt.join(least, [at, "piece"]).drop("piece")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` of every vertex that has an edge; the component is its least vertex.

    Edges may be repeated and in either direction; loops and edges with a null end are left out.
    """
    high, low = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    known = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = materialise(known.select(high.cast("long").alias("a"), low.cast("long").alias("b")).distinct(), "edges")
    total, wrong = _state(edges)
    while wrong:
        # Large star: whatever is larger than a vertex is hung under the least in its neighbourhood.
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        large = _least(both, "u", "v", 2 * total).where("v > u").select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
        large = materialise(large.distinct(), "edges")
        # Small star: a vertex and what is smaller are hung under the least of them.
        small = _least(large, "a", "b", total)
        hung = small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(hung.union(large.groupBy("a").agg(F.min("b").alias("b"))).distinct(), "edges")
        total, wrong = _state(edges)
    roots = edges.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.toDF("id", "component").union(roots)
