"""Operator 2, mixing sources to target weights: entropy balancing, in DataFrame functions only.

Every document d of source s gets the rate that stays closest, in relative entropy, to 1 for each
document, while the source takes its target number of words and no rate exceeds ``most``:

    rate(d) = min(most, exp(lambda(s) * size(d) / mean size(s)))

lambda(s) solves the convex dual of the constraint sum of size * rate = target. All sources are solved
together: one Newton step for every source is one aggregation over the (source, size) cells, in which
documents of one size count as a row, with bisection where a step leaves its bracket. The cells are
summed as decimals, so that reruns agree to the last digit whatever the order of the rows.

Rates become whole copies by one cut per source: a document with rate r gets floor(r) copies and one
more if its hash falls below the fraction of r plus a shift t(s); t(s) is found by three rounds of
histograms of 256 bins over (hash - fraction), to about one document, and then the one document whose
change brings the source nearest to its target changes sides. No window, sort or join holds more than bins or cells of a source.
The hash is that of the id and of a number among the rows of a source with this id, so that rows
without id or with one id move one by one and not as a block.

Defined results: null text has size 0 and takes 0; null source is a source of its own, the last one;
rows that are equal in every column may get different copies, and how many of them get which number is
the same on every run; an empty table gives an empty result; texts of any length count whole; other
columns only settle the order of rows with one id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbatlas.llm.tables import numbered, word_count
from verbatlas.operators.ordering import global_ordinals
from verbatlas.session import BROADCAST_LIMIT_BYTES, materialise

# Weights of the sources in the order of their names, repeating, and the share of all words to take.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
STEPS = 14
BINS = 256


def source_key(source: Column) -> Column:
    """A join key without null: "1" and the name, or "2" for the source without name."""
    return F.when(source.isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), source.cast("string")))


def sized(docs: DataFrame, item_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``id, key, size`` of every row."""
    return docs.select(
        F.col(item_id).cast("long").alias("id"), source_key(F.col(source)).alias("key"), word_count(F.col(text).cast("string")).alias("size")
    )


def _few(sources: DataFrame) -> bool:
    """Whether one row per source is small enough to be sent to every task."""
    return sources.count() * 128 <= BROADCAST_LIMIT_BYTES


def cells(sizes: DataFrame) -> DataFrame:
    """Documents of one source and size as one row: ``key, size, n``."""
    return sizes.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n"))


def targets(counted: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``key, source_size, n, target`` of every source, from the ``cells``.

    Sources in the order of their names take the weights in turn. What a source cannot take, because
    its target stops at ``most`` times its size, is shared anew by weight among the others: each round
    is one aggregate that returns two numbers, and the level only rises.
    """
    total = counted.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
    ranked = global_ordinals(total, ["key"], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    cap = (F.col("source_size") * most).cast("double")
    ranked = materialise(ranked.withColumns({"weight": weight, "cap": cap}), "sources")
    wanted = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        capped = F.col("weight") * level > F.col("cap")
        row = ranked.agg(
            F.count_if(capped).alias("full"),
            F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)).alias("taken"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weight"),
        ).first()
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (share * wanted - most * row["taken"]) / row["weight"]
    return ranked.select("key", "source_size", "n", F.least(F.col("weight") * level, F.col("cap")).alias("target"))


def _rate(most: int) -> Column:
    tilted = F.exp(F.least(F.col("tilt") * F.col("size") * F.col("n_all") / F.col("source_size"), F.lit(30.0)))
    return F.when(F.col("size") == 0, 1.0).otherwise(F.least(F.lit(float(most)), tilted))


def tilts(counted: DataFrame, wanted: DataFrame, most: int = MOST, steps: int = STEPS) -> DataFrame:
    """Newton's method on the dual: adds ``tilt`` to ``key, source_size, n_all, target``.

    A step is one join of the cells with the few sources and one aggregation. Steps are chained in one
    plan, and the state is written after every few of them.
    """
    some, few = counted.where("size > 0"), _few(wanted)
    reach = 200.0
    # A source whose target is its cap takes everything ``most`` times: the tilt is at its upper end.
    begin = F.when(F.col("target") >= F.col("source_size") * most, reach).otherwise(0.0)
    state = wanted.where("source_size > 0").withColumnRenamed("n", "n_all")
    state = state.withColumns({"tilt": begin, "low": F.lit(-reach), "high": F.lit(reach)})
    keep = ("source_size", "n_all", "target", "tilt", "low", "high")
    for step in range(steps):
        scaled = F.col("size") * F.col("n_all") / F.col("source_size")
        words = F.col("n") * F.col("size") * _rate(most)
        slope = F.when(_rate(most) < most, words * scaled).otherwise(0.0)
        exact = lambda x: F.sum(x.cast("decimal(32,6)")).cast("double")  # noqa: E731  the same sum in any order
        state = some.join(F.broadcast(state) if few else state, "key")
        state = state.groupBy("key").agg(*[F.max(c).alias(c) for c in keep], exact(words).alias("sum"), exact(slope).alias("slope"))
        above = F.col("sum") > F.col("target")
        state = state.withColumn("low", F.when(above, F.col("low")).otherwise(F.col("tilt")))
        state = state.withColumn("high", F.when(above, F.col("tilt")).otherwise(F.col("high")))
        newton = F.col("tilt") - (F.col("sum") - F.col("target")) / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        moved = F.when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        settled = (F.col("sum") == F.col("target")) | (F.col("tilt") >= reach)
        state = state.select("key", *[c for c in keep if c != "tilt"], F.when(settled, F.col("tilt")).otherwise(moved).alias("tilt"))
        if step % 5 == 4 or step == steps - 1:
            state = materialise(state, "tilts")
    return state.select("key", "source_size", "n_all", "target", "tilt")


def plan(docs: DataFrame, item_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: ``key, source_size, n_all, target, tilt, cut, moved, moved_number``, written once.

    ``cut`` and ``moved`` say which documents get one copy more than the whole part of their rate.
    """
    sizes = materialise(sized(docs, item_id, text, source), "sizes")
    counted = materialise(cells(sizes), "cells")
    sizes = numbered(sizes, ["key", "id"], [F.col("size")])
    wanted = targets(counted, weights, share, most)
    solved = tilts(counted, wanted, most)
    few = _few(wanted)

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    rated = _rated(sizes.join(small(solved), "key"), most)
    movable = rated.where("size > 0 and place is not null").select("id", "number", "key", "size", "place")
    movable = materialise(movable, "movable")

    # The words that one more copy of some documents must give, source by source.
    floors = rated.groupBy("key").agg(F.sum(F.col("floor") * F.col("size")).alias("sure"))
    cut = floors.join(small(solved.select("key", "target")), "key")
    cut = cut.select("key", F.lit(0).cast("long").alias("prefix"), (F.col("target") - F.col("sure")).alias("rest"))
    cut = materialise(cut.where("rest > 0"), "cut")
    for depth in (16, 8, 0):
        inside = movable.join(small(cut), "key").where(F.shiftright("place", depth + 8) == F.col("prefix"))
        bins = inside.groupBy("key", F.shiftright("place", depth).alias("bin")).agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
        before, whole = Window.partitionBy("key").orderBy("bin"), Window.partitionBy("key")
        bins = bins.withColumn("sum", F.sum("words").over(before)).withColumn("last", F.max("bin").over(whole))
        crossed = (F.col("sum") >= F.col("rest")) & (F.col("sum") - F.col("words") < F.col("rest"))
        crossed = crossed | ((F.col("bin") == F.col("last")) & (F.col("sum") < F.col("rest")))
        rest = F.col("rest") - F.col("sum") + F.col("words")
        cut = materialise(bins.where(crossed).select("key", F.col("bin").alias("prefix"), rest.alias("rest"), "words"), "cut")
    over = F.col("rest") * 2 >= F.col("words")
    left = F.col("rest") - F.when(over, F.col("words")).otherwise(0)
    cut = materialise(cut.select("key", (F.col("prefix") + over.cast("long")).alias("cut"), left.alias("left")), "cut")

    # One document of each source changes sides if that brings the words nearer to the target.
    change = F.when(F.col("place") < F.col("cut"), -F.col("size")).otherwise(F.col("size"))
    miss = F.abs(F.col("left") - change)
    moved = movable.join(small(cut), "key").where(miss < F.abs("left"))
    moved = moved.groupBy("key").agg(F.min(F.struct(miss, "place", "id", "number")).alias("one"))
    moved = moved.select("key", F.col("one.id").alias("moved"), F.col("one.number").alias("moved_number"))
    return materialise(solved.join(cut.select("key", "cut"), "key", "left").join(moved, "key", "left"), "plan")


def _rated(sizes: DataFrame, most: int) -> DataFrame:
    """Adds ``rate``, its whole part ``floor`` and the ``place`` of the rest among 2**24, null at the most."""
    rated = sizes.withColumn("rate", F.coalesce(_rate(most), F.lit(1.0))).withColumn("floor", F.floor("rate").cast("long"))
    drawn = F.when(F.col("number") == 0, F.xxhash64("id")).otherwise(F.xxhash64("id", "number"))
    hashed = F.shiftrightunsigned(drawn, 11) / float(1 << 53)
    place = ((hashed - (F.col("rate") - F.col("floor")) + 1.0) / 2.0 * (1 << 24)).cast("long")
    return rated.withColumn("place", F.when(F.col("floor") < most, place))


def apply(docs: DataFrame, planned: DataFrame, item_id: str = "doc_id", text: str = "text", source: str = "source", most: int = MOST, column: str = "_mixed") -> DataFrame:
    """All columns of ``docs`` and a struct ``column`` of ``id, size, source_size, target, rate, copies``.

    The plan has a row per source, so texts are not shuffled but for those of rows with a repeated id.
    """
    ids = docs.select(F.col(item_id).cast("long").alias("id"), source_key(F.col(source)).alias("key"))
    all_columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        all_columns.alias("row"), F.col(item_id).cast("long").alias("id"),
        source_key(F.col(source)).alias("key"), word_count(F.col(text).cast("string")).alias("size"),
    )
    rows = numbered(rows, ["key", "id"], [F.col("size"), F.xxhash64(F.to_json("row"))], counted=ids)
    rated = _rated(rows.join(F.broadcast(planned) if _few(planned) else planned, "key", "left"), most)
    below = F.coalesce(F.col("place") < F.col("cut"), F.lit(False))
    more = below != (F.col("id").eqNullSafe(F.col("moved")) & F.coalesce(F.col("number") == F.col("moved_number"), F.lit(False)))
    more = F.when(F.col("place").isNull() | (F.col("size") == 0), False).otherwise(more).cast("long")
    result = F.struct(
        "id", "size", F.coalesce("source_size", F.lit(0).cast("long")).alias("source_size"),
        F.coalesce("target", F.lit(0.0)).alias("target"), "rate", (F.col("floor") + more).alias("copies"),
    )
    return rated.select("row.*", result.alias(column))


def mix(docs: DataFrame, item_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``id, size, source_size, target, rate, copies`` of every row."""
    docs = docs.select(F.col(item_id).alias("id"), F.col(text).alias("text"), F.col(source).alias("source"))
    planned = plan(docs, "id", "text", "source", weights, share, most)
    return apply(docs, planned, "id", "text", "source", most).select("_mixed.*")
