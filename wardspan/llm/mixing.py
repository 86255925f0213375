"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words. What of it is a whole multiple of the source is allocated
as certain whole copies of every document; for the rest, one more copy of some documents, the
source's inclusion probability is p = rest / size. Documents are ranked by random odds divided by
inclusion odds, u/(1-u) : p/(1-p), and the first ones are taken until their words reach the rest
(the last one only if it brings the sum nearer).

No source is ever sorted as a whole. The words of each source are summed in ``BINS`` bins of the
rank value; the bin in which the sum passes the rest is the only one whose documents are ranked one
by one. The outcome is one cut per source, with which every document decides for itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardspan.llm.common import HEX_RANGE, count_words, hash_number
from wardspan.operators import dense_ids
from wardspan.runtime import broadcast_within, stage

BINS = 65_536


def identity(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Id and text of a document in a short text."""
    return F.concat(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
        F.lit(":"),
        F.md5(F.coalesce(F.col(text), F.lit(""))),
    )


def chance(of: Column | None = None) -> Column:
    """A number in (0, 1) that follows from id and text, so that reruns agree."""
    return (hash_number(identity() if of is None else of) + 0.5) / HEX_RANGE


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, most: float
) -> DataFrame:
    """Target words of each source of ``sizes`` (source, source_size).

    Sources in code point order, null last, take ``weights`` in turn. Targets are ``share`` of all
    words, divided by weight; none exceeds ``most`` times its source, and what is cut off there goes
    to the others by weight until none exceeds. That ends where every target is
    min(most * size, weight * level); the level follows from running sums in the order of
    size / weight, at which sources reach their limit. Both windows see one row per source.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    ranked = sizes.withColumn("weight", F.array(*map(F.lit, weights))[turn].cast("double"))
    ranked = ranked.withColumn("limit", F.col("source_size") * F.lit(float(most)))
    total = Window.partitionBy()
    order = (F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(total) * F.lit(float(share)) - F.coalesce(
        F.sum("limit").over(before), F.lit(0.0)
    )
    # The level if this source is the first one that stays below its limit. These values rise up to
    # the source where that is so and fall from there.
    return ranked.withColumn("level", left / F.sum("weight").over(after)).select(
        "source",
        "source_size",
        F.least("limit", F.max("level").over(total) * F.col("weight")).alias("target"),
    )


def _rank_value(u: Column, p: Column) -> Column:
    """key / (1 + key) of the Pareto key, which lies between 0 and 1 in the same order."""
    odds = u * (1 - p)
    return odds / (odds + p * (1 - u))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with columns ``size`` (words), ``source_size``,
    ``target`` and ``copies``, how often the mix takes the document. Columns of these names in
    ``docs`` are replaced; all others are kept, under any names.

    A null text has size 0. Documents of size 0 follow the same rule, as they do not count.
    Null sources are one source. Rows alike in id and text are drawn one by one, by their turn among
    each other, so that a source of one repeated row meets its target too; which of them is taken
    once more follows from their other columns. An empty table gives an empty table. Sizes are staged
    when this is called.
    """
    kept = [c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "copies")]
    # The caller's columns travel in one, so that no name of theirs meets one used here.
    sized = docs.select(
        F.struct(*kept).alias("doc"),
        "source",
        count_words(F.col("text")).alias("size"),
        identity().alias("key"),
        chance().alias("u"),
    )
    narrow = stage(sized.select("source", "size", "u"), "mix-sizes")
    again = stage(narrow.groupBy("u").count().filter("count > 1").select("u"), "mix-again")
    if not again.isEmpty():
        sized = _one_by_one(sized, again)
        narrow = stage(sized.select("source", "size", "u"), "mix-sizes")
    cuts = _cuts(narrow, weights, share, most).withColumnRenamed("source", "source_key")
    joined = sized.join(cuts, F.col("source").eqNullSafe(F.col("source_key")), "left")
    extra = F.col("u") < F.col("cut")
    return joined.select(
        *[F.col("doc")[c].alias(c) for c in kept],
        "size",
        "source_size",
        "target",
        (F.col("whole") + extra.cast("long")).alias("copies"),
    )


def _one_by_one(sized: DataFrame, again: DataFrame) -> DataFrame:
    """A number of its own for each of the rows that share one: the first keeps it."""
    again = broadcast_within(again)
    kinds = {f.name: f.dataType.simpleString() for f in sized.schema["doc"].dataType.fields}
    rest = [F.col("doc")[c] for c, kind in kinds.items() if c != "text" and "map" not in kind and "variant" not in kind]
    many = sized.join(again, "u", "left_semi").withColumn("rest", F.xxhash64(F.lit(0), *rest))
    placed = dense_ids(many, ["key", "source", "rest"], "at")
    firsts = broadcast_within(placed.groupBy("key").agg(F.min("at").alias("first")))
    turn = F.col("at") - F.col("first")
    other = chance(F.concat("key", F.lit(":"), turn.cast("string")))
    turned = placed.join(firsts, "key").withColumn("u", F.when(turn == 0, F.col("u")).otherwise(other))
    return sized.join(again, "u", "left_anti").unionByName(turned.select(*sized.columns))


def _cuts(narrow: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """One row per source: target, whole copies of every document, and the u below which documents are
    taken once more."""
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(sizes, weights, share, most)
    times = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))
    plan = plan.withColumn("whole", F.floor(times)).withColumn("p", times - F.floor(times))
    plan = stage(
        plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-plan"
    )
    # One row per source and bin; null sources are joined as such.
    chances = plan.filter(F.col("p") > 0).select(F.col("source").alias("s"), "p", "rest")
    value = _rank_value(F.col("u"), F.col("p"))
    placed = narrow.join(chances, F.col("source").eqNullSafe(F.col("s"))).select(
        "source",
        "size",
        "u",
        "rest",
        F.least(F.floor(value * BINS), F.lit(BINS - 1)).cast("int").alias("bin"),
    )
    bins = placed.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    passing = bins.withColumn("upto", running).filter(
        (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest"))
    )
    passing = passing.select(
        F.col("source").alias("s"), F.col("bin").alias("b"), (F.col("upto") - F.col("words")).alias("before")
    )
    edge = placed.join(
        passing, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b"))
    ).groupBy("source", "u", "rest", "before").agg(F.sum("size").alias("size"))
    earlier = F.col("before") + F.sum("size").over(
        Window.partitionBy("source").orderBy("u")
    ) - F.col("size")
    edge = edge.withColumn("taken", earlier + F.col("size") / 2 <= F.col("rest")).filter("size > 0")
    # The first document that is not taken, or a place just behind the last one of the bin.
    behind = F.max("u") + 0.5 / HEX_RANGE
    first_left = F.min(F.when(~F.col("taken"), F.col("u")))
    stop = edge.groupBy("source").agg(F.coalesce(first_left, behind).alias("stop"))
    ends = stop.select(F.col("source").alias("s"), "stop")
    # Without such a bin all of the source is within the rest.
    cut = F.when(F.col("p") > 0, F.coalesce("stop", F.lit(1.0))).otherwise(0.0)
    cuts = plan.join(ends, F.col("source").eqNullSafe(F.col("s")), "left")
    return stage(cuts.select("source", "source_size", "target", "whole", cut.alias("cut")), "mix-cuts")
