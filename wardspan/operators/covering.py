"""Assigning points in time to the spans that contain them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardspan.functions import day_number
from wardspan.operators.ranges import RANGE, Like, cut_ranges
from wardspan.runtime import partitions_for, stage

_CELL, _LEVEL, _POINT = "_cell", "_level", "_point"
_FROM, _TO = "_from_minute", "_to_minute"
LEVELS = 16  # cells of 4 ** level minutes: one minute to 2,000 years


def _minute(column: Column, kind: T.DataType) -> Column:
    """Minutes since 1970 of a date or time."""
    day = day_number(column).cast("long") * 1440
    return day if isinstance(kind, T.DateType) else day + F.hour(column) * 60 + F.minute(column)


def _own_level(minutes: Column) -> Column:
    """The level at which a span of so many minutes is 4 to 16 cells long, or 0."""
    return reduce(Column.__add__, [(minutes >= 4**j).cast("int") for j in range(2, LEVELS + 1)])


def _cell(minute: Column) -> Column:
    return F.call_function("shiftright", minute, F.col(_LEVEL) * 2)


def shared_level(lengths: DataFrame, minutes: Column) -> tuple[int, list[int]]:
    """The level most spans are cut at, and all levels in use.

    It is the highest one whose cells are at most the spans' mean length, so that the cells of all
    spans cover at most three times their time. Spans of more than 64 such cells keep their own level.
    """
    return _levels_and_cells(lengths, minutes)[:2]


def _levels_and_cells(lengths: DataFrame, minutes: Column) -> tuple[int, list[int], int]:
    """The levels of ``shared_level``, and about how many cells the spans touch."""
    own = _own_level(minutes)
    total = lengths.agg(F.avg(minutes).alias("mean"), F.collect_set(own).alias("levels"), F.count(F.lit(1)).alias("n")).first()
    base = max((j for j in range(LEVELS) if 4**j <= (total["mean"] or 0)), default=0)
    used = sorted({base if level <= base + 1 else level for level in total["levels"]}) or [base]
    return base, used, int(total["n"] * min(1 + (total["mean"] or 0) / 4**base, 65))


def cut_spans(
    spans: DataFrame, from_minute: Column, to_minute: Column, base: int, levels: Sequence[int] = ()
) -> DataFrame:
    """``spans`` repeated for each cell they touch, at level ``base`` or their own: at most 65. If
    ``levels`` says that no other one is in use, the lengths are not compared again.

    Filters that Spark infers from a join or an explode are pushed down to where the minutes are
    computed, and compute them anew for each comparison of a level: so a level is a constant or never
    null, and the explode an outer one."""
    own = _own_level(to_minute - from_minute + 1)
    level = F.coalesce(F.when(own <= base + 1, base).otherwise(own), F.lit(0))
    leveled = spans.withColumn(_LEVEL, F.lit(base) if list(levels) == [base] else level)
    cells = F.explode_outer(F.sequence(_cell(from_minute), _cell(to_minute)))
    return leveled.withColumn(_CELL, cells).filter(F.col(_CELL).isNotNull())


def containment_join(
    points: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    at: str,
    lo: str,
    hi: str,
    how: str = "inner",
) -> DataFrame:
    """Every (point, span) of equal keys with ``lo <= at <= hi``; ``how`` is inner or left.

    Time is cut into cells of a minute, four, sixteen and so on. A span is repeated for the cells it
    touches, and points look spans up by key and cell, so a large key is spread over the time it
    covers. The size of the cells follows from the spans' mean length; a span of more than 64 cells is
    cut into larger ones, by its own length. So no span is in more than 65 pieces, whether spans last
    minutes or centuries or both, and the pieces cover at most three times the time of the spans.
    Points are repeated for each size in use, of which there are few. Spans are clipped to the time of
    the points. Key columns have the same names on both sides; a null key matches nothing.

    Not lazy: a small job finds the time of the points, and one the lengths. With several sizes of
    cells a left join stages the points and the matches. A join of more rows than the session's
    partitions should sort is staged in more partitions (``partitions_for``).
    """
    kinds = {c: df.schema[c].dataType for df, c in ((points, at), (spans, lo), (spans, hi))}
    minute = {c: _minute(F.col(c), kind) for c, kind in kinds.items()}
    first, last, rows = points.agg(F.min(minute[at]), F.max(minute[at]), F.count(F.lit(1))).first()
    if first is None:  # no point in time at all: nothing can match
        first, last = 0, -1
    # A date stands for its first moment, in points as in the ends of spans.
    from_minute = F.greatest(minute[lo], F.lit(first))
    to_minute = F.least(minute[hi], F.lit(last))
    touching = spans.filter((F.col(hi) >= F.col(lo)) & (from_minute <= to_minute))
    # Columns, as a length is compared with every level, and minutes of a time are dear to compute.
    touching = touching.withColumns({_FROM: from_minute, _TO: to_minute})
    base, levels, cells = _levels_and_cells(touching, F.col(_TO) - F.col(_FROM) + 1)
    sorted_rows = rows * len(levels) + cells
    pieces = cut_spans(touching, F.col(_FROM), F.col(_TO), base, levels).drop(_FROM, _TO)
    pieces = pieces.withColumnsRenamed({c: f"_span_{c}" for c in (*keys, _LEVEL, _CELL)})
    same = (F.col(_CELL) == F.col(f"_span_{_CELL}")) & (F.col(_LEVEL) == F.col(f"_span_{_LEVEL}"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_span_{k}"))
    inside = (F.col(at) >= F.col(lo)) & (F.col(at) <= F.col(hi))

    def joined(points: DataFrame, how: str) -> DataFrame:
        at_levels = F.lit(levels[0]) if len(levels) == 1 else F.explode(F.array(*map(F.lit, levels)))
        placed = points.withColumn(_LEVEL, at_levels).withColumn(_CELL, _cell(minute[at]))
        found = placed.join(pieces, same & inside, how)
        return found.drop(_LEVEL, _CELL, *[f"_span_{c}" for c in (*keys, _LEVEL, _CELL)])

    if how == "inner" or len(levels) == 1:
        with partitions_for(points.sparkSession, sorted_rows) as more:
            return stage(joined(points, how), "contained") if more else joined(points, how)
    numbered = stage(points.withColumn(_POINT, F.monotonically_increasing_id()), "points")
    with partitions_for(points.sparkSession, sorted_rows):
        found = stage(joined(numbered, "inner"), "contained")
    rest = numbered.join(found.select(_POINT), _POINT, "left_anti")
    return found.unionByName(rest, allowMissingColumns=True).drop(_POINT)


def earliest_cover(
    points: DataFrame,
    spans: DataFrame,
    key: str,
    at: str,
    kinds: Sequence[str],
    exact_kinds: Sequence[str] = (),
    like: Sequence[Like] | None = None,
) -> DataFrame:
    """For every point and kind of span, the span containing it that starts first.

    ``spans`` has columns ``key``, kind, span_id, span_start, span_end. The result is the points plus
    one struct column (span_id, span_start) per kind, NULL where no span of the kind contains the
    point. Kinds in ``exact_kinds`` also give ``<kind>_exact``: the smallest span id starting exactly
    at the point. Spans that differ only in their id should be reduced to the smallest one before. A
    null key matches nothing.

    No pairs are formed. Among the spans of a key in order of start, only those reaching beyond all
    before them can be the first to contain a point, and each of them only after that reach; cut to
    these stretches the spans of a kind are disjoint, and the last stretch begun decides. Spans are
    sorted once to find the stretches, and these once more together with the points, in ranges of
    (key, time) (``Ranges``); what a key had in the ranges before is broadcast. Points at a moment
    that fills a range by itself are not sorted: the moment is looked up, and its answer broadcast.

    ``like`` has frames with ``key`` and ``at`` that are cheap to read and distributed like the points
    and spans; by default these are sampled themselves. Stretches are staged when this is called.
    """
    time, before = "_time", (Window.unboundedPreceding, -1)
    valid = spans.filter(
        F.col(key).isNotNull() & (F.col("span_end") >= F.col("span_start")) & F.col("kind").isin(*kinds)
    ).withColumn(time, F.col("span_start"))
    known = points.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    like = like or [Like(points.select(key, at)), Like(spans.select(key, F.col("span_start").alias(at)))]

    def timed(one: Like) -> Like:
        return Like(one.base, lambda some: one.through(some).select(key, F.col(at).alias(time)).dropna())

    ranges = cut_ranges([timed(one) for one in like], [key, time], exact=True)
    split = ranges.on_cuts(valid, key)
    of_split = F.broadcast(split.select(key).distinct())

    # Stretches: how far the spans before reach, in the ranges before and in this one.
    ordered = Window.partitionBy(RANGE, key, "kind").orderBy("span_start", "span_id")
    across = Window.partitionBy(key, "kind").orderBy(RANGE).rowsBetween(*before)
    reached = (
        ranges.assign(valid.join(of_split, key, "left_semi"))
        .groupBy(key, "kind", RANGE)
        .agg(F.max("span_end").alias("_end"))
        .withColumn("_far", F.max("_end").over(across))
        .drop("_end")
    )
    reach = F.greatest(F.max("span_end").over(ordered.rowsBetween(*before)), F.col("_far"))
    again = F.lag("span_start").over(ordered).eqNullSafe(F.col("span_start"))
    dealt = ranges.deal(valid).join(F.broadcast(reached), [key, "kind", RANGE], "left")
    dealt = dealt.withColumns({"_reach": reach, "_again": again})
    # A stretch opened by the reach of an earlier span begins just after that moment.
    late = F.coalesce(F.col("_reach") >= F.col("span_start"), F.lit(False))

    def stretch(kind: Column, to: Column, since: Column, rank: Column) -> Column:
        return F.struct(kind.alias("kind"), to.alias("_to"), since.alias(time), rank.alias("_rank"))

    longer = F.col("_reach").isNull() | (F.col("span_end") > F.col("_reach"))
    since = F.greatest("span_start", "_reach")
    of_kind = F.when(longer, stretch(F.col("kind"), F.col("span_end"), since, F.when(late, 2).otherwise(0)))
    exact = F.when(
        F.col("kind").isin(*exact_kinds) & ~F.col("_again"),
        stretch(F.concat("kind", F.lit("_exact")), F.col("span_start"), F.col("span_start"), F.lit(0)),
    )
    begun = dealt.select(
        key,
        F.struct("span_id", "span_start").alias("_span"),
        F.explode(F.array(of_kind, exact)).alias("_s"),  # a filter of the array would not be compiled
    ).filter("_s IS NOT NULL").select(key, "_span", "_s.*")
    begun = stage(begun, "stretches")

    names = [*kinds, *[f"{k}_exact" for k in exact_kinds]]
    stretches = {n: F.when(F.col("kind") == n, F.struct("_span", "_to")) for n in names}
    moment = F.struct(time, "_rank")
    upto = Window.partitionBy(key).orderBy(RANGE).rowsBetween(*before)
    last = ranges.assign(begun.join(of_split, key, "left_semi")).groupBy(key, RANGE)
    last = last.agg(*[F.max_by(s, F.when(s.isNotNull(), moment)).alias(n) for n, s in stretches.items()])
    carried = (
        split.join(last, [key, RANGE], "full")
        .select(key, RANGE, *[F.last(n, ignorenulls=True).over(upto).alias(f"_before_{n}") for n in names])
    )

    hot = None
    if ranges.repeated is not None:
        moments = points.sparkSession.range(1).select(F.explode(ranges.repeated).alias("m"))
        hot = moments.select(F.col("m.v0").alias(key), F.col("m.v1").alias(time))
        held = known.withColumn(time, F.col(at)).join(F.broadcast(hot), [key, time], "left_semi").drop(time)
        known = known.withColumn(time, F.col(at)).join(F.broadcast(hot), [key, time], "left_anti").drop(time)
    asked = known.select(key, F.col(at).alias(time), F.struct(*points.columns).alias("_row"))
    if hot is not None:
        asked = asked.unionByName(hot, allowMissingColumns=True)
    asked = asked.withColumns({"_rank": F.lit(1), "_asked": F.lit(True)})
    together = ranges.deal(asked.unionByName(begun, allowMissingColumns=True))
    within = Window.partitionBy(RANGE, key).orderBy(time, "_rank").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        together.select(
            key, time, RANGE, "_asked", "_row",
            *[F.last(s, ignorenulls=True).over(within).alias(f"_today_{n}") for n, s in stretches.items()],
        )
        .filter("_asked")
        .join(F.broadcast(carried), [key, RANGE], "left")
    )
    latest = {n: F.coalesce(f"_today_{n}", f"_before_{n}") for n in names}
    answers = [F.when(F.col(f"{n}._to") >= F.col(time), F.col(f"{n}._span")).alias(n) for n in names]
    answered = found.withColumns(latest).select("_row", key, time, *answers)
    result = answered.filter("_row IS NOT NULL").select("_row.*", *names)
    if hot is not None:
        moments = stage(answered.filter("_row IS NULL").select(key, F.col(time).alias(at), *names), "hot-moments")
        result = result.unionByName(held.join(F.broadcast(moments), [key, at]).select(*points.columns, *names))
    lost = points.filter(F.col(key).isNull() | F.col(at).isNull())
    return result.unionByName(lost, allowMissingColumns=True)
