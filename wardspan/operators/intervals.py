"""Merging of intervals that overlap, touch or lie within an allowed gap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardspan.functions import day_number, plus_days
from wardspan.runtime import spread, stage

_CELL, _ISLAND, _REACH = "_cell", "_island", "_reach"
_DAY, _RUN, _ALONE = "_day", "_run", "_alone"


def _cell(df: DataFrame, start: str, gap_days: int) -> Column:
    """Two valid intervals starting in one cell are never more than the gap apart, so they always
    belong together and may be folded before the rows of a key are brought into one place."""
    if _by_moment(df, start, gap_days):
        return F.col(start)
    if isinstance(df.schema[start].dataType, T.DateType):
        return F.floor(day_number(F.col(start)) / F.lit(gap_days + 1))
    return F.floor(day_number(F.col(start)) / F.lit(gap_days))


def _number_islands(
    cells: DataFrame, keys: Sequence[str], start: str, end: str, gap_days: int
) -> DataFrame:
    """Cells, and rows without an end, in islands: the number and the end of each. A row without an
    end opens no island and reaches nowhere; it stays if the island before it covers its start."""
    kind = cells.schema[end].dataType
    if _by_moment(cells, start, gap_days):
        return _number_by_day(cells, keys, start, end)
    # Cells come before such rows of the same start.
    ordered = Window.partitionBy(*keys).orderBy(start, F.col(end).isNull())
    reach = F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    beyond = F.col(_REACH).isNull() | (F.col(start) > plus_days(F.col(_REACH), gap_days, kind))
    opens = F.col(end).isNotNull() & beyond
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (
        cells.withColumn(_REACH, reach)
        .withColumn(_ISLAND, F.sum(opens.cast("long")).over(upto))
        .withColumn(_REACH, F.max(end).over(Window.partitionBy(*keys, _ISLAND)))
    )
    return numbered.filter(F.col(start) <= F.col(_REACH))


def _by_moment(df: DataFrame, start: str, gap_days: int) -> bool:
    """Whether no cell can be given to the rows, so that their islands are found day by day."""
    return gap_days == 0 and not isinstance(df.schema[start].dataType, T.DateType)


def _day_runs(cells: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Moments without a gap, of which a key may have any number: the run of each among the rows that
    start on its day. A row without an end that no row of its day covers is alone. Fields of structs
    are equal if both are null, so a null key is a key here too."""
    ordered = Window.partitionBy("_key", _DAY).orderBy(start, F.col(end).isNull())
    reach = F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.coalesce(F.col(start) <= F.col(_REACH), F.lit(False))
    opens = F.col(end).isNotNull() & ~covered
    alone = F.struct(F.when(F.col(end).isNull() & ~covered, F.col(start)).alias("at"))
    return (
        cells.withColumns({"_key": F.struct(*keys), _DAY: day_number(F.col(start))})
        .withColumn(_REACH, reach)
        .withColumns({_RUN: F.sum(opens.cast("long")).over(upto), _ALONE: alone})
        .drop(_REACH)
    )


def _stitch(runs: DataFrame, start: str, end: str) -> DataFrame:
    """Runs of days in islands, named by the moment that opens them. An island is carried into a day by
    one summary row for each day before: how far they reach, and where the last one opened."""
    known = F.when(F.col(end).isNotNull(), F.col(start))
    before = Window.partitionBy("_key").orderBy(_DAY).rowsBetween(Window.unboundedPreceding, -1)
    opened = F.when(F.col(_REACH).isNull() | (F.col(_ISLAND) > F.col(_REACH)), F.col(_ISLAND))
    days = (
        runs.groupBy("_key", _DAY)
        .agg(F.max(end).alias(_REACH), F.max(known).alias(_ISLAND))
        .withColumn(_REACH, F.max(_REACH).over(before))
        .withColumn(_ISLAND, opened)
        .withColumn(_ISLAND, F.max(_ISLAND).over(before))
    )
    carried = F.col(start) <= F.col(_REACH)
    island = F.when(carried, F.col(_ISLAND)).otherwise(known)
    return runs.join(days, ["_key", _DAY]).withColumn(_ISLAND, island).drop(_REACH).filter(F.col(_ISLAND).isNotNull())


def _number_by_day(cells: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """The cells of ``_number_islands`` for moments without a gap."""
    one_run = ["_key", _DAY, _RUN, _ALONE]
    numbered = stage(_day_runs(cells, keys, start, end), "runs")
    runs = numbered.groupBy(*one_run).agg(F.min(start).alias(start), F.max(end).alias(end))
    islands = _stitch(runs, start, end)
    ends = islands.groupBy("_key", _ISLAND).agg(F.max(end).alias(_REACH))
    found = islands.join(ends, ["_key", _ISLAND]).select(*one_run, _ISLAND, _REACH)
    return numbered.join(found, one_run).drop(*one_run)


def valid_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose start and end are known and in order; ``interval_problems`` counts the others."""
    return df.filter(F.col(start).isNotNull() & (F.col(end) >= F.col(start)))


def inverted_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows that end before they start."""
    return df.filter(F.col(end) < F.col(start))


def merge_intervals(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    gap_days: int = 0,
    count_as: str | None = None,
    sums: Mapping[str, str] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """One row per island: keys, first start, last end, number of rows and sums of columns.

    ``start`` and ``end`` are both dates or both timestamps. A row joins the island before it when
    its start is at most ``gap_days`` after the latest end so far.

    A row that ends before it starts is counted in the island that covers its start; if there is
    none it is left out, as rows without a start or an end are. ``interval_problems`` counts both.

    Rows are first folded to one per key and cell of the gap's width, with map-side combine: a hot
    key or copied rows shrink before any shuffle, and no window sees more rows of a key than there
    are cells in the time covered (36,525 days a century for dates without a gap, 1,179 cells for
    30 days). The island window and the final grouping share one exchange by key. Timestamps
    without a gap have no such cells: they are folded to the runs of a day, which are staged when
    this is called, and stitched over days by one summary row a day.

    ``rows`` is about how many rows ``df`` has, if that is cheap to tell. With it the islands of many
    rows are found in more partitions than the session has, so that no task sorts more the more rows
    there are.
    """
    sums = dict(sums or {})
    parts = [F.count(F.lit(1)).alias("_n")] if count_as else []
    parts += [F.sum(column).alias(f"_sum_{out}") for out, column in sums.items()]
    folded = (
        valid_intervals(df, start, end)
        .groupBy(*keys, _cell(df, start, gap_days).alias(_CELL))
        .agg(F.min(start).alias(start), F.max(end).alias(end), *parts)
        .drop(_CELL)
    )
    points = inverted_intervals(df, start, end).groupBy(*keys, start).agg(F.lit(1).alias(_ISLAND), *parts)
    points = points.drop(_ISLAND).withColumn(end, F.lit(None).cast(df.schema[end].dataType))
    folded = folded.unionByName(points)
    totals = [F.sum("_n").alias(count_as)] if count_as else []
    totals += [F.sum(f"_sum_{out}").alias(out) for out in sums]
    if _by_moment(df, start, gap_days):
        runs = _day_runs(folded, keys, start, end).groupBy("_key", _DAY, _RUN, _ALONE)
        held = ["_n"] if count_as else []
        held += [f"_sum_{out}" for out in sums]
        held = [F.sum(c).cast(folded.schema[c].dataType).alias(c) for c in held]
        runs = stage(runs.agg(F.min(start).alias(start), F.max(end).alias(end), *held), "runs")
        numbered = _stitch(runs, start, end).select("*", *[F.col("_key")[k].alias(k) for k in keys])
    else:
        numbered = _number_islands(spread(folded, keys, rows), keys, start, end, gap_days)
    return (
        numbered.groupBy(*keys, _ISLAND)
        .agg(F.min(start).alias(start), F.max(end).alias(end), *totals)
        .drop(_ISLAND)
    )


def island_ends(
    df: DataFrame, keys: Sequence[str], start: str, end: str, out: str, gap_days: int
) -> DataFrame:
    """Keep every row and add the end of its island. A row that ends before it starts belongs to the
    island that covers its start; without one it is dropped, as rows without a start or an end are.

    The islands are found on the folded cells as in ``merge_intervals``; the rows themselves are
    only joined to their cell or start, so no task holds all rows of a key.
    """
    rows = valid_intervals(df, start, end).withColumn(_CELL, _cell(df, start, gap_days))
    cells = rows.groupBy(*keys, _CELL).agg(F.min(start).alias(start), F.max(end).alias(end))
    inverted = inverted_intervals(df, start, end)
    kind = cells.schema[_CELL].dataType
    points = inverted.select(*keys, F.lit(None).cast(kind).alias(_CELL), start).distinct()
    points = points.withColumn(end, F.lit(None).cast(df.schema[end].dataType))
    numbered = _number_islands(cells.unionByName(points), keys, start, end, gap_days)
    numbered = numbered.withColumnRenamed(_REACH, out)
    known = rows.join(numbered.filter(F.col(end).isNotNull()).select(*keys, _CELL, out), [*keys, _CELL])
    covered = inverted.join(numbered.filter(F.col(end).isNull()).select(*keys, start, out), [*keys, start])
    return known.drop(_CELL).unionByName(covered)
