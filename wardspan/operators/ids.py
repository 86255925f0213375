"""Dense surrogate keys 1..n in a given order, numbered by all tasks in parallel."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import takewhile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardspan.operators.ranges import RANGE, Like, cut_ranges
from wardspan.runtime import stage

# Tells identical copies of a source row apart, so that range partitioning can split them.
COPY = "copy_no"
_SLOT = "_slot"
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above the low 33 bits


def tag_copies(scan: DataFrame) -> DataFrame:
    """Add ``copy_no`` to a file scan.

    Apply it to a scan only: there a retried task reads the same rows in the same order and gives
    them the same numbers, which is not so behind a shuffle.
    """
    return scan.withColumn(COPY, F.monotonically_increasing_id())


def _leading(like: Sequence[Like], order: Sequence[str]) -> list[str]:
    """The columns of ``order`` up to the first that ``like`` does not have."""
    has = set(like[0].through(like[0].base.limit(0)).columns)
    return list(takewhile(has.__contains__, order))


def dense_ids(
    df: DataFrame, order: Sequence[str], name: str, like: Sequence[Like] | None = None
) -> DataFrame:
    """Number the rows 1..n by ``order`` (NULLs last) in column ``name``.

    ``order`` must be a total order up to identical rows; then a rerun gives the same result. The
    rows are range partitioned and sorted, written once with their position inside the partition,
    and shifted by the row counts of the partitions before. Only one count per partition reaches the
    driver.

    ``like`` gives frames with the leading columns of ``order`` that are cheap to read and distributed
    like the rows (``Ranges``). With it the rows are computed once and ranged on their first write.
    Without it, or if a single key of ``like`` fills more than a range, the rows are staged first and
    ranged by their whole order, so that a key holding a third of the rows is spread over a third of
    the partitions; identical copies are spread through ``copy_no`` if the frame has it.

    Not lazy: the rows are computed and written when this is called.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    if COPY in df.columns:
        keys.append(F.col(COPY).asc())
    ranges = cut_ranges(like, _leading(like, order)) if like else None
    if ranges and ranges.repeated is None:
        dealt = df.repartition(1) if ranges.count == 1 else ranges.deal(df).drop(RANGE)
        ranged = dealt.sortWithinPartitions(*keys)
    else:
        # Range partitioning samples its input first; from a staged table that is a plain read.
        ranged = stage(df, f"{name}-rows").repartitionByRange(*keys).sortWithinPartitions(*keys)
    staged = stage(ranged.withColumn(_SLOT, F.monotonically_increasing_id()).drop(COPY), name)

    part = F.shiftright(_SLOT, _ROW_BITS)
    position = F.col(_SLOT).bitwiseAND((1 << _ROW_BITS) - 1) + 1
    sizes = sorted(staged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, before = [], 0
    for row in sizes:
        offsets.append((row["part"], before))
        before += row["n"]
    shift = df.sparkSession.createDataFrame(offsets, "_part long, _before long")
    return (
        staged.withColumn("_part", part)
        .join(F.broadcast(shift), "_part")  # one row per partition
        .withColumn(name, F.col("_before") + position)
        .drop("_part", "_before", _SLOT)
    )
