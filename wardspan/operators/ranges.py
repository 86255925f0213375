"""Ranges of a total order, cut where a bounded sample says, for scans that go from row to row.

Rows of neighbouring ranges lie in neighbouring partitions, so one shuffle and one sort serve any
number of windows by (range, key). What a window misses is what the key had in the ranges before; only
keys that lie on a cut have such ranges, and there are no more of them than cuts. So their summaries
are small and broadcast, however many rows a key has.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE = "_range"
ROWS = 1_000_000  # that a range should hold
LEAST_ROWS = 10_000  # below, it is not worth a task
MOST = 4096  # ranges; beyond, they hold more rows and sort on disk
PER_RANGE = 40  # sampled rows
_ROW_KEY = "_row_key"


@dataclass(frozen=True)
class Like:
    """Rows whose order columns are distributed like those of a frame that is dear to compute.

    ``base`` is counted and sampled, so it should be a scan; ``through`` turns the sample, a few
    thousand rows, into the columns that count, for example by joining an id to it.
    """

    base: DataFrame
    through: Callable[[DataFrame], DataFrame] = lambda sample: sample


def _key(columns: Sequence[str]) -> Column:
    """Compares like the columns, NULLs last."""
    flagged = [(F.when(F.col(c).isNull(), 1).alias(f"n{i}"), F.col(c).alias(f"v{i}")) for i, c in enumerate(columns)]
    return F.struct(*[p for pair in flagged for p in pair])


@dataclass(frozen=True)
class Ranges:
    columns: tuple[str, ...]  # as many of those asked for as tell the cuts apart
    count: int
    cuts: Column  # array of keys, in order; a row belongs behind every cut that is not above it
    repeated: Column | None  # keys that take more than one range's share of the sample

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with the number of each row's range, found by halving. Every step is a column of its
        own: compiled, and computed once a row."""
        found = df.withColumn(RANGE, F.lit(0))
        if self.count == 1:
            return found
        found = found.withColumn(_ROW_KEY, _key(self.columns))
        for width in [1 << k for k in reversed(range(self.count.bit_length()))]:
            at = F.col(RANGE)
            found = found.withColumn(
                RANGE, F.when(F.get(self.cuts, at + F.lit(width - 1)) <= F.col(_ROW_KEY), at + F.lit(width)).otherwise(at)
            )
        return found.drop(_ROW_KEY)

    def deal(self, df: DataFrame) -> DataFrame:
        """``df`` with each range in a partition of its own; a single range is left as it lies."""
        assigned = self.assign(df)
        return assigned if self.count == 1 else assigned.repartitionById(self.count, F.col(RANGE))

    def on_cuts(self, df: DataFrame, key: str) -> DataFrame:
        """(key, range) of each key of ``df`` that may lie in more than one range, for the ranges it
        may lie in. ``key`` is the first of the columns."""
        if self.count == 1:
            return df.select(key).filter("false").withColumn(RANGE, F.lit(0))
        cuts = df.sparkSession.range(1).select(F.posexplode(self.cuts).alias("at", "cut"))
        cuts = cuts.select(F.col("cut.v0").alias(key), "at")
        return cuts.select(key, F.explode(F.array("at", F.col("at") + 1)).alias(RANGE)).distinct()


def cut_ranges(
    likes: Sequence[Like], columns: Sequence[str], count: int | None = None, exact: bool = False
) -> Ranges:
    """Ranges of about equal numbers of rows in the order of ``columns``, NULLs last.

    The base frames are counted, and ``PER_RANGE`` rows a range are drawn from them: at most 163,840
    in all, sorted in one place. The cuts, at most ``MOST`` keys, become part of the plan. Which rows
    are drawn changes the ranges, not what is computed over them. With ``exact`` all columns cut, and
    not only as many as tell the cuts apart.
    """
    rows = sum(like.base.count() for like in likes)
    context = likes[0].base.sparkSession.sparkContext
    if count is None:
        count = max(min(context.defaultParallelism, rows // LEAST_ROWS), min(rows // ROWS, MOST), 1)
    share = count * PER_RANGE / max(rows, 1)
    drawn = [
        like.through(F.broadcast(like.base if share >= 1 else like.base.sample(share, seed=17)))
        for like in likes
    ]
    sample = reduce(DataFrame.unionByName, [d.select(*columns) for d in drawn])
    texts = [F.col(c).cast("string") for c in columns]
    # Moved, not coalesced, to one place: that would have one task read the base frames whole.
    ordered = sample.repartition(1).sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in columns])
    keys = [tuple(row) for row in ordered.select(*texts).collect()]
    every = max(len(keys) // count, 1)
    chosen = keys[every - 1 : every * (count - 1) : every]
    cuts = list(dict.fromkeys(chosen))
    repeated = sorted({a for a, b in zip(chosen, chosen[1:]) if a == b}, key=chosen.index)
    width = len(columns) if exact else next(w for w in range(1, len(columns) + 1) if len({c[:w] for c in cuts}) == len(cuts))

    def written(keys: list[tuple], width: int) -> Column:
        """Keys as a constant of the plan, from their texts."""
        kind = sample.select(F.array(_key(columns[:width])).alias("k")).schema["k"].dataType.simpleString()
        rows = [
            {f"n{i}": "1" if v is None else None, f"v{i}": v} for k in keys for i, v in enumerate(k[:width])
        ]
        merged = [dict(pair for r in rows[j : j + width] for pair in r.items()) for j in range(0, len(rows), width)]
        plain = ", ".join(f"n{i}: string, v{i}: string" for i in range(width))
        return F.from_json(F.lit(json.dumps(merged)), f"array<struct<{plain}>>").cast(kind)

    return Ranges(
        tuple(columns[:width]), len(cuts) + 1, written(cuts, width), written(repeated, len(columns)) if repeated else None
    )
