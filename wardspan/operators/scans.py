"""Ordered scans over the rows of a key that stay parallel when one key is very large.

A window over a key puts the whole key into one task. Here each key is cut into day blocks: a window
inside (key, day) gives the answer among the rows of the day, and a window over one summary row per
day (a century has 36,525) carries the answer in from the days before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardspan.functions import day_number

_BLOCK, _CARRY, _LOCAL = "_block", "_carry", "_local"


def previous_value(
    df: DataFrame, keys: Sequence[str], time: str, tie: str, value: str, out: str
) -> DataFrame:
    """``value`` of the preceding row of the key by (time, tie); NULL for the first.

    ``df`` is read twice; keys, time and value must not be NULL.
    """
    blocked = df.withColumn(_BLOCK, day_number(F.col(time)))
    within = Window.partitionBy(*keys, _BLOCK).orderBy(time, tie)
    across = Window.partitionBy(*keys).orderBy(_BLOCK)
    carried = (
        blocked.groupBy(*keys, _BLOCK)
        .agg(F.max_by(value, F.struct(time, tie)).alias("_last"))
        .select(*keys, _BLOCK, F.lag("_last").over(across).alias(_CARRY))
    )
    return (
        blocked.withColumn(_LOCAL, F.lag(value).over(within))
        .join(carried, [*keys, _BLOCK], "left")
        .withColumn(out, F.coalesce(_LOCAL, _CARRY))
        .drop(_LOCAL, _CARRY, _BLOCK)
    )


def highest_before(
    df: DataFrame, keys: Sequence[str], time: str, tie: str, value: str, out: str
) -> DataFrame:
    """Largest ``value`` among the preceding rows of the key by (time, tie); NULL for the first."""
    blocked = df.withColumn(_BLOCK, day_number(F.col(time)))
    preceding = (Window.unboundedPreceding, -1)
    within = Window.partitionBy(*keys, _BLOCK).orderBy(time, tie).rowsBetween(*preceding)
    across = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(*preceding)
    carried = (
        blocked.groupBy(*keys, _BLOCK)
        .agg(F.max(value).alias("_top"))
        .select(*keys, _BLOCK, F.max("_top").over(across).alias(_CARRY))
    )
    return (
        blocked.withColumn(_LOCAL, F.max(value).over(within))
        .join(carried, [*keys, _BLOCK], "left")
        .withColumn(out, F.greatest(_LOCAL, _CARRY))
        .drop(_LOCAL, _CARRY, _BLOCK)
    )
