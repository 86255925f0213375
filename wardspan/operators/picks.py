"""One best row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pick_best(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes first by ``order``, NULLs last.

    A minimum combines on the map side, so a hot key is reduced before the shuffle. ``order`` should
    be total for a repeatable pick.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = [part for c in order for part in (F.col(c).isNull(), F.col(c))]
    best = F.min_by(F.struct(*rest), F.struct(*rank)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)
