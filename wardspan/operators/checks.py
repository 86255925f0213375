"""Data quality reports. Spark enforces no NOT NULL and no keys, so they are counted instead."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardspan.schemas import required_columns


def check_not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column_name, null_count) for every required column, in one aggregate pass."""
    names = [c for c in required_columns(schema) if c in df.columns]
    counted = df.agg(*_nulls(names))
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in names]
    return counted.select(F.inline(F.array(*pairs)))


def observe_not_null(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, Observation]:
    """``df``, and the counts of ``check_not_null`` by column, which are taken while the first action
    on it runs, such as its write; nothing is read again for them."""
    seen = Observation()
    names = [c for c in required_columns(schema) if c in df.columns]
    return (df.observe(seen, *_nulls(names)) if names else df), seen


def _nulls(names: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in names]


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(repeated_keys, surplus_rows): keys occurring more than once and the rows beyond the first."""
    return (
        df.groupBy(*keys)
        .count()
        .agg(
            F.count_if(F.col("count") > 1).alias("repeated_keys"),
            F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("surplus_rows"),
        )
    )


def interval_problems(df: DataFrame, start: str, end: str) -> DataFrame:
    """(open_start, open_end, inverted): the rows that interval merging cannot use as they are."""
    return df.agg(
        F.count_if(F.col(start).isNull()).alias("open_start"),
        F.count_if(F.col(end).isNull()).alias("open_end"),
        F.count_if(F.col(end) < F.col(start)).alias("inverted"),
    )


def repeated_deaths(death: DataFrame) -> DataFrame:
    """(person_id, death_rows) for persons with more than one death row."""
    return (
        death.groupBy("person_id")
        .agg(F.count(F.lit(1)).alias("death_rows"))
        .filter(F.col("death_rows") > 1)
    )
