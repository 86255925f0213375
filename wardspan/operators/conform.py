"""Fit a frame to a fixed layout: column order, types and typed NULLs for what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Missing columns become NULL, extra ones are left out."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f'`{f.name}`' if f.name in present else 'NULL'} AS {f.dataType.simpleString()})"
            f" AS `{f.name}`"
            for f in schema.fields
        ]
    )


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
