"""Column helpers: everything here is a built-in expression and stays inside code generation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardspan.schemas import NUMERIC

# Fixed value: unsigned decimals only, so "-3" and "1e5" are not numbers.
PLAIN_NUMBER = r"^([0-9]+\.?[0-9]*|\.[0-9]+)\z"


def case_map(column: Column, mapping: Mapping[str, object], default: object = None) -> Column:
    """Case-insensitive lookup of a text column in a short literal table."""
    folded = F.lower(column)
    result = None
    for key, value in mapping.items():
        hit = folded == key.lower()
        result = F.when(hit, value) if result is None else result.when(hit, value)
    return result.otherwise(default)


def parse_number(column: Column) -> Column:
    """DECIMAL(18,3) for plain unsigned decimals, NULL for every other text."""
    return F.when(column.rlike(PLAIN_NUMBER), column.try_cast(NUMERIC))


def days_between(end: Column, start: Column) -> Column:
    """Whole days from start to end, both taken as dates."""
    return F.datediff(end.cast("date"), start.cast("date"))


def plus_days(column: Column, days: int, kind: T.DataType) -> Column:
    """A date or timestamp moved by whole days, keeping its type."""
    if isinstance(kind, T.DateType):
        return F.date_add(column, days)
    return column + F.make_dt_interval(days=F.lit(days))


def day_number(column: Column) -> Column:
    return F.unix_date(column.cast("date"))


def stamp_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
