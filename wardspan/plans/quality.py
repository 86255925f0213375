"""One report over sources and finished tables: what Spark does not enforce and the build leaves out."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardspan.operators import (
    check_not_null,
    check_unique,
    code_map,
    interval_problems,
    repeated_deaths,
    unmapped_codes,
)
from wardspan.plans.codes import CLASSES, VisitClasses
from wardspan.plans.visits import hidden_stays
from wardspan.schemas import CDM

_UNIQUE = ("encounters", "patients", "providers")
_INTERVALS = ("allergies", "conditions", "devices", "encounters", "medications", "procedures")
_CODED = (
    "allergies",
    "conditions",
    "devices",
    "immunizations",
    "medications",
    "observations",
    "procedures",
)


def quality_report(
    source: dict[str, DataFrame],
    standard: DataFrame,
    done: dict[str, DataFrame],
    nulls: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """(check_name, table_name, column_name, row_count) for the tables given.

    missing: NULLs in required columns; surplus: rows beyond the first of an id; inverted: intervals
    that end before they start; unmapped: events whose code has no standard concept at all;
    repeated: persons with more than one death. ``nulls`` are the counts of NULLs by table and column
    that were taken while tables were written (``observe_not_null``); those tables are not scanned for them.
    """
    parts = []

    def add(check: str, table: str, column, rows: DataFrame, count: str) -> None:
        named = F.lit(column) if isinstance(column, str) else column
        parts.append(
            rows.select(
                F.lit(check).alias("check_name"),
                F.lit(table).alias("table_name"),
                named.alias("column_name"),
                F.coalesce(count, F.lit(0)).cast("long").alias("row_count"),
            )
        )

    for name, table in done.items():
        if nulls and nulls.get(name):
            counts = list(nulls[name].items())
            missing = standard.sparkSession.createDataFrame(counts, "column_name string, null_count long")
        else:
            missing = check_not_null(table, CDM[name])
        add("missing", name, F.col("column_name"), missing, "null_count")
    for name in sorted(source.keys() & set(_UNIQUE)):
        add("surplus", name, "id", check_unique(source[name], ["id"]), "surplus_rows")
    for name in sorted(source.keys() & set(_INTERVALS)):
        problems = interval_problems(source[name], "start", "stop")
        add("inverted", name, "stop", problems, "inverted")
    mapped = code_map(standard)
    for name in sorted(source.keys() & set(_CODED)):
        lost = unmapped_codes(source[name], mapped).agg(F.sum("event_count").alias("n"))
        add("unmapped", name, "code", lost, "n")
    if "death" in done:
        again = repeated_deaths(done["death"]).agg(F.count(F.lit(1)).alias("n"))
        add("repeated", "death", "person_id", again, "n")
    return reduce(DataFrame.unionByName, parts)


def hidden_report(encounters: DataFrame, classes: VisitClasses = CLASSES) -> DataFrame:
    """A row like those of ``quality_report``: stays that an open stay of the patient hides."""
    return hidden_stays(encounters, classes).agg(
        F.lit("hidden").alias("check_name"),
        F.lit("encounters").alias("table_name"),
        F.lit("stop").alias("column_name"),
        F.count(F.lit(1)).alias("row_count"),
    )
