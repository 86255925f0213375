"""Encounters rolled up to visits, and each encounter assigned to one visit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.functions import case_map
from wardspan.operators import (
    Like,
    conform,
    containment_join,
    dense_ids,
    earliest_cover,
    island_ends,
    pick_best,
    previous_value,
)
from wardspan.plans import codes
from wardspan.plans.codes import CLASSES, VisitClasses
from wardspan.runtime import stage
from wardspan.schemas import CDM

_KEYS = ["patient", "encounterclass"]
_VISIT = ["encounter_id", "patient", "encounterclass", "visit_start_date", "visit_end_date", "provider"]
_NEVER = dt.datetime(9999, 12, 31)  # stands for the end of a stay that is still open
_FAMILIES = ("inpatient", "emergency", "outpatient")


def _family(column: Column, classes: VisitClasses) -> Column:
    family = F.lit(None).cast("string")
    for name in _FAMILIES:
        family = F.when(column.isin(*getattr(classes, name)), name).otherwise(family)
    return family


def _same_start(encounters: DataFrame, classes: tuple[str, ...], stop: Column) -> DataFrame:
    """One row per patient, class and start: smallest encounter id, with its provider, and last stop."""
    return (
        encounters.filter(F.col("encounterclass").isin(*classes))
        .groupBy(*_KEYS, F.col("start").alias("visit_start_date"))
        .agg(F.min(F.struct("id", "provider")).alias("_first"), F.max(stop).alias("visit_end_date"))
        .withColumn("encounter_id", F.col("_first.id"))
        .withColumn("provider", F.col("_first.provider"))
        .select(*_VISIT)
    )


def inpatient_visits(
    encounters: DataFrame,
    classes: VisitClasses = CLASSES,
    gap_days: int = 1,
    drop_from_open: bool = True,
) -> DataFrame:
    """Stays with at most ``gap_days`` between them share the end of the last one.

    Every distinct start stays a row of its own. With ``drop_from_open`` a stay without a stop never
    ends, so it and every stay of its island or after it are left out; otherwise it ends at its start.
    A stay that stops before it starts is a visit if an island covers its start.
    """
    never = F.lit(_NEVER).cast("timestamp_ntz")
    stop = F.coalesce("stop", never if drop_from_open else F.col("start"))
    return (
        _stays(encounters, classes, gap_days, stop)
        .filter(F.col("_island_end") < never)
        .withColumn("visit_end_date", F.col("_island_end"))
        .select(*_VISIT)
    )


def hidden_stays(
    encounters: DataFrame, classes: VisitClasses = CLASSES, gap_days: int = 1
) -> DataFrame:
    """The stays that ``inpatient_visits`` leaves out as their island has an open one."""
    never = F.lit(_NEVER).cast("timestamp_ntz")
    stays = _stays(encounters, classes, gap_days, F.coalesce("stop", never))
    return stays.filter(F.col("_island_end") >= never).select(*_VISIT)


def _stays(encounters: DataFrame, classes: VisitClasses, gap_days: int, stop: Column) -> DataFrame:
    """One row per start of a stay, with the end of its island. The starts are staged, as ``island_ends``
    reads them four times and each time would sort and group the encounters anew."""
    usable = encounters.filter(F.col("patient").isNotNull() & F.col("start").isNotNull())
    starts = stage(_same_start(usable, classes.inpatient, stop), "stays")
    return island_ends(
        starts, _KEYS, "visit_start_date", "visit_end_date", "_island_end", gap_days
    )


def emergency_visits(encounters: DataFrame, classes: VisitClasses = CLASSES) -> DataFrame:
    """Emergency encounters of the same patient, class and start become one visit."""
    known = encounters.filter(F.col("patient").isNotNull() & F.col("start").isNotNull())
    return _same_start(known, classes.emergency, F.col("stop"))


def outpatient_visits(encounters: DataFrame, classes: VisitClasses = CLASSES) -> DataFrame:
    """Outpatient encounters of the same patient, class and start become one visit."""
    return _same_start(encounters, classes.outpatient, F.col("stop"))


def all_visits(
    inpatient: DataFrame, emergency: DataFrame, outpatient: DataFrame, like: Like | None = None
) -> DataFrame:
    """All visits, numbered by patient, start, class and encounter. ``like`` has the patients and
    starts of the encounters they come from."""
    together = inpatient.unionByName(emergency).unionByName(outpatient)
    order = ["patient", "visit_start_date", "encounterclass", "encounter_id"]
    return dense_ids(together, order, "visit_occurrence_id", [like] if like else None)


def roll_up(encounters: DataFrame, classes: VisitClasses = CLASSES) -> DataFrame:
    return all_visits(
        inpatient_visits(encounters, classes),
        emergency_visits(encounters, classes),
        outpatient_visits(encounters, classes),
        Like(encounters.select("patient", F.col("start").alias("visit_start_date"))),
    )


def candidate_visits(
    encounters: DataFrame, visits: DataFrame, classes: VisitClasses = CLASSES
) -> DataFrame:
    """Every visit of the patient that contains the start of an encounter, with the visit id where
    the pair of classes is allowed.

    The output is as large as the overlap itself; ``final_visit_ids`` does not need it.
    """
    spans = visits.select(
        "patient",
        F.col("encounterclass").alias("visit_type"),
        "visit_start_date",
        "visit_end_date",
        "visit_occurrence_id",
    )
    points = encounters.select(
        F.col("id").alias("encounter_id"),
        "patient",
        F.col("start").alias("date_service"),
        F.col("stop").alias("date_service_end"),
        "encounterclass",
    )
    pairs = containment_join(
        points, spans, ["patient"], "date_service", "visit_start_date", "visit_end_date"
    )
    asked, held = _family(F.col("encounterclass"), classes), _family(F.col("visit_type"), classes)
    since = F.col("date_service") - F.col("visit_start_date")
    zero = F.make_dt_interval()
    allowed = (
        ((held == "inpatient") & asked.isin("inpatient", "outpatient"))
        | ((held == "inpatient") & (asked == "emergency") & (since > zero))
        | ((held == "emergency") & (asked == "emergency") & (since == zero))
        | ((held == "outpatient") & (asked == "outpatient"))
    )
    return pairs.select(
        "encounter_id",
        F.col("patient").alias("person_source_value"),
        "date_service",
        "date_service_end",
        "encounterclass",
        "visit_type",
        "visit_start_date",
        "visit_end_date",
        "visit_occurrence_id",
        F.when(allowed, F.col("visit_occurrence_id")).alias("visit_occurrence_id_new"),
    )


def pick_visits(candidates: DataFrame, classes: VisitClasses = CLASSES) -> DataFrame:
    """The best candidate per encounter: an inpatient visit, then one of its own family, then none.

    Needs the candidate pairs. ``final_visit_ids`` gives the same rows without forming them.
    """
    held = _family(F.col("visit_type"), classes)
    priority = (
        F.when(F.col("visit_occurrence_id_new").isNull(), 99).when(held == "inpatient", 1).otherwise(2)
    )
    best = pick_best(
        candidates.withColumn("priority", priority).select(
            "encounter_id", "priority", "visit_start_date", "visit_occurrence_id", "visit_occurrence_id_new"
        ),
        ["encounter_id"],
        ["priority", "visit_start_date", "visit_occurrence_id"],
    )
    return best.select("encounter_id", "visit_occurrence_id_new")


def final_visit_ids(
    encounters: DataFrame, visits: DataFrame, classes: VisitClasses = CLASSES
) -> DataFrame:
    """One row per encounter that starts inside any visit of its patient: encounter_id and the
    chosen visit_occurrence_id_new, which may be NULL. Ties go to the earliest visit.

    The earliest visit of each family that contains the start decides, so a patient with very many
    overlapping stays costs no more than the rows themselves.
    """
    spans = visits.select(
        "patient",
        _family(F.col("encounterclass"), classes).alias("kind"),
        F.col("visit_occurrence_id").alias("span_id"),
        F.col("visit_start_date").alias("span_start"),
        F.col("visit_end_date").alias("span_end"),
    )
    points = encounters.select(F.col("id").alias("encounter_id"), "patient", "start", "encounterclass")
    covered = earliest_cover(points, spans, "patient", "start", _FAMILIES, exact_kinds=("emergency",))
    asked = _family(F.col("encounterclass"), classes)
    stay, clinic = F.col("inpatient.span_id"), F.col("outpatient.span_id")
    during = F.when(F.col("inpatient.span_start") < F.col("start"), stay)
    return covered.filter(
        F.col("inpatient").isNotNull()
        | F.col("emergency").isNotNull()
        | F.col("outpatient").isNotNull()
    ).select(
        "encounter_id",
        F.when(asked == "inpatient", stay)
        .when(asked == "emergency", F.coalesce(during, F.col("emergency_exact.span_id")))
        .when(asked == "outpatient", F.coalesce(stay, clinic))
        .alias("visit_occurrence_id_new"),
    )


def visit_occurrence(
    visits: DataFrame, person: DataFrame, provider: DataFrame, final_ids: DataFrame
) -> DataFrame:
    """Visits chosen by some encounter, with their person and provider and the visit before.

    The provider comes along from the rollup, so the encounters are not joined again. Encounter ids
    are taken to be unique (``check_unique``).
    """
    chosen = (
        final_ids.filter(F.col("visit_occurrence_id_new").isNotNull())
        .select(F.col("visit_occurrence_id_new").alias("visit_occurrence_id"))
        .distinct()
    )
    people = person.select("person_id", F.col("person_source_value").alias("patient"))
    doctors = provider.select("provider_id", F.col("provider_source_value").alias("provider"))
    kept = (
        visits.join(chosen, "visit_occurrence_id", "left_semi")
        .join(people, "patient")
        .join(doctors, "provider")
    )
    linked = previous_value(
        stage(kept, "kept_visits"),  # read twice
        ["person_id"],
        "visit_start_date",
        "visit_occurrence_id",
        "visit_occurrence_id",
        "preceding_visit_occurrence_id",
    )
    return conform(
        linked.select(
            "visit_occurrence_id",
            "person_id",
            case_map(F.col("encounterclass"), codes.VISIT_CONCEPT, 0).alias("visit_concept_id"),
            "visit_start_date",
            F.col("visit_start_date").alias("visit_start_datetime"),
            "visit_end_date",
            F.col("visit_end_date").alias("visit_end_datetime"),
            F.lit(codes.VISIT_TYPE).alias("visit_type_concept_id"),
            "provider_id",
            F.col("encounter_id").alias("visit_source_value"),
            F.lit(0).alias("visit_source_concept_id"),
            F.lit(0).alias("admitting_source_concept_id"),
            F.lit(0).alias("discharge_to_concept_id"),
            "preceding_visit_occurrence_id",
        ),
        CDM["visit_occurrence"],
    )


def visit_detail(visit_occurrence: DataFrame) -> DataFrame:
    """The visits once more as their own details, with moved ids."""
    renamed = {
        c: c.replace("visit_", "visit_detail_", 1)
        for c in visit_occurrence.columns
        if c.startswith("visit_") and c != "visit_occurrence_id"
    }
    moved = visit_occurrence.withColumnsRenamed(renamed)
    return conform(
        moved.withColumn("visit_detail_id", F.col("visit_occurrence_id") + codes.DETAIL_OFFSET).withColumn(
            "preceding_visit_detail_id",
            F.col("preceding_visit_occurrence_id") + codes.DETAIL_OFFSET,
        ),
        CDM["visit_detail"],
    )


def encounter_context(
    encounters: DataFrame, final_ids: DataFrame, provider: DataFrame
) -> DataFrame:
    """What every clinical event looks up by encounter: visit id, patient and provider."""
    doctors = provider.select("provider_id", F.col("provider_source_value").alias("provider"))
    return (
        encounters.select(
            F.col("id").alias("encounter"), F.col("patient").alias("context_patient"), "provider"
        )
        .join(final_ids.withColumnRenamed("encounter_id", "encounter"), "encounter", "left")
        .join(doctors, "provider", "left")
        .select(
            "encounter",
            "context_patient",
            F.col("visit_occurrence_id_new").alias("visit_occurrence_id"),
            "provider_id",
        )
    )
