"""Clinical event tables: coded source rows mapped to concepts and placed in their visit.

Each leg maps codes first (unmapped rows fall away), then joins the person and one shared dimension
of encounters. Only the columns that vary are numbered and written between stages; constants follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.functions import days_between, parse_number, stamp_text
from wardspan.operators import (
    COPY,
    Like,
    code_map,
    conform,
    dense_ids,
    map_codes,
    with_source_concept,
)
from wardspan.plans import codes
from wardspan.schemas import CDM

_LEAD = ["person_id", "at", "code", "encounter", "target_concept_id", "source_concept_id"]


def _place(
    facts: DataFrame, mapping: DataFrame, person: DataFrame, context: DataFrame, **columns: Column
) -> DataFrame:
    """Mapped facts of known persons with visit and provider, plus the given columns.

    The visit is that of the encounter; the provider counts only if the encounter is the patient's.
    """
    copy = F.col(COPY) if COPY in facts.columns else F.lit(0).cast("long")
    people = person.select("person_id", F.col("person_source_value").alias("patient"))
    return (
        map_codes(facts, mapping)
        .join(people, "patient")
        .join(context, "encounter", "left")
        .select(
            "person_id",
            "encounter",
            "code",
            "target_concept_id",
            "source_concept_id",
            "visit_occurrence_id",
            F.when(F.col("context_patient") == F.col("patient"), F.col("provider_id")).alias(
                "provider_id"
            ),
            *[column.alias(name) for name, column in columns.items()],
            copy.alias(COPY),
        )
    )


def _like(facts: DataFrame, person: DataFrame, at: Column) -> Like:
    """Person and time of facts, to be known from a sample without mapping them."""
    people = person.select("person_id", F.col("person_source_value").alias("patient"))
    return Like(
        facts.select("patient", at.alias("at")),
        lambda some: some.join(people, "patient").select("person_id", "at"),
    )


def _finish(numbered: DataFrame, table: str, prefix: str, **columns: Column | int) -> DataFrame:
    """Give the shared columns their names in ``table``, add the others and fit the layout."""
    named = {
        f"{prefix}_concept_id": F.col("target_concept_id"),
        f"{prefix}_source_value": F.col("code"),
        f"{prefix}_source_concept_id": F.col("source_concept_id"),
        "visit_detail_id": F.col("visit_occurrence_id") + codes.DETAIL_OFFSET,
    }
    for name, value in columns.items():
        named[name] = value if isinstance(value, Column) else F.lit(value)
    return conform(numbered.withColumns(named), CDM[table])


def condition_map(standard: DataFrame) -> DataFrame:
    return code_map(standard, domain="Condition", target="SNOMED", source="SNOMED")


def condition_occurrence(
    conditions: DataFrame, standard: DataFrame, person: DataFrame, context: DataFrame
) -> DataFrame:
    """Conditions; an open one ends when it starts. Conditions take no provider."""
    rows = _place(
        conditions,
        condition_map(standard),
        person,
        context,
        at=F.col("start"),
        end=F.coalesce("stop", "start"),
    ).drop("provider_id")
    like = [_like(conditions, person, F.col("start"))]
    numbered = dense_ids(rows, [*_LEAD, "end"], "condition_occurrence_id", like)
    return _finish(
        numbered,
        "condition_occurrence",
        "condition",
        condition_start_date=F.col("at"),
        condition_start_datetime=F.col("at"),
        condition_end_date=F.col("end"),
        condition_end_datetime=F.col("end"),
        condition_type_concept_id=codes.CONDITION_TYPE,
        condition_status_concept_id=0,
    )


def observation(
    allergies: DataFrame,
    conditions: DataFrame,
    observations: DataFrame,
    standard: DataFrame,
    own: DataFrame,
    person: DataFrame,
    context: DataFrame,
) -> DataFrame:
    """Allergies, conditions and observations whose codes map into the domain Observation."""

    def mapping(vocabulary: str) -> DataFrame:
        found = code_map(standard, domain="Observation", target=vocabulary)
        return with_source_concept(found, own, vocabulary, domain="Observation")

    def leg(facts: DataFrame, vocabulary: str, time: str) -> DataFrame:
        at = F.col(time).cast("timestamp_ntz")
        return _place(facts, mapping(vocabulary), person, context, at=at)

    rows = (
        leg(allergies, "SNOMED", "start")
        .unionByName(leg(conditions, "SNOMED", "start"))
        .unionByName(leg(observations, "LOINC", "date"))
    )
    order = [*_LEAD, "visit_occurrence_id", "provider_id"]
    times = ((allergies, "start"), (conditions, "start"), (observations, "date"))
    like = [_like(facts, person, F.col(time).cast("timestamp_ntz")) for facts, time in times]
    numbered = dense_ids(rows, order, "observation_id", like)
    return _finish(
        numbered,
        "observation",
        "observation",
        observation_date=F.col("at"),
        observation_datetime=F.col("at"),
        observation_type_concept_id=codes.OBSERVATION_TYPE,
        value_as_concept_id=0,
        qualifier_concept_id=0,
        unit_concept_id=0,
    )


def measurement(
    procedures: DataFrame,
    observations: DataFrame,
    standard: DataFrame,
    own: DataFrame,
    person: DataFrame,
    context: DataFrame,
) -> DataFrame:
    """Procedures that are measurements, and observations with number, unit and value concept."""
    procedure_map = with_source_concept(
        code_map(standard, domain="Measurement", source="SNOMED"), own, "SNOMED"
    )
    observation_map = with_source_concept(
        code_map(standard, domain="Measurement", source="LOINC"), own, "LOINC", how="left"
    ).withColumn("source_concept_id", F.coalesce("source_concept_id", F.lit(0)))
    units = code_map(standard, target="UCUM", source="UCUM")
    values = code_map(standard, domain="Meas value")

    def lookup(facts: DataFrame, mapping: DataFrame, column: str, out: str) -> DataFrame:
        narrow = mapping.select("code", F.col("target_concept_id").alias(out))
        return map_codes(facts, narrow, code=column, how="left").withColumn(
            out, F.coalesce(out, F.lit(0))
        )

    # Mapped first: most observations are not measurements and need no unit or value looked up.
    mapped = _place(
        observations,
        observation_map,
        person,
        context,
        at=F.col("date"),
        value_as_number=parse_number(F.col("value")),
        unit_source_value=F.col("units"),
        value_source_value=F.col("value"),
    )
    from_observations = lookup(
        lookup(mapped, units, "unit_source_value", "unit_concept_id"),
        values,
        "value_source_value",
        "value_as_concept_id",
    )
    from_procedures = _place(
        procedures,
        procedure_map,
        person,
        context,
        at=F.col("start"),
        value_as_number=F.lit(None).cast("decimal(18,3)"),
        value_as_concept_id=F.lit(0),
        unit_concept_id=F.lit(0),
        unit_source_value=F.lit(None).cast("string"),
        value_source_value=F.lit(None).cast("string"),
    )
    order = [
        *_LEAD,
        "value_source_value",
        "unit_source_value",
        "value_as_concept_id",
        "unit_concept_id",
        "visit_occurrence_id",
        "provider_id",
    ]
    rows = from_procedures.unionByName(from_observations)
    like = [_like(procedures, person, F.col("start")), _like(observations, person, F.col("date"))]
    numbered = dense_ids(rows, order, "measurement_id", like)
    return _finish(
        numbered,
        "measurement",
        "measurement",
        measurement_date=F.col("at"),
        measurement_datetime=F.col("at"),
        measurement_time=stamp_text(F.col("at")),
        measurement_type_concept_id=codes.MEASUREMENT_TYPE,
        operator_concept_id=0,
    )


def procedure_occurrence(
    procedures: DataFrame,
    standard: DataFrame,
    own: DataFrame,
    person: DataFrame,
    context: DataFrame,
) -> DataFrame:
    mapping = with_source_concept(
        code_map(standard, domain="Procedure", target="SNOMED", source="SNOMED"), own, "SNOMED"
    )
    rows = _place(procedures, mapping, person, context, at=F.col("start"))
    like = [_like(procedures, person, F.col("start"))]
    numbered = dense_ids(rows, _LEAD, "procedure_occurrence_id", like)
    return _finish(
        numbered,
        "procedure_occurrence",
        "procedure",
        procedure_date=F.col("at"),
        procedure_datetime=F.col("at"),
        procedure_type_concept_id=codes.PROCEDURE_TYPE,
        modifier_concept_id=0,
    )


def device_exposure(
    devices: DataFrame,
    standard: DataFrame,
    own: DataFrame,
    person: DataFrame,
    context: DataFrame,
) -> DataFrame:
    """Devices; an open one keeps a NULL end."""
    mapping = with_source_concept(
        code_map(standard, domain="Device", target="SNOMED", source="SNOMED"), own, "SNOMED"
    )
    rows = _place(
        devices,
        mapping,
        person,
        context,
        at=F.col("start"),
        end=F.col("stop"),
        unique_device_id=F.col("udi"),
    )
    like = [_like(devices, person, F.col("start"))]
    numbered = dense_ids(rows, [*_LEAD, "end", "unique_device_id"], "device_exposure_id", like)
    return _finish(
        numbered,
        "device_exposure",
        "device",
        device_exposure_start_date=F.col("at"),
        device_exposure_start_datetime=F.col("at"),
        device_exposure_end_date=F.col("end"),
        device_exposure_end_datetime=F.col("end"),
        device_type_concept_id=codes.DEVICE_TYPE,
    )


def drug_exposure(
    medications: DataFrame,
    immunizations: DataFrame,
    standard: DataFrame,
    own: DataFrame,
    person: DataFrame,
    context: DataFrame,
) -> DataFrame:
    """Medications mapped to RxNorm and immunizations mapped to CVX, whatever vocabulary the code
    comes from. An open medication ends when it starts; an immunization lasts its day."""

    def leg(facts: DataFrame, vocabulary: str, start: str, stop: str) -> DataFrame:
        mapping = with_source_concept(
            code_map(standard, domain="Drug", target=vocabulary), own, vocabulary
        )
        return _place(facts, mapping, person, context, at=F.col(start), stop=F.col(stop))

    rows = leg(medications, "RxNorm", "start", "stop").unionByName(
        leg(immunizations, "CVX", "date", "date")
    )
    order = [*_LEAD, "stop", "visit_occurrence_id", "provider_id"]
    like = [_like(medications, person, F.col("start")), _like(immunizations, person, F.col("date"))]
    numbered = dense_ids(rows, order, "drug_exposure_id", like)
    end = F.coalesce("stop", "at")
    return _finish(
        numbered,
        "drug_exposure",
        "drug",
        drug_exposure_start_date=F.col("at"),
        drug_exposure_start_datetime=F.col("at"),
        drug_exposure_end_date=end,
        drug_exposure_end_datetime=end,
        verbatim_end_date=F.col("stop"),
        drug_type_concept_id=codes.DRUG_TYPE,
        refills=0,
        quantity=0,
        days_supply=F.coalesce(days_between(F.col("stop"), F.col("at")), F.lit(0)),
        route_concept_id=0,
        lot_number=0,
    )
