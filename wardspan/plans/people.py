"""Persons, providers, observation periods, deaths and the description of the source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardspan.functions import case_map
from wardspan.operators import COPY, Like, code_map, conform, dense_ids, map_codes
from wardspan.plans import codes
from wardspan.schemas import CDM


def person(patients: DataFrame) -> DataFrame:
    """One row per patient with a gender, numbered by patient id.

    A gender other than M or F gives a NULL concept, which ``check_not_null`` reports.
    """
    known = patients.filter(F.col("gender").isNotNull()).select(
        "id", "birthdate", "gender", "race", "ethnicity", *_copy(patients)
    )
    numbered = dense_ids(known, ["id", "birthdate", "gender", "race", "ethnicity"], "person_id", [Like(patients.select("id"))])
    born = F.col("birthdate").cast("date")
    return conform(
        numbered.select(
            "person_id",
            case_map(F.col("gender"), codes.GENDER).alias("gender_concept_id"),
            F.year(born).alias("year_of_birth"),
            F.month(born).alias("month_of_birth"),
            F.dayofmonth(born).alias("day_of_birth"),
            F.col("birthdate").alias("birth_datetime"),
            case_map(F.col("race"), codes.RACE, 0).alias("race_concept_id"),
            case_map(F.col("ethnicity"), codes.ETHNICITY, 0).alias("ethnicity_concept_id"),
            F.col("id").alias("person_source_value"),
            F.col("gender").alias("gender_source_value"),
            F.lit(0).alias("gender_source_concept_id"),
            F.col("race").alias("race_source_value"),
            F.lit(0).alias("race_source_concept_id"),
            F.col("ethnicity").alias("ethnicity_source_value"),
            F.lit(0).alias("ethnicity_source_concept_id"),
        ),
        CDM["person"],
    )


def provider(providers: DataFrame) -> DataFrame:
    """Providers numbered by their source id."""
    rows = providers.select("id", "name", "gender", "speciality", *_copy(providers))
    numbered = dense_ids(rows, ["id", "name", "gender", "speciality"], "provider_id", [Like(providers.select("id"))])
    gender = case_map(F.col("gender"), codes.GENDER)
    return conform(
        numbered.select(
            "provider_id",
            F.col("name").alias("provider_name"),
            F.lit(codes.SPECIALTY).alias("specialty_concept_id"),
            gender.alias("gender_concept_id"),
            F.col("id").alias("provider_source_value"),
            F.col("speciality").alias("specialty_source_value"),
            F.lit(codes.SPECIALTY).alias("specialty_source_concept_id"),
            F.col("gender").alias("gender_source_value"),
            gender.alias("gender_source_concept_id"),
        ),
        CDM["provider"],
    )


def observation_period(person: DataFrame, encounters: DataFrame) -> DataFrame:
    """First encounter start to last encounter stop per person; none for persons without one.

    Encounters are reduced to one row per patient before they are joined.
    """
    spans = encounters.groupBy("patient").agg(F.min("start").alias("lo"), F.max("stop").alias("hi"))
    rows = person.select("person_id", "person_source_value").join(
        spans, F.col("person_source_value") == F.col("patient")
    )
    per_person = rows.groupBy("person_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    like = [Like(person.select("person_id"))]
    numbered = dense_ids(per_person, ["person_id", "lo", "hi"], "observation_period_id", like)
    return conform(
        numbered.select(
            "observation_period_id",
            "person_id",
            F.col("lo").alias("observation_period_start_date"),
            F.col("hi").alias("observation_period_end_date"),
            F.lit(codes.OBSERVATION_PERIOD_TYPE).alias("period_type_concept_id"),
        ),
        CDM["observation_period"],
    )


def death(encounters: DataFrame, standard: DataFrame, person: DataFrame) -> DataFrame:
    """Death certificates with a mapped cause. A person may appear more than once, and a
    certificate without a mapped cause gives no row."""
    certificates = encounters.filter(F.col("code") == codes.DEATH_CERTIFICATE).select(
        "patient", "start", "reasoncode"
    )
    causes = code_map(
        standard, domain="Condition", target="SNOMED", source="SNOMED", source_domain="Condition"
    )
    mapped = map_codes(certificates, causes, code="reasoncode")
    return conform(
        mapped.join(person, F.col("patient") == F.col("person_source_value")).select(
            "person_id",
            F.col("start").alias("death_date"),
            F.col("start").alias("death_datetime"),
            F.lit(codes.DEATH_TYPE).alias("death_type_concept_id"),
            F.col("target_concept_id").alias("cause_concept_id"),
            F.col("reasoncode").alias("cause_source_value"),
            F.col("source_concept_id").alias("cause_source_concept_id"),
        ),
        CDM["death"],
    )


def cdm_source(
    vocabulary: DataFrame, describe: dict[str, str], day: dt.date | None = None
) -> DataFrame:
    """One row about the data set. ``describe`` gives the descriptive columns by name, ``day`` the
    release dates (today if not given); the vocabulary version is that of the row "None"."""
    released = F.current_date() if day is None else F.lit(day)
    return conform(
        vocabulary.filter(F.col("vocabulary_id") == "None").select(
            *[F.lit(text).alias(column) for column, text in describe.items()],
            released.alias("source_release_date"),
            released.alias("cdm_release_date"),
            F.lit(codes.CDM_VERSION).alias("cdm_version"),
            "vocabulary_version",
        ),
        CDM["cdm_source"],
    )


def _copy(df: DataFrame) -> list[str]:
    return [COPY] if COPY in df.columns else []
