"""Concept ids and literals of the target model. All are fixed values."""

from __future__ import annotations

from dataclasses import dataclass

GENDER = {"M": 8507, "F": 8532}
RACE = {"white": 8527, "black": 8516, "asian": 8515}
ETHNICITY = {"hispanic": 38003563, "nonhispanic": 38003564}
VISIT_CONCEPT = {
    "ambulatory": 9202,
    "emergency": 9203,
    "inpatient": 9201,
    "wellness": 9202,
    "urgentcare": 9203,
    "outpatient": 9202,
}
OBSERVATION_PERIOD_TYPE = 44814724
SPECIALTY = 38004446
VISIT_TYPE = 44818517
CONDITION_TYPE = 38000175
OBSERVATION_TYPE = 38000280
PROCEDURE_TYPE = 38000267
MEASUREMENT_TYPE = 38000267
DEVICE_TYPE = 38000267
DRUG_TYPE = 32869
DEATH_TYPE = 38003566
DEATH_CERTIFICATE = "308646001"
COST_TYPE = 32814
CURRENCY = 44818668
REVENUE_CODE = "UNKNOWN / UNKNOWN"
DRG_CODE = "000"
CDM_VERSION = "5.3.1"
DETAIL_OFFSET = 1_000_000  # visit_detail_id is the visit id moved by this


@dataclass(frozen=True)
class VisitClasses:
    """Encounter classes of the three visit families. The rollup says "urgent" where the visit
    concept table says "urgentcare"; encounters of other classes get no visit."""

    inpatient: tuple[str, ...] = ("inpatient",)
    emergency: tuple[str, ...] = ("emergency", "urgent")
    outpatient: tuple[str, ...] = ("ambulatory", "wellness", "outpatient")


CLASSES = VisitClasses()
