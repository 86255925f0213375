"""Codes, people and clinical events on hand-made tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from tests.conftest import rows
from wardspan.functions import parse_number
from wardspan.operators import (
    check_not_null,
    check_unique,
    code_map,
    conform,
    repeated_deaths,
    source_to_source,
    source_to_standard,
    unmapped_codes,
    with_source_concept,
)
from wardspan.plans import events, people
from wardspan.schemas import CDM, SOURCE, VOCABULARY

DAY = dt.date(2020, 1, 1)
T0 = dt.datetime(2020, 1, 1, 8)


def table(spark, schema, names, data):
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    described = ", ".join(f"{n} {kinds[n]}" for n in names.split())
    return conform(spark.createDataFrame(data, described), schema)


def concepts(spark, data):
    """(id, code, vocabulary, domain, standard, invalid)"""
    names = "concept_id concept_code vocabulary_id domain_id standard_concept invalid_reason concept_name concept_class_id"
    return table(spark, VOCABULARY["concept"], names, [(*r, f"n{r[0]}", "Clinical") for r in data])


@pytest.fixture(scope="module")
def vocab(spark):
    concept = concepts(
        spark,
        [
            (1, "A", "SNOMED", "Condition", "S", None),
            (2, "B", "SNOMED", "Condition", None, None),  # maps to two targets
            (3, "C", "SNOMED", "Condition", "S", "D"),  # invalid
            (4, "D", "SNOMED", "Condition", "S", None),  # link invalid
            (5, "E", "SNOMED", "Condition", None, None),  # target invalid
            (6, "F", "SNOMED", "Condition", "S", None),
            (7, "G", "SNOMED", "Condition", None, "U"),  # invalid source, valid target
            (8, "H", "SNOMED", "Procedure", "S", None),
            (9, "L", "LOINC", "Measurement", "S", None),
            (10, "mg", "UCUM", "Unit", "S", None),
            (11, "high", "SNOMED", "Meas value", "S", None),
            (12, "R", "RxNorm", "Drug", "S", None),
            (13, "V", "CVX", "Drug", "S", None),
        ],
    )
    links = [
        (1, 1, "Maps to", None),
        (2, 1, "MAPS TO", None),
        (2, 6, "maps to", None),
        (4, 4, "Maps to", "D"),
        (5, 3, "Maps to", None),
        (7, 6, "Maps to", None),
        (6, 6, "Maps to", None),
        (6, 6, "Maps to", None),  # a repeat that the union removes
        (1, 6, "Is a", None),
        *[(i, i, "Maps to", None) for i in range(8, 14)],
    ]
    names = "concept_id_1 concept_id_2 relationship_id invalid_reason"
    relation = table(spark, VOCABULARY["concept_relationship"], names, links)
    names = "source_code source_concept_id source_vocabulary_id target_concept_id target_vocabulary_id invalid_reason"
    custom = table(
        spark,
        VOCABULARY["source_to_concept_map"],
        names,
        [("K", 0, "SNOMED", 1, "SNOMED", None), ("X", 0, "SNOMED", 1, "SNOMED", "D")],
    )
    return {
        "standard": source_to_standard(concept, relation, custom).cache(),
        "own": source_to_source(concept, custom).cache(),
    }


def test_standard_map(vocab):
    got = rows(vocab["standard"].filter("source_vocabulary_id = 'SNOMED'"), "source_code", "target_concept_id")
    assert got == [
        ("A", 1), ("B", 1), ("B", 6), ("F", 6), ("G", 6), ("H", 8), ("K", 1), ("high", 11),
    ]


def test_source_map_keeps_invalid_concepts(vocab):
    got = rows(vocab["own"], "source_code")
    assert ("C",) in got and ("G",) in got and ("K",) in got and ("X",) not in got
    assert len(got) == 14


def test_fan_out_and_unmapped(spark, vocab):
    conditions = table(spark, SOURCE["conditions"], "code", [("B",), ("B",), ("zz",), (None,)])
    mapping = events.condition_map(vocab["standard"])
    joined = conditions.join(mapping, "code")
    assert joined.count() == 4
    assert rows(unmapped_codes(conditions, mapping)) == [("zz", 1), (None, 1)]
    both = with_source_concept(code_map(vocab["standard"], domain="Condition"), vocab["own"], "SNOMED")
    assert rows(both.filter("code = 'B'")) == [("B", 1, 2), ("B", 6, 2)]


def test_numbers(spark):
    texts = ["12", "12.", ".5", "-3", "1e5", "abc", "", None, "1.23456", "12\n", "9" * 30]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_number(df.t)).collect()]
    D = Decimal
    assert got[:9] == [D("12.000"), D("12.000"), D("0.500"), None, None, None, None, None, D("1.235")]
    assert got[9] is None and got[10] is None


def test_persons(spark):
    data = [
        ("b", DAY, "M", "White", "HISPANIC"),
        ("a", DAY, "f", "native", None),
        ("c", DAY, None, "asian", "nonhispanic"),  # no gender: no person
        ("d", DAY, "U", "black", "x"),
    ]
    patients = table(spark, SOURCE["patients"], "id birthdate gender race ethnicity", data)
    person = people.person(patients)
    columns = "person_id person_source_value gender_concept_id race_concept_id ethnicity_concept_id year_of_birth"
    assert rows(person, *columns.split()) == [
        (1, "a", 8532, 0, 0, 2020),
        (2, "b", 8507, 8527, 38003563, 2020),
        (3, "d", None, 8516, 0, 2020),
    ]
    report = dict(rows(check_not_null(person, CDM["person"])))
    assert report["gender_concept_id"] == 1 and report["person_id"] == 0
    assert person.schema.simpleString() == CDM["person"].simpleString()


@pytest.fixture(scope="module")
def people_and_context(spark):
    person = spark.createDataFrame([(1, "p"), (2, "q")], "person_id long, person_source_value string")
    context = spark.createDataFrame(
        [("e1", "p", 100, 7), ("e2", "q", None, 8)],
        "encounter string, context_patient string, visit_occurrence_id long, provider_id long",
    )
    return person, context


def test_conditions(spark, vocab, people_and_context):
    person, context = people_and_context
    data = [
        (DAY, None, "p", "e1", "A"),  # open: ends when it starts
        (DAY, DAY + dt.timedelta(3), "p", "e2", "K"),
        (DAY, None, "p", "none", "H"),  # a procedure code: dropped
        (DAY, None, "stranger", "e1", "A"),  # unknown person: dropped
    ]
    conditions = table(spark, SOURCE["conditions"], "start stop patient encounter code", data)
    out = events.condition_occurrence(conditions, vocab["standard"], person, context)
    columns = "condition_occurrence_id person_id condition_concept_id condition_end_date visit_occurrence_id visit_detail_id provider_id condition_source_concept_id"
    assert rows(out, *columns.split()) == [
        (1, 1, 1, DAY, 100, 1_000_100, None, 1),
        (2, 1, 1, DAY + dt.timedelta(3), None, None, None, 0),
    ]


def test_procedures_take_the_provider_of_their_own_patient_only(spark, vocab, people_and_context):
    person, context = people_and_context
    data = [(T0, "p", "e1", "H"), (T0, "q", "e1", "H")]
    procedures = table(spark, SOURCE["procedures"], "start patient encounter code", data)
    out = events.procedure_occurrence(procedures, vocab["standard"], vocab["own"], person, context)
    got = rows(out, "person_id", "visit_occurrence_id", "provider_id", "procedure_date")
    assert got == [(1, 100, 7, DAY), (2, 100, None, DAY)]


def test_measurements(spark, vocab, people_and_context):
    person, context = people_and_context
    data = [
        (T0, "p", "e1", "L", "12.5", "mg"),
        (T0, "p", "e1", "L", "high", "unknown"),
        (T0, "p", "e1", "L", "-3", None),
    ]
    seen = table(spark, SOURCE["observations"], "date patient encounter code value units", data)
    none = table(spark, SOURCE["procedures"], "start patient encounter code", [])
    out = events.measurement(none, seen, vocab["standard"], vocab["own"], person, context)
    columns = "value_source_value value_as_number value_as_concept_id unit_concept_id measurement_time"
    stamp = "2020-01-01 08:00:00"
    assert rows(out, *columns.split()) == [
        ("-3", None, 0, 0, stamp),
        ("12.5", Decimal("12.500"), 0, 10, stamp),
        ("high", None, 11, 0, stamp),
    ]


def test_drugs(spark, vocab, people_and_context):
    person, context = people_and_context
    taken = table(
        spark,
        SOURCE["medications"],
        "start stop patient encounter code",
        [(T0, T0 + dt.timedelta(days=9, hours=20), "p", "e1", "R"), (T0, None, "p", "e1", "R")],
    )
    shots = table(spark, SOURCE["immunizations"], "date patient encounter code", [(T0, "p", "e1", "V")])
    out = events.drug_exposure(taken, shots, vocab["standard"], vocab["own"], person, context)
    columns = "drug_concept_id days_supply drug_exposure_end_date verbatim_end_date"
    last = dt.date(2020, 1, 11)
    assert rows(out, *columns.split()) == [
        (12, 0, DAY, None),
        (12, 10, last, last),
        (13, 0, DAY, DAY),
    ]


def test_deaths(spark, vocab, people_and_context):
    person, _ = people_and_context
    data = [
        (T0, "p", "308646001", "A"),
        (T0, "p", "308646001", "B"),  # two causes
        (T0, "q", "308646001", "zz"),  # unmapped cause: no row
        (T0, "q", "1", "A"),
    ]
    encounters = table(spark, SOURCE["encounters"], "start patient code reasoncode", data)
    death = people.death(encounters, vocab["standard"], person)
    assert rows(death, "person_id", "cause_concept_id") == [(1, 1), (1, 1), (1, 6)]
    assert rows(repeated_deaths(death)) == [(1, 3)]


def test_source_description(spark):
    vocabulary = table(
        spark, VOCABULARY["vocabulary"], "vocabulary_id vocabulary_version", [("None", "v5.0"), ("X", "1")]
    )
    out = people.cdm_source(vocabulary, {"cdm_source_name": "here"}, DAY)
    got = rows(out, "cdm_source_name", "cdm_release_date", "cdm_version", "vocabulary_version")
    assert got == [("here", DAY, "5.3.1", "v5.0")]


def test_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (3,)], "k int")
    assert rows(check_unique(df, ["k"])) == [(2, 3)]
