from __future__ import annotations

import datetime as dt
import random

import pytest

from tests.conftest import in_order, rows
from wardspan.operators import conform, merge_intervals
from wardspan.plans import visits
from wardspan.plans.codes import VisitClasses
from wardspan.schemas import SOURCE

T0 = dt.datetime(2020, 1, 1)
KEYS = "id string, patient string, encounterclass string, start timestamp_ntz, stop timestamp_ntz, provider string"


def at(days, seconds=0):
    return T0 + dt.timedelta(days=days, seconds=seconds)


def encounters(spark, data):
    """(id, patient, class, start, stop) in days from the first of January."""
    full = [(*r[:3], at(*r[3]) if isinstance(r[3], tuple) else at(r[3]), None if r[4] is None else at(r[4]), "d1") for r in data]
    return conform(spark.createDataFrame(full, KEYS), SOURCE["encounters"])


def test_inpatient_starts_share_the_island_end(spark):
    e = encounters(
        spark,
        [
            ("a", "p", "inpatient", 1, 5),
            ("b", "p", "inpatient", 4, 8),  # overlaps: two rows, one end
            ("c", "p", "inpatient", 9, 10),  # exactly a day later: same island
            ("e", "p", "inpatient", (11, 1), 12),  # a day and a second later: a new one
            ("f", "p", "inpatient", (11, 1), 11.5),  # same start: smallest id
            ("z", "q", "inpatient", 1, 2),
        ],
    )
    got = rows(visits.inpatient_visits(e), "patient", "encounter_id", "visit_start_date", "visit_end_date")
    assert got == [
        ("p", "a", at(1), at(10)),
        ("p", "b", at(4), at(10)),
        ("p", "c", at(9), at(10)),
        ("p", "e", at(11, 1), at(12)),
        ("q", "z", at(1), at(2)),
    ]
    collapsed = merge_intervals(e, ["patient"], "start", "stop", 1, count_as="n")
    assert rows(collapsed) == [
        ("p", at(1), at(10), 3),
        ("p", at(11, 1), at(12), 2),
        ("q", at(1), at(2), 1),
    ]


def test_an_open_stay_hides_what_follows(spark):
    e = encounters(
        spark,
        [
            ("a", "p", "inpatient", 1, 2),
            ("b", "p", "inpatient", 10, 20),  # its island holds the open stay
            ("c", "p", "inpatient", 15, None),
            ("d", "p", "inpatient", 40, 41),
            ("e", "q", "inpatient", 40, 41),
        ],
    )
    assert [r[0] for r in rows(visits.inpatient_visits(e), "encounter_id")] == ["a", "e"]
    assert [r[0] for r in rows(visits.hidden_stays(e), "encounter_id")] == ["b", "c", "d"]
    closed = visits.inpatient_visits(e, drop_from_open=False)
    assert rows(closed, "encounter_id", "visit_end_date") == [
        ("a", at(2)),
        ("b", at(20)),
        ("c", at(20)),
        ("d", at(41)),
        ("e", at(41)),
    ]


def test_emergency_and_outpatient_merge_equal_starts(spark):
    e = encounters(
        spark,
        [
            ("b", "p", "emergency", 1, 2),
            ("a", "p", "emergency", 1, None),
            ("c", "p", "urgent", 1, 3),
            ("d", "p", "wellness", 1, 2),
            ("e", "p", "wellness", 1, 4),
            ("f", "p", "urgentcare", 1, 4),
        ],
    )
    columns = ["encounter_id", "encounterclass", "visit_end_date"]
    assert rows(visits.emergency_visits(e), *columns) == [("a", "emergency", at(2)), ("c", "urgent", at(3))]
    assert rows(visits.outpatient_visits(e), *columns) == [("d", "wellness", at(4))]
    other = VisitClasses(emergency=("emergency", "urgentcare"))
    assert [r[0] for r in rows(visits.emergency_visits(e, other), "encounter_id")] == ["a", "f"]


def test_encounters_go_to_the_best_visit(spark):
    e = encounters(
        spark,
        [
            ("i1", "p", "inpatient", 10, 20),
            ("i2", "p", "inpatient", 12, 15),  # inside the longer stay: its first row
            ("r1", "p", "emergency", 10, 11),  # at the start of the stay: its own visit
            ("r2", "p", "emergency", 13, 14),  # later inside: the stay
            ("o1", "p", "wellness", 10, 11),  # at the start: the stay
            ("o2", "p", "outpatient", 18, 19),
            ("o3", "p", "outpatient", 30, 31),  # alone
            ("u1", "p", "urgentcare", 13, 14),  # no family: a row without a visit
            ("u2", "p", "urgentcare", 90, 91),  # inside nothing: no row
        ],
    )
    all_visits = visits.roll_up(e)
    starts = {r["visit_occurrence_id"]: r["encounter_id"] for r in all_visits.collect()}
    final = visits.final_visit_ids(e, all_visits)
    got = {r["encounter_id"]: starts.get(r["visit_occurrence_id_new"]) for r in final.collect()}
    assert got == {
        "i1": "i1",
        "i2": "i1",
        "r1": "r1",
        "r2": "i1",
        "o1": "i1",
        "o2": "i1",
        "o3": "o3",
        "u1": None,
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_direct_pick_equals_the_pick_among_all_pairs(spark, seed):
    rng = random.Random(seed)
    classes = ["inpatient", "emergency", "urgent", "ambulatory", "wellness", "outpatient", "hospice"]
    data = []
    for i in range(400):
        lo = rng.randrange(160) / 2
        patient = "hot" if rng.random() < 0.4 else f"p{rng.randrange(5)}"
        hi = None if rng.random() < 0.02 else lo + rng.choice([0, 0.5, 1, 4, 10])
        data.append((f"e{i}", patient, rng.choice(classes), lo, hi))
    e = encounters(spark, data)
    all_visits = visits.roll_up(e)
    direct = rows(visits.final_visit_ids(e, all_visits))
    pairs = rows(visits.pick_visits(visits.candidate_visits(e, all_visits)))
    assert direct == pairs and len(direct) > 300


def test_visit_tables_link_to_the_visit_before(spark):
    e = encounters(
        spark,
        [
            ("a", "p", "wellness", 1, 2),
            ("b", "p", "wellness", (1, 3600), 2),
            ("c", "p", "emergency", 50, 51),
            ("d", "q", "wellness", 3, 4),
            ("x", "r", "wellness", 3, 4),  # unknown person
        ],
    )
    person = spark.createDataFrame([(1, "p"), (2, "q")], "person_id long, person_source_value string")
    provider = spark.createDataFrame([(7, "d1")], "provider_id long, provider_source_value string")
    all_visits = visits.roll_up(e)
    final = visits.final_visit_ids(e, all_visits)
    v = visits.visit_occurrence(all_visits, person, provider, final)
    ids = {r["visit_source_value"]: r["visit_occurrence_id"] for r in v.collect()}
    assert set(ids) <= {"a", "b", "c", "d"}
    got = {r["visit_source_value"]: r["preceding_visit_occurrence_id"] for r in v.collect()}
    # "b" starts inside the visit of "a" and goes there, so its own visit is not chosen
    assert got == {"a": None, "c": ids["a"], "d": None}
    assert rows(v, "visit_source_value", "visit_concept_id") == [("a", 9202), ("c", 9203), ("d", 9202)]
    detail = visits.visit_detail(v)
    assert sorted(r["visit_detail_id"] - 1_000_000 for r in detail.collect()) == sorted(
        r["visit_occurrence_id"] for r in detail.collect()
    )
    linked = [r["preceding_visit_detail_id"] for r in detail.collect() if r["visit_detail_source_value"] == "c"]
    assert linked == [ids["a"] + 1_000_000]


def test_stays_are_grouped_once(spark):
    """F11, F12, F14, F16, F19, F20: each of four readings of the stays grouped all encounters anew."""
    e = encounters(spark, [("a", "p", "inpatient", 1, 5), ("b", "p", "inpatient", 4, 3), ("c", "q", "inpatient", 2, 4)])
    found = visits.inpatient_visits(e)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "min(struct" not in plan and "LogicalRDD" not in plan  # nothing but staged stays is read
    assert rows(found, "patient", "encounter_id", "visit_end_date") == [("p", "a", at(5)), ("p", "b", at(5)), ("q", "c", at(4))]
