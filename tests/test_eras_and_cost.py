from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from proxies import registry
from tests.conftest import rows
from wardspan.operators import conform
from wardspan.plans import cost as costs
from wardspan.plans import eras
from wardspan.runtime import stage
from wardspan.schemas import CDM, SOURCE, VOCABULARY

D0 = dt.date(2020, 1, 1)
T0 = dt.datetime(2020, 1, 1)


def day(n):
    return None if n is None else D0 + dt.timedelta(days=n)


def table(spark, schema, names, data):
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    described = ", ".join(f"{n} {kinds[n]}" for n in names.split())
    return conform(spark.createDataFrame(data, described), schema)


def test_condition_eras(spark):
    data = [
        (1, 1, 5, 0, 10),
        (2, 1, 5, 40, 50),  # a gap of 30
        (3, 1, 5, 81, 90),  # a gap of 31
        (4, 1, 6, 5, None),  # no end: one day
        (5, 2, 5, 0, 0),
        (6, 2, 5, 0, 0),  # twins
    ]
    names = "condition_occurrence_id person_id condition_concept_id condition_start_date condition_end_date"
    found = table(
        spark, CDM["condition_occurrence"], names, [(*r[:3], day(r[3]), day(r[4])) for r in data]
    )
    assert rows(eras.condition_era(found)) == [
        (1, 1, 5, day(0), day(50), 2),
        (2, 1, 5, day(81), day(90), 1),
        (3, 1, 6, day(5), day(6), 1),
        (4, 2, 5, day(0), day(0), 2),
    ]


@pytest.fixture(scope="module")
def ingredients(spark):
    names = "concept_id vocabulary_id concept_class_id"
    concept = table(
        spark,
        VOCABULARY["concept"],
        names,
        [(100, "RxNorm", "Ingredient"), (101, "RxNorm", "Ingredient"), (102, "RxNorm", "Dose form"), (103, "CVX", "Ingredient")],
    )
    pairs = [(100, 1), (100, 2), (101, 2), (102, 1), (103, 1), (100, 0), (100, 100)]
    closure = table(
        spark, VOCABULARY["concept_ancestor"], "ancestor_concept_id descendant_concept_id", pairs
    )
    return closure, concept


def exposures(spark, data):
    names = "drug_exposure_id person_id drug_concept_id drug_exposure_start_date drug_exposure_end_date days_supply"
    full = [(i, 1, d, day(lo), day(hi), supply) for i, (d, lo, hi, supply) in enumerate(data)]
    return table(spark, CDM["drug_exposure"], names, full)


def test_drug_eras(spark, ingredients):
    taken = exposures(
        spark,
        [
            (1, 0, 10, 10),
            (1, 5, 12, 7),  # overlaps: one stretch of 12 days
            (2, 42, 50, 8),  # a combination, 30 days later; counts for both ingredients
            (1, 81, 81, 0),  # 31 days later
            (0, 0, 5, 5),  # unmapped
            (1, 20, 15, -5),  # negative supply
        ],
    )
    got = rows(eras.drug_era(taken, *ingredients))
    assert got == [
        (1, 1, 100, day(0), day(50), 3, 30),
        (2, 1, 100, day(81), day(81), 1, 0),
        (3, 1, 101, day(42), day(50), 1, 0),
    ]


def test_missing_ends_fall_back_to_the_supply(spark, ingredients):
    taken = exposures(spark, [(1, 0, None, 9), (1, 100, None, 0), (1, 200, None, None)])
    got = rows(eras.drug_targets(taken, *ingredients), "start", "end")
    assert got == [(day(0), day(9)), (day(100), day(101)), (day(200), day(201))]


@pytest.fixture(scope="module")
def bill(spark):
    """One person with visit 100 of encounters e1 (its representative) and e2, two events each."""
    s = {}
    D = Decimal
    s["encounters"] = table(
        spark,
        SOURCE["encounters"],
        "id patient provider payer start total_claim_cost payer_coverage",
        [("e1", "p", "d1", "y1", T0, D(100), D(30)), ("e2", "p", "d1", "y1", T0, D(500), D(0))],
    )
    names = "start patient encounter code base_cost"
    facts = [
        (T0, "p", "e1", "A", D(10)),
        (T0, "p", "e1", "A", D(10)),  # the same charge again
        (T0, "p", "e1", "A", D(20)),  # another charge for the same code
        (T0, "p", "e2", "B", D(10)),  # not the representative: no cost
    ]
    s["procedures"] = table(spark, SOURCE["procedures"], names, facts)
    s["medications"] = table(spark, SOURCE["medications"], names, [])
    s["immunizations"] = table(
        spark, SOURCE["immunizations"], "date patient encounter code base_cost", [(T0, "p", "e1", "V", D(1))]
    )
    s["conditions"] = table(
        spark, SOURCE["conditions"], "start patient encounter code", [(D0, "p", "e1", "C")]
    )
    s["claims"] = table(
        spark,
        SOURCE["claims"],
        "id patientid diagnosis1 currentillnessdate appointmentid providerid primarypatientinsuranceid servicedate",
        [("c1", "p", "C", T0, "e1", "d1", "y1", T0), ("c2", "p", "C", T0, "e1", "other", "y1", T0)],
    )
    s["claims_transactions"] = table(
        spark,
        SOURCE["claims_transactions"],
        "claimid patientid appointmentid providerid transfertype amount",
        [
            ("c1", "p", "e1", "d1", "1", D(7)),
            ("c1", "p", "e1", "d1", "1", D(5)),
            ("c1", "p", "e1", "d1", "p", D(2)),
            ("c1", "p", "e1", "d1", "x", D(99)),
            ("c2", "p", "e1", "other", "1", D(99)),
        ],
    )
    s["person"] = spark.createDataFrame([(1, "p")], "person_id long, person_source_value string")
    s["visit_occurrence"] = table(
        spark, CDM["visit_occurrence"], "visit_occurrence_id person_id visit_source_value", [(100, 1, "e1")]
    )
    s["procedure_occurrence"] = table(
        spark,
        CDM["procedure_occurrence"],
        "procedure_occurrence_id person_id procedure_date visit_occurrence_id procedure_source_value",
        [(1, 1, day(0), 100, "A"), (2, 1, day(0), 100, "A"), (3, 1, day(0), 100, "B")],
    )
    s["drug_exposure"] = table(
        spark,
        CDM["drug_exposure"],
        "drug_exposure_id person_id drug_exposure_start_date visit_occurrence_id drug_source_value",
        [(1, 1, day(400), 100, "V")],
    )
    s["condition_occurrence"] = table(
        spark,
        CDM["condition_occurrence"],
        "condition_occurrence_id person_id condition_start_date visit_occurrence_id condition_source_value",
        [(1, 1, day(10), 100, "C")],
    )
    s["payer_plan_period"] = table(
        spark,
        CDM["payer_plan_period"],
        "payer_plan_period_id person_id payer_plan_period_start_date payer_plan_period_end_date",
        [(50, 1, day(0), day(10)), (51, 1, day(10), day(20)), (52, 2, day(0), day(900))],
    )
    return s


def test_cost(bill):
    got = rows(
        costs.cost(**bill),
        "cost_domain_id",
        "cost_event_id",
        "total_charge",
        "total_paid",
        "paid_by_payer",
        "paid_by_patient",
        "payer_plan_period_id",
    )
    assert [(r[0], *(None if v is None else int(v) for v in r[1:])) for r in got] == [
        ("Condition", 1, 14, 14, 12, 2, 50),  # the last day of one plan is the first of the next
        ("Condition", 1, 14, 14, 12, 2, 51),
        ("Drug", 1, 101, 31, 30, 71, None),  # no plan that day
        ("Procedure", 1, 110, 40, 30, 80, 50),
        ("Procedure", 1, 120, 50, 30, 90, 50),
        ("Procedure", 2, 110, 40, 30, 80, 50),
        ("Procedure", 2, 120, 50, 30, 90, 50),
    ]


def test_cost_ids_are_dense(bill):
    assert [r[0] for r in rows(costs.cost(**bill), "cost_id")] == list(range(1, 8))


def test_plan_periods(spark):
    payers = table(spark, SOURCE["payers"], "id name", [("y1", "One")])
    moves = table(
        spark,
        SOURCE["payer_transitions"],
        "patient start_year end_year payer",
        [("p", day(400), day(800), "y1"), ("p", day(0), day(399), "y1"), ("p", day(0), day(1), "no"), ("s", day(0), day(1), "y1")],
    )
    person = spark.createDataFrame([(9, "p")], "person_id long, person_source_value string")
    out = costs.payer_plan_period(payers, moves, person)
    names = ["payer_plan_period_id", "person_id", "payer_plan_period_start_date", "plan_source_value"]
    assert rows(out, *names) == [(1, 9, day(0), "One"), (2, 9, day(400), "One")]


def test_amounts_of_codes_without_events_go_before_any_shuffle(bill, spark, monkeypatch):
    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "code string, n int")
    events = spark.createDataFrame([("a",), ("a",), (None,), ("c",)], "code string")
    kept = costs._of_codes(facts, events)
    assert rows(kept, "code", "n") == [("a", 1), ("a", 4)]
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(costs, "BROADCAST_BYTES", 0)
    assert costs._of_codes(facts, events).count() == 4


def test_many_codes_are_broadcast_as_bits(spark):
    """Before, the codes themselves were broadcast, which took the driver over 100 bytes for each."""
    events = spark.range(20_000).selectExpr("concat('c', id) AS code")
    facts = spark.range(40_000).selectExpr("concat('c', id) AS code", "id")
    kept = costs._of_codes(facts, events)
    assert "BroadcastHashJoin" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.filter("id < 20000").count() == 20_000
    assert kept.count() < 21_000
    (words,) = costs._code_bits(events, 1 << 10).selectExpr("size(_words)").first()
    assert words == 1 << 10


def test_cost_holds_the_shuffles_of_one_leg(bill, spark, monkeypatch):
    """Before, the legs were one query, and their shuffle files stayed after it."""
    seen, setting = [], "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def noted(df, label):
        seen.append((label, spark.conf.get(setting, "false"), float(spark.conf.get("spark.sql.sources.fileCompressionFactor"))))
        return stage(df, label)

    monkeypatch.setattr(costs, "stage", noted)
    before = spark.conf.get(setting, None)
    assert costs.cost(**bill).count() == 7
    assert [label for label, *_ in seen].count("priced") == 4
    assert {row[1:] for row in seen} == {("true", 6.0)}
    assert spark.conf.get(setting, None) == before


def test_a_claim_with_several_payments_and_repeated_conditions(bill, spark):
    """Two claims of a diagnosis, one of them without a payment by the patient; the condition noted twice."""
    found = costs.cost(**bill | {
        "conditions": bill["conditions"].unionByName(bill["conditions"]),
        "claims": bill["claims"].unionByName(bill["claims"]),
    }).filter("cost_domain_id = 'Condition'")
    assert {tuple(map(int, r)) for r in found.select("paid_by_payer", "paid_by_patient").collect()} == {(48, 8)}


def test_order_lines_are_joined_once(spark, tmp_path):
    """Before, each source table of order lines held the join, and was read several times."""
    orders = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"
    lines = (
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    )
    day0 = dt.datetime(2020, 1, 1)
    order_rows = [(1, 5, day0), (2, None, None), (None, 6, day0)]
    line_rows = [(k, n, 7, 3, 2.0, 9.5, 0.0, 0.0, "R", "O", day0) for k in (1, 2, 3, None) for n in (1, 1)]
    spark.createDataFrame(order_rows, orders).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(line_rows, lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(3,)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    chart = registry.Chart(spark, str(tmp_path))
    for table, n in (("conditions", 4), ("immunizations", 4), ("claims", 4), ("claims_transactions", 12)):
        got = getattr(chart, table)
        assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == n
    assert rows(chart.conditions, "patient", "encounter") == [("p5", "e1")] * 2 + [(None, "e2")] * 2
