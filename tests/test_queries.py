"""Registered queries beside their SQL at the smallest scale. All of them with WARDSPAN_ALL=1;
tools/compare.py does the same at any scale."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver
from proxies.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
SOME = (
    "merge_intervals_gap0",
    "merge_moments",
    "map_codes_shuffled",
    "inpatient_islands",
    "dense_ids",
    "earliest_cover",
    "containment_join",
    "all_visits",
    "final_visit_ids",
    "condition_era",
    "drug_era",
    "payer_plan_period",
    "cost",
)
TABLES = "region nation customer supplier part orders lineitem events"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def sorted_rows(table):
    names = sorted(table.column_names)
    return names, sorted(zip(*[table.column(n).to_pylist() for n in names]), key=str)


def test_every_query_has_its_sql():
    assert QUERIES.keys() <= driver.queries().keys()
    assert QUERIES.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES if os.environ.get("WARDSPAN_ALL") else SOME)
def test_query(spark, con, name):
    got = driver.queries()[name](spark, SMALL).toArrow()
    want = con.execute(driver.oracle_sql()[name]).to_arrow_table()
    assert sorted_rows(got) == sorted_rows(want)
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}


def test_entry(spark):
    assert driver.entry(spark).columns[0] == "condition_era_id"
