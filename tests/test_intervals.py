from __future__ import annotations

import datetime as dt
import random
import re

import pytest

from tests.conftest import in_order, rows
from tests.test_plans import plan
from wardspan import runtime
from wardspan.operators import interval_problems, intervals, island_ends, merge_intervals
from wardspan.runtime import stage

D0 = dt.date(2020, 1, 1)
T0 = dt.datetime(2020, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def brute(intervals, gap):
    """Islands of one key by repeated sweeping: (start, end, count)."""
    islands = []
    for lo, hi in sorted(intervals):
        if islands and lo <= islands[-1][1] + gap:
            islands[-1][1] = max(islands[-1][1], hi)
            islands[-1][2] += 1
        else:
            islands.append([lo, hi, 1])
    return [tuple(i) for i in islands]


def merged(spark, data, gap, schema="k string, start date, end date"):
    df = spark.createDataFrame(data, schema)
    return rows(merge_intervals(df, ["k"], "start", "end", gap, count_as="n"))


@pytest.mark.parametrize(
    "intervals, gap, islands",
    [
        ([(0, 5), (3, 9)], 0, [(0, 9, 2)]),  # overlap
        ([(0, 5), (5, 9)], 0, [(0, 9, 2)]),  # touch
        ([(0, 5), (6, 9)], 0, [(0, 5, 1), (6, 9, 1)]),
        ([(0, 5), (35, 40)], 30, [(0, 40, 2)]),  # a gap of exactly 30
        ([(0, 5), (36, 40)], 30, [(0, 5, 1), (36, 40, 1)]),
        ([(0, 50), (3, 9), (20, 25)], 0, [(0, 50, 3)]),  # contained
        ([(0, 5), (0, 5)], 0, [(0, 5, 2)]),  # identical twins count twice
        ([(4, 4)], 0, [(4, 4, 1)]),  # zero length
        ([(-400, -395), (-394, -380)], 1, [(-400, -380, 2)]),
    ],
)
def test_islands(spark, intervals, gap, islands):
    got = merged(spark, [("a", day(lo), day(hi)) for lo, hi in intervals], gap)
    assert got == [("a", day(lo), day(hi), n) for lo, hi, n in islands]


def test_unusable_rows_are_left_out_and_counted(spark):
    data = [("a", day(0), day(2)), ("a", day(9), day(5)), ("a", day(3), None), ("a", None, day(1))]
    assert merged(spark, data, 0) == [("a", day(0), day(2), 1)]
    df = spark.createDataFrame(data, "k string, start date, end date")
    assert rows(interval_problems(df, "start", "end")) == [(1, 1, 1)]


@pytest.mark.parametrize("gap", [0, 1, 7, 30])
def test_dates_match_brute_force(spark, gap):
    rng = random.Random(gap)
    data = []
    for _ in range(3000):
        # a third of the rows on one key, dates on both sides of 1970
        key = "hot" if rng.random() < 0.33 else f"k{rng.randrange(60)}"
        lo = dt.date(1969, 1, 1) + dt.timedelta(days=rng.randrange(3000))
        data.append((key, lo, lo + dt.timedelta(days=rng.choice([0, 0, 1, 3, 20]))))
    keys = {k for k, _, _ in data}
    want = sorted(
        (k, *island)
        for k in keys
        for island in brute([(lo, hi) for kk, lo, hi in data if kk == k], dt.timedelta(days=gap))
    )
    assert merged(spark, data, gap) == want


def test_timestamps_match_brute_force(spark):
    rng = random.Random(5)
    data = []
    for _ in range(2000):
        key = "hot" if rng.random() < 0.33 else f"k{rng.randrange(40)}"
        lo = dt.datetime(1968, 1, 1) + dt.timedelta(seconds=rng.randrange(4 * 365 * 86400))
        data.append((key, lo, lo + dt.timedelta(seconds=rng.randrange(3 * 86400))))
    schema = "k string, start timestamp_ntz, end timestamp_ntz"
    for gap in (0, 1, 2):
        want = sorted(
            (k, *island)
            for k in {k for k, _, _ in data}
            for island in brute([(lo, hi) for kk, lo, hi in data if kk == k], dt.timedelta(days=gap))
        )
        assert merged(spark, data, gap, schema) == want


def test_gap_in_time_is_exact(spark):
    second = dt.timedelta(seconds=1)
    day1 = dt.timedelta(days=1)
    end = T0 + dt.timedelta(hours=5)
    schema = "k string, start timestamp_ntz, end timestamp_ntz"
    exact = [("a", T0, end), ("a", end + day1, end + day1)]
    late = [("a", T0, end), ("a", end + day1 + second, end + day1 + second)]
    assert len(merged(spark, exact, 1, schema)) == 1
    assert len(merged(spark, late, 1, schema)) == 2


def test_sums_and_every_row_in_one_island(spark):
    rng = random.Random(1)
    data = [("a", day(lo), day(lo + 2), rng.randrange(9)) for lo in rng.choices(range(500), k=200)]
    df = spark.createDataFrame(data, "k string, start date, end date, v long")
    out = merge_intervals(df, ["k"], "start", "end", 3, count_as="n", sums={"total": "v"}).collect()
    assert sum(r["n"] for r in out) == 200
    assert sum(r["total"] for r in out) == sum(r[3] for r in data)
    spans = sorted((r["start"], r["end"]) for r in out)
    assert all(b[0] > a[1] + dt.timedelta(days=3) for a, b in zip(spans, spans[1:]))


def test_island_ends_keep_rows(spark):
    data = [("a", day(0), day(4)), ("a", day(3), day(8)), ("a", day(20), day(21))]
    df = spark.createDataFrame(data, "k string, start date, end date")
    got = rows(island_ends(df, ["k"], "start", "end", "last", 1), "start", "last")
    assert got == [(day(0), day(8)), (day(3), day(8)), (day(20), day(21))]


def test_rows_that_end_before_they_start(spark):
    """They count in the island that covers their start and open none."""
    day = dt.date
    data = [
        ("a", day(2020, 1, 10), day(2020, 1, 20), 1),
        ("a", day(2020, 1, 15), day(2020, 1, 12), 2),  # inside
        ("a", day(2020, 1, 24), day(2020, 1, 30), 4),
        ("a", day(2020, 1, 22), day(2020, 1, 2), 8),  # in the gap that the island spans
        ("a", day(2020, 1, 30), day(2020, 1, 1), 16),  # on its last day
        ("a", day(2020, 1, 31), day(2020, 1, 1), 32),  # behind it
        ("a", day(2020, 1, 9), day(2020, 1, 8), 64),  # before it
        ("b", day(2020, 1, 9), day(2020, 1, 8), 128),
    ]
    df = spark.createDataFrame(data, "k string, start date, end date, v long")
    merged = merge_intervals(df, ["k"], "start", "end", 5, count_as="n", sums={"total": "v"})
    assert [tuple(r) for r in merged.collect()] == [("a", day(2020, 1, 10), day(2020, 1, 30), 5, 31)]
    ended = island_ends(df, ["k"], "start", "end", "last", 5).collect()
    assert {(r.v, r.last) for r in ended} == {(v, day(2020, 1, 30)) for v in (1, 2, 4, 8, 16)}


def test_moments_over_days_sums_and_ends(spark, monkeypatch):
    """Islands that last for days, rows that end before they start in gaps and inside of them; one
    table is written. The end of each row's island is the same by ``island_ends``."""
    rng = random.Random(21)
    data = []
    for i in range(1500):
        key = rng.choice(["hot", None, f"k{rng.randrange(20)}"])
        lo = T0 + dt.timedelta(minutes=rng.randrange(60 * 1440))
        length = rng.choice([-5000, -30, -30, 0, 3, 40, 900, 1440, 9000 if key != "hot" else 1])
        data.append((key, lo, lo + dt.timedelta(minutes=length), i))
    df = spark.createDataFrame(data, "k string, start timestamp_ntz, end timestamp_ntz, v long").repartition(5)
    want, ends = [], []
    for k in {row[0] for row in data}:
        mine = [row for row in data if row[0] == k]
        for lo, hi, _ in brute([(lo, hi) for _, lo, hi, _ in mine if hi >= lo], dt.timedelta(0)):
            held = [v for _, a, _, v in mine if lo <= a <= hi]
            want.append((k, lo, hi, len(held), sum(held)))
            ends += [(v, hi) for v in held if k is not None]
    written = []
    monkeypatch.setattr(intervals, "stage", lambda d, label: written.append(label) or stage(d, label))
    got = merge_intervals(df, ["k"], "start", "end", count_as="n", sums={"total": "v"})
    assert rows(got) == sorted(want, key=in_order) and written == ["runs"]
    assert rows(island_ends(df, ["k"], "start", "end", "reach", 0), "v", "reach") == sorted(ends) and written == ["runs"] * 2


def test_moments_of_hot_and_null_keys_without_a_gap(spark):
    """Many distinct moments a day; some rows end before they start and stay where they are covered."""
    rng = random.Random(9)
    data = []
    for _ in range(3000):
        key = rng.choice(["hot", None, f"k{rng.randrange(30)}"])
        lo = T0 + dt.timedelta(minutes=rng.randrange(20 * 1440))
        data.append((key, lo, lo + dt.timedelta(minutes=rng.choice([-30, 0, 2, 5, 20]))))
    want = []
    for k in {k for k, _, _ in data}:
        mine = [(lo, hi) for kk, lo, hi in data if kk == k]
        islands = brute([(lo, hi) for lo, hi in mine if hi >= lo], dt.timedelta(0))
        for lo, hi, n in islands:
            want.append((k, lo, hi, n + sum(a > b and lo <= a <= hi for a, b in mine)))
    schema = "k string, start timestamp_ntz, end timestamp_ntz"
    assert merged(spark, data, 0, schema) == sorted(want, key=in_order)


@pytest.mark.parametrize("known, parts", [(None, 4), (12, 4), (60, 12)])
def test_islands_of_many_rows_take_more_partitions(spark, monkeypatch, known, parts):
    """The session has 4; with 60 rows and 5 a task there are 12, by key, and the islands are the same."""
    monkeypatch.setattr(runtime, "SORT_ROWS", 5)
    days = [(k or None, day(5 * i), day(5 * i + 1)) for k in range(4) for i in range(15)]
    df = spark.createDataFrame(days, "k int, start date, end date")
    islands = merge_intervals(df, ["k"], "start", "end", 5, count_as="n", rows=known)
    found = re.findall(r"hashpartitioning\(k#\d+, (\d+)\), (REPARTITION_BY_NUM|ENSURE_REQUIREMENTS)", plan(islands))
    assert found[0] == (str(parts), "REPARTITION_BY_NUM" if parts > 4 else "ENSURE_REQUIREMENTS")
    assert rows(islands, "k", "n") == [(1, 15), (2, 15), (3, 15), (None, 15)]
