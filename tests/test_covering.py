from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from proxies import registry
from tests.conftest import rows
from wardspan import runtime
from wardspan.operators import containment_join, covering, earliest_cover, ranges
from wardspan.operators.covering import _minute, cut_spans, shared_level

D0, T0 = dt.date(2020, 1, 1), dt.datetime(2020, 1, 1)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_containment_matches_brute_force(spark, how):
    rng = random.Random(2)
    points = [(rng.randrange(8), D0 + dt.timedelta(days=rng.randrange(400)), i) for i in range(300)]
    spans = []
    for s in range(60):
        lo = D0 + dt.timedelta(days=rng.randrange(-200, 400))
        hi = dt.date(9999, 12, 31) if s % 10 == 0 else lo + dt.timedelta(days=rng.randrange(-3, 90))
        spans.append((rng.randrange(8), lo, hi, s))
    want = []
    for k, at, i in points:
        hits = [(i, s) for kk, lo, hi, s in spans if kk == k and lo <= at <= hi]
        want += hits or ([(i, None)] if how == "left" else [])
    p = spark.createDataFrame(points, "k int, at date, i int")
    q = spark.createDataFrame(spans, "k int, lo date, hi date, s int")
    got = containment_join(p, q, ["k"], "at", "lo", "hi", how)
    assert rows(got, "i", "s") == sorted(want, key=lambda r: (r[0], r[1] is None, r[1] or 0))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_spans_of_a_minute_to_a_century(spark, how, kind):
    rng = random.Random(7)
    minute, far = dt.timedelta(minutes=1), dt.datetime(1950, 6, 1)
    lengths = [0, 1, 3, 4, 63, 64, 1440, 43_200, 525_600, 52_560_000]
    spans = []
    for s in range(150):
        lo = far + minute * rng.choice([rng.randrange(2000), rng.randrange(60_000_000)])
        spans.append((rng.choice([1, 2, None]), lo, lo + minute * rng.choice(lengths) + dt.timedelta(seconds=rng.randrange(-60, 60)), s))
    points = [(rng.choice([1, 2, None]), far + minute * rng.choice([rng.randrange(2500), rng.randrange(60_000_000)]), i) for i in range(200)]
    points += [(k, rng.choice(x), 200 + i) for i, (k, *x, _) in enumerate(spans)]
    want = []
    for k, at, i in points:
        hits = [(i, s) for kk, lo, hi, s in spans if k is not None and kk == k and lo <= at <= hi]
        want += hits or ([(i, None)] if how == "left" else [])
    p = spark.createDataFrame(points, "k int, at timestamp_ntz, i int").withColumn("at", F.col("at").cast(kind))
    q = spark.createDataFrame(spans, "k int, lo timestamp_ntz, hi timestamp_ntz, s int")
    q = q.withColumns({c: F.col(c).cast(kind) for c in ("lo", "hi")})
    got = containment_join(p, q, ["k"], "at", "lo", "hi", how)
    assert rows(got, "i", "s") == sorted(want, key=lambda r: (r[0], r[1] is None, r[1] or 0))


def test_no_span_is_in_many_pieces(spark):
    """65 cells at most; those of all spans together cover at most three times their time."""
    q = spark.range(1, 48).select(F.col("id").alias("s"), F.explode(F.expr("array(0, 17, 4095)")).alias("lo"))
    q = q.withColumn("n", F.pow(F.lit(1.45), "s").cast("long"))
    base, levels = shared_level(q, F.col("n"))
    cut = cut_spans(q, F.col("lo").cast("long"), F.col("lo") + F.col("n") - 1, base)
    counts = cut.groupBy("s", "lo").agg(F.count(F.lit(1)).alias("pieces"), F.max("_level").alias("level")).collect()
    assert max(r.pieces for r in counts) <= 65 and {r.level for r in counts} == set(levels)
    covered, time = cut.agg(F.sum(F.pow(F.lit(4), "_level"))).first()[0], q.agg(F.sum("n")).first()[0]
    assert covered <= 3 * time



def test_containment_without_points_or_spans(spark):
    p = spark.createDataFrame([], "k int, at date")
    q = spark.createDataFrame([(1, D0, D0)], "k int, lo date, hi date")
    assert containment_join(p, q, ["k"], "at", "lo", "hi", "left").count() == 0
    one = spark.createDataFrame([(1, D0)], "k int, at date")
    none = spark.createDataFrame([], "k int, lo date, hi date")
    assert containment_join(one, none, ["k"], "at", "lo", "hi", "left").count() == 1


@pytest.mark.parametrize("seed, rows_a_range, hot", [(1, 10_000, False), (2, 30, False), (3, 7, False), (4, 40, True)])
def test_earliest_cover_matches_brute_force(spark, monkeypatch, seed, rows_a_range, hot):
    """In one range and in many, so that keys lie on cuts; and with a moment that fills several."""
    monkeypatch.setattr(ranges, "LEAST_ROWS", rows_a_range)
    monkeypatch.setattr(ranges, "ROWS", rows_a_range)
    rng = random.Random(seed)
    # coarse times, so that starts, ends and points often coincide, also at midnight
    step = dt.timedelta(hours=12)
    points = [(rng.randrange(4), T0 + step * rng.randrange(120), i) for i in range(300)]
    points += [(None, T0, 300), (2, None, 301)]
    if hot:
        points += [(2, T0 + step * 50, i) for i in range(302, 600)]
    spans = []
    for s in range(120):
        lo = T0 + step * rng.randrange(120)
        hi = rng.choice([None, lo, lo - step, lo + step, lo + step * rng.randrange(60)])
        spans.append((rng.randrange(4), rng.choice(["x", "y", "z"]), s, lo, hi))

    def first(k, at, kind, exact=False):
        hits = [
            (lo, s)
            for kk, n, s, lo, hi in spans
            if kk == k and n == kind and None not in (hi, at) and lo <= at <= hi and (lo == at or not exact)
        ]
        return min(hits)[1] if hits else None

    want = [(i, first(k, at, "x"), first(k, at, "y"), first(k, at, "y", True)) for k, at, i in points]
    p = spark.createDataFrame(points, "k int, at timestamp_ntz, i int")
    q = spark.createDataFrame(
        spans, "k int, kind string, span_id long, span_start timestamp_ntz, span_end timestamp_ntz"
    )
    out = earliest_cover(p, q, "k", "at", ["x", "y"], ["y"])
    got = rows(out, "i", "x.span_id", "y.span_id", "y_exact.span_id")
    assert got == sorted(want, key=lambda r: r[0])


@pytest.mark.parametrize("how", ["inner", "left"])
def test_one_date_far_off(spark, how):
    """Points over two centuries, spans from days to all of them: no span is cut into many pieces."""
    rng = random.Random(4)
    day = lambda n: dt.date(1900, 1, 1) + dt.timedelta(days=n)
    points = [(rng.choice([1, 2, None]), day(rng.choice([0, 70000, rng.randrange(70000)])), i) for i in range(200)]
    spans = []
    for s in range(60):
        lo = rng.randrange(70000)
        spans.append((rng.choice([1, 2, None]), day(lo), day(lo + rng.choice([3, 600, 9000, 90000])), s))
    want = []
    for k, at, i in points:
        hits = [(i, s) for kk, lo, hi, s in spans if k is not None and kk == k and lo <= at <= hi]
        want += hits or ([(i, None)] if how == "left" else [])
    p = spark.createDataFrame(points, "k int, at date, i int")
    q = spark.createDataFrame(spans, "k int, lo date, hi date, s int")
    got = containment_join(p, q, ["k"], "at", "lo", "hi", how)
    assert got.columns == ["k", "at", "i", "lo", "hi", "s"]
    assert rows(got, "i", "s") == sorted(want, key=lambda r: (r[0], r[1] is None, r[1] or 0))


def test_ranges_of_cover_count_points_and_spans(spark, tmp_path, monkeypatch):
    """Were only the orders counted, a range would hold as many more rows as an order has lines."""
    orders = spark.createDataFrame([(i, i % 3, dt.datetime(2020, 1, 1 + i)) for i in range(9)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    lines = [(i, n, 5, 7, dt.datetime(2020, 1, 2 + i, n)) for i in range(9) for n in range(6)]
    lines = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp_ntz")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    seen = []

    def cover(points, spans, key, at, kinds, exact, like):
        seen.extend(like)
        return earliest_cover(points, spans, key, at, kinds, exact, like)

    monkeypatch.setattr(registry, "earliest_cover", cover)
    assert registry.QUERIES["earliest_cover"](registry.Chart(spark, str(tmp_path))).count() == 54
    assert sum(one.base.count() for one in seen) == 9 + 54
    drawn = [rows(one.through(one.base), "o_custkey", "l_shipdate") for one in seen]
    assert drawn[1] == rows(lines.selectExpr("l_orderkey % 3 AS o_custkey", "l_shipdate"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_containment_of_many_rows_takes_more_partitions(spark, monkeypatch, how):
    """Before, a task sorted the more rows the more there were, as the session's partitions stayed."""
    setting, given, staged = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"), []
    write = covering.stage

    def seen(df, label):
        staged.append(int(spark.conf.get(setting)))
        return write(df, label)

    monkeypatch.setattr(runtime, "JOIN_ROWS", 10)
    monkeypatch.setattr(covering, "stage", seen)
    points = [(i % 3, D0 + dt.timedelta(days=i % 50), i) for i in range(200)]
    spans = [(k, D0 + dt.timedelta(days=5 * s), D0 + dt.timedelta(days=5 * s + 7), s) for k in range(2) for s in range(8)]
    want = []
    for k, at, i in points:
        hits = [(i, s) for kk, lo, hi, s in spans if kk == k and lo <= at <= hi]
        want += hits or ([(i, None)] if how == "left" else [])
    p = spark.createDataFrame(points, "k int, at date, i int")
    q = spark.createDataFrame(spans, "k int, lo date, hi date, s int")
    got = containment_join(p, q, ["k"], "at", "lo", "hi", how)
    assert rows(got, "i", "s") == sorted(want, key=lambda r: (r[0], r[1] is None, r[1] or 0))
    assert staged and staged[0] >= 20 and staged[0] > int(given)
    assert spark.conf.get(setting) == given


def test_minutes_are_computed_a_few_times(spark):
    """filters that Spark infers had the minutes of a span computed for each comparison of its level."""
    times = "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(int(id)) AS"
    points = spark.range(300).selectExpr("'k' AS k", f"{times} at", "id AS n")
    for hours in ("5", "CASE WHEN n = 0 THEN 9000 ELSE 1 END"):  # one size of cells, and several
        spans = points.selectExpr("k", "at AS lo", f"at + make_dt_interval(0, int({hours})) AS hi", "n AS m")
        pieces = spans.withColumns({"a": _minute(F.col("lo"), spans.schema["lo"].dataType), "b": _minute(F.col("hi"), spans.schema["hi"].dataType)})
        base, levels = shared_level(pieces, F.col("b") - F.col("a") + 1)
        joined = containment_join(points, spans, ["k"], "at", "lo", "hi")
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("hour(") <= 12
        brute = points.join(spans.withColumnRenamed("k", "k2"), F.expr("at >= lo AND at <= hi")).select("n", "m")
        assert rows(joined, "n", "m") == rows(brute)
        assert len(levels) == (1 if hours == "5" else 2)
