from __future__ import annotations

import datetime as dt
import random
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import in_order, rows
from wardspan import runtime
from wardspan.operators import ranges
from wardspan.operators import COPY, Like, dense_ids, highest_before, pick_best, previous_value, tag_copies

T0 = dt.datetime(2020, 1, 1)


def test_ids_follow_a_total_order(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), i) for i in range(500)]
    df = spark.createDataFrame(data, "a int, b string, c long").repartition(7)
    out = dense_ids(df, ["a", "b", "c"], "id").orderBy("id").collect()
    order = sorted(data, key=in_order)
    assert [r["id"] for r in out] == list(range(1, 501))
    assert [(r["a"], r["b"], r["c"]) for r in out] == order


def test_identical_copies_are_numbered_and_spread(spark, tmp_path):
    path = str(tmp_path / "copies")
    spark.range(30_000).select(F.lit(1).alias("a")).write.parquet(path)
    tagged = tag_copies(spark.read.parquet(path))
    keys = [F.col("a").asc_nulls_last(), F.col(COPY).asc()]
    parts = tagged.repartitionByRange(4, *keys).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) < 15_000
    out = dense_ids(tagged, ["a"], "id")
    assert out.columns == ["a", "id"]
    assert out.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()[:] == (1, 30_000, 30_000)


@pytest.mark.parametrize("count, columns", [(4, ["a", "b"]), (50, ["a", "b"]), (3, ["a"]), (6, ["b"])])
def test_ids_over_ranges_of_a_sample(spark, monkeypatch, count, columns):
    """Ranges come from another frame, by compiled cuts or by halving; NULLs are last. A key that fills
    a range (b has three values) sends the rows the other way."""
    monkeypatch.setattr(ranges, "LEAST_ROWS", 3000 // count)
    monkeypatch.setattr(ranges, "ROWS", 3000 // count)
    rng = random.Random(count)
    data = [(rng.choice([None, *range(900)]), rng.choice([None, "a", "ä"]), i) for i in range(3000)]
    df = spark.createDataFrame(data, "a int, b string, c long")
    order = ["b", "a", "c"] if columns == ["b"] else ["a", "b", "c"]
    like = Like(df.select("c"), lambda some: some.join(df, "c").select(*columns))
    out = dense_ids(df, order, "id", [like]).orderBy("id").collect()
    assert [r["id"] for r in out] == list(range(1, 3001))
    at = [["a", "b", "c"].index(c) for c in order]
    want = sorted(([r[i] for i in at] for r in data), key=in_order)
    assert [[r[c] for c in order] for r in out] == want
    found = ranges.cut_ranges([like], columns)
    assert (found.repeated is not None) == (columns == ["b"])
    if columns != ["b"]:
        parts = found.deal(df).groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == found.count and max(r["count"] for r in parts) < 4 * 3000 / found.count


def test_rows_are_computed_and_written_once(spark):
    """With a sample of the inputs a frame is neither staged nor run for its ranges."""
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(50_000).selectExpr("id * 7919 % 50000 AS a").mapInArrow(watch, "a long")
    out = dense_ids(df, ["a"], "id", [Like(spark.range(50_000).selectExpr("id AS a"))])
    assert out.filter("a + 1 = id").count() == 50_000 and seen.value == 50_000
    folder = Path(out.inputFiles()[0]).parent.name
    assert folder.startswith("id-") and not folder.startswith("id-rows")


def test_ids_of_nothing_and_of_one_row(spark):
    empty = spark.createDataFrame([], "a int")
    assert dense_ids(empty, ["a"], "id").collect() == []
    one = spark.createDataFrame([(5,)], "a int")
    assert rows(dense_ids(one, ["a"], "id")) == [(5, 1)]


def test_ids_do_not_depend_on_partitions(spark):
    df = spark.range(2000).select((F.col("id") * 7 % 501).alias("a"), "id")
    seen = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            seen.append(rows(dense_ids(df, ["a", "id"], "n")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert seen[0] == seen[1] == seen[2]


def test_scratch_is_in_the_folder_the_cluster_names(spark, shared_folder):
    assert runtime.scratch_root(spark).startswith(str(shared_folder))
    kept = runtime.stage(spark.range(3), "kept")
    with runtime.scratch_run(spark):
        inner = runtime.scratch_root(spark)
        runtime.stage(spark.range(3), "gone")
        assert list(Path(inner).rglob("*.parquet"))
    assert not Path(inner).exists()
    assert kept.count() == 3


def test_no_machine_local_scratch_on_a_cluster():
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, default: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        runtime.scratch_root(SimpleNamespace(sparkContext=context, conf=conf))


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(9)
    data, seen = [], set()
    while len(data) < 1500:
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 30)
        at = T0 + dt.timedelta(hours=rng.randrange(24 * 90))
        i = len(data)
        if (key, at, i) not in seen:
            data.append((key, at, i, rng.randrange(1000)))
    return data


def _by_key(data):
    groups = {}
    for r in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


def test_previous_value(spark, series):
    df = spark.createDataFrame(series, "k int, at timestamp_ntz, i long, v int")
    got = rows(previous_value(df, ["k"], "at", "i", "i", "prev"), "i", "prev")
    want = []
    for group in _by_key(series).values():
        want += [(r[2], group[n - 1][2] if n else None) for n, r in enumerate(group)]
    assert got == sorted(want, key=lambda r: r[0])


def test_highest_before(spark, series):
    df = spark.createDataFrame(series, "k int, at timestamp_ntz, i long, v int")
    got = rows(highest_before(df, ["k"], "at", "i", "v", "top"), "i", "top")
    want = []
    for group in _by_key(series).values():
        want += [(r[2], max((x[3] for x in group[:n]), default=None)) for n, r in enumerate(group)]
    assert got == sorted(want, key=lambda r: r[0])


def test_pick_best_puts_nulls_last(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 5, 2), ("a", 5, 3), ("b", None, 4)], "k string, p int, i int"
    )
    assert rows(pick_best(df, ["k"], ["p", "i"])) == [("a", 5, 2), ("b", None, 4)]


def test_no_task_reads_the_base_of_a_sample(spark, tmp_path, monkeypatch):
    """The sample is drawn where the rows lie, and only then sorted in one place."""
    spark.range(0, 100_000, 1, 8).selectExpr("id AS a", "cast(id AS string) AS b").write.parquet(str(tmp_path / "t"))
    kind, plans = type(spark.range(0)), []
    collect = kind.collect

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(kind, "collect", noted)
    found = ranges.cut_ranges([Like(spark.read.parquet(str(tmp_path / "t")))], ["a", "b"], 4)
    assert found.count == 4
    (drawn,) = [p for p in plans if "Sample" in p]
    assert "Coalesce" not in drawn and drawn.index("Exchange") < drawn.index("Sample")
