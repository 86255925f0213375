"""What the plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from proxies.registry import QUERIES, Chart
from wardspan.operators import map_codes
from wardspan.operators.mapping import frequent_codes
from wardspan.plans import etl, people, visits
from wardspan.runtime import real_sizes
from wardspan.sources import read_source

SMALL = "/root/testdata/sf0.001"
LAZY = (
    "merge_intervals_gap30",
    "previous_value",
    "highest_before",
    "earliest_cover",
    "pick_best",
    "inpatient_visits",
    "emergency_visits",
    "outpatient_visits",
    "source_to_standard",
    "source_to_source",
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_task_sees_everything(spark, name):
    text = plan(QUERIES[name](Chart(spark, SMALL)))
    for bad in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text


def test_merging_folds_before_it_shuffles(spark):
    """Exchanges of folded rows by key and cell, and one by key; the islands reuse the last."""
    chart = Chart(spark, SMALL)
    episodes = chart.raw("lineitem").selectExpr(
        "l_suppkey AS k", "date(l_shipdate) AS start", "date_add(date(l_shipdate), 9) AS end"
    )
    from wardspan.operators import merge_intervals

    text = plan(merge_intervals(episodes, ["k"], "start", "end", 30, count_as="n"))
    # By cell, by start for the few rows that end before they start, and by key.
    assert text.count("Exchange hashpartitioning") == 3
    folds = text.split("Exchange hashpartitioning")[2:]
    assert "partial_count" in folds[0] and "partial_min" in folds[0] and "partial_count" in folds[1]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    Chart(spark, SMALL).encounters.write.parquet(f"{folder}/encounters.parquet")
    return read_source(spark, str(folder), "encounters")


def test_filters_and_columns_reach_the_scan(spark, stored):
    text = plan(visits.outpatient_visits(stored))
    assert "PushedFilters: [In(encounterclass" in text
    assert "total_claim_cost" not in text[text.index("ReadSchema") :]

    assert "PushedFilters: [IsNotNull(id), EqualTo(id,e1)]" in plan(stored.filter("id = 'e1'"))

    chart = Chart(spark, SMALL)
    text = plan(people.death(stored, chart._standard(), chart.person))
    assert "EqualTo(code,308646001)" in text


@pytest.mark.parametrize("limit, way", [(1 << 20, "BroadcastHashJoin"), (100, "SortMergeJoin")])
def test_maps_are_broadcast_by_their_size(spark, limit, way):
    facts = spark.range(1000).selectExpr("string(id % 7) AS code")
    mapping = spark.range(50).selectExpr("string(id) AS code", "id AS target_concept_id")
    joined = map_codes(facts, mapping, max_bytes=limit)
    assert way in plan(joined) and joined.count() == 1000


def test_frequent_codes_are_not_shuffled(spark):
    """A third of the facts on one code, a third without any; the map has two targets for each code."""
    drawn = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.concat(F.lit("c"), F.col("id")))
    facts = spark.range(30_000).select("id", drawn.alias("code"))
    targets = F.explode(F.sequence(F.lit(1), F.lit(2))).alias("target_concept_id")
    mapping = facts.filter("code != 'c5'").select("code").distinct().select("code", targets)
    assert frequent_codes(facts) == ["hot"]
    assert frequent_codes(facts.limit(0)) == []

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for how, unmapped in (("inner", 0), ("left", 10_001)):
            joined = map_codes(facts, mapping, how=how, max_bytes=0)
            assert joined.columns == ["id", "code", "target_concept_id"]
            assert joined.count() == 20_000 + 2 * 9_999 + unmapped
            assert joined.filter("target_concept_id IS NULL").count() == unmapped
            assert joined.distinct().count() == joined.count()
            # The shuffled part alone: its partitions are even.
            rare = joined.filter("code LIKE 'c%'").groupBy(F.spark_partition_id().alias("p")).count()
            sizes = sorted(r["count"] for r in rare.collect())
            assert sizes[-1] < 2 * sizes[len(sizes) // 2]
            text = plan(joined)
            assert "BroadcastHashJoin" in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    with pytest.raises(ValueError, match="inner or left"):
        map_codes(facts, mapping, how="full")


def test_concepts_are_not_broadcast(spark):
    """Their files are small and their rows are not."""
    for name in ("source_to_standard", "source_to_source"):
        text = plan(QUERIES[name](Chart(spark, SMALL)))
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_small_files_of_many_rows_are_not_broadcast_in_a_build(spark, tmp_path, monkeypatch):
    """Files of persons are small for their rows. Spark goes by files, and had the driver hold them all."""
    persons = spark.range(60_000).selectExpr("id AS person_id", "concat('p', id % 100) AS patient")
    persons.write.parquet(f"{tmp_path}/person.parquet")
    facts = spark.range(200_000).selectExpr("concat('p', id) AS patient")
    size = sum(f.stat().st_size for f in (tmp_path / "person.parquet").glob("*.parquet"))

    def joined():
        return plan(facts.join(spark.read.parquet(f"{tmp_path}/person.parquet"), "patient"))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(size * 2))
    try:
        assert "BroadcastHashJoin" in joined()
        with real_sizes(spark):
            assert "BroadcastHashJoin" not in joined()
        assert "BroadcastHashJoin" in joined()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

    seen = []
    monkeypatch.setitem(etl.STEPS, "person", lambda b: seen.append(float(spark.conf.get("spark.sql.sources.fileCompressionFactor"))))
    monkeypatch.setattr("proxies.registry.build_tables", lambda b, keep, **k: etl.build_tables(b, keep, ["person", "cdm_source"], **k))
    assert QUERIES["table_rows"](Chart(spark, SMALL)).count() == 1
    assert seen == [6]
