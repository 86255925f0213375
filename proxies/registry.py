"""One query per operator over the proxy tables. ``oracle.py`` has the same answers in SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proxies.frames import Clinic
from wardspan.functions import parse_number
from wardspan.operators import (
    COPY,
    check_not_null,
    check_unique,
    conform,
    containment_join,
    dense_ids,
    earliest_cover,
    highest_before,
    interval_problems,
    map_codes,
    merge_intervals,
    pick_best,
    previous_value,
    repeated_deaths,
    rollup_to_ancestor,
    source_to_source,
    source_to_standard,
    unmapped_codes,
)
from wardspan.operators import Like
from wardspan.plans import cost as costs
from wardspan.plans import eras, events, people, visits
from wardspan.plans.quality import quality_report
from wardspan.plans.etl import NEEDED, Build, build_tables, run_etl
from wardspan.runtime import fresh_folder, real_sizes, shuffles_removed, stage, written
from wardspan.schemas import CDM, SOURCE
from wardspan.sources import (
    empty_cdm,
    read_cdm,
    read_source,
    read_source_lenient,
    read_vocabulary,
    read_vocabulary_text,
    vocab_tsv_to_parquet,
    write_cdm,
    write_table,
)
from wardspan.sources.tables import DOWNLOAD_TABLES

DAY = dt.date(2024, 1, 1)
DESCRIBE = {
    "cdm_source_name": "Orders",
    "cdm_source_abbreviation": "ORD",
    "cdm_holder": "",
    "source_description": "Orders shaped like patient records",
    "source_documentation_reference": "README",
    "cdm_etl_reference": "README",
}
VOCABULARY_TABLES = (
    "concept",
    "concept_relationship",
    "source_to_concept_map",
    "concept_ancestor",
    "vocabulary",
)


class Chart(Clinic):
    """The build over the proxy tables: each work table is written once for the query asking."""

    @cached_property
    def standard(self) -> DataFrame:
        return stage(self._standard(), "standard")

    def _standard(self) -> DataFrame:
        return source_to_standard(
            self.concept, self.concept_relationship, self.source_to_concept_map
        )

    @cached_property
    def own(self) -> DataFrame:
        return stage(source_to_source(self.concept, self.source_to_concept_map), "own")

    @cached_property
    def person(self) -> DataFrame:
        return people.person(self.patients)

    @cached_property
    def provider(self) -> DataFrame:
        return people.provider(self.providers)

    @cached_property
    def visits(self) -> DataFrame:
        return visits.roll_up(self.encounters)

    @cached_property
    def final_ids(self) -> DataFrame:
        return stage(visits.final_visit_ids(self.encounters, self.visits), "final_ids")

    @cached_property
    def context(self) -> DataFrame:
        return stage(
            visits.encounter_context(self.encounters, self.final_ids, self.provider), "context"
        )

    @cached_property
    def visit_occurrence(self) -> DataFrame:
        return visits.visit_occurrence(self.visits, self.person, self.provider, self.final_ids)

    @cached_property
    def condition_occurrence(self) -> DataFrame:
        return events.condition_occurrence(self.conditions, self.standard, self.person, self.context)

    @property
    def _maps(self) -> tuple[DataFrame, ...]:
        return self.standard, self.own, self.person, self.context

    @cached_property
    def observation(self) -> DataFrame:
        return events.observation(self.allergies, self.conditions, self.observations, *self._maps)

    @cached_property
    def measurement(self) -> DataFrame:
        return events.measurement(self.procedures, self.observations, *self._maps)

    @cached_property
    def procedure_occurrence(self) -> DataFrame:
        return events.procedure_occurrence(self.procedures, *self._maps)

    @cached_property
    def device_exposure(self) -> DataFrame:
        return events.device_exposure(self.devices, *self._maps)

    @cached_property
    def drug_exposure(self) -> DataFrame:
        return events.drug_exposure(self.medications, self.immunizations, *self._maps)

    @cached_property
    def payer_plan_period(self) -> DataFrame:
        return costs.payer_plan_period(self.payers, self.payer_transitions, self.person)

    @property
    def cost(self) -> DataFrame:
        with shuffles_removed(self.spark), real_sizes(self.spark):
            return costs.cost(
                self.procedures,
                self.immunizations,
                self.medications,
                self.conditions,
                self.claims,
                self.claims_transactions,
                self.encounters,
                self.person,
                stage(self.visit_occurrence, "visit_occurrence"),
                self.procedure_occurrence,
                self.drug_exposure,
                self.condition_occurrence,
                self.payer_plan_period,
            )

    @property
    def death(self) -> DataFrame:
        return people.death(self.encounters, self.standard, self.person)

    @property
    def episodes(self) -> DataFrame:
        """Shipments of a customer and part family as intervals of dates."""
        lines = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
        orders = self.raw("orders").select("o_orderkey", "o_custkey")
        start = F.col("l_shipdate").cast("date")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "o_custkey",
            (F.col("l_partkey") % 5).alias("family"),
            start.alias("start"),
            # Quantities below 4 give intervals that end before they start.
            F.date_add(start, F.col("l_quantity").cast("int") - 4).alias("end"),
            F.col("l_quantity").cast("long").alias("quantity"),
        )


def _merged(c: Chart, gap: int) -> DataFrame:
    rows = c.raw("lineitem").count()
    return merge_intervals(
        c.episodes, ["o_custkey", "family"], "start", "end", gap, "n", {"quantity": "quantity"}, rows
    )


def _dense_ids(c: Chart) -> DataFrame:
    columns = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = c.raw("lineitem").select(*columns)
    return dense_ids(lines, columns, "line_id", [Like(lines)])


def _visit_columns(visits_: DataFrame) -> DataFrame:
    return visits_.drop("provider")


def _islands(c: Chart) -> DataFrame:
    stays = c.encounters.filter(F.col("encounterclass") == "inpatient")
    return merge_intervals(stays, ["patient"], "start", "stop", 1, "stays", rows=c.raw("orders").count())


def _contained(c: Chart) -> DataFrame:
    points = c.lines.select("patient", "encounter", "code", F.col("date").cast("date").alias("at"), "udi")
    spans = c.payer_transitions.select("patient", "payer", "start_year", "end_year")
    return containment_join(points, spans, ["patient"], "at", "start_year", "end_year", "left")


def _earliest(c: Chart) -> DataFrame:
    points = c.raw("lineitem").join(
        c.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select("o_custkey", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    key = F.col("o_orderkey")
    spans = c.raw("orders").select(
        "o_custkey",
        F.when(key % 2 == 0, "even").otherwise("odd").alias("kind"),
        key.alias("span_id"),
        F.col("o_orderdate").alias("span_start"),
        (F.col("o_orderdate") + F.make_dt_interval(days=(key % 200).cast("int"))).alias("span_end"),
    )
    of_order = c.raw("orders").select(key.alias("l_orderkey"), "o_custkey")
    like = [
        Like(c.raw("orders").select("o_custkey", F.col("o_orderdate").alias("l_shipdate"))),
        Like(
            c.raw("lineitem").select("l_orderkey", "l_shipdate"),
            lambda some: some.join(of_order, "l_orderkey").select("o_custkey", "l_shipdate"),
        ),
    ]
    found = earliest_cover(points, spans, "o_custkey", "l_shipdate", ["even", "odd"], ["odd"], like)
    return found.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        F.col("even.span_id").alias("even_id"),
        F.col("odd.span_id").alias("odd_id"),
        F.col("odd_exact.span_id").alias("odd_exact_id"),
    )


def _orders(c: Chart) -> DataFrame:
    return c.raw("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


def _pick_best(c: Chart) -> DataFrame:
    lines = c.raw("lineitem").select(
        "l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return pick_best(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"])


def _numbers(c: Chart) -> DataFrame:
    return c.raw("events").join(
        c.observations.select(F.expr("cast(substring(encounter, 2) as bigint)").alias("event_id"), F.col("value").alias("text")),
        "event_id",
    ).select("event_id", "text", parse_number(F.col("text")).alias("number"))


def _shuffled_codes(c: Chart) -> DataFrame:
    """A third of the lines have one code, and the map is too large to broadcast."""
    mapped = map_codes(c.lines, events.condition_map(c.standard), max_bytes=0)
    return mapped.select("patient", "encounter", "date", "code", "target_concept_id")


def _moments(c: Chart) -> DataFrame:
    """Orders of a day of the week, open for some hours, as islands of moments without a gap."""
    day = F.col("o_orderkey") % 24
    orders = c.raw("orders").select(
        F.dayofweek("o_orderdate").alias("weekday"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=day.cast("int"))).alias("start"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(day + F.col("o_orderkey") % 9 - 1).cast("int"))).alias("end"),
    )
    return merge_intervals(orders, ["weekday"], "start", "end", count_as="n")


def _rollup(c: Chart) -> DataFrame:
    facts = c.medications.select("patient", "start", "encounter", F.col("code").cast("int").alias("drug"), F.col("description"))
    return rollup_to_ancestor(facts.drop("description"), "drug", c.concept_ancestor, c.concept, "ingredient")


def _round_trip(c: Chart) -> DataFrame:
    """Encounters written as CSV and read back as a source table."""
    folder = fresh_folder(c.spark, "csv")
    upper = c.encounters.toDF(*[n.upper() for n in c.encounters.columns])
    upper.write.mode("overwrite").option("header", True).csv(f"{folder}/encounters.csv")
    return conform(read_source(c.spark, folder, "encounters"), SOURCE["encounters"])


def _rejects(c: Chart) -> DataFrame:
    """Conditions written as CSV in several files, one row in seven with a start that is no date."""
    folder, key = fresh_folder(c.spark, "csv"), F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    rows = c.raw("orders").select(
        F.when(key % 7 == 0, "soon").otherwise(day).alias("START"),
        F.concat(F.lit("p"), "o_custkey").alias("PATIENT"),
        F.concat(F.lit("e"), key).alias("ENCOUNTER"),
    )
    rows.repartition(3).write.option("header", True).csv(f"{folder}/conditions.csv")
    kept, rejects = read_source_lenient(c.spark, folder, "conditions")
    record = F.concat_ws(",", "start", "patient", "encounter")
    return rejects.select("record", "reason").unionByName(
        kept.select(record.alias("record"), F.lit("").alias("reason"))
    )


def _vocabulary_text(c: Chart) -> DataFrame:
    """Concepts written like a vocabulary download, converted to Parquet and loaded."""
    folder = fresh_folder(c.spark, "vocabulary")
    dates = {n: F.date_format(n, "yyyyMMdd") for n in ("valid_start_date", "valid_end_date")}
    writer = c.concept.withColumns(dates).write.mode("overwrite").option("header", True)
    writer.option("sep", "\t").option("quote", "").csv(f"{folder}/text/CONCEPT.csv")
    text = read_vocabulary_text(c.spark, f"{folder}/text/CONCEPT.csv", "concept")
    text.write.mode("overwrite").parquet(f"{folder}/bundle/concept.parquet")
    for table in ("concept_relationship", "concept_ancestor", "vocabulary"):
        getattr(c, table).write.parquet(f"{folder}/bundle/{table}.parquet")
    return read_vocabulary(c.spark, f"{folder}/bundle")["concept"]


def _vocabulary_download(c: Chart) -> DataFrame:
    """A whole download of tab-separated tables, names in either case, converted to Parquet and
    loaded; source codes are mapped by what came through."""
    folder, nothing = fresh_folder(c.spark, "download"), empty_cdm(c.spark)
    for number, table in enumerate(DOWNLOAD_TABLES):
        rows = getattr(c, table) if table in VOCABULARY_TABLES else nothing[table]
        dates = {n: F.date_format(n, "yyyyMMdd") for n in rows.columns if "_date" in n}
        writer = rows.withColumns(dates).write.option("header", True).option("sep", "\t").option("quote", "")
        writer.csv(f"{folder}/text/{table.upper() if number % 2 else table}.csv")
    vocab_tsv_to_parquet(c.spark, f"{folder}/text", f"{folder}/bundle")
    found = read_vocabulary(c.spark, f"{folder}/bundle")
    return source_to_standard(found["concept"], found["concept_relationship"], c.source_to_concept_map)


def _write_cdm(c: Chart) -> DataFrame:
    folder = fresh_folder(c.spark, "cdm")
    write_cdm({"person": c.person}, folder, overwrite=True)
    return c.spark.read.schema(CDM["person"]).parquet(f"{folder}/person.parquet")


def _quality(c: Chart) -> DataFrame:
    source = {t: getattr(c, t) for t in ("encounters", "patients", "conditions", "observations")}
    done = {"person": c.person, "death": stage(c.death, "death")}
    return quality_report(source, c.standard, done)


def _by_concept(c: Chart) -> DataFrame:
    """Exposures to the concepts of one class."""
    wanted = c.concept.filter(F.col("concept_class_id") == "Ingredient").select(
        F.col("concept_id").cast("long").alias("drug_concept_id")
    )
    return c.drug_exposure.join(wanted, "drug_concept_id", "left_semi").select(
        "drug_exposure_id", "person_id", "drug_concept_id", "drug_exposure_start_date"
    )


def _table_rows(c: Chart) -> DataFrame:
    """The whole build, table by table, and the row count of each finished table."""
    build = Build(
        source={t: getattr(c, t) for t in SOURCE if hasattr(c, t)},
        vocabulary={t: getattr(c, t) for t in VOCABULARY_TABLES},
        describe=DESCRIBE,
        day=DAY,
    )
    folder = fresh_folder(c.spark, "whole")

    def hold(table: DataFrame, label: str) -> DataFrame:
        written(table).parquet(f"{folder}/work/{label}.parquet")
        return c.spark.read.schema(table.schema).parquet(f"{folder}/work/{label}.parquet")

    build.hold = hold

    def keep(name: str, table: DataFrame) -> DataFrame:
        write_table(table, folder, name)
        return c.spark.read.schema(CDM[name]).parquet(f"{folder}/{name}.parquet")

    with shuffles_removed(c.spark), real_sizes(c.spark):
        build_tables(build, keep, clean=True)
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in build.done.items()
    ]
    together = counts[0]
    for one in counts[1:]:
        together = together.unionByName(one)
    return together


def _files_to_cost(c: Chart) -> DataFrame:
    """The build from files to files, and its last table."""
    folder = fresh_folder(c.spark, "etl")
    # At its usual level gzip takes more time than all the rest of writing, for files a fifth smaller.
    gzip = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    for t in NEEDED:
        writer = getattr(c, t).drop(COPY).write.option("header", True).options(**gzip)
        writer.csv(f"{folder}/csv/{t}.csv")
    for t in VOCABULARY_TABLES:
        getattr(c, t).write.parquet(f"{folder}/vocabulary/{t}.parquet")
    run_etl(c.spark, f"{folder}/csv", f"{folder}/vocabulary", f"{folder}/cdm", DESCRIBE, DAY)
    return read_cdm(c.spark, f"{folder}/cdm", "cost")


QUERIES: dict[str, Callable[[Chart], DataFrame]] = {
    "merge_intervals_gap0": lambda c: _merged(c, 0),
    "merge_intervals_gap30": lambda c: _merged(c, 30),
    "merge_moments": _moments,
    "inpatient_islands": _islands,
    "dense_ids": _dense_ids,
    "previous_value": lambda c: previous_value(
        _orders(c), ["o_custkey"], "o_orderdate", "o_orderkey", "o_orderkey", "previous_order"
    ),
    "highest_before": lambda c: highest_before(
        _orders(c), ["o_custkey"], "o_orderdate", "o_orderkey", "o_totalprice", "highest_price"
    ),
    "earliest_cover": _earliest,
    "containment_join": _contained,
    "pick_best": _pick_best,
    "parse_number": _numbers,
    "ancestor_rollup": _rollup,
    "source_to_standard": lambda c: c._standard(),
    "source_to_source": lambda c: source_to_source(c.concept, c.source_to_concept_map),
    "map_codes_shuffled": _shuffled_codes,
    "unmapped_codes": lambda c: unmapped_codes(c.conditions, events.condition_map(c.standard)),
    "inpatient_visits": lambda c: _visit_columns(visits.inpatient_visits(c.encounters)),
    "emergency_visits": lambda c: _visit_columns(visits.emergency_visits(c.encounters)),
    "outpatient_visits": lambda c: _visit_columns(visits.outpatient_visits(c.encounters)),
    "all_visits": lambda c: _visit_columns(c.visits),
    "candidate_visits": lambda c: visits.candidate_visits(c.encounters, c.visits),
    "picked_visits": lambda c: visits.pick_visits(visits.candidate_visits(c.encounters, c.visits)),
    "final_visit_ids": lambda c: visits.final_visit_ids(c.encounters, c.visits),
    "encounter_context": lambda c: visits.encounter_context(c.encounters, c.final_ids, c.provider),
    "person": lambda c: c.person,
    "observation_period": lambda c: people.observation_period(c.person, c.encounters),
    "provider": lambda c: c.provider,
    "visit_occurrence": lambda c: c.visit_occurrence,
    "visit_detail": lambda c: visits.visit_detail(c.visit_occurrence),
    "condition_occurrence": lambda c: c.condition_occurrence,
    "observation": lambda c: c.observation,
    "measurement": lambda c: c.measurement,
    "procedure_occurrence": lambda c: c.procedure_occurrence,
    "drug_exposure": lambda c: c.drug_exposure,
    "device_exposure": lambda c: c.device_exposure,
    "death": lambda c: c.death,
    "condition_era": lambda c: eras.condition_era(c.condition_occurrence),
    "drug_era": lambda c: eras.drug_era(c.drug_exposure, c.concept_ancestor, c.concept),
    "cdm_source": lambda c: people.cdm_source(c.vocabulary, DESCRIBE, DAY),
    "payer_plan_period": lambda c: c.payer_plan_period,
    "cost": lambda c: c.cost,
    "not_null_report": lambda c: check_not_null(c.person, CDM["person"]),
    "unique_report": lambda c: check_unique(c.raw("lineitem"), ["l_orderkey", "l_linenumber"]),
    "interval_report": lambda c: interval_problems(c.encounters, "start", "stop"),
    "repeated_deaths": lambda c: repeated_deaths(c.death),
    "quality_report": _quality,
    "exposures_by_concept": _by_concept,
    "read_source": _round_trip,
    "read_rejects": _rejects,
    "read_vocabulary": _vocabulary_text,
    "vocabulary_download": _vocabulary_download,
    "write_cdm": _write_cdm,
    "table_rows": _table_rows,
    "run_etl": _files_to_cost,
}


def bind(query: Callable[[Chart], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(Chart(spark, folder))
