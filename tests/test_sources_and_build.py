from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from proxies.registry import DAY, DESCRIBE, VOCABULARY_TABLES, Chart
from tests.conftest import rows
from wardspan import runtime
from wardspan.operators import COPY
from wardspan.plans import etl, quality
from wardspan.schemas import CDM, SOURCE, VOCABULARY
from wardspan.sources import (
    bundle_name,
    cdm_folder,
    empty_cdm,
    read_cdm,
    read_source,
    read_source_lenient,
    read_sources,
    read_vocabulary,
    read_vocabulary_text,
    vocab_tsv_to_parquet,
    write_cdm,
)

SMALL = "/root/testdata/sf0.001"


def test_layouts():
    assert (len(CDM), len(VOCABULARY), len(SOURCE)) == (27, 10, 18)
    kind = {f.name: f.dataType.simpleString() for f in CDM["drug_exposure"].fields}
    assert kind["quantity"] == "decimal(18,3)" and kind["drug_exposure_start_datetime"] == "timestamp_ntz"
    assert VOCABULARY["drug_strength"]["numerator_value"].dataType.simpleString() == "decimal(28,3)"
    assert VOCABULARY["concept"]["concept_class_id"].dataType.simpleString() == "string"


def test_csv_by_name(spark, tmp_path):
    """Upper-case names in another order, an extra and a missing column, times marked as UTC."""
    (tmp_path / "medications.csv").write_text(
        "CODE,START,STOP,PATIENT,EXTRA,BASE_COST,DISPENSES,DESCRIPTION\n"
        '0012345678901234567,2018-12-09T02:58:57Z,,p,x,712.34,51,"a, ""b"""\n'
        "7,2018-12-09 02:58:57.5,2018-12-10,p,,,,\n"
    )
    df = read_source(spark, str(tmp_path), "medications")
    assert df.columns == SOURCE["medications"].fieldNames()
    got = rows(df, "code", "start", "stop", "base_cost", "dispenses", "description", "encounter")
    t = dt.datetime(2018, 12, 9, 2, 58, 57)
    assert got == [
        ("0012345678901234567", t, None, Decimal("712.340"), 51, 'a, "b"', None),
        ("7", t.replace(microsecond=500000), dt.datetime(2018, 12, 10), None, None, None, None),
    ]


def test_counts_that_are_no_whole_numbers_fail(spark, tmp_path):
    (tmp_path / "medications.csv").write_text("CODE,DISPENSES\na,12.0\nb,5\n")
    assert rows(read_source(spark, str(tmp_path), "medications"), "code", "dispenses") == [("a", 12), ("b", 5)]
    (tmp_path / "medications.csv").write_text("CODE,DISPENSES\na,12.7\n")
    with pytest.raises(Exception, match="12.7"):
        read_source(spark, str(tmp_path), "medications").collect()


def test_missing_sources_are_named(spark, tmp_path):
    (tmp_path / "patients.csv").write_text("Id\np\n")
    with pytest.raises(FileNotFoundError, match="encounters, providers"):
        read_sources(spark, str(tmp_path), ["patients", "encounters", "providers"])
    assert read_sources(spark, str(tmp_path), ["patients"])["patients"].count() == 1


def test_vocabulary_text(spark, tmp_path):
    (tmp_path / "CONCEPT.csv").write_text(
        "concept_id\tconcept_name\tconcept_code\tvalid_start_date\tvalid_end_date\tinvalid_reason\n"
        '5\tthe "quoted\t007\t19700101\t20991231\t\n'
    )
    out = read_vocabulary_text(spark, str(tmp_path / "CONCEPT.csv"), "concept")
    got = rows(out, "concept_id", "concept_name", "concept_code", "valid_end_date", "invalid_reason")
    assert got == [(5, 'the "quoted', "007", dt.date(2099, 12, 31), None)]


def test_vocabulary_bundle(spark, tmp_path):
    source, target = tmp_path / "text", tmp_path / "bundle"
    source.mkdir()
    for name in ("CONCEPT", "CONCEPT_ANCESTOR", "CONCEPT_RELATIONSHIP", "RELATIONSHIP", "CONCEPT_SYNONYM", "DOMAIN", "CONCEPT_CLASS"):
        (source / f"{name}.csv").write_text("concept_id\n1\n")
    (source / "VOCABULARY.csv").write_text("vocabulary_id\tvocabulary_version\nNone\tv5.0 22-JUN-22\n")
    (source / "CONCEPT_CPT4.csv").write_text("concept_id\n2\n")
    with pytest.raises(FileNotFoundError, match="drug_strength"):
        vocab_tsv_to_parquet(spark, str(source), str(target))
    (source / "DRUG_STRENGTH.csv").write_text("drug_concept_id\tnumerator_value\n1\t12345678901234567890.5\n")
    done = vocab_tsv_to_parquet(spark, str(source), str(target))
    assert "concept_cpt4" not in done and len(done) == 9
    assert sorted(p.name for p in target.iterdir()) == sorted(f"{t}.parquet" for t in done)
    vocabulary = read_vocabulary(spark, str(target))
    assert set(vocabulary) == set(VOCABULARY)
    assert vocabulary["concept"].count() == 1 and vocabulary["source_to_concept_map"].count() == 0
    assert vocabulary["drug_strength"].first()["numerator_value"] == Decimal("12345678901234567890.500")
    assert bundle_name(vocabulary["vocabulary"]) == "vocabulary_bundle_v5_0-22-JUN-22"


def test_write_needs_permission_to_replace(spark, tmp_path):
    tables = {t: df for t, df in empty_cdm(spark).items() if t in ("person", "note")}
    out = str(tmp_path / "cdm")
    write_cdm(tables, out)
    with pytest.raises(FileExistsError):
        write_cdm(tables, out)
    write_cdm(tables, out, overwrite=True)
    write_cdm(tables, out, layout="tsv", overwrite=True)
    assert read_cdm(spark, out, "person").count() == 0
    assert (tmp_path / "cdm" / "note.tsv").is_dir()
    with pytest.raises(ValueError):
        write_cdm(tables, out, layout="other", overwrite=True)


def test_whole_build_from_files(spark, tmp_path, monkeypatch):
    """CSV sources and a Parquet vocabulary to a finished folder; a second run changes nothing."""
    chart = Chart(spark, SMALL)
    source, bundle, out = (str(tmp_path / n) for n in ("csv", "vocabulary", "cdm"))
    for t in etl.NEEDED:
        getattr(chart, t).drop(COPY).write.option("header", True).csv(f"{source}/{t}.csv")
    for t in VOCABULARY_TABLES:
        getattr(chart, t).write.parquet(f"{bundle}/{t}.parquet")
    results = etl.run_etl(spark, source, bundle, out, DESCRIBE, DAY)
    assert [r.step for r in results] == list(etl.STEPS) and all(r.ok for r in results)
    now = lambda folder: Path(cdm_folder(spark, folder))
    assert {p.name for p in now(out).iterdir()} == {f"{t}.parquet" for t in CDM}
    assert read_cdm(spark, out, "person").count() == 135
    assert read_cdm(spark, out, "note").count() == 0
    first = {t: rows(read_cdm(spark, out, t)) for t in ("visit_occurrence", "cost")}
    assert len(first["cost"]) > 1000
    for t, schema in CDM.items():
        written = spark.read.parquet(f"{now(out)}/{t}.parquet").schema
        assert [(f.name, f.dataType) for f in written] == [(f.name, f.dataType) for f in schema]

    with pytest.raises(FileExistsError):
        etl.run_etl(spark, source, bundle, out, DESCRIBE, DAY)
    some = ["vocabulary_maps", "visit_rollup", "person", "provider", "visit_occurrence"]
    report, text = str(tmp_path / "report"), str(tmp_path / "text")
    scan = quality.check_not_null
    monkeypatch.setattr(quality, "check_not_null", None)  # NULLs are counted while tables are written
    again = etl.run_etl(spark, source, bundle, out, DESCRIBE, DAY, steps=some, overwrite=True, report=report)
    assert all(r.ok for r in again)
    counted = {(r.check_name, r.table_name): r.row_count for r in spark.read.parquet(report).collect()}
    missing = spark.read.parquet(report).filter("check_name = 'missing'")
    for t in some[2:]:
        assert rows(missing.filter(F.col("table_name") == t), "column_name", "row_count") == rows(scan(read_cdm(spark, out, t), CDM[t]))
    missing_before = spark.createDataFrame(missing.collect(), missing.schema)
    assert counted["hidden", "encounters"] > 0 and counted["surplus", "patients"] == 0
    etl.run_etl(spark, source, bundle, text, DESCRIBE, DAY, steps=["person"], layout="tsv")
    built = {"person", *(CDM.keys() - etl.STEPS.keys())}
    assert {p.name for p in now(text).iterdir()} == {f"{t}.tsv" for t in built}
    assert spark.read.option("header", True).option("sep", "\t").csv(f"{now(text)}/person.tsv").count() == 135
    with pytest.raises(ValueError, match="layout"):
        etl.run_etl(spark, source, bundle, text, DESCRIBE, DAY, layout="other", overwrite=True)
    assert rows(read_cdm(spark, out, "visit_occurrence")) == first["visit_occurrence"]

    def fails(build):
        raise RuntimeError("no")

    monkeypatch.setitem(etl.STEPS, "provider", fails)
    current = now(out)
    before = {p: p.stat().st_mtime_ns for p in current.rglob("*.parquet")}
    with pytest.raises(RuntimeError):
        etl.run_etl(spark, source, bundle, out, DESCRIBE, DAY, steps=some, overwrite=True)
    assert now(out) == current
    assert {p: p.stat().st_mtime_ns for p in current.rglob("*.parquet")} == before

    # It goes on where it stopped: at its fourth step, without the three before.
    for done in some[:3]:
        monkeypatch.setitem(etl.STEPS, done, fails)
    monkeypatch.setitem(etl.STEPS, "provider", lambda b: etl.people.provider(b.source["providers"]))
    done = etl.run_etl(spark, source, bundle, out, DESCRIBE, DAY, steps=some, overwrite=True, resume=True, report=report)
    assert rows(spark.read.parquet(report).filter("check_name = 'missing'")) == rows(missing_before)
    assert [r.reused for r in done] == [True, True, True, False, False]
    assert now(out) != current and rows(read_cdm(spark, out, "visit_occurrence")) == first["visit_occurrence"]
    assert {p.name for p in now(out).iterdir()} == {f"{t}.parquet" for t in {*some[2:], *(CDM.keys() - etl.STEPS.keys())}}
    assert {p.name for p in (Path(out) / "builds").iterdir()} == {now(out).name, current.name}
    with pytest.raises(RuntimeError):  # other settings: nothing to go on with
        etl.run_etl(spark, source, bundle, out, {**DESCRIBE, "source_description": "x"}, DAY, steps=some, overwrite=True, resume=True)


def test_bad_rows_are_set_aside(spark, tmp_path):
    """Rows with wrong values or numbers of fields, in two files, and line breaks inside quotes."""
    folder = tmp_path / "medications.csv"
    folder.mkdir()
    head = "START,CODE,DISPENSES,BASE_COST,DESCRIPTION\n"
    (folder / "a.csv").write_text(head + '2020-01-01 10:00:00,c1,5,1.5,"x, ""y"""\nnever,c2,12.7,1.5,z\n2020-01-01,c3\n')
    (folder / "b.csv").write_text(head + "2020-01-02T00:00:00Z,c4,12.0,,\n2020-01-03,c5,1,2,3,4\n,c6,,much,\n")
    kept, rejects = read_source_lenient(spark, str(tmp_path), "medications")
    assert rows(kept, "code", "dispenses") == [("c1", 5), ("c4", 12)]
    got = {(r.file[-5:], r.record, r.reason) for r in rejects.collect()}
    assert got == {
        ("a.csv", "never,c2,12.7,1.5,z", "start,dispenses"),
        ("a.csv", "2020-01-01,c3", "fields"),
        ("b.csv", "2020-01-03,c5,1,2,3,4", "fields"),
        ("b.csv", ",c6,,much,", "base_cost"),
    }
    assert kept.schema == read_source(spark, str(tmp_path), "medications").schema
    (folder / "b.csv").write_text(head + '2020-01-02,c4,1,2,"two\nlines"\n')
    kept, rejects = read_source_lenient(spark, str(tmp_path), "medications", multi_line=True)
    assert rows(kept, "code", "description") == [("c1", 'x, "y"'), ("c4", "two\nlines")] and rejects.count() == 2


def test_downloaded_vocabulary(spark, tmp_path):
    for name in ("CONCEPT", "CONCEPT_ANCESTOR", "CONCEPT_RELATIONSHIP", "VOCABULARY", "CONCEPT_CPT4"):
        (tmp_path / f"{name}.csv").write_text("concept_id\n1\n")
    vocabulary = read_vocabulary(spark, str(tmp_path))
    assert vocabulary["concept"].count() == 1 and vocabulary["domain"].count() == 0


def test_text_that_several_steps_read_is_parsed_once(spark, tmp_path):
    """Before, each step parsed conditions anew, several times over. A row that does not fit still fails
    only the steps that read its column."""
    head = "START,STOP,PATIENT,ENCOUNTER,CODE"
    (tmp_path / "conditions.csv").write_text(f"{head}\n2020-01-01,,p,e,c\n2020-01-01,,p,e,c\n")
    (tmp_path / "claims.csv").write_text("ID\nc1\n")
    texts, made = read_sources(spark, str(tmp_path), ["conditions", "claims"]), []

    def parse(table, name):
        made.append(name)
        return runtime.stage(table, name)

    source = etl.Sources(texts, etl.PARSED_ONCE, parse)
    assert source["claims"] is texts["claims"] and made == []
    scans = [source["conditions"]._jdf.queryExecution().executedPlan().toString() for _ in range(2)]
    assert made == ["conditions"] and all("Scan parquet" in s for s in scans)
    assert rows(source["conditions"]) == rows(texts["conditions"])

    (tmp_path / "conditions.csv").write_text(f"{head}\n2020-01-01,never,p,e,c\n")
    texts = read_sources(spark, str(tmp_path), ["conditions"])
    source = etl.Sources(texts, etl.PARSED_ONCE, parse)
    assert source["conditions"] is texts["conditions"] and source["conditions"] is texts["conditions"]
    assert made == ["conditions"] * 2
    assert rows(source["conditions"], "code") == [("c",)]
    with pytest.raises(Exception, match="never"):
        source["conditions"].select("stop").collect()


def test_failing_steps(spark):
    build = etl.Build(source={}, vocabulary={})
    with pytest.raises(KeyError):
        etl.build_tables(build, lambda n, t: t, ["person"])
    results = etl.build_tables(build, lambda n, t: t, ["person", "provider"], keep_going=True)
    assert [(r.step, r.ok) for r in results] == [("person", False), ("provider", False)]
    with pytest.raises(ValueError):
        etl.build_tables(build, lambda n, t: t, ["nothing"], keep_going=True)


def test_parts_with_another_column_order_fail(spark, tmp_path):
    folder = tmp_path / "conditions.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text("START,STOP,PATIENT,ENCOUNTER,CODE\n2020-01-01,,p1,e1,c1\n")
    (folder / "part-1.csv").write_text("CODE,START,STOP,PATIENT,ENCOUNTER\nc2,2020-01-01,,p1,e1\n")
    with pytest.raises(Exception, match="CSV header|header"):
        read_source(spark, str(tmp_path), "conditions").collect()


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "conditions.csv").write_text('START,PATIENT,CODE,DESCRIPTION\n2020-01-01,p1,c1,"two\nlines"\n')
    (row,) = read_source(spark, str(tmp_path), "conditions", multi_line=True).collect()
    assert (row.patient, row.code, row.description) == ("p1", "c1", "two\nlines")


@pytest.mark.parametrize("gone", ["concept", "concept_relationship", "concept_ancestor", "vocabulary"])
def test_incomplete_vocabulary(spark, tmp_path, gone):
    for table in {"concept", "concept_relationship", "concept_ancestor", "vocabulary"} - {gone}:
        spark.createDataFrame([], VOCABULARY[table]).write.parquet(str(tmp_path / f"{table}.parquet"))
    with pytest.raises(FileNotFoundError, match=gone):
        read_vocabulary(spark, str(tmp_path))


def test_a_step_leaves_nothing_staged(spark, shared_folder, tmp_path):
    """What a step staged is gone when it is done; what it made is not."""
    chart = Chart(spark, "/root/testdata/sf0.001")
    build = etl.Build(source={t: getattr(chart, t) for t in ("patients", "providers")}, vocabulary={})
    staged = lambda: {p for p in Path(shared_folder).rglob("run-*/*")}
    before, during, after = staged(), [], []

    def keep(name, table):
        during.append(staged() - before)
        table.write.parquet(f"{tmp_path}/{name}.parquet")
        return spark.read.parquet(f"{tmp_path}/{name}.parquet")

    etl.build_tables(build, keep, ["person", "provider"], note=lambda s: after.append(staged() - before), clean=True)
    assert all(during) and after == [set(), set()]
    assert build.done["person"].count() == 135 and build.done["provider"].count()


def test_shuffles_go_only_meanwhile(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with runtime.shuffles_removed(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before
