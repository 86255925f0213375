"""The whole build: source and vocabulary tables in, finished CDM tables out."""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable, Container, Iterable
from contextlib import nullcontext
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from wardspan.operators import COPY, empty_table, source_to_source, source_to_standard, tag_copies
from wardspan.operators.checks import observe_not_null
from wardspan.plans import cost as costs
from wardspan.plans import eras, events, people, visits
from wardspan.plans.codes import CLASSES, VisitClasses
from wardspan.plans.quality import hidden_report, quality_report
from wardspan.runtime import real_sizes, remove_folder, scratch_run, shuffles_removed, stage, written
from wardspan.schemas import CDM
from wardspan.sources.tables import (
    BUILDS,
    LAYOUTS,
    check_free,
    check_sources,
    commit_build,
    fingerprint,
    is_text,
    list_files,
    read_cdm,
    read_source_lenient,
    read_sources,
    read_text,
    read_vocabulary,
    write_table,
    write_text,
)

DONE = "done"  # the notes of an unfinished build

# Source tables that the steps read; the other four of the export may be present or not.
NEEDED = (
    "allergies",
    "claims",
    "claims_transactions",
    "conditions",
    "devices",
    "encounters",
    "immunizations",
    "medications",
    "observations",
    "patients",
    "payer_transitions",
    "payers",
    "procedures",
    "providers",
)
# Their rows become numbered rows one by one. Tagged at the scan, so that identical ones are spread;
# filters on the others reach the files.
TAGGED = (
    "allergies",
    "conditions",
    "devices",
    "immunizations",
    "medications",
    "observations",
    "patients",
    "payer_transitions",
    "procedures",
    "providers",
)
# Several steps read these, and count, sample and scan them: text is parsed once for all.
PARSED_ONCE = ("conditions", "encounters", "observations", "procedures")


class Sources(dict):
    """Source tables by name. Those of ``texts`` are replaced by what ``parse`` makes of them when they are
    first asked for. One with a row that does not fit is left as text, so that only the steps fail that
    read its column."""

    def __init__(self, tables: dict[str, DataFrame], texts: Iterable[str], parse: Callable[[DataFrame, str], DataFrame]):
        super().__init__(tables)
        self._texts, self._parse = set(texts) & tables.keys(), parse

    def __getitem__(self, table: str) -> DataFrame:
        if table in self._texts:
            self._texts.remove(table)
            try:
                self[table] = self._parse(super().__getitem__(table), table)
            except Exception:  # noqa: BLE001 - the step that reads the row tells
                pass
        return super().__getitem__(table)


@dataclass
class Build:
    """Everything the steps share: inputs, work tables and the finished tables so far."""

    source: dict[str, DataFrame]
    vocabulary: dict[str, DataFrame]
    describe: dict[str, str] = field(default_factory=dict)
    day: dt.date | None = None
    classes: VisitClasses = CLASSES
    work: dict[str, DataFrame] = field(default_factory=dict)
    done: dict[str, DataFrame] = field(default_factory=dict)
    nulls: dict[str, dict[str, int]] = field(default_factory=dict)  # by finished table and column
    hold: Callable[[DataFrame, str], DataFrame] = stage  # stores a work table


@dataclass(frozen=True)
class StepResult:
    step: str
    ok: bool
    seconds: float
    error: str | None = None
    reused: bool = False  # from a build that did not finish


def _maps(b: Build) -> None:
    v = b.vocabulary
    concept, custom = v["concept"], v["source_to_concept_map"]
    standard = source_to_standard(concept, v["concept_relationship"], custom)
    b.work["standard"] = b.hold(standard, "standard")
    b.work["own"] = b.hold(source_to_source(concept, custom), "own")


def _visits(b: Build) -> None:
    encounters = b.source["encounters"]
    b.work["visits"] = b.hold(visits.roll_up(encounters, b.classes), "visits")
    final_ids = visits.final_visit_ids(encounters, b.work["visits"], b.classes)
    b.work["final_ids"] = b.hold(final_ids, "final_ids")


def _context(b: Build) -> None:
    context = visits.encounter_context(
        b.source["encounters"], b.work["final_ids"], b.done["provider"]
    )
    b.work["context"] = b.hold(context, "context")


def _event_inputs(b: Build) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return b.work["standard"], b.work["own"], b.done["person"], b.work["context"]


def _cost(b: Build) -> DataFrame:
    s, d = b.source, b.done
    return costs.cost(
        s["procedures"],
        s["immunizations"],
        s["medications"],
        s["conditions"],
        s["claims"],
        s["claims_transactions"],
        s["encounters"],
        d["person"],
        d["visit_occurrence"],
        d["procedure_occurrence"],
        d["drug_exposure"],
        d["condition_occurrence"],
        d["payer_plan_period"],
    )


# What steps that return no table leave behind.
WORK = {"vocabulary_maps": ("standard", "own"), "visit_rollup": ("visits", "final_ids"), "encounter_context": ("context",)}

# In order of need. A step returns its finished table, or fills ``work`` and returns nothing.
STEPS: dict[str, Callable[[Build], DataFrame | None]] = {
    "vocabulary_maps": _maps,
    "visit_rollup": _visits,
    "person": lambda b: people.person(b.source["patients"]),
    "observation_period": lambda b: people.observation_period(
        b.done["person"], b.source["encounters"]
    ),
    "provider": lambda b: people.provider(b.source["providers"]),
    "encounter_context": _context,
    "visit_occurrence": lambda b: visits.visit_occurrence(
        b.work["visits"], b.done["person"], b.done["provider"], b.work["final_ids"]
    ),
    "visit_detail": lambda b: visits.visit_detail(b.done["visit_occurrence"]),
    "condition_occurrence": lambda b: events.condition_occurrence(
        b.source["conditions"], b.work["standard"], b.done["person"], b.work["context"]
    ),
    "observation": lambda b: events.observation(
        b.source["allergies"], b.source["conditions"], b.source["observations"], *_event_inputs(b)
    ),
    "measurement": lambda b: events.measurement(
        b.source["procedures"], b.source["observations"], *_event_inputs(b)
    ),
    "procedure_occurrence": lambda b: events.procedure_occurrence(
        b.source["procedures"], *_event_inputs(b)
    ),
    "drug_exposure": lambda b: events.drug_exposure(
        b.source["medications"], b.source["immunizations"], *_event_inputs(b)
    ),
    "condition_era": lambda b: eras.condition_era(b.done["condition_occurrence"]),
    "drug_era": lambda b: eras.drug_era(
        b.done["drug_exposure"], b.vocabulary["concept_ancestor"], b.vocabulary["concept"]
    ),
    "cdm_source": lambda b: people.cdm_source(b.vocabulary["vocabulary"], b.describe, b.day),
    "device_exposure": lambda b: events.device_exposure(b.source["devices"], *_event_inputs(b)),
    "death": lambda b: people.death(
        b.source["encounters"], b.work["standard"], b.done["person"]
    ),
    "payer_plan_period": lambda b: costs.payer_plan_period(
        b.source["payers"], b.source["payer_transitions"], b.done["person"]
    ),
    "cost": _cost,
}


def build_tables(
    build: Build,
    keep: Callable[[str, DataFrame], DataFrame],
    steps: Iterable[str] = tuple(STEPS),
    keep_going: bool = False,
    finished: Container[str] = (),
    note: Callable[[str], None] = lambda step: None,
    clean: bool = False,
) -> list[StepResult]:
    """Run the steps in order. ``keep`` stores a finished table and gives the stored one back.

    A failing step ends the build, or with ``keep_going`` is recorded and the later steps still run.
    Steps in ``finished`` are not run: what they made is in ``build`` already. ``note`` is told of
    each step that is done. With ``clean`` what a step stages is removed when the step is done, so
    ``keep`` and the build's ``hold`` must store outside the scratch area.
    """
    results = []
    for name in steps:
        if name not in STEPS:
            raise ValueError(f"unknown step {name!r}; known: {', '.join(STEPS)}")
        began = time.monotonic()
        if name in finished:
            results.append(StepResult(name, True, 0.0, reused=True))
            continue
        try:
            with scratch_run(next(iter(build.source.values())).sparkSession) if clean else nullcontext():
                table = STEPS[name](build)
                if table is not None:
                    build.done[name] = keep(name, table)
            note(name)
            results.append(StepResult(name, True, time.monotonic() - began))
        except Exception as problem:  # noqa: BLE001 - a step may fail in any way
            if not keep_going:
                raise
            first_line = (str(problem) or repr(problem)).splitlines()[0]
            results.append(StepResult(name, False, time.monotonic() - began, first_line))
    return results


def run_etl(
    spark: SparkSession,
    source_dir: str,
    vocabulary_dir: str,
    out: str,
    describe: dict[str, str],
    day: dt.date | None = None,
    steps: Iterable[str] = tuple(STEPS),
    keep_going: bool = False,
    classes: VisitClasses = CLASSES,
    overwrite: bool = False,
    layout: str = "parquet",
    report: str | None = None,
    multi_line: bool = False,
    bad_rows: str = "fail",
    resume: bool = False,
) -> list[StepResult]:
    """Build every CDM table from files and write it to ``out``, as Parquet or, with ``layout``
    "tsv", as tab-separated text. With ``report`` the quality report of sources and tables is
    written to that folder as Parquet, in place of an older one; its counts of NULLs are taken while
    tables are written.

    Each table is written once and read back by the steps that need it, so a lost executor costs
    only its tasks. CSV that several steps read is parsed once, into a work table. Tables that no step fills are written empty. What a step stages and shuffles goes
    when it is done, so the disk holds the tables and the work of one step.

    Tables go to ``out/builds/<build>``; when all is written, the file ``out/CURRENT`` is replaced by
    one that names the build, which ``cdm_folder`` and ``read_cdm`` follow. So readers see the tables
    of one build, never of two: with ``steps`` or ``keep_going`` those not built are not there. A
    build that fails leaves the current one as it is; ``resume`` goes on with it, if inputs, their
    files' times and all settings are the same, and does not run the steps that were done. The build
    before stays until the next. A folder that has a build is only given a new one with ``overwrite``.

    ``multi_line`` allows line breaks inside quotes in CSV. With ``bad_rows`` "reject" rows that do not
    fit are left out and kept, with file and reason, in the table ``rejects.parquet`` of the build.
    """
    steps = tuple(steps)
    if not overwrite:
        check_free(spark, out, but=BUILDS)
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}: {' or '.join(LAYOUTS)}")
    if bad_rows not in ("fail", "reject"):
        raise ValueError(f"bad_rows: fail or reject, not {bad_rows!r}")
    names = check_sources(spark, source_dir, NEEDED)
    inputs = fingerprint(spark, (source_dir, vocabulary_dir), steps, describe, day, classes, layout, multi_line, bad_rows)
    name = f"{inputs[:16]}-{uuid.uuid4().hex[:8]}"
    if resume:
        name = max((n for n in _unfinished(spark, out) if n.startswith(inputs[:16])), default=name)
    building = f"{out.rstrip('/')}/{BUILDS}/{name}"
    if bad_rows == "reject":
        read = {t: read_source_lenient(spark, source_dir, t, multi_line) for t in names}
        source = {t: rows for t, (rows, _) in read.items()}
        rejects = reduce(DataFrame.unionByName, [bad for _, bad in read.values()])
        rejects.write.mode("overwrite").parquet(f"{building}/rejects.parquet")
    else:
        source = read_sources(spark, source_dir, names, multi_line)

    def hold(table: DataFrame, label: str) -> DataFrame:
        written(table).mode("overwrite").parquet(f"{building}/work/{label}.parquet")
        return spark.read.parquet(f"{building}/work/{label}.parquet")

    def tagged(table: DataFrame, name: str) -> DataFrame:
        return tag_copies(table) if name in TAGGED else table

    texts = [t for t in PARSED_ONCE if is_text(spark, source_dir, t)]
    build = Build(
        source=Sources(
            {t: tagged(df, t) for t, df in source.items()},
            texts,
            lambda table, name: tagged(hold(table.drop(COPY), f"source-{name}"), name),
        ),
        vocabulary=read_vocabulary(spark, vocabulary_dir),
        describe=describe,
        day=day,
        classes=classes,
        hold=hold,
    )
    finished = _done_before(spark, building, build) if resume else []

    def keep(name: str, table: DataFrame) -> DataFrame:
        counted, seen = observe_not_null(table, CDM[name])
        write_table(counted, building, name)
        build.nulls[name] = seen.get if counted is not table else {}
        return read_cdm(spark, building, name)

    def note(step: str) -> None:
        write_text(spark, f"{building}/{DONE}/{step}", json.dumps(build.nulls.get(step, {})))

    with scratch_run(spark), shuffles_removed(spark), real_sizes(spark):
        for empty in CDM.keys() - STEPS.keys():
            write_table(empty_table(spark, CDM[empty]), building, empty)
        results = build_tables(build, keep, steps, keep_going, finished, note, clean=True)
        checked = None
        if report and "standard" in build.work:
            checked = quality_report(source, build.work["standard"], build.done, build.nulls)
            checked = stage(checked.unionByName(hidden_report(source["encounters"], classes)), "report")
        if layout != "parquet":
            for table in [*build.done, *(CDM.keys() - STEPS.keys())]:
                write_table(read_cdm(spark, building, table), building, table, layout)
                remove_folder(spark, f"{building}/{table}.parquet")
        remove_folder(spark, f"{building}/work")
        remove_folder(spark, f"{building}/{DONE}")
        commit_build(spark, out.rstrip("/"), name)
        if checked is not None:
            checked.write.mode("overwrite").parquet(report)
    return results


def _unfinished(spark: SparkSession, out: str) -> list[str]:
    """Names of the builds that still have notes of their steps."""
    try:
        builds = list_files(spark, f"{out.rstrip('/')}/{BUILDS}")
    except FileNotFoundError:
        return []
    return [name for name, path in builds.items() if DONE in list_files(spark, path)]


def _done_before(spark: SparkSession, building: str, build: Build) -> list[str]:
    """Steps that an unfinished build has done; their tables are put into ``build``."""
    try:
        steps = [s for s in list_files(spark, f"{building}/{DONE}") if s in STEPS]
    except FileNotFoundError:
        return []
    for step in steps:
        for label in WORK.get(step, ()):
            build.work[label] = spark.read.parquet(f"{building}/work/{label}.parquet")
        if step not in WORK:
            build.done[step] = read_cdm(spark, building, step)
            build.nulls[step] = json.loads(read_text(spark, f"{building}/{DONE}/{step}"))
    return steps
