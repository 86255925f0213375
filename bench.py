"""Operators on $BENCH_SF_DIR with $BENCH_CPUS cores, then the whole build step by step.

Everything runs twice in one session; the second pass counts and the first is given as ``cold``.
Operators write to a sink that discards the rows; the build writes its tables. A step's time is its
own: the tables it reads were written by the steps before. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import time

from proxies.registry import DAY, DESCRIBE, QUERIES, VOCABULARY_TABLES, Chart
from wardspan.plans.etl import Build, build_tables
from wardspan.runtime import scratch_root, scratch_run, session
from wardspan.schemas import CDM, SOURCE
from wardspan.sources import write_table

OPERATORS = (
    "merge_intervals_gap0",
    "merge_intervals_gap30",
    "dense_ids",
    "previous_value",
    "highest_before",
    "earliest_cover",
    "containment_join",
    "pick_best",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.codegen.cache.maxEntries": "2000",
        # The test files are small; smaller splits let every core read.
        "spark.sql.files.maxPartitionBytes": "4m",
        "spark.sql.files.openCostInBytes": "1m",
    }
    spark = session("bench", cores, **settings)
    spark.sparkContext.setLogLevel("ERROR")

    def operator(name: str) -> float:
        began = time.perf_counter()
        with scratch_run(spark):
            QUERIES[name](Chart(spark, folder)).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    def build() -> dict[str, float]:
        chart = Chart(spark, folder)
        inputs = Build(
            source={t: getattr(chart, t) for t in SOURCE if hasattr(chart, t)},
            vocabulary={t: getattr(chart, t) for t in VOCABULARY_TABLES},
            describe=DESCRIBE,
            day=DAY,
        )
        with scratch_run(spark):
            out = f"{scratch_root(spark)}/out"

            def keep(name, table):
                write_table(table, out, name)
                return spark.read.schema(CDM[name]).parquet(f"{out}/{name}.parquet")

            return {f"build_{r.step}": round(r.seconds, 3) for r in build_tables(inputs, keep)}

    def everything() -> dict[str, float]:
        return {name: operator(name) for name in OPERATORS} | build()

    cold, warm = everything(), everything()
    line = {
        "metric": "operators and whole build, second pass",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": os.path.basename(folder.rstrip("/")),
        "cores": cores,
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
