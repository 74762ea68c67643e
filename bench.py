"""Time the headline queries; one JSON line on stdout.

One study, run from the test tables to every extract. A stage that later ones read
is written once, within the time of the first query that needs it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from cohortforge import Study
from cohortforge.plans.release import extract_names
from cohortforge.session import configure
from cohortforge.sources import StageStore
from testbed.sources import CONFIG, ViewSources, stage_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "cohort_counts",
    "cohort",
    "patient_table",
    "encounters",
    "diagnosis_fact",
    "procedure_fact",
    "all_medications",
    "all_labs",
    "vitals",
    "latest_social_history",
    "latest_family_history",
    "problem_list_dx",
    "order_procedures",
    "adt_events",
    "encounter_key",
    "providers",
    "panel_profile",
    "panel_age",
    "extract_diagnoses",
    "extract_labs",
    "masked_code_counts",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    sources = ViewSources(spark, SF_DIR)
    run(sources("order_results"))  # warm the session, not the queries

    study = Study(sources, CONFIG, StageStore(spark, stage_folder(spark)))
    times = {}
    for name in (*HEADLINE, *extract_names()):
        if name not in times:
            times[name] = seconds(lambda name=name: run(study(name)))
            print(f"{times[name]:8.2f} {name}", file=sys.stderr)
    study.release()
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
