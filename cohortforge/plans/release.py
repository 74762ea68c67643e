"""Files a study hands out and takes back: extracts, review lists, selections, key maps.

Only here are rows sorted: the stages themselves have no order.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortforge.operators import check_private
from cohortforge.plans.extracts import IDENTIFIED
from cohortforge.sources import LAB_SELECTION, MED_SELECTION, Files, from_frames, read_driver, write_csv
from cohortforge.sources.sinks import csv_writer
from cohortforge.study import STAGES, Study

PANEL_REPORTS = ("panel_profile", "panel_age", "panel_geocode")
MANIFEST = "manifest.json"
FILE_ROWS = 1_000_000  # of one file, whose digest a task takes from memory
REVIEW_LISTS = ("med_review_list", "lab_review_list", "order_review_list")

# The order of a file's rows, missing values last.
FILE_ORDER = {
    "panel_profile": ("prov_study_id", "demo_type", "demo_sub_type"),
    "lab_review_list": ("component_name",),
    "extract_providers": ("prov_study_id",),
    "extract_adt": ("study_id", "encounter_num", "time_in"),
    "extract_microbiology": (
        "study_id",
        "order_proc_id",
        "micro_sorting",
        "line",
        "line_comment",
    ),
    "extract_susceptibility": ("study_id", "order_proc_id"),
    "extract_pathology": ("study_id", "order_proc_id", "line", "line_comment"),
    "extract_imaging": ("study_id", "order_proc_id"),
    "extract_narratives": ("study_id", "order_proc_id", "line"),
    "extract_impressions": ("study_id", "order_proc_id", "line"),
    "extract_appointments": ("study_id", "appt_dttm"),
    "extract_patient_coverage": ("study_id", "mem_eff_from_date"),
    "extract_encounter_coverage": ("study_id", "encounter_num", "line"),
}

# key map -> (stage, its key)
KEY_MAPS = {
    "study_id": ("study_id_map", "pat_id"),
    "prov_study_id": ("provider_key", "provider_id"),
    "encounter_id": ("encounter_key", "pat_enc_csn_id"),
    "number": ("person_number", "pat_id"),
}


def extract_names() -> list[str]:
    return [n for n in STAGES if n.startswith("extract_") or n in PANEL_REPORTS]


def in_file_order(df: DataFrame, name: str) -> DataFrame:
    columns = FILE_ORDER.get(name, ())
    return df.orderBy(*(F.asc_nulls_last(c) for c in columns)) if columns else df


def write_list(df: DataFrame, name: str, folder: str) -> str:
    """One CSV folder, in the file's order."""
    write_csv(in_file_order(df, name), f"{folder}/{name}")
    return f"{folder}/{name}"


def export(s: Study, folder: str, names: list[str] | None = None) -> list[str]:
    """Publish extracts as CSV under `folder`; a private one with a raw identifier is refused.

    Files are written aside, in a folder of this release. The manifest, replaced at the end, is what
    publishes them: until then, and after an export that failed, the last release is the one that
    readers find. Extracts that are not named stay as they were published.
    """
    spark = s("cohort").sparkSession
    release = f"{folder}/release-{uuid.uuid4().hex}"
    published = {}
    for name in names or extract_names():
        df = s(name) if name in IDENTIFIED else check_private(s(name))
        counted = Observation()
        ordered = in_file_order(df, name).observe(counted, F.count(F.lit(1)).alias("rows"))
        csv_writer(ordered).option("maxRecordsPerFile", FILE_ROWS).csv(f"{release}/{name}")
        published[name] = {"path": f"{release}/{name}", "rows": counted.get["rows"]}
    for name, entry in published.items():
        entry["files"] = {r["file"]: [r["bytes"], r["digest"]] for r in _digests(spark, entry["path"]).collect()}
    files = Files(spark)
    files.replace(f"{folder}/{MANIFEST}", json.dumps({**manifest(spark, folder), **published}, indent=1))
    return [entry["path"] for entry in published.values()]


def _digests(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, digest) of an extract's files: one row each, hashed by the executors."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("digest"))


def manifest(spark: SparkSession, folder: str) -> dict[str, dict]:
    """What is published in a folder: extract -> its path, rows, and files with size and digest."""
    files = Files(spark)
    path = f"{folder}/{MANIFEST}"
    return json.loads(files.text(path)) if files.exists(path) else {}


def verify(spark: SparkSession, folder: str) -> DataFrame:
    """(extract, rows, files, whole): whether each published extract's files are as the manifest says."""
    expected, found = [], None
    for name, entry in manifest(spark, folder).items():
        expected += [(name, entry["rows"], f, size, digest) for f, (size, digest) in entry["files"].items()]
        expected += [(name, entry["rows"], None, None, None)]
        there = _digests(spark, entry["path"]).withColumn("extract", F.lit(name))
        found = there if found is None else found.unionByName(there)
    stated = spark.createDataFrame(expected, "extract string, rows long, file string, bytes long, digest string")
    if found is None:
        return stated.selectExpr("extract", "rows", "0L as files", "true as whole")
    of_both = stated.alias("m").join(
        found.alias("f"), (F.col("m.extract") == F.col("f.extract")) & (F.col("m.file") == F.col("f.file")), "full_outer"
    )
    same = (F.col("m.bytes") == F.col("f.bytes")) & (F.col("m.digest") == F.col("f.digest"))
    nothing = F.col("m.extract").isNotNull() & F.col("m.file").isNull()  # the extract's own line
    return of_both.groupBy(F.coalesce("m.extract", "f.extract").alias("extract")).agg(
        F.max("m.rows").alias("rows"),
        F.count("m.file").alias("files"),
        F.bool_and(nothing | F.coalesce(same, F.lit(False))).alias("whole"),
    )


def prune(spark: SparkSession, folder: str) -> list[str]:
    """Delete the releases of a folder that its manifest no longer names."""
    files = Files(spark)
    named = {entry["path"].rpartition("/")[0].rpartition("/")[2] for entry in manifest(spark, folder).values()}
    old = [f for f in files.folders(folder) if f.rpartition("/")[2].startswith("release-") and f.rpartition("/")[2] not in named]
    return [f for f in old if files.delete(f)]


def save_keys(s: Study, folder: str) -> None:
    """The study's key maps, for the next release. They identify people: keep them apart."""
    for name, (stage, key) in KEY_MAPS.items():
        s(stage).select(key, name).write.parquet(f"{folder}/{name}")


def load_keys(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Key maps of an earlier release, for `Study(..., keys=...)`."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in KEY_MAPS}


def review(s: Study, folder: str) -> list[str]:
    """Write the lists from which people choose medications, labs and orders."""
    return [write_list(s(name), name, folder) for name in REVIEW_LISTS]


def select(s: Study, spark: SparkSession, medications: str, labs: str) -> Study:
    """The study with the chosen medications and labs of two CSV files.

    Stages that read neither list, themselves or through others, are kept as they are.
    """
    chosen = {
        "med_selection_list": read_driver(spark, medications, MED_SELECTION),
        "lab_selection_list": read_driver(spark, labs, LAB_SELECTION),
    }
    changed = Study(from_frames(chosen, s.sources), s.cfg, s.store, s.keys)
    changed.reuse(s, [name for name in s.built if not chosen.keys() & s.sources_of(name)])
    return changed
