"""Masked counts of listed lab codes over the common data model."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.operators import mask_small
from cohortforge.study import Study, stage


@stage("Masked lab code counts")
def masked_code_counts(s: Study) -> DataFrame:
    """Measurements are counted per id pair first; only the counts meet the names."""
    concepts = s.src("concept").select("concept_id", "concept_code", "concept_name")
    listed = concepts.join(s.src("lab_code_list"), "concept_code", "left_semi").select(
        F.col("concept_id").alias("measurement_concept_id"),
        F.col("concept_code").alias("lab_concept_code"),
        F.col("concept_name").alias("lab_concept_name"),
    )
    wanted = listed.select("measurement_concept_id")
    results = concepts.select(
        F.col("concept_id").alias("value_as_concept_id"),
        F.col("concept_code").alias("result_concept_code"),
        F.col("concept_name").alias("result_concept_name"),
    )
    counted = (
        s.src("measurement")
        .join(wanted, "measurement_concept_id", "left_semi")
        .groupBy("measurement_concept_id", "value_as_concept_id")
        .agg(F.count("*").alias("n"))
    )
    names = [
        "lab_concept_code",
        "lab_concept_name",
        "result_concept_code",
        "result_concept_name",
    ]
    totals = (
        counted.join(listed, "measurement_concept_id")
        .join(results, "value_as_concept_id", "left")
        .groupBy(*names)
        .agg(F.sum("n").alias("lab_count"))
    )
    return mask_small(totals, "lab_count", s.cfg.mask_floor)
