"""Driver lists: quoted CSV files with a header, loaded with a fixed layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The layouts of the driver files.
DX_CODES = "icd_type int, icd_code string, icd_desc string, dx_flag string"
LAB_RULES = "loinc string, proc_description string, component_name string, step string"
MED_SELECTION = (
    "medication_id long, medication_name string, generic_name string, "
    "pharm_class string, thera_class string, pharm_subclass string"
)
LAB_SELECTION = "proc_id long, description string, component_id long, component_name string"


def read_driver(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Distinct trimmed rows of a driver file; blank cells are NULL.

    The layout's column order rules, as the header's spelling differs by site. A cell may
    hold line breaks. A row that does not fit the layout stops the read.
    """
    df = spark.read.csv(
        path,
        schema=layout,
        header=True,
        enforceSchema=True,
        escape='"',
        multiLine=True,
        mode="FAILFAST",
    )
    trimmed = [
        F.nullif(F.trim(f.name), F.lit("")).alias(f.name)
        if f.dataType.typeName() == "string"
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*trimmed).distinct()
