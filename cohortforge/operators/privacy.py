"""Replacing patient and encounter identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns that identify a person, never in a private extract.
RAW_IDENTIFIERS = frozenset(
    "pat_id pat_enc_csn_id pat_mrn_id mrn patient_name pat_name pat_last_name pat_first_name "
    "email_address work_phone home_phone add_line_1 add_line_2 hsp_account_id".split()
)


def deidentify(
    df: DataFrame,
    patients: DataFrame,
    links: DataFrame | None = None,
    keep_repeats: bool = False,
) -> DataFrame:
    """Swap pat_id for study_id (inner) and add encounter_num (left).

    The patient table may hold a person twice. Extracts that end in DISTINCT use
    one entry per person; `keep_repeats` joins every row, as plain selects need.
    """
    ids = patients.select("pat_id", "study_id")
    out = df.drop("study_id").join(ids if keep_repeats else ids.distinct(), "pat_id")
    if links is not None:
        numbers = links.select(F.col("encounter_ide").alias("pat_enc_csn_id"), "encounter_num")
        out = out.join(numbers, "pat_enc_csn_id", "left")
    return out


def check_private(df: DataFrame) -> DataFrame:
    """Refuse a frame that still carries a raw identifier."""
    found = RAW_IDENTIFIERS.intersection(c.lower() for c in df.columns)
    if found:
        raise ValueError(f"raw identifiers in extract: {sorted(found)}")
    return df
