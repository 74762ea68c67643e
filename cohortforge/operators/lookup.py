"""Code lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decode(
    df: DataFrame,
    dictionary: DataFrame,
    on: str,
    code: str,
    alias: str,
    value: str = "name",
    default: str | None = None,
) -> DataFrame:
    """Add `alias` = the dictionary's `value` for the code in `on`; misses give `default`."""
    key = f"_{alias}_code"
    names = dictionary.select(F.col(code).alias(key), F.col(value).alias(alias))
    out = df.join(names, F.col(on) == F.col(key), "left").drop(key)
    return out.fillna({alias: default}) if default is not None else out


def code_map(icd9: DataFrame, icd10: DataFrame) -> DataFrame:
    """Both code editions as one map, so facts are joined once, not once per edition."""
    parts = [
        edition.select("dx_id", F.col("code").alias("icd_code"), F.lit(kind).alias("icd_type"))
        for kind, edition in ((9, icd9), (10, icd10))
    ]
    return parts[0].unionByName(parts[1])
