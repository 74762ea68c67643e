"""Review lists, selections made from them, and tagged unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def review_list(df: DataFrame, cols: list[str], out: str = "total") -> DataFrame:
    """Rows per combination of `cols`, for people to choose from."""
    return df.groupBy(*cols).agg(F.count("*").alias(out))


def apply_selection(df: DataFrame, driver: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys were chosen; repeats in the driver do not multiply rows."""
    return df.join(driver.select(*keys), keys, "left_semi")


def tagged_union(parts: list[tuple[int, DataFrame]], tag: str) -> DataFrame:
    """Distinct union of the parts, each under its tag."""
    tagged = [df.select(F.lit(mark).alias(tag), "*") for mark, df in parts]
    return reduce(DataFrame.unionByName, tagged).distinct()
