"""Source tables landed once, in partitions that the study window prunes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions.dates import MONTH, SLICE, month_of, slice_of

FILE_ROWS = 5_000_000


def land(df: DataFrame, column: str, path: str, spread: int = 8) -> str:
    """Write a table by the month of a time, or the slice of a numbered day; the new column's name.

    Read with `from_parquet`, such a table is pruned wherever stages ask for their window. Each
    month is written by `spread` tasks, so that one with most of the rows does not wait for one of
    them. Rows without a time are kept in a partition of their own.
    """
    timed = df.schema[column].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
    name = f"{column}{MONTH if timed else SLICE}"
    part = month_of(F.col(column)) if timed else slice_of(F.col(column))
    rows = df.withColumn(name, part)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(spread))
    writer = rows.repartition(F.col(name), salt).write.option("maxRecordsPerFile", FILE_ROWS)
    writer.partitionBy(name).parquet(path)
    return name
