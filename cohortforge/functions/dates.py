"""Study window, ages and text dates."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.config import StudyConfig

TEXT_DATE = "MM/dd/yyyy"


def in_window(ts: Column, cfg: StudyConfig) -> Column:
    """Between the window bounds; the upper bound is that day's midnight.

    Pass `day_of(...)` instead of a timestamp to keep the whole last day.
    """
    return ts.between(F.lit(cfg.window_start), F.lit(cfg.window_end))


MONTH, SLICE = "_month", "_slice"  # what landed tables are partitioned by, after the column's name
SLICE_DAYS = 32


def month_of(ts: Column) -> Column:
    return F.trunc(ts, "month")


def slice_of(day_number: Column) -> Column:
    """The slice of a numbered day, about a month."""
    return F.floor(day_number / SLICE_DAYS).cast("int")


def windowed(df: DataFrame, ts: str, cfg: StudyConfig) -> DataFrame:
    """Rows in the study window; of a table landed by the month of `ts`, only its months are read."""
    rows = df.where(in_window(F.col(ts), cfg))
    if f"{ts}{MONTH}" not in df.columns:
        return rows
    first, last = (date(d.year, d.month, 1) for d in (cfg.window_start, cfg.window_end))
    return rows.where(F.col(f"{ts}{MONTH}").between(F.lit(first), F.lit(last))).drop(f"{ts}{MONTH}")


def join_landed(df: DataFrame, days: DataFrame, number: str) -> DataFrame:
    """Join to chosen days by their number; a table landed in slices is pruned by the days' slices."""
    if f"{number}{SLICE}" not in df.columns:
        return df.join(days, number)
    days = days.withColumn(f"{number}{SLICE}", slice_of(F.col(number)))
    return df.join(days, [number, f"{number}{SLICE}"]).drop(f"{number}{SLICE}")


def day_of(df: DataFrame, name: str) -> Column:
    """The day of a timestamp column, in the column's own type."""
    return F.to_date(df[name]).cast(df.schema[name].dataType)


def months_age(birth: Column, on: Column | date) -> Column:
    """Fractional age in years from calendar months."""
    at = F.lit(on) if isinstance(on, date) else on
    return F.months_between(at, birth, False) / 12


def age_years(birth: Column, on: Column | date) -> Column:
    """Completed years, rounding toward zero."""
    return months_age(birth, on).cast("int")


def as_text_date(ts: Column) -> Column:
    return F.date_format(ts, TEXT_DATE)
