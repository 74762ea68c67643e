"""Declared layouts: rows that do not fit are set aside with their reasons, or stop the job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """A declared column. A value that is not of its type, is too long, or is missing does not fit."""

    name: str
    type: str | None = None  # as it is
    required: bool = False
    longest: int | None = None  # characters of its text


def fitted(field: Field) -> Column:
    """The column in its declared type; NULL where it does not fit."""
    return F.col(field.name).try_cast(field.type) if field.type else F.col(field.name)


def faults(field: Field) -> list[Column]:
    """A reason for each way in which a value does not fit, else NULL."""
    value, found = F.col(field.name), []
    if field.required:
        found.append(F.when(value.isNull(), f"{field.name} is missing"))
    if field.type:
        found.append(F.when(value.isNotNull() & fitted(field).isNull(), f"{field.name} is not {field.type}"))
    if field.longest is not None:
        found.append(F.when(F.length(value.cast("string")) > field.longest, f"{field.name} is longer than {field.longest}"))
    return found


def judged(df: DataFrame, layout: tuple[Field, ...]) -> DataFrame:
    """All rows with `reasons`, which is empty for those that fit; worked out in one pass.

    Columns stay as they came. Store the result once where both parts of it are needed.
    """
    every = [reason for field in layout for reason in faults(field)]
    return df.withColumn("reasons", F.array_compact(F.array(*every).cast("array<string>")))


def accepted(rows: DataFrame, layout: tuple[Field, ...]) -> DataFrame:
    """The rows of `judged` that fit, in the declared columns and types."""
    return rows.where(F.size("reasons") == 0).select(*(fitted(f).alias(f.name) for f in layout))


def rejected(rows: DataFrame) -> DataFrame:
    """The rows of `judged` that do not fit, as they came, with the reasons."""
    return rows.where(F.size("reasons") > 0)


def enforced(df: DataFrame, layout: tuple[Field, ...]) -> DataFrame:
    """The declared columns of `df`; a row that does not fit stops the job."""
    message = F.concat(F.lit("a row does not fit: "), F.array_join("reasons", ", "))
    fits = F.when(F.size("reasons") > 0, F.raise_error(message).cast("boolean")).otherwise(True)
    return judged(df, layout).where(fits).select(*(fitted(f).alias(f.name) for f in layout))
