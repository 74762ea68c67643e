"""Text helpers where an empty string counts as missing."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def trimmed(text: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return blank_to_null(F.trim(text))


def has_text(text: Column) -> Column:
    """True when something is left after trimming."""
    return F.trim(text) != ""


def concat_present(*parts: Column) -> Column:
    """Join the parts that are present; NULL only when all are missing."""
    return blank_to_null(F.concat_ws("", *parts))
