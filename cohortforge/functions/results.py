"""Harmonising free-text laboratory results."""

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortforge.functions.text import trimmed

# The result patterns.
SIGN = r"[><%]=*"
WHOLE_NUMBER = r"[1-9]\d*(\.,\d+)?"  # a decimal part needs the literal ".,"
DECIMAL_NUMBER = r"\d+(\.\d+)?"
TRAILING_NUMBER = r"-?[0-9,.]*\z"
NEGATIVE_WORDS = "(?i)NR|N/R|NEG"
NEGATION, REACTIVITY = "(?i)NO", "(?i)REA[CV][IT]"  # negative together
POSITIVE_WORDS = r"(?i)LY REACTIVE|POSITIVE|\AREACTIVE\z|\A *DETECTED *\z"


class Harmonized(NamedTuple):
    sign: Column
    text: Column
    number: Column


def _number(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("decimal(20,10)")


def harmonize_numeric(text: Column, number: Column, strict_decimals: bool = False) -> Harmonized:
    """Comparison sign, trimmed text (NULL when blank) and best number of a result.

    Times and results with no nonzero digit keep the stored number; `<0.04`
    gives what follows the sign, `28%` the leading whole number (28.5 for
    `28.5%` with `strict_decimals`).
    """
    percent = DECIMAL_NUMBER if strict_decimals else WHOLE_NUMBER
    value = (
        F.when(text.contains(":") | ~text.rlike(WHOLE_NUMBER), number)
        .when(text.rlike("[<>]"), _number(F.regexp_substr(text, F.lit(TRAILING_NUMBER))))
        .when(text.contains("%"), _number(F.regexp_substr(text, F.lit(percent))))
        .otherwise(number)
    )
    return Harmonized(F.regexp_substr(text, F.lit(SIGN)), trimmed(text), value)


def harmonize_qualitative(text: Column) -> Column:
    """0 for a negative wording, 1 for a positive one, NULL otherwise; negative wins."""
    negative = text.rlike(NEGATIVE_WORDS) | (text.rlike(NEGATION) & text.rlike(REACTIVITY))
    return F.when(negative, 0).when(text.rlike(POSITIVE_WORDS), 1)
