"""Choosing and decoding codes."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def resolve_medication(
    ordered: Column, dispensable: Column, user_selected: Column, placeholder: int
) -> Column:
    """The ordered drug, unless it is the placeholder (or missing)."""
    return F.when(ordered != placeholder, ordered).otherwise(
        F.coalesce(dispensable, user_selected)
    )


def choose_icd(noted: Column, before: Column, after: Column, cutover: date) -> Column:
    """`before` up to the cut-over day, `after` later or when undated."""
    return F.when(noted <= F.lit(cutover), before).otherwise(after)


def decode_value(code: Column, labels: dict[str, object]) -> Column:
    """Label or value of a code; NULL for codes without one."""
    (first, text), *rest = labels.items()
    chain = F.when(code == first, text)
    for key, text in rest:
        chain = chain.when(code == key, text)
    return chain
