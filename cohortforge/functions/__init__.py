from cohortforge.functions.address import incomplete_address
from cohortforge.functions.codes import choose_icd, decode_value, resolve_medication
from cohortforge.functions.dates import (
    age_years,
    as_text_date,
    day_of,
    in_window,
    join_landed,
    month_of,
    months_age,
    slice_of,
    windowed,
)
from cohortforge.functions.results import harmonize_numeric, harmonize_qualitative
from cohortforge.functions.text import blank_to_null, concat_present, has_text, trimmed

__all__ = [
    "age_years",
    "as_text_date",
    "blank_to_null",
    "choose_icd",
    "concat_present",
    "day_of",
    "decode_value",
    "harmonize_numeric",
    "harmonize_qualitative",
    "has_text",
    "in_window",
    "incomplete_address",
    "join_landed",
    "month_of",
    "months_age",
    "resolve_medication",
    "slice_of",
    "trimmed",
    "windowed",
]
