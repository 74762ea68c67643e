"""Mailing-address completeness."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortforge.functions.text import blank_to_null

# What counts as no address, no city, no zip.
PLACEHOLDERS = (" ", ".", ",", "0", "00", "000", "0000")
STREET_EXACT = ("HOMELESS", "RETURN MAIL", "MAIL RETURNED", "BAD ADDRESS", "NO STREET")
STREET_CONTAINS = ("NO ADDRESS", "NOT KNOWN", "UNKNOWN", "0000")
CITY_EXACT = ("HOMELESS", "RETURN MAIL", "MAIL RETURNED", "BAD ADDRESS")
CITY_CONTAINS = ("NO CITY", "UNKNOWN", "#")
CITY_PATTERN = r"(?i)RETURN.MAIL|MAIL.RETURNED|BAD.ADDRESS|NO.CITY"


def incomplete_address(street: Column, city: Column, zip_code: Column) -> Column:
    """1 when street, city or zip cannot be mailed to, else 0."""
    street, city, zip_code = (blank_to_null(c) for c in (street, city, zip_code))
    up_street, up_city = F.upper(street), F.upper(city)
    reasons = [
        street.isNull() | street.isin(*PLACEHOLDERS),
        up_street.contains("BOX") & up_street.contains("PO"),
        up_street.isin(*STREET_EXACT),
        *(up_street.contains(mark) for mark in STREET_CONTAINS),
        city.isNull() | city.isin(*PLACEHOLDERS),
        up_city.isin(*CITY_EXACT) | city.rlike(CITY_PATTERN),
        *(up_city.contains(mark) for mark in CITY_CONTAINS),
        zip_code.isNull() | (F.length(zip_code) < 5) | zip_code.contains("###"),
    ]
    return F.when(reduce(or_, reasons), 1).otherwise(0)
