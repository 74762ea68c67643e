from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortforge import functions as C
from testbed.sources import CONFIG

STORED = Decimal("9999999")

# result, sign, number (None = the stored number), flag
RESULTS = [
    ("<0.04", "<", "0.04", None),
    ("28%", "%", "28", None),
    ("28.5%", "%", "28", None),
    (">10,000", ">", "10000", None),
    (">=100", ">=", "100", None),
    ("12-19-08 6:45AM", None, STORED, None),
    ("NEGATIVE", None, STORED, 0),
    ("0", None, STORED, None),
    ("NON-REACTIVE", None, STORED, 0),
    ("non reactive", None, STORED, 0),
    ("NR", None, STORED, 0),
    ("REACTIVE", None, STORED, 1),
    ("weakly reactive", None, STORED, 1),
    ("POSITIVE", None, STORED, 1),
    (" detected ", None, STORED, 1),
    ("NOT DETECTED", None, STORED, None),
    ("< 20 copies", "<", None, None),
]


def test_results(spark):
    df = spark.createDataFrame([(r[0], STORED) for r in RESULTS], "t string, n decimal(20,10)")
    harm = C.harmonize_numeric(F.col("t"), F.col("n"))
    rows = df.select(
        "t", harm.sign, harm.text, harm.number, C.harmonize_qualitative(F.col("t"))
    ).collect()
    got = {r[0]: tuple(r)[1:] for r in rows}
    for text, sign, number, flag in RESULTS:
        expected = None if number is None else Decimal(number)
        assert got[text] == (sign, text.strip(), expected, flag), text


def test_strict_decimals(spark):
    df = spark.createDataFrame([("28.5%", STORED)], "t string, n decimal(20,10)")
    strict = C.harmonize_numeric(F.col("t"), F.col("n"), strict_decimals=True)
    assert df.select(strict.number).first()[0] == Decimal("28.5")


@pytest.mark.parametrize(
    "street, city, zip_code, expected",
    [
        ("1 Main St", "Town", "90001", 0),
        (None, "Town", "90001", 1),
        ("", "Town", "90001", 1),
        ("po box 7", "Town", "90001", 1),
        ("Box 7", "Town", "90001", 0),
        ("no street", "Town", "90001", 1),
        ("no street 1", "Town", "90001", 0),
        ("1 Main St", "Return-Mail", "90001", 1),
        ("1 Main St", "Town#", "90001", 1),
        ("1 Main St", None, "90001", 1),
        ("1 Main St", "Town", "9000", 1),
        ("1 Main St", "Town", None, 1),
        ("1 Main St", "Town", "###01", 1),
        ("homeless", "Town", "90001", 1),
    ],
)
def test_address(spark, street, city, zip_code, expected):
    df = spark.createDataFrame([(street, city, zip_code)], "a string, c string, z string")
    assert df.select(C.incomplete_address(F.col("a"), F.col("c"), F.col("z"))).first()[0] == expected


def test_window_bounds(spark):
    times = [datetime(2000, 2, 28), datetime(2000, 2, 28, 10), datetime(1996, 3, 2), None]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    rows = df.select(
        C.in_window(F.col("ts"), CONFIG), C.in_window(C.day_of(df, "ts"), CONFIG)
    ).collect()
    assert [tuple(r) for r in rows] == [(True, True), (False, True), (True, True), (None, None)]


def test_dates_and_codes(spark):
    df = spark.createDataFrame(
        [(date(2000, 2, 29), 800001, 5, 6, None, "T")],
        "birth date, med long, disp long, sel long, a string, b string",
    )
    med = C.resolve_medication(F.col("med"), F.col("disp"), F.col("sel"), 800001)
    missing = C.resolve_medication(F.lit(None), F.lit(None), F.col("sel"), 800001)
    row = df.select(
        C.age_years(F.col("birth"), date(2018, 2, 28)),
        C.age_years(F.col("birth"), date(2018, 3, 1)),
        med,
        missing,
        C.concat_present(F.col("a"), F.col("b")),
        C.concat_present(F.col("a"), F.col("a")),
        C.as_text_date(F.col("birth")),
        C.choose_icd(F.lit(None).cast("date"), F.lit(9), F.lit(10), date(2015, 1, 1)),
        C.choose_icd(F.lit(date(2015, 1, 1)), F.lit(9), F.lit(10), date(2015, 1, 1)),
        C.decode_value(F.col("b"), {"T": "Tee"}),
        C.decode_value(F.col("a"), {"T": "Tee"}),
    ).first()
    # both days end their month, so the month count is whole
    assert tuple(row) == (18, 18, 5, 6, "T", None, "02/29/2000", 10, 9, "Tee", None)
