import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesflow.functions.dates import date_text, month_label, parse_date, repair_date_cell
from salesflow.functions.kinds import as_day, as_upper, column_as
from salesflow.functions.numbers import coerce_double, coerce_int, number_text, percent_off, round_int
from salesflow.functions.text import (
    blank_to, cell_text, clean_text, last_part, na_to_null, remove_text, replace_first, strip, suffix_after,
)
from salesflow.plans.marketplace import sales_type


def apply(spark, kind, make, values):
    """The values through one column expression, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row[0] for row in df.orderBy("i").select(make("x")).collect()]


def test_parse_date_takes_three_layouts_and_nothing_else(spark):
    texts = [
        "2026-09-01 10:11:12", "2026-09-01", "13/10/2026", "3/1/2026", "99/99/2026", "2026-02-30", "2026-01-02 10:11",
        "1/2/26", "2026-001-01", "", "x", None, "2026-01-02 25:00:00", "29/2/2024", "29/2/2023", "2026-1-2 3:4:5",
    ]
    d = dt.date
    assert apply(spark, "string", parse_date, texts) == [
        d(2026, 9, 1), d(2026, 9, 1), d(2026, 10, 13), d(2026, 1, 3), None, None, None, None, None, None, None, None,
        None, d(2024, 2, 29), None, d(2026, 1, 2),
    ]


def test_dates_in_by_column_type(spark):
    df = spark.sql("SELECT '2026-01-02' AS a, timestamp_ntz'2026-01-02 23:59:59' AS b, 5 AS c, date'2026-01-02' AS d")
    row = df.select(*[column_as(df, c, as_day).alias(c) for c in df.columns]).first()
    assert tuple(row) == (dt.date(2026, 1, 2), dt.date(2026, 1, 2), 5, dt.date(2026, 1, 2))


def test_repair_date_cell(spark):
    texts = ["45597", " 45597.75 ", "36525", "60001", "13/10/2026", " 3/1/2026\n", "99/99/2026", "n/a", None]
    as_number = apply(spark, "string", lambda c: repair_date_cell(c, F.lit(True)), texts)
    as_text = apply(spark, "string", lambda c: repair_date_cell(c, F.lit(False)), texts)
    assert as_number[:4] == ["2024-11-01", "2024-11-01", "36525", "60001"]
    assert as_text == ["45597", " 45597.75 ", "36525", "60001", "2026-10-13", "2026-01-03", "99/99/2026", "n/a", None]


def test_round_int_halves_to_even(spark):
    values = [0.5, 1.5, 2.5, -0.5, -1.5, float("nan"), float("inf"), None]
    assert apply(spark, "double", round_int, values) == [0, 2, 2, 0, -2, None, None, None]


def test_coerce_int_cuts_toward_zero_and_defaults_to_zero(spark):
    texts = ["12.7", "-3.9", "1d", "1f", "", " ", None, " 5 ", "+7", "1e3", ".5", "5.", "NaN", "1,000", "12345678901234567"]
    assert apply(spark, "string", coerce_int, texts) == [12, -3, 0, 0, 0, 0, 0, 5, 7, 1000, 0, 5, 0, 0, 12345678901234567]


@pytest.mark.parametrize("text", ["9223372036854775808", "10000000000000000000", "100000000000000000000", "1e25", "-1e19", "inf", "-Infinity", "1e400"])
def test_coerce_int_refuses_what_does_not_fit(spark, text):
    with pytest.raises(Exception, match="fit|OVERFLOW|overflow"):
        apply(spark, "string", coerce_int, [text])


def test_coerce_int_at_the_limits(spark):
    texts = ["9223372036854775807", "-9223372036854775808", "1e18", "-1.5e2", "+7.9", "1e-30", "nan", "infinite", "0" * 40 + "12"]
    assert apply(spark, "string", coerce_int, texts) == [2**63 - 1, -(2**63), 10**18, -150, 7, 0, 0, 0, 12]


def test_coerce_int_refuses_to_wrap_around(spark):
    with pytest.raises(Exception, match="OVERFLOW"):
        apply(spark, "string", coerce_int, ["99999999999999999999"])


def test_coerce_double(spark):
    assert apply(spark, "string", coerce_double, ["1.25", "1d", None, " -2 ", "x"]) == [1.25, 0.0, 0.0, -2.0, 0.0]


def test_number_text_keeps_digits(spark):
    assert apply(spark, "double", number_text, [1.23456789e9, 0.25, -0.0, 1e15, None]) == [
        "1234567890", "0.25", "0", "1000000000000000", None,
    ]


def test_suffix_and_last_part_rules_differ(spark):
    names = ["X_SHOP", "X_Y_SHOP", "SHOP", "X_NEXUS_NEXUS", "_", "", None]
    assert apply(spark, "string", suffix_after, names) == ["SHOP", "Y_SHOP", "", "NEXUS_NEXUS", "", "", ""]
    assert apply(spark, "string", last_part, names) == ["SHOP", "SHOP", "SHOP", "NEXUS", "", "", None]
    assert apply(spark, "string", sales_type, names)[3] == "ENDORSE_ENDORSE"
    first_only = apply(spark, "string", lambda c: replace_first(c, "NEXUS", "ENDORSE"), names)
    assert first_only == ["X_SHOP", "X_Y_SHOP", "SHOP", "X_ENDORSE_NEXUS", "_", "", None]


def test_text_cleaning(spark):
    assert apply(spark, "string", strip, ["\t a b \n", " x　", "", None]) == ["a b", "x", "", None]
    assert apply(spark, "string", clean_text, ["a\r\n\nb ", "\n", "c d"]) == ["a b", "", "c d"]
    assert apply(spark, "string", lambda c: blank_to(c, "-"), [None, " \t", " 1 ", "x"]) == ["-", "-", " 1 ", "x"]
    assert apply(spark, "string", na_to_null, ["NA", "na", "", "None", None, "x"]) == [None, "na", None, None, None, "x"]
    assert apply(spark, "string", lambda c: remove_text(c, " (ID)"), ["A (ID) (ID)", "(ID)", None]) == ["A", "(ID)", None]


def test_cell_text(spark):
    cells = [("5.0", "float"), ("5.25", "float"), ("1e+16", "float"), ("7", "int"), ("true", "bool"), ("", "text"),
             ("x", "text"), ("2026-01-02", "date"), ("2026-01-02 03:04:05", "datetime"), ("z", "empty")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cells)], "i int, v string, k string")
    got = [r[0] for r in df.orderBy("i").select(cell_text("v", "k")).collect()]
    assert got == ["5", "5.25", "10000000000000000", "7", "TRUE", None, "x", "2026-01-02", "2026-01-02T03:04:05", None]


def test_upper_keeps_null_and_long_numbers(spark):
    df = spark.sql("SELECT 'aé' AS a, cast(null AS string) AS b, 1234567890123D AS c")
    assert tuple(df.select(*[column_as(df, c, as_upper).alias(c) for c in df.columns]).first()) == ("AÉ", None, "1234567890123")


def test_labels_and_percent(spark):
    day = [dt.date(2026, 9, 30), None]
    assert apply(spark, "date", month_label, day) == ["2026 09 Sep", None]
    assert apply(spark, "date", date_text, day) == ["2026-09-30", ""]
    assert spark.range(1).select(percent_off(F.lit(5), F.lit(0))).first()[0] == 500.0
