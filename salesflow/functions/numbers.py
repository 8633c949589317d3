"""Numbers out of text and doubles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from salesflow.functions import as_column

# Shapes that count as a number; Spark alone would also read '1d' and '1f'.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

INFINITE = r"(?i)^[+-]?inf(inity)?$"


def round_int(col: Column | str) -> Column:
    """Nearest whole number, halves to even; what does not fit is null."""
    return F.bround(as_column(col), 0).try_cast("bigint")


def coerce_double(col: Column | str) -> Column:
    """Text to double; blank, null and non-numbers are 0."""
    text = as_column(col).cast("string")
    return F.coalesce(F.when(text.rlike(NUMBER), F.trim(text).try_cast("double")), F.lit(0.0))


def coerce_int(col: Column | str) -> Column:
    """Text to whole number, cut toward zero; blank, null and what is no number are 0.

    One rule for every length: text that has the shape of a number, or is an infinity, and
    does not fit 64 bits is an error. A long number keeps all its digits in a wide decimal;
    one too wide for that, or written with a large exponent, is judged as a double, which
    is never below 2**63 in size when the number is not.
    """
    text = F.trim(as_column(col).cast("string"))
    wide = text.try_cast("decimal(38,18)")
    rough = text.try_cast("double")
    refused = F.raise_error(F.concat(F.lit("does not fit a 64-bit whole number: "), text)).cast("bigint")
    small = F.when(F.abs(rough) < 2.0**63, rough.cast("bigint")).otherwise(refused)
    return (
        F.when(text.rlike(NUMBER), F.coalesce(wide.cast("bigint"), small))
        .when(text.rlike(INFINITE), refused)
        .otherwise(F.lit(0).cast("bigint"))
    )


def number_text(col: Column | str) -> Column:
    """A double as text: whole values, as far as 38 digits hold them, without a fraction or an exponent."""
    value = as_column(col)
    whole = value.try_cast("decimal(38,0)")
    return F.when(whole.isNotNull() & (whole.cast("double") == value), whole.cast("string")).otherwise(value.cast("string"))


def percent_off(actual: Column | str, expected: Column | str) -> Column:
    """Difference in percent of the expected figure, whose floor is 1."""
    want = as_column(expected)
    return (as_column(actual) - want) / F.greatest(want, F.lit(1)) * 100
