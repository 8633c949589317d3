"""What a column becomes, by the type it has: day, whole number, text, upper-case text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, FloatType, LongType, StringType, TimestampNTZType, TimestampType

from salesflow.functions import named
from salesflow.functions.dates import parse_date
from salesflow.functions.numbers import number_text, round_int


def as_text(value: Column, have: DataType) -> Column:
    return number_text(value) if isinstance(have, (DoubleType, FloatType)) else value.cast("string")


def as_day(value: Column, have: DataType) -> Column:
    """Text is parsed and a moment cut to its day; numbers and dates stay."""
    if isinstance(have, (TimestampType, TimestampNTZType)):
        return value.cast(DateType())
    return parse_date(value) if isinstance(have, StringType) else value


def as_whole(value: Column, have: DataType) -> Column:
    return value if isinstance(have, LongType) else round_int(value)


def as_upper(value: Column, have: DataType) -> Column:
    return F.upper(as_text(value, have))


def as_is(value: Column, have: DataType) -> Column:
    return value


def column_as(df: DataFrame, name: str, kind=as_is) -> Column:
    """A column of the table in the kind asked for."""
    return kind(named(name), df.schema[name].dataType)


def to_text(df: DataFrame, name: str) -> Column:
    """A column of any type as text; doubles keep all their digits."""
    return column_as(df, name, as_text)
