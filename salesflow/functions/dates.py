"""Dates out of text, serial numbers and timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from salesflow.functions import as_column
from salesflow.functions.text import strip

# Accepted text layouts. Ranges are in the pattern, so that bad text fails cheaply.
_YEAR, _MONTH, _DAY = r"\d{4}", r"(?:0?[1-9]|1[0-2])", r"(?:0?[1-9]|[12]\d|3[01])"
_TIME = r"(?:[01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d"
DAY_FIRST = f"^({_DAY})/({_MONTH})/({_YEAR})$"
ISO_OR_DAY_FIRST = f"^{_YEAR}-{_MONTH}-{_DAY}( {_TIME})?$|{DAY_FIRST}"

# Spreadsheet serial numbers read as dates, and the day that serial 0 stands for.
SERIAL_MIN, SERIAL_MAX = 36526, 60000
SERIAL_ORIGIN = dt.date(1899, 12, 30)


def _text_date(text: Column, shape: str) -> Column:
    # Day-first text is turned round; the cast reads the day in front of a time.
    iso = F.regexp_replace(text, DAY_FIRST, "$3-$2-$1")
    return F.when(text.rlike(shape), iso.try_cast("date"))


def parse_date(col: Column | str) -> Column:
    """Text to date: ``yyyy-MM-dd HH:mm:ss``, ``yyyy-MM-dd`` or ``dd/MM/yyyy``, else null.

    The text is named only twice, since filters on the date are pushed below and copy it.
    """
    return _text_date(as_column(col), ISO_OR_DAY_FIRST)


def repair_date_cell(value: Column | str, is_number: Column) -> Column:
    """Repair a date cell kept as text: a serial number, or day-first text, becomes ISO text.

    ``is_number`` says whether the sheet stored a number. A cell that cannot be repaired
    stays as it was.
    """
    text = as_column(value)
    # One-digit days and months are fine; surrounding blanks of any kind are allowed.
    bare = strip(text)
    serial = F.when(is_number, bare.try_cast("double"))
    from_serial = F.when(
        serial.between(SERIAL_MIN, SERIAL_MAX),
        F.date_add(F.lit(SERIAL_ORIGIN), F.floor(serial).cast("int")),
    )
    from_text = F.when(~is_number, _text_date(bare, DAY_FIRST))
    return F.coalesce(F.coalesce(from_serial, from_text).cast("string"), text)


def date_text(col: Column | str) -> Column:
    """``yyyy-MM-dd``, and the empty text where there is no date."""
    return F.coalesce(as_column(col).cast("date").cast("string"), F.lit(""))


def month_start(col: Column | str) -> Column:
    return F.trunc(as_column(col), "month")


def month_key(col: Column | str) -> Column:
    """``2026-09``."""
    return F.date_format(as_column(col), "yyyy-MM")


def month_label(col: Column | str) -> Column:
    """``2026 09 Sep``."""
    return F.date_format(as_column(col), "yyyy MM MMM")
