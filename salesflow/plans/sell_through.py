"""Sell-through: many hand-kept regional sheets become one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesflow.functions import named
from salesflow.functions.dates import date_text, parse_date, repair_date_cell
from salesflow.functions.numbers import coerce_double
from salesflow.functions.text import clean_text
from salesflow.sources.files import REGIONAL_NAME, select_files
from salesflow.sources.grid import number_mark, stack_sheets, visible_sheets

TOTAL_NAMES = ("total", "quantity")


def compile_sheets(grid: DataFrame, blank_as_text: bool = False) -> DataFrame:
    """Visible sheets of the numbered workbooks as one cleaned table.

    Columns are matched by stripped header. Dates kept as serial numbers or day-first text
    are repaired and end as ``yyyy-MM-dd`` or the empty text; the first total or quantity
    column becomes a number, 0 where it is none; every other cell is text without line
    breaks. ``blank_as_text`` writes missing texts as ``nan``.
    """
    rows, names = stack_sheets(visible_sheets(select_files(grid, "source_file", include=REGIONAL_NAME)))
    # Each step names its input several times, so the steps stay apart as columns.
    if "Date" in names:
        repaired = clean_text(repair_date_cell("Date", named(number_mark("Date"))))
        # A stored date-time cell is ISO with a T.
        rows = rows.withColumn("Date", F.replace(repaired, F.lit("T"), F.lit(" ")))
    total = next((n for n in names if n.lower() in TOTAL_NAMES), None)
    cols = []
    for name in names:
        text = clean_text(name)
        if name == "Date":
            text = date_text(parse_date(name))
        elif name == total:
            text = coerce_double(text)
        elif blank_as_text:
            text = F.coalesce(text, F.lit("nan"))
        cols.append(text.alias(name))
    return rows.select(*cols)
