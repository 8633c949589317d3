"""Text cleaning and null handling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from salesflow.functions import as_column
from salesflow.functions.numbers import number_text

# Texts that mean "missing" in a delimited file; a fixed list.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Every character that counts as blank: the ASCII ones, next line, no-break and wide spaces.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    chr(c) for c in [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def strip(col: Column | str) -> Column:
    """Cut blanks of any kind (tabs and line breaks too) from both ends."""
    return F.btrim(as_column(col), F.lit(BLANKS))


def clean_text(col: Column | str) -> Column:
    """Runs of line breaks become one space, then both ends are stripped."""
    return strip(F.regexp_replace(as_column(col), r"[\n\r]+", " "))


def na_to_null(col: Column | str, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Texts that mean "missing" become null."""
    value = as_column(col)
    return F.when(~value.isin(list(tokens)), value)


def blank_to(col: Column | str, default: str) -> Column:
    """Null and blank become the default; other texts stay untouched, padding included."""
    value = as_column(col)
    return F.when(value.isNull() | (strip(value) == ""), F.lit(default)).otherwise(value)


def remove_text(col: Column | str, part: str, by: str = "") -> Column:
    """Replace every occurrence of a literal."""
    return F.replace(as_column(col), F.lit(part), F.lit(by))


def suffix_after(col: Column | str, sep: str = "_") -> Column:
    """All after the first separator; the empty text where there is none or no value."""
    value = as_column(col)
    at = F.instr(value, sep)
    tail = F.substring(value, at + F.lit(len(sep)), F.length(value))
    return F.when(at > 0, tail).otherwise(F.lit(""))


def last_part(col: Column | str, sep: str = "_") -> Column:
    """What follows the last separator; the whole text where there is none."""
    return F.substring_index(as_column(col), sep, -1)


def replace_first(col: Column | str, part: str, by: str) -> Column:
    """Replace only the first occurrence of a literal."""
    value = as_column(col)
    at = F.instr(value, part)
    head = F.substring(value, F.lit(1), at - F.lit(1))
    tail = F.substring(value, at + F.lit(len(part)), F.length(value))
    return F.when(at > 0, F.concat(head, F.lit(by), tail)).otherwise(value)


def cell_text(value: Column | str, kind: Column | str) -> Column:
    """A sheet cell as text, by what the sheet stored.

    ``kind`` is one of empty, text, bool, int, float, date, datetime.
    """
    raw, stored = as_column(value), as_column(kind)
    return (
        F.when(stored == "empty", F.lit(None).cast("string"))
        .when(stored == "bool", F.upper(raw))
        .when(stored == "float", F.coalesce(_float_text(raw), raw))
        .when(stored == "datetime", F.replace(raw, F.lit(" "), F.lit("T")))
        .otherwise(F.nullif(raw, F.lit("")))
    )


def _float_text(raw: Column) -> Column:
    number = raw.try_cast("double")
    return F.when(number == F.floor(number), number_text(number))
