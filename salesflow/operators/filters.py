"""Row predicates. Each is a plain Column so that Spark can push it into the scan."""

from __future__ import annotations

import calendar
import datetime as dt
import re
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType

from salesflow.functions import as_column, named
from salesflow.functions.text import strip

# Days after which a dispatched order counts as delivered.
STALE_DAYS = 14
ITEM_TYPES = ["ACTIVITY", "REGULER"]
ONLINE = "ONLINE"
# Name checks on marketplace source files.
SOURCE_WORD, SOURCE_BAN = "REPORT", "$"


def not_contains(col: Column | str, text: str) -> Column:
    """Case-sensitive literal test. Null is neither, so a filter drops it."""
    return ~as_column(col).contains(text)


def drop_sentinel(col: Column | str, value: str) -> Column:
    """All but one value; null stays in."""
    return ~as_column(col).eqNullSafe(F.lit(value))


def has_key(col: Column | str, blanks: Sequence[str] = ("", "nan")) -> Column:
    """A key that is neither null nor one of the blank spellings."""
    return ~strip(col).isin(list(blanks))


def type_filter(col: Column | str, values: Sequence[str] = ITEM_TYPES, keep_null: bool = True) -> Column:
    """One of the values, with or without null."""
    member = as_column(col).isin(list(values))
    return as_column(col).isNull() | member if keep_null else member


def any_differs(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """True when one of the pairs differs; null equals null."""
    return reduce(or_, [~a.eqNullSafe(b) for a, b in pairs])


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    """First and last day."""
    return dt.date(year, month, 1), dt.date(year, month, calendar.monthrange(year, month)[1])


def in_days(col: Column | str, lo: dt.date, hi: dt.date) -> Column:
    """Inclusive day range on a date column."""
    return as_column(col).between(F.lit(lo), F.lit(hi))


def in_months(df: DataFrame, col: str, months: Sequence[tuple[int, int]]) -> Column:
    """The day lies in one of the (year, month) pairs.

    A date is named only once: filters are pushed below what works a column out, and every further
    mention works it out again.
    """
    bounds = [month_bounds(y, m) for y, m in months]
    if isinstance(df.schema[col].dataType, DateType):
        return F.trunc(named(col), "month").isin([F.lit(lo) for lo, _ in bounds])
    return reduce(or_, [in_days(col, lo, hi) for lo, hi in bounds])


def sale_window(sent: str, created: str, lo: dt.date, end: dt.date) -> Column:
    """The sale moment (sent, else created) lies in ``[lo, end)``.

    Spelled as two ranges, because a coalesce would keep the scan from using its statistics.
    """
    sent_col, created_col = named(sent), named(created)

    def within(col: Column) -> Column:
        return (col >= F.lit(lo)) & (col < F.lit(end))

    return within(sent_col) | (sent_col.isNull() & within(created_col))


def counted(status: Column, sale_day: Column, as_of: dt.date, stale_days: int = STALE_DAYS) -> Column:
    """An order line counts when delivered, or dispatched at least ``stale_days`` ago.

    A dispatched line without any date does not count; a delivered one needs none.
    """
    cutoff = as_of - dt.timedelta(days=stale_days)
    stale = (status == "DISPATCHED") & F.coalesce(sale_day <= F.lit(cutoff), F.lit(False))
    return F.coalesce((status == "DELIVERED") | stale, F.lit(False))


def sale_day(sent: str, created: str) -> Column:
    """Day of sale: when sent, else when created."""
    return F.coalesce(named(sent).cast("date"), named(created).cast("date"))


def is_online(group: Column | str) -> Column:
    """Whether the channel group is ONLINE; a null group is not."""
    return as_column(group).eqNullSafe(F.lit(ONLINE))


def source_tags(year: int, month: int) -> list[str]:
    """Tags of the source files of a month's quarter, and of the spill-over file before it."""
    first = 3 * ((month - 1) // 3) + 1
    quarter = [dt.date(year, m, 1) for m in range(first, first + 3)]
    before = quarter[0] - dt.timedelta(days=1)
    return [_tag(d) for d in quarter] + [_tag(before) + " (3)"]


def _tag(day: dt.date) -> str:
    return f"{day:%y %m} {calendar.month_abbr[day.month]}"


def in_quarter_scope(source: Column | str, year: int, month: int) -> Column:
    """The source name holds one of the quarter's tags, the report word and no ``$``.

    Tags and word ignore case. One pattern, so that the name is worked out once a row.
    """
    tags = "|".join(re.escape(tag) for tag in source_tags(year, month))
    return as_column(source).rlike(rf"(?is)^(?!.*{re.escape(SOURCE_BAN)})(?=.*{SOURCE_WORD}).*({tags})")


def quarter_scope(
    df: DataFrame, source: str, year: int, month: int, list_up_to: int | None = None
) -> DataFrame:
    """Only the rows of the source files that a month's quarter covers.

    On a table partitioned by source the filter alone prunes folders. On a flat table pass
    ``list_up_to``: the distinct source names are listed first (one column read, reduced in
    the map side) and become an ``IN`` list, which row-group statistics understand. With
    more wanted names than that, the plain filter does the work.
    """
    wanted = in_quarter_scope(source, year, month)
    scoped = df.filter(wanted)
    if list_up_to is None:
        return scoped
    names = scoped.select(named(source)).distinct().limit(list_up_to + 1).collect()
    if len(names) > list_up_to:
        return scoped
    return scoped.filter(named(source).isin([row[0] for row in names]))
