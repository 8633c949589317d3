"""Which months an advance of the as-of day, or changed source files, make it needful to rebuild.

Late orders age in: a dispatched line counts some days after its sale, so with every day that passes
older months gain lines. And a source file that was delivered anew may change any month. Both deltas
are worked out from the orders without building a month: source files whose rows are the same before
and after are told by sums of hashes, of them only the few days that have aged in are read, and of
the others only the counted lines, summed up by month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from salesflow.functions import named
from salesflow.functions.dates import month_key
from salesflow.functions.text import strip
from salesflow.operators.compare import uneven_groups
from salesflow.operators.filters import STALE_DAYS, counted, sale_day, sale_window
from salesflow.operators.shape import require_columns

NEEDED = ["Source", "Order Status", "SentOn", "CreatedOn"]


def _counts(as_of: dt.date, stale_days: int) -> Column:
    return counted(strip("Order Status"), sale_day("SentOn", "CreatedOn"), as_of, stale_days)


def aged_months(orders: DataFrame, before: dt.date, after: dt.date, stale_days: int = STALE_DAYS) -> DataFrame:
    """Months (``ym``) whose dispatched lines begin or cease to count as the as-of day moves.

    Such lines were sold within as many days as lie between, which the scan is told.
    """
    early, late = sorted([before, after])
    lo, end = (d - dt.timedelta(days=stale_days - 1) for d in (early, late))
    aged = orders.filter(sale_window("SentOn", "CreatedOn", lo, end)).filter(_counts(early, stale_days) != _counts(late, stale_days))
    return aged.select(month_key(sale_day("SentOn", "CreatedOn")).alias("ym")).distinct()


def changed_sources(old: DataFrame, new: DataFrame, source: str = "Source") -> DataFrame:
    """Source files whose rows are not the same on both sides, gone and new ones included."""
    return uneven_groups(old, new, [source])


def touched_months(
    old: DataFrame, new: DataFrame, before: dt.date, after: dt.date, columns: Sequence[str], stale_days: int = STALE_DAYS
) -> DataFrame:
    """Months (``ym``) whose counted lines, by ``columns``, differ between two states of the orders.

    ``old`` are the orders as the last build saw them on the as-of day ``before``, ``new`` those
    of ``after``. Lines without a sale day are in no month.
    """
    for orders in (old, new):
        require_columns(orders, [*NEEDED, *columns])
    kept = sorted({*NEEDED, *columns})
    old, new = (orders.select(*[named(c) for c in kept]) for orders in (old, new))
    changed = [r[0] for r in changed_sources(old, new).collect()]  # as many as were delivered anew
    known = [s for s in changed if s is not None]
    is_changed = F.coalesce(named("Source").isin(known), F.lit(None in changed))
    sides = [
        orders.filter(is_changed & _counts(day, stale_days)).withColumn("ym", month_key(sale_day("SentOn", "CreatedOn")))
        for orders, day in ((old, before), (new, after))
    ]
    redelivered = uneven_groups(*sides, ["ym"])
    aged = aged_months(new.filter(~is_changed), before, after, stale_days)
    return redelivered.unionByName(aged).filter("ym IS NOT NULL").distinct()
