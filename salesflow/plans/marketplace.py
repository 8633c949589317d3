"""One month of marketplace orders under the counting rule."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from salesflow.functions import named
from salesflow.functions.numbers import coerce_int
from salesflow.functions.text import remove_text, strip, suffix_after
from salesflow.operators.filters import (
    STALE_DAYS, counted, in_days, month_bounds, quarter_scope, sale_day, sale_window, type_filter,
)
from salesflow.operators.joins import lookup, lookup_or_default, prepared
from salesflow.operators.shape import require_columns, union_all
from salesflow.schemas import MARKETPLACE_COLUMNS

ORDER_COLUMNS = [
    "Source", "Marketplace", "CreatedOn", "SentOn", "Order Number", "Item Name", "Order Status",
    "Shipping Postcode", "Ordered Quantity", "Unit Price",
]


class Masters(NamedTuple):
    """Postcode, channel and product masters as the marketplace reads them."""

    postcode: DataFrame
    channel: DataFrame
    product: DataFrame


def sales_type(marketplace: Column | str) -> Column:
    """All after the first ``_``, with NEXUS spelled ENDORSE, upper-cased."""
    return F.upper(remove_text(suffix_after(marketplace), "NEXUS", "ENDORSE"))


def marketplace_month(
    orders: DataFrame, masters: Masters, year: int, month: int, as_of: dt.date,
    scope: str = "all", stale_days: int = STALE_DAYS, list_sources: int | None = 1000,
) -> DataFrame:
    """The month's counted order lines with place, channel and product, in 18 columns."""
    return marketplace_months(orders, masters, [(year, month)], as_of, scope, stale_days, list_sources)


def marketplace_months(
    orders: DataFrame, masters: Masters, months: Sequence[tuple[int, int]], as_of: dt.date,
    scope: str = "all", stale_days: int = STALE_DAYS, list_sources: int | None = 1000,
) -> DataFrame:
    """The counted order lines of several (year, month) pairs, looked up in one pass.

    ``scope`` is ``all`` source files, or those of each month's ``quarter``; for the latter up
    to ``list_sources`` file names are listed first, so that the scan skips all others (pass
    None for orders stored by source). The date windows too are filters the scan understands.
    """
    require_columns(orders, ORDER_COLUMNS, "The sale date is SentOn, else CreatedOn.")
    if scope not in ("all", "quarter"):
        raise ValueError(f"unknown scope {scope!r}")
    bounds = [month_bounds(y, m) for y, m in months]
    windows = [sale_window("SentOn", "CreatedOn", lo, hi + dt.timedelta(days=1)) for lo, hi in bounds]
    lines = orders.select(*[named(c) for c in ORDER_COLUMNS])
    if scope == "quarter":
        scoped = [quarter_scope(lines, "Source", y, m, list_sources).filter(w) for (y, m), w in zip(months, windows)]
        lines = union_all(scoped)
    else:
        lines = lines.filter(reduce(or_, windows))
    lines = lines.filter(counted(strip("Order Status"), sale_day("SentOn", "CreatedOn"), as_of, stale_days))
    lines = lines.select(
        named("CreatedOn").cast("date").alias("CreatedOn"),
        sale_day("SentOn", "CreatedOn").alias("SentOn"),
        sales_type("Marketplace").alias("SalesType"),
        named("Order Number").alias("NoPesanan"),
        F.upper(named("Item Name").cast("string")).alias("ItemName"),
        coerce_int("Ordered Quantity").alias("Quantity"),
        coerce_int("Unit Price").alias("Unit Price"),
        named("Shipping Postcode").cast("string").alias("__postcode"),
    )
    found = lookup_or_default(lines, prepared(masters.postcode), "__postcode", "Kode Pos").drop("__postcode")
    found = lookup(found, prepared(masters.channel), ["SalesType"])
    product = prepared(masters.product).withColumnsRenamed({"SubCategory": "Sub Category"})
    found = lookup(found, product, ["ItemName"])
    kept = found.filter(type_filter("Type of Item")).filter(reduce(or_, [in_days("SentOn", lo, hi) for lo, hi in bounds]))
    return kept.select(*[named(c) for c in MARKETPLACE_COLUMNS])
