"""The monthly sell-in report: clean three feeds, join masters, split and shape a month."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from salesflow.functions import named
from salesflow.functions.kinds import as_day, as_is, as_text, as_upper, as_whole, column_as
from salesflow.functions.text import remove_text
from salesflow.operators.filters import in_months, is_online, not_contains
from salesflow.operators.joins import lookup, prepared
from salesflow.operators.packing import SPLIT_DAYS, with_parts
from salesflow.operators.shape import rename_drop, require_columns, union_relaxed
from salesflow.schemas import REPORT_COLUMNS, REPORT_SCHEMA
from salesflow.session import staged

# The feeds' columns as delivered, what they are called in the report, and what
# they become. The order is the order of the cleaned feed.
STOCK_FEED = [
    ("CreatedOn", "CreatedOn", as_day),
    ("SentOn", "SentOn", as_day),
    ("SalesType", "SalesType", as_upper),
    ("City", "City", as_upper),
    ("NoPesanan", "NoPesanan", as_upper),
    ("CustomerName", "CustomerName", as_upper),
    ("ItemName", "ItemName", as_upper),
    ("Quantity", "Quantity", as_whole),
]
ERP_FEED = [
    ("CreatedOn", "CreatedOn", as_day),
    ("SalesType", "CustomerLevel1", as_upper),
    ("SubSalesType", "CustomerLevel2", as_upper),
    ("Province", "CustomerState", lambda value, have: F.upper(remove_text(as_text(value, have), " (ID)"))),
    ("City", "CustomerCity", as_upper),
    ("CustomerName", "CustomerName", as_upper),
    ("ItemName", "ItemName", as_upper),
    ("NoPesanan", "OrderReference", as_upper),
    ("SentOn", "SentOn", as_day),
    ("Status", "Delivery Status", as_upper),
    ("Payment Terms", "Payment Terms", as_is),
    ("Quantity", "Quantity", as_whole),
    ("Customer & Address", "Customer & Address", as_is),
    ("InvoiceOn", "InvoiceOn", as_day),
]
ACCOUNTING_FEED = [
    ("CreatedOn", "CreatedOn", as_day),
    ("SentOn", "SentOn", as_day),
    ("SO Number", "SO Number", as_is),
    ("NoPesanan", "DO Number", as_upper),
    ("SalesType", "Sales Type", as_upper),
    ("CustomerName", "Customer", as_upper),
    ("Province", "Province", as_text),
    ("City", "City", as_upper),
    ("ItemName", "Item Name", as_upper),
    ("Qty Sales", "Qty Sales", as_is),
    ("Revenue", "Revenue", as_is),
    ("Qty Return", "Qty Return", as_is),
    ("Quantity", "Quantity", as_whole),
]
# The ERP feed counts from this day; earlier rows came through another feed.
ERP_FIRST_DAY = dt.date(2025, 1, 1)


def clean_feed(feed: DataFrame, columns: Sequence[tuple], report_source: Column) -> DataFrame:
    """A feed in the report's terms: one projection of (name, delivered name, kind)."""
    require_columns(feed, [source for _, source, _ in columns])
    return feed.select(
        *[column_as(feed, source, kind).alias(name) for name, source, kind in columns], report_source.alias("ReportSource")
    )


def clean_stock(feed: DataFrame, report_source: str) -> DataFrame:
    """The stock feed (source A): dates, whole quantities, upper-case names."""
    return clean_feed(feed, STOCK_FEED, F.upper(F.lit(report_source)))


def clean_erp(feed: DataFrame, report_source: str, first_day: dt.date = ERP_FIRST_DAY) -> DataFrame:
    """The ERP feed (source B).

    Rows checked as reported, and rows without a check mark, are left out; so are rows sent
    before the first day or without a day.
    """
    unreported = feed.filter(not_contains("Checked", "Reported"))
    return clean_feed(unreported, ERP_FEED, F.upper(F.lit(report_source))).filter(named("SentOn") >= F.lit(first_day))


def clean_accounting(feed: DataFrame, report_source: str) -> DataFrame:
    """The accounting feed (source C).

    Employee sales are dropped in any spelling; a row without a customer goes too.
    """
    return clean_feed(feed, ACCOUNTING_FEED, F.lit(report_source)).filter(not_contains("CustomerName", "EMPLOYE"))


def offline_base(
    feeds: Sequence[DataFrame], product: DataFrame, area: DataFrame, channel: DataFrame
) -> DataFrame:
    """All cleaned feeds stacked by name, with product, region and channel looked up.

    A missing key finds the master's blank row, and duplicate master keys multiply rows.
    Masters that have to be worked out are written once first.
    """
    base = lookup(union_relaxed(*feeds), prepared(product), ["ItemName"])
    base = lookup(base, prepared(area), ["Province"])
    return lookup(base, prepared(channel), ["SalesType", "SubSalesType"])


def marketplace_rows(month: DataFrame, report_source: str) -> DataFrame:
    """A marketplace month in the report's terms: the sales type stands in for the customer."""
    require_columns(month, ["SalesType", "Sub Category"])
    df = rename_drop(month, {"Sub Category": "SubCategory"}, ["Unit Price"])
    df = df.withColumns({"CustomerName": named("SalesType"), "ReportSource": F.upper(F.lit(report_source))})
    return df


def report_column(df: DataFrame, name: str) -> Column:
    """A report column with the type it has; one the sources never supply is null."""
    if name in df.columns:
        return named(name)
    return F.lit(None).cast(REPORT_SCHEMA[name].dataType).alias(name)


def report_rows(base: DataFrame, marketplace: DataFrame, days: Column) -> DataFrame:
    """The report rows of the given days in one pass, with ``side`` Online or Offline.

    Base rows without an ONLINE channel group are offline, also when the group is null.
    Marketplace rows count online only; one outside the ONLINE group is on neither side and
    is what ``lost_marketplace`` counts.
    """
    both = union_relaxed(
        base.withColumn("__own", F.lit(True)), marketplace.withColumn("__own", F.lit(False))
    ).filter(days)
    online = is_online("Channel Group")
    side = F.when(online, F.lit("Online")).otherwise(F.lit("Offline")).alias("side")
    return both.filter(online | F.col("__own")).select(
        *[report_column(both, name) for name in REPORT_COLUMNS], side
    )


def month_rows(base: DataFrame, marketplace: DataFrame, year: int, month: int) -> DataFrame:
    """One month's report rows."""
    return report_rows(base, marketplace, in_months(base, "SentOn", [(year, month)]))


def lost_marketplace(marketplace: DataFrame) -> DataFrame:
    """Marketplace rows and units per sales type that reach no part of the report."""
    return marketplace.filter(~is_online("Channel Group")).groupBy("SalesType").agg(
        F.count("*").alias("rows"), F.sum("Quantity").alias("units")
    )


def month_report(
    base: DataFrame, marketplace: DataFrame, year: int, month: int,
    split_days: Sequence[int] = SPLIT_DAYS, cap: int | None = None,
) -> DataFrame:
    """A month's report rows, both sides, each with its ``sale_month`` and ``part_name``.

    The rows are written once before they are counted and cut into parts.
    """
    rows = staged(month_rows(base, marketplace, year, month), "month")
    return with_parts(rows, "SentOn", "side", split_days, cap)
