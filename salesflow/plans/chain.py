"""Several months in one run: the report parts and the history, from one base."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from salesflow.functions.dates import month_key
from salesflow.operators.filters import in_months
from salesflow.operators.packing import SPLIT_DAYS, with_parts
from salesflow.plans.figures import FIGURES, month_figures
from salesflow.plans.history import save_months, typed_month
from salesflow.plans.marketplace import Masters, marketplace_months
from salesflow.plans.sell_in import marketplace_rows, report_rows
from salesflow.session import new_folder, remove_folder
from salesflow.sources.releases import publish, read_aside, versions, write_months_aside
from salesflow.sources.sinks import write_report_parts


def built_rows(
    base: DataFrame, orders: DataFrame, masters: Masters, months: Sequence[tuple[int, int]], as_of: dt.date,
    market_source: str, scope: str = "all",
) -> DataFrame:
    """The report rows of the given (year, month) pairs, in one pass over the base and the orders."""
    days = in_months(base, "SentOn", months)
    market = marketplace_rows(marketplace_months(orders, masters, months, as_of, scope), market_source)
    return report_rows(base, market, days)


def month_keys(months: Sequence[tuple[int, int]]) -> list[str]:
    return [f"{year:04d}-{month:02d}" for year, month in months]


def build_months(
    base: DataFrame, orders: DataFrame, masters: Masters, months: Sequence[tuple[int, int]], as_of: dt.date,
    market_source: str, report_path: str, history_path: str, scope: str = "all",
    split_days: Sequence[int] = SPLIT_DAYS, cap: int | None = None,
) -> None:
    """Rebuild the given (year, month) pairs; all other months stay as they are.

    All months are worked out in one pass over the base and the orders, and kept in the
    shared folder while they are counted and cut into parts; the history is taken from the
    report as written. A month that comes out empty replaces the rows it had by none. Report and
    history are replaced one after the other; ``release_months`` replaces both at once.
    """
    spark, keys = base.sparkSession, month_keys(months)
    rows = built_rows(base, orders, masters, months, as_of, market_source, scope)
    folder = new_folder(spark, "months")
    rows.write.parquet(folder)
    kept = spark.read.schema(rows.schema).parquet(folder)
    write_report_parts(with_parts(kept, "SentOn", "side", split_days, cap).drop("side"), report_path, keys)
    remove_folder(spark, folder)
    report = spark.read.parquet(report_path).withColumn("sale_month", F.col("sale_month").cast("string"))
    save_months(report.filter(F.col("sale_month").isin(keys)).drop("part_name"), history_path, months=keys)


def release_months(
    base: DataFrame, orders: DataFrame, masters: Masters, months: Sequence[tuple[int, int]], as_of: dt.date,
    market_source: str, path: str, scope: str = "all", split_days: Sequence[int] = SPLIT_DAYS, cap: int | None = None,
) -> int:
    """Rebuild the given months and publish their report, history and figures as one new version.

    Until that moment, and after a failure at any other, readers find all as they were. What
    was published while this run was at work makes it fail rather than be undone. Returns the
    version; the tables are ``report``, ``history`` and ``figures``, what the guards go by.
    """
    spark, keys = base.sparkSession, month_keys(months)
    started_from = (versions(spark, path) or [0])[-1]
    rows = built_rows(base, orders, masters, months, as_of, market_source, scope)
    folder = new_folder(spark, "months")
    rows.write.parquet(folder)
    kept = spark.read.schema(rows.schema).parquet(folder)
    parts = with_parts(kept, "SentOn", "side", split_days, cap).drop("side")
    report = write_months_aside(parts, path, "report", "sale_month", keys, ["part_name"])
    typed = typed_month(kept.drop("side")).withColumn("sale_month", month_key("SentOn"))
    history = write_months_aside(typed, path, "history", "sale_month", keys)
    written = read_aside(spark, path, history)
    figures = write_months_aside(month_figures(written), path, FIGURES, "sale_month", keys)
    version = publish(spark, path, report, history, figures, base=started_from)
    remove_folder(spark, folder)
    return version
