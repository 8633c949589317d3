"""Figures of each month, kept beside its rows, so that checks over many months read no rows.

A month's figures are states that merge: counts, sums, a newest day, and a sketch of distinct order
numbers beside their exact number within the group. They are published with the month's rows, in one
version (``release_months``), so that after one month is rebuilt the guards read its new states and
those of all other months as they were. Sums and counts are exact however they are merged; distinct
numbers over several groups come from the sketches and are estimates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesflow.functions import named
from salesflow.operators.filters import any_differs
from salesflow.operators.joins import full_compare
from salesflow.plans.quality import ECOMMERCE_CHANNEL, RELEASE_METRICS
from salesflow.sources.releases import read_months

FIGURES = "figures"
# Columns that figures are kept by within a month.
BY = ("ReportSource", "Channel")
# Bits of a distinct sketch: about 1.6 % off.
SKETCH_BITS = 12


def month_figures(
    rows: DataFrame, month_col: str = "sale_month", by: Sequence[str] = BY, metrics: Sequence[str] = RELEASE_METRICS,
    day: str = "SentOn", number: str = "NoPesanan",
) -> DataFrame:
    """One row per month and group: rows, dated, newest, the metrics' sums, orders and their sketch."""
    sums = [F.coalesce(F.sum(named(m)), F.lit(0)).cast("long").alias(m) for m in metrics]
    text = named(number).cast("string")
    return rows.groupBy(named(month_col), *[named(c) for c in by]).agg(
        F.count("*").alias("rows"), F.count(named(day)).alias("dated"), F.max(named(day).cast("date")).alias("newest"),
        *sums, F.count_distinct(text).alias("orders"), F.hll_sketch_agg(text, SKETCH_BITS).alias("orders_sketch"),
    )


def merged_figures(figures: DataFrame, by: Sequence[str], metrics: Sequence[str] = RELEASE_METRICS) -> DataFrame:
    """Figures of coarser groups out of finer ones; ``orders`` is estimated from the sketches."""
    return figures.groupBy(*[named(c) for c in by]).agg(
        *[F.sum(named(c)).alias(c) for c in ("rows", "dated", *metrics)], F.max("newest").alias("newest"),
        F.hll_sketch_estimate(F.hll_union_agg("orders_sketch")).alias("orders"),
    )


def stored_figures(
    spark: SparkSession, path: str, version: int | None = None, months: Sequence[str] | None = None
) -> DataFrame:
    """The figures published with a version; opens no file of the months' rows."""
    return read_months(spark, path, FIGURES, version, months, date_cols=["newest"])


def stored_units(figures: DataFrame, report_source: str, quantity: str = "Quantity") -> DataFrame:
    """E-commerce units per month, for ``units_guard``, out of stored figures."""
    kept = figures.filter((named("ReportSource") == report_source) & (named("Channel") == ECOMMERCE_CHANNEL))
    return kept.groupBy(F.col("sale_month").alias("ym")).agg(F.sum(named(quantity)).alias("actual"))


def version_compare(
    new: DataFrame, old: DataFrame, by: str = "ReportSource", metrics: Sequence[str] = RELEASE_METRICS, suffix: str = "_old"
) -> DataFrame:
    """Two versions' figures per month and group side by side, with status MATCH or DIFF."""
    def keyed(figures: DataFrame) -> DataFrame:
        sums = [F.sum(named(c)).alias(c) for c in ("rows", *metrics)]
        return figures.groupBy(F.struct(named("sale_month"), named(by)).alias("key")).agg(*sums)

    both = full_compare(keyed(new), keyed(old), "key", ["rows", *metrics], suffix)
    differs = any_differs([(named(m), named(m + suffix)) for m in ["rows", *metrics]])
    status = F.when(differs, F.lit("DIFF")).otherwise(F.lit("MATCH")).alias("status")
    return both.select("key.*", *[named(c) for c in both.columns if c != "key"], status)
