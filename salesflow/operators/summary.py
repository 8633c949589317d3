"""Aggregates used by reports and checks; all have a map-side part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from salesflow.functions import as_column, named
from salesflow.functions.dates import month_key, month_start


def monthly_units(df: DataFrame, day: Column | str, quantity: Column | str, alias: str = "units") -> DataFrame:
    """Units per calendar month ``yyyy-MM``."""
    return df.groupBy(month_key(day).alias("ym")).agg(F.sum(as_column(quantity)).alias(alias))


def summarise(df: DataFrame, by: str, metrics: Sequence[str]) -> DataFrame:
    """Rows and the sum of each metric; a sum over nothing but nulls is 0."""
    sums = [F.coalesce(F.sum(named(m)), F.lit(0)).alias(m) for m in metrics]
    return df.groupBy(named(by)).agg(F.count("*").alias("rows"), *sums)


def day_counts(df: DataFrame, day: str) -> DataFrame:
    """Rows per day, days without a date left out."""
    return (
        df.filter(named(day).isNotNull())
        .groupBy(named(day).cast("date").alias("day"))
        .agg(F.count("*").alias("n"))
    )


def dominant_month(df: DataFrame, day: str) -> DataFrame:
    """One row: the month most rows fall in, the earliest where months tie."""
    months = (
        df.filter(named(day).isNotNull())
        .groupBy(month_start(day).alias("month"))
        .agg(F.count("*").alias("n"))
    )
    # Ordered by count, then by nearness to the past.
    rank = F.struct(F.col("n"), -F.unix_date("month"))
    return months.agg(F.max_by("month", rank).alias("month"))


def profile(df: DataFrame, distinct: str, bounded: str, filled: str) -> DataFrame:
    """One row: rows, distinct values, least and greatest value, share of non-blank texts."""
    present = F.coalesce(named(filled) != "", F.lit(False))
    return df.agg(
        F.count("*").alias("rows"),
        F.count_distinct(named(distinct)).alias("distinct_values"),
        F.min(named(bounded)).alias("least"),
        F.max(named(bounded)).alias("greatest"),
        F.avg(present.cast("int")).alias("share_filled"),
    )
