"""Writing months, report parts, one-pass unions and exception lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from salesflow.functions import named
from salesflow.session import remove_folder


def write_months(df: DataFrame, path: str, month_col: str, months: Sequence[str] | None = None) -> None:
    """One folder per month; only the months present in ``df``, or named, are replaced.

    ``months`` names those that are being rebuilt: one that came out without rows loses the
    rows it had. The rebalance lets adaptive execution give every month few files and cut a
    month that holds most of the rows into several tasks.
    """
    _by_folder(df, path, month_col, [], months)


def write_report_parts(df: DataFrame, path: str, months: Sequence[str] | None = None) -> None:
    """Report rows by month; only the months present in ``df``, or named, are replaced.

    A month is replaced whole, since a rebuilt month can have fewer parts than before; so
    the part stays a column. Rows lie sorted by part, and reading one part skips the rest.
    """
    _by_folder(df, path, "sale_month", ["sale_month", "part_name"], months)


def _by_folder(df: DataFrame, path: str, by: str, sort: list[str], months: Sequence[str] | None) -> None:
    seen = Observation("written")
    spread = df.observe(seen, F.collect_set(named(by).cast("string")).alias("months")).hint("rebalance", by)
    ordered = spread.sortWithinPartitions(*[named(c) for c in sort]) if sort else spread
    (
        ordered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )
    # Overwriting by folder leaves the folders that got no rows: those of emptied months go.
    for month in set(months or ()) - set(seen.get["months"]):
        remove_folder(df.sparkSession, f"{path.rstrip('/')}/{by}={month}")


def write_union(df: DataFrame, path: str) -> int:
    """Write in one pass and return the number of rows written, counted on the way."""
    seen = Observation("written")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(seen.get["rows"])


def write_exceptions(df: DataFrame, path: str) -> None:
    """An exception list as CSV with a header; nulls are empty cells."""
    df.write.mode("overwrite").options(header=True, nullValue="", emptyValue="").csv(path)
