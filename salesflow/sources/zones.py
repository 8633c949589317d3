"""Zone maps: the least and greatest values of every file of a table, kept beside it.

Parquet footers hold the same figures, but to see them each file has to be opened by a task. A zone
map is one small table, joined with what is asked for before the scan, so the other files are never
opened. It pays where rows of like values lie together: ``write_zoned`` sees to that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesflow.functions import named
from salesflow.operators.filters import in_quarter_scope

ZONES = "_zones"  # an underscore hides it from scans


def write_zoned(df: DataFrame, path: str, cols: Sequence[str], files: int | None = None) -> None:
    """Write a table with its rows dealt to files by ranges of the columns, then its zone map."""
    by = [named(c) for c in cols]
    dealt = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    dealt.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    write_zones(df.sparkSession, path, cols)


def write_zones(spark: SparkSession, path: str, cols: Sequence[str]) -> None:
    """The zone map of a table that lies there; reads the columns, no others."""
    table = spark.read.parquet(path)
    bounds = [f(named(c)).alias(f"{name}_{i}") for i, c in enumerate(cols) for f, name in ((F.min, "low"), (F.max, "high"), (_nulls, "nulls"))]
    # Least and greatest texts alone would be found by sorting all rows; beside a set, files are hashed and
    # a task holds one row for each.
    names = F.element_at(F.collect_set(F.array(*[F.lit(c) for c in cols])), 1).alias("cols")
    zones = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), *bounds, names)
    zones.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{ZONES}")


def _nulls(col: Column) -> Column:
    return F.count_if(col.isNull())


class Zones:
    """A table's zone map; ``scan`` reads only files that may hold what is asked for."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.table = spark.read.parquet(f"{path.rstrip('/')}/{ZONES}")
        row = self.table.select("cols").first()
        self.cols = list(row["cols"]) if row else []

    def bounds(self, col: str) -> tuple[Column, Column, Column]:
        """Least and greatest value of a file's column, and its number of nulls."""
        i = self.cols.index(col)
        return F.col(f"low_{i}"), F.col(f"high_{i}"), F.col(f"nulls_{i}")

    def meets(self, col: str, low=None, high=None, or_null: bool = False) -> Column:
        """Whether a file may hold a value within ``low`` and ``high``, either open where None."""
        least, greatest, nulls = self.bounds(col)
        tests = [F.lit(True) if low is None else greatest >= F.lit(low), F.lit(True) if high is None else least <= F.lit(high)]
        inside = F.coalesce(reduce(and_, tests) & least.isNotNull(), F.lit(False))
        return inside | (nulls > 0) if or_null else inside

    def files(self, test: Column) -> list[str]:
        """The files for which the test on bounds holds; as many as the scan will open."""
        return sorted(unquote(r["file"]) for r in self.table.filter(test).select("file").collect())

    def scan(self, test: Column) -> DataFrame:
        """The rows of these files; the caller filters the rows as before."""
        schema, files = self.spark.read.parquet(self.path).schema, self.files(test)
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*files)


def quarter_files(zones: Zones, year: int, month: int, source: str = "Source") -> Column:
    """Files that may hold rows of the source files of a month's quarter.

    A file of one source is decided by its name; one of several is read.
    """
    least, greatest, _ = zones.bounds(source)
    return F.coalesce((least != greatest) | in_quarter_scope(least, year, month), F.lit(False))
