"""Figures of Parquet tables out of their files' footers, without reading a row.

Spark's second reader answers counts, minima and maxima from footers where it may push them down; the
first one, which all other scans use, cannot. It is chosen by settings, so the figures are taken in a
session of their own that shares nothing with the caller's but the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from salesflow.functions import named


def footer_figures(
    spark: SparkSession, paths: str | Sequence[str], newest: str | None = None, schema: StructType | None = None
) -> DataFrame:
    """One row: ``rows`` and the greatest value of a column, ``newest``; null without the column.

    Pushed down for numbers, dates and flags; another type's column is scanned, alone.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    reader = own.read if schema is None else own.read.schema(schema)
    table = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    aggregates = [F.count("*").alias("rows")]
    if newest in table.columns:
        aggregates.append(F.max(named(newest)).alias("newest"))
    return table.agg(*aggregates)


def read_footers(
    spark: SparkSession, paths: str | Sequence[str], newest: str | None = None, schema: StructType | None = None
) -> tuple[int, object]:
    """Rows of a table and its newest value, None without one."""
    if not isinstance(paths, str) and not paths:
        return 0, None
    row: Row = footer_figures(spark, paths, newest, schema).first()
    # a table of files without a row has no footer to count from
    return row["rows"] or 0, row["newest"] if "newest" in row else None
