"""Column-in, Column-out helpers; all stay inside Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def named(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_column(value: Column | str) -> Column:
    return named(value) if isinstance(value, str) else value
