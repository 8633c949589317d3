"""The typed monthly history: type a month, replace its unit, stack all months."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesflow.functions.dates import month_key
from salesflow.operators.shape import stack_months, typed
from salesflow.schemas import HISTORY_DATES, HISTORY_LONGS, HISTORY_TEXTS
from salesflow.sources.files import ROLLUP_WORDS, list_files, read_text_csvs
from salesflow.sources.sinks import write_months

STEM = r"^(\d{4})[ -](0[1-9]|1[0-2])(?: .*)?$"


def typed_month(df: DataFrame) -> DataFrame:
    """A month's rows with the history's types."""
    return typed(df, HISTORY_DATES, HISTORY_LONGS, HISTORY_TEXTS)


def save_months(
    df: DataFrame, path: str, month_col: str = "sale_month", day: str = "SentOn", months: Sequence[str] | None = None
) -> None:
    """Type the rows and replace the months they belong to; other months stay.

    A month's key is ``yyyy-MM``. ``months`` names the months being rebuilt, so that one
    without rows any more is emptied too.
    """
    rows = typed_month(df)
    if month_col not in rows.columns:
        rows = rows.withColumn(month_col, month_key(day))
    write_months(rows, path, month_col, months)


def combined(months: Sequence[DataFrame]) -> DataFrame:
    """All month units as one table."""
    return stack_months(months, HISTORY_DATES)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All saved months as one table, also where a month has columns that others lack.

    Months of equal schema are read together.
    """
    folders = sorted({f.rsplit("/", 1)[0] for f in list_files(spark, path, ".parquet")})
    with ThreadPoolExecutor(16) as pool:
        schemas = list(pool.map(lambda f: spark.read.parquet(f).schema.json(), folders))
    groups: dict[str, list[str]] = {}
    for folder, schema in zip(folders, schemas):
        groups.setdefault(schema, []).append(folder)
    reader = spark.read.option("basePath", path)
    return combined([reader.parquet(*same) for same in groups.values()])


def seed_history(spark: SparkSession, folder: str, path: str, only: Sequence[str] = ()) -> None:
    """Turn a folder of month exports into month units, one per file name stem.

    A stem such as ``2026 09 Sep`` is stored under the month's key, as a rebuilt month is, so
    either replaces the other; a stem that names no month is an error. Roll-up files are
    left out by name; ``only`` names the months to seed, as stems or keys.
    """
    files = [f for f in list_files(spark, folder, ".csv") if not _is_rollup(f)]
    months = {f: stem_month(_stem(f)) for f in files}
    if only:
        wanted = {stem_month(m) for m in only}
        files = [f for f in files if months[f] in wanted]
    rows = read_text_csvs(spark, files, stem_col="sale_month", skip_empty=True)
    key = F.regexp_replace("sale_month", STEM, "$1-$2")
    save_months(rows.withColumn("sale_month", key), path, months=sorted({months[f] for f in files}))


def stem_month(stem: str) -> str:
    """``2026-09`` for ``2026 09 Sep`` or ``2026-09``."""
    found = re.match(STEM, stem)
    if not found:
        raise ValueError(f"no month in {stem!r}")
    return f"{found[1]}-{found[2]}"


def _is_rollup(path: str) -> bool:
    return any(word in path.rsplit("/", 1)[-1].lower() for word in ROLLUP_WORDS)


def _stem(path: str) -> str:
    return path.rsplit("/", 1)[-1].split("_", 1)[0].replace("%20", " ")
