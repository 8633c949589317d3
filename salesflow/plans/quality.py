"""Release checks. Each returns a table of findings; the caller decides what to do."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesflow.functions import named
from salesflow.functions.numbers import percent_off
from salesflow.functions.text import last_part, replace_first
from salesflow.operators.compare import schema_changes, set_diff
from salesflow.operators.filters import (
    ITEM_TYPES, STALE_DAYS, any_differs, counted, month_bounds, sale_day, type_filter,
)
from salesflow.operators.joins import full_compare
from salesflow.operators.shape import union_all
from salesflow.operators.summary import dominant_month, monthly_units, summarise
from salesflow.sources.footers import read_footers

# Sales types that make up e-commerce, a fixed list.
ECOMMERCE = [
    "TIKTOK SHOP", "SHOPEE MALL", "SHOPEE STAR", "LAZADA", "ZALORA", "BUKALAPAK", "TOKOPEDIA",
    "TOKOPEDIA & SHOP",
]
ECOMMERCE_CHANNEL = "E-COMMERCE"
# A month fails when it is off by more than both.
UNITS_SHARE, UNITS_FLOOR = 0.005, 500
FIRST_MONTH = "2025-01"
# Least share of the old rows a release must keep.
PROMOTION_ROWS, COMPILE_ROWS = 0.95, 0.90
# Least share of rows with a date.
DATES_FILLED = 0.95
RELEASE_METRICS = ["Quantity", "Qty Sales", "Revenue", "Qty Return"]
REBUILD_GAP = dt.timedelta(hours=1)
MAX_WAIT = dt.timedelta(hours=2)


def expected_units(orders: DataFrame, as_of: dt.date, sales_types: Sequence[str] = ECOMMERCE) -> DataFrame:
    """E-commerce units per month, counted straight from the orders.

    Kept apart from the marketplace job on purpose, so that a fault there shows: the sales
    type is the part after the last ``_``, and a line without an item type is left out.
    """
    day = sale_day("SentOn", "CreatedOn")
    kind = replace_first(last_part(F.upper("Marketplace")), "NEXUS", "ENDORSE")
    lines = orders.filter(
        counted(F.upper("Order Status"), day, as_of, STALE_DAYS)
        & kind.isin(list(sales_types))
        & type_filter(F.upper("Type of Item"), ITEM_TYPES, keep_null=False)
    )
    return monthly_units(lines, day, "Ordered Quantity", "expected")


def published_units(history: DataFrame, report_source: str) -> DataFrame:
    """E-commerce units per month in the published history."""
    rows = history.filter(
        (named("ReportSource") == report_source) & (named("Channel") == ECOMMERCE_CHANNEL)
    )
    return monthly_units(rows, "SentOn", "Quantity", "actual")


def units_guard(
    expected: DataFrame, actual: DataFrame, first_month: str = FIRST_MONTH,
    share: float = UNITS_SHARE, floor: int = UNITS_FLOOR,
) -> DataFrame:
    """Expected against published units per month, with a ``bad`` flag."""
    both = expected.join(actual, "ym", "full").na.fill(0, subset=["expected", "actual"])
    off = F.abs(F.col("diff"))
    return (
        both.filter(F.col("ym") >= first_month)
        .withColumn("diff", F.col("actual") - F.col("expected"))
        .withColumns(
            {
                "pct": percent_off("actual", "expected"),
                "bad": (off > floor) & (off > F.greatest("expected", F.lit(1)) * share),
            }
        )
    )


def release_compare(
    new: DataFrame, old: DataFrame, by: str = "ReportSource",
    metrics: Sequence[str] = RELEASE_METRICS, day: str = "SentOn", suffix: str = "_old",
) -> DataFrame:
    """A new month unit against the same month of the old table, per source.

    The month is the one most new rows fall in; it is found first, so that the scan of the
    old table skips all other months.
    """
    month = dominant_month(new, day).first()["month"]
    same = old.filter(F.lit(False))
    if month is not None:
        lo, hi = month_bounds(month.year, month.month)
        same = old.filter((named(day) >= F.lit(lo)) & (named(day) < F.lit(hi + dt.timedelta(days=1))))
    both = full_compare(
        summarise(new, by, metrics), summarise(same, by, metrics), by, ["rows", *metrics], suffix
    )
    differs = any_differs([(named(m), named(m + suffix)) for m in ["rows", *metrics]])
    return both.withColumn("status", F.when(differs, F.lit("DIFF")).otherwise(F.lit("MATCH")))


def _sided(new: DataFrame, old: DataFrame, col: str | None, kind: str) -> DataFrame:
    """One column of both tables, tagged, so that one pass yields figures of each side.

    A side without the column has nulls.
    """
    def side(df: DataFrame, is_new: bool) -> DataFrame:
        value = named(col) if col in df.columns else F.lit(None)
        return df.select(F.lit(is_new).alias("is_new"), value.cast(kind).alias("v"))

    return side(new, True).unionByName(side(old, False))


def _findings(figures: DataFrame, rules: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """One row per violated rule out of a one-row table of figures."""
    rows = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail"), broken.alias("broken"))
            for rule, broken, detail in rules
        ]
    )
    return figures.select(F.inline(rows)).filter("broken").drop("broken")


def promotion_check(
    new: DataFrame, old: DataFrame | None, allowed: Sequence[str] = (),
    min_ratio: float = PROMOTION_ROWS, date_col: str | None = "SentOn",
) -> DataFrame:
    """Reasons not to promote a table, one row per violated rule.

    A first release, without an old table, breaks none.
    Unexpected or dropped columns, too few rows, or a newest date that went backwards. The
    date check needs the column on both sides.
    """
    old = new.filter(F.lit(False)) if old is None else old
    is_new, day = F.col("is_new"), F.col("v")
    figures = _sided(new, old, date_col, "date").agg(
        F.count_if(is_new).alias("new_rows"),
        F.count_if(~is_new).alias("old_rows"),
        F.max(F.when(is_new, day)).alias("new_max"),
        F.max(F.when(~is_new, day)).alias("old_max"),
    )
    return _findings(figures, _promotion_rules(schema_changes(old, new, allowed), min_ratio))


def _promotion_rules(changes: Sequence[tuple[str, str]], min_ratio: float) -> list[tuple[str, Column, Column]]:
    rules = [(kind, F.lit(True), F.lit(column)) for kind, column in changes if kind in ("unexpected", "dropped")]
    return rules + [
        ("rows", F.col("new_rows") < F.col("old_rows") * min_ratio, F.col("new_rows")),
        ("newest", F.coalesce(F.col("new_max") < F.col("old_max"), F.lit(False)), F.col("new_max")),
    ]


def promotion_check_files(
    spark: SparkSession, new: str | Sequence[str], old: str | Sequence[str] | None, allowed: Sequence[str] = (),
    min_ratio: float = PROMOTION_ROWS, date_col: str | None = "SentOn",
) -> DataFrame:
    """``promotion_check`` of Parquet tables as they lie in files: rows and newest dates come from the
    footers, so no row of either table is read."""
    new_rows, new_max = read_footers(spark, new, date_col)
    old_rows, old_max = (0, None) if old is None else read_footers(spark, old, date_col)
    tables = [spark.read.parquet(*([p] if isinstance(p, str) else p)) for p in (new, old if old is not None else new)]
    figures = spark.createDataFrame(
        [(new_rows, old_rows, *(None if x is None else str(x) for x in (new_max, old_max)))],
        "new_rows long, old_rows long, new_max string, old_max string",
    ).withColumns({c: F.col(c).cast("date") for c in ("new_max", "old_max")})
    return _findings(figures, _promotion_rules(schema_changes(tables[1], tables[0], allowed), min_ratio))


def compile_check(
    new: DataFrame, old: DataFrame | None, file_col: str = "SourceFile", date_col: str = "Date",
    min_ratio: float = COMPILE_ROWS, min_dates: float = DATES_FILLED,
) -> DataFrame:
    """Reasons not to publish a compiled table, one row per violated rule.

    Source files missing or new, columns that differ or moved, too few rows, or too few
    rows with a date; a table without rows or without the date column has too few. A first
    release, without an old table, is held to the dates alone.
    """
    if old is None:
        return compile_check(new, new, file_col, date_col, 0.0, min_dates)
    files = set_diff(old, new, file_col).select(
        F.concat(F.lit("file "), F.col("side")).alias("rule"), named(file_col).alias("detail")
    )
    is_new = F.col("is_new")
    filled = F.coalesce(F.col("v") != "", F.lit(False))
    figures = _sided(new, old, date_col, "string").agg(
        F.count_if(is_new).alias("new_rows"),
        F.count_if(~is_new).alias("old_rows"),
        F.count_if(is_new & filled).alias("dated"),
    )
    rules = [
        ("columns", F.lit(new.columns != old.columns), F.lit(",".join(new.columns))),
        ("rows", F.col("new_rows") < F.col("old_rows") * min_ratio, F.col("new_rows")),
        ("dates", (F.col("new_rows") == 0) | (F.col("dated") < F.col("new_rows") * min_dates), F.col("dated")),
    ]
    return files.unionByName(_findings(figures, rules))


def _moment(value: dt.datetime) -> Column:
    # As text, so that the driver's own time zone has no say.
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def file_updates(spark: SparkSession, datasets: Mapping[str, str]) -> DataFrame:
    """When each file below the datasets' folders was last written (``dataset``, ``ts``), for
    ``freshness``, from the store's listing: no file is opened. ``ts`` is in the session's zone."""
    listed = [
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select(F.lit(name).alias("dataset"), F.col("modificationTime").cast("timestamp_ntz").alias("ts"))
        for name, path in datasets.items()
    ]
    return union_all(listed)


def freshness(
    updates: DataFrame, limits: Mapping[str, dt.timedelta], as_of: dt.datetime,
    last_output: dt.datetime | None = None, dataset: str = "dataset", moment: str = "ts",
) -> DataFrame:
    """Newest update per dataset against its age limit.

    ``stale`` when too old or never updated, ``newer`` when it came after the last output.
    """
    now = _moment(as_of)
    newest = (
        updates.filter(named(dataset).isin(list(limits)))
        .groupBy(named(dataset).alias("dataset"))
        .agg(F.max(named(moment).cast("timestamp_ntz")).alias("newest"))
    )
    wanted = updates.sparkSession.createDataFrame(
        [(name, int(age.total_seconds())) for name, age in limits.items()],
        "dataset string, max_age long",
    )
    rows = wanted.join(newest, "dataset", "left")
    age = F.timestamp_diff("SECOND", F.col("newest"), now)
    newer = F.lit(True) if last_output is None else F.col("newest") > _moment(last_output)
    return rows.select(
        "dataset",
        "newest",
        age.alias("age_seconds"),
        F.coalesce(F.col("newest") + F.make_dt_interval(secs=F.col("max_age")) < now, F.lit(True)).alias("stale"),
        F.coalesce(newer, F.lit(False)).alias("newer"),
    )


def build_decision(
    fresh: DataFrame, as_of: dt.datetime, last_output: dt.datetime | None, hourly: str,
    running: Sequence[str] = (), rebuild_gap: dt.timedelta = REBUILD_GAP, max_wait: dt.timedelta = MAX_WAIT,
    force: bool = False,
) -> DataFrame:
    """One row ``(run, reason)`` out of the freshness table.

    A forced build runs whatever the feeds say. Else, in turn: wait for a running feed
    unless the last output is too old; wait for a stale feed; nothing new; only feeds other
    than ``hourly`` changed and the last output is younger than the gap; else run.
    """
    age = None if last_output is None else as_of - last_output
    waiting = bool(running) and (age is None or age < max_wait)
    facts = fresh.agg(
        F.concat_ws(", ", F.array_sort(F.collect_list(F.when(F.col("stale"), F.col("dataset"))))).alias("stale"),
        F.coalesce(F.bool_or("newer"), F.lit(False)).alias("newer"),
        F.coalesce(F.bool_or(F.col("newer") & (F.col("dataset") == hourly)), F.lit(False)).alias("hourly_newer"),
    )
    recent = F.lit(age is not None and age < rebuild_gap)
    go = "ready: something new and nothing stale"
    if running:
        go = f"ready: last finished inputs, though {', '.join(running)} is loading"
    if force:
        return facts.select(F.lit(True).alias("run"), F.lit("ready: forced").alias("reason"))
    reason = (
        F.when(F.lit(waiting), F.lit(f"wait: {', '.join(running)} is loading"))
        .when(F.col("stale") != "", F.concat(F.lit("wait: stale "), F.col("stale")))
        .when(~F.col("newer"), F.lit("skip: nothing new"))
        .when(~F.col("hourly_newer") & recent, F.lit("skip: built lately and only slower inputs are new"))
        .otherwise(F.lit(go))
    )
    return facts.select((reason == go).alias("run"), reason.alias("reason"))
