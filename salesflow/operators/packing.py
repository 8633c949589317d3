"""Cutting a month into report parts: at split days and, where a capacity is given, by row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from salesflow.functions import named
from salesflow.functions.dates import month_key, month_label, month_start
from salesflow.operators.joins import lookup

# What a spreadsheet's sheet holds beside its header: for callers whose parts become sheets.
SHEET_CAPACITY = 1_048_576 - 1
SPLIT_DAYS = (15,)


def month_ranges(month: Column, split_days: Sequence[int] = SPLIT_DAYS) -> Column:
    """Array of day ranges ``(lo, hi)`` of a month, cut behind the split days inside it."""
    last = F.day(F.last_day(month))
    days = F.array(*[F.lit(d) for d in sorted(set(split_days))]).cast("array<int>")
    cuts = F.filter(days, lambda d: (d > 0) & (d < last))
    bounds = F.arrays_zip(F.concat(F.array(F.lit(0)), cuts).alias("lo"), F.concat(cuts, F.array(last)).alias("hi"))
    return F.transform(
        bounds,
        lambda b: F.struct(
            F.date_add(month, b["lo"]).alias("lo"), F.date_add(month, b["hi"] - 1).alias("hi")
        ),
    )


def _filled(days: Column, lo: Column, hi: Column, cap: int) -> Column:
    """Array of parts ``(lo, hi, rows)`` of one range, from its sorted day counts."""
    empty = F.struct(lo.alias("lo"), hi.alias("hi"), F.lit(0).cast("long").alias("rows"))

    def add(parts: Column, day: Column) -> Column:
        last, done = F.element_at(parts, -1), F.slice(parts, 1, F.size(parts) - 1)
        total = last["rows"] + day["n"]
        grown = F.struct(last["lo"].alias("lo"), last["hi"].alias("hi"), total.alias("rows"))
        closed = F.struct(last["lo"].alias("lo"), F.date_sub(day["day"], 1).alias("hi"), last["rows"].alias("rows"))
        opened = F.struct(day["day"].alias("lo"), last["hi"].alias("hi"), day["n"].alias("rows"))
        full = (last["rows"] > 0) & (total > cap)
        return F.when(full, F.concat(done, F.array(closed, opened))).otherwise(F.concat(done, F.array(grown)))

    return F.aggregate(days, F.array(empty), add)


def _whole(days: Column, lo: Column, hi: Column) -> Column:
    """One part of all rows between two days."""
    inside = F.filter(days, lambda d: d["day"].between(lo, hi))
    rows = F.aggregate(inside, F.lit(0).cast("long"), lambda total, d: total + d["n"])
    return F.struct(lo.alias("lo"), hi.alias("hi"), rows.alias("rows"))


def online_parts(month: Column, days: Column, split_days: Sequence[int], cap: int | None) -> Column:
    """Array of a month's online parts; with a cap, a single day above it is an error."""
    if cap is None:
        return F.transform(month_ranges(month, split_days), lambda r: _whole(days, r["lo"], r["hi"]))
    above = F.filter(days, lambda d: d["n"] > cap)
    day = F.get(above, F.lit(0))["day"].cast("string")
    refused = F.raise_error(F.concat(F.lit("more rows than one part holds on "), day))
    fitting = F.when(F.size(above) > 0, refused.cast("array<struct<day:date,n:bigint>>")).otherwise(days)
    return F.flatten(
        F.transform(
            month_ranges(month, split_days),
            lambda r: _filled(
                F.filter(fitting, lambda d: d["day"].between(r["lo"], r["hi"])), r["lo"], r["hi"], cap
            ),
        )
    )


def offline_parts(month: Column, days: Column, cap: int | None) -> Column:
    """Array of a month's one offline part; with a cap, a month above it is an error."""
    part = _whole(days, month, F.last_day(month))
    if cap is None:
        return F.array(part)
    too_long = F.concat(F.lit("more offline rows than one part holds in "), month_key(month))
    rows = F.when(part["rows"] > cap, F.raise_error(too_long).cast("long")).otherwise(part["rows"])
    return F.array(F.struct(part["lo"].alias("lo"), part["hi"].alias("hi"), rows.alias("rows")))


def _month_days(counts: DataFrame, *by: str) -> DataFrame:
    """One row a month with its sorted day counts, at most 31."""
    return counts.groupBy(*by, month_start("day").alias("month")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("day"), F.col("n").cast("long").alias("n")))).alias("days")
    )


def pack_days(counts: DataFrame, split_days: Sequence[int] = SPLIT_DAYS, cap: int | None = None) -> DataFrame:
    """Parts of each month: ``month, part_no, lo, hi, rows, part_count``.

    ``counts`` has ``day`` and ``n``, one row a day. Without a cap each range between split
    days is one part. With one, each range above the cap is filled day by day, a new part starting where the next day would not fit, which gives the fewest
    parts; ranges within the cap stay whole, also when they are empty. Parts are numbered
    over the month in date order. A single day above the cap is an error.
    """
    months = _month_days(counts)
    parts = months.select("month", online_parts(F.col("month"), F.col("days"), split_days, cap).alias("parts"))
    numbered = parts.select(
        "month", F.size("parts").cast("long").alias("part_count"), F.posexplode("parts").alias("at", "part")
    )
    part_no = (F.col("at") + 1).cast("long").alias("part_no")
    return numbered.select("month", part_no, "part.lo", "part.hi", "part.rows", "part_count")


def part_name(side: Column, month: Column, part_no: Column, part_count: Column) -> Column:
    """``2026 09 Sep Online``, with ``(n)`` when the side has several parts that month."""
    number = F.when(part_count > 1, F.concat(F.lit(" ("), part_no.cast("string"), F.lit(")")))
    return F.concat(month_label(month), F.lit(" "), side, F.coalesce(number, F.lit("")))


def with_parts(
    rows: DataFrame, day: str, side: str, split_days: Sequence[int] = SPLIT_DAYS, cap: int | None = None
) -> DataFrame:
    """Each row with its ``sale_month`` and ``part_name``; ``side`` says Online or Offline.

    Rows are counted once by side and day. Parts are spread to their days, so rows meet them
    by equal day in a table that has at most as many rows as the calendar has days, twice.
    """
    counts = rows.groupBy(named(side).alias("__side"), named(day).alias("day")).agg(F.count("*").alias("n"))
    month, days, of = F.col("month"), F.col("days"), F.col("__side")
    parts = F.when(of == "Online", online_parts(month, days, split_days, cap)).otherwise(offline_parts(month, days, cap))
    numbered = _month_days(counts, "__side").select("__side", "month", parts.alias("parts")).select(
        "__side", "month", F.size("parts").alias("count"), F.posexplode("parts").alias("at", "part")
    )
    calendar = numbered.select(
        "__side",
        F.explode(F.sequence("part.lo", "part.hi")).alias("__day"),
        month_key("month").alias("sale_month"),
        part_name(of, month, F.col("at") + 1, F.col("count")).alias("part_name"),
    )
    return lookup(rows, calendar, [(side, "__side"), (day, "__day")], "inner", nulls_match=False)
