"""Report parts against a plain-Python fill of the same day counts."""

import calendar
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from salesflow.operators.packing import pack_days, with_parts

CAP = 100


def filled(counts, splits, cap):
    """[(lo, hi, rows)] of a month, day by day."""
    month = next(iter(counts)).replace(day=1)
    last = calendar.monthrange(month.year, month.month)[1]
    ends = [*sorted(d for d in set(splits) if 0 < d < last), last]
    parts = []
    for begin, end in zip([0, *ends], ends):
        open_part = None
        for day in (month.replace(day=d) for d in range(begin + 1, end + 1)):
            n = counts.get(day, 0)
            if open_part is None:
                open_part = [day, day, n]
            elif open_part[2] and open_part[2] + n > cap:
                parts.append(tuple(open_part))
                open_part = [day, day, n]
            else:
                open_part[1], open_part[2] = day, open_part[2] + n
        parts.append(tuple(open_part))
    return parts


def packed(spark, counts, splits, cap):
    df = spark.createDataFrame(list(counts.items()), "day date, n long")
    return [tuple(r) for r in pack_days(df, splits, cap).orderBy("month", "part_no").select("lo", "hi", "rows").collect()]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(st.dates(dt.date(2024, 2, 1), dt.date(2024, 2, 29)), st.integers(1, CAP), min_size=1, max_size=29),
    st.sampled_from([(15,), (10, 20), (), (31,)]),
)
def test_parts_match_the_plain_fill(spark, counts, splits):
    got = packed(spark, counts, splits, CAP)
    assert got == filled(counts, splits, CAP)
    assert all(n <= CAP for _, _, n in got) and sum(n for _, _, n in got) == sum(counts.values())
    assert all(b[0] - a[1] == dt.timedelta(1) for a, b in zip(got, got[1:]))


def test_a_day_above_the_cap_is_an_error(spark):
    with pytest.raises(Exception, match="2026-01-05"):
        packed(spark, {dt.date(2026, 1, 5): CAP + 1}, (15,), CAP)


def test_rows_get_their_part_and_empty_ranges_keep_their_number(spark):
    rows = spark.range(60).select(
        F.date_add(F.lit(dt.date(2026, 9, 18)), (F.col("id") % 3).cast("int")).alias("SentOn"),
        F.when(F.col("id") < 50, F.lit("Online")).otherwise(F.lit("Offline")).alias("side"),
    )
    out = with_parts(rows, "SentOn", "side", (15,), 40)
    assert out.count() == 60
    found = {r["part_name"]: r["count"] for r in out.groupBy("part_name").count().collect()}
    # 17, 17 and 16 online rows on three days; the empty first half is part 1.
    assert found == {"2026 09 Sep Online (2)": 34, "2026 09 Sep Online (3)": 16, "2026 09 Sep Offline": 10}
    assert {r["sale_month"] for r in out.collect()} == {"2026-09"}


def test_a_single_part_has_no_number(spark):
    rows = spark.sql("SELECT date'2026-09-18' AS SentOn, 'Online' AS side")
    assert with_parts(rows, "SentOn", "side", ()).first()["part_name"] == "2026 09 Sep Online"


def test_offline_month_above_the_cap_is_an_error(spark):
    rows = spark.range(5).select(F.lit(dt.date(2026, 9, 1)).alias("SentOn"), F.lit("Offline").alias("side"))
    with pytest.raises(Exception, match="2026-09"):
        with_parts(rows, "SentOn", "side", (), 4).collect()
