"""Figures from footers and stored states, months to rebuild, zone maps, first rows by place."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesflow.operators.compare import multiset_compare, uneven_groups
from salesflow.operators.masters import first_by_place, keep_first
from salesflow.plans.figures import (
    FIGURES, merged_figures, month_figures, stored_figures, stored_units, version_compare,
)
from salesflow.plans.quality import file_updates, freshness, promotion_check, promotion_check_files
from salesflow.plans.rebuild import aged_months, touched_months
from salesflow.sources.files import file_place
from salesflow.sources.footers import footer_figures, read_footers
from salesflow.sources.releases import publish, read_months, write_months_aside
from salesflow.sources.zones import Zones, quarter_files, write_zoned


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def release(spark):
    return spark.range(1000).select(
        F.expr("date_add(date'2026-01-01', cast(id % 90 AS int))").alias("SentOn"), F.col("id").cast("string").alias("NoPesanan"),
        (F.col("id") % 7).alias("Quantity"), F.lit(1).cast("long").alias("Qty Sales"), F.lit(2).cast("long").alias("Revenue"),
        F.lit(0).cast("long").alias("Qty Return"), F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("ReportSource"),
        F.when(F.col("id") % 3 == 0, "E-COMMERCE").otherwise("GENERAL").alias("Channel"),
    ).withColumn("sale_month", F.date_format("SentOn", "yyyy-MM"))


# footers


def test_footers_answer_without_a_scan(spark, release, tmp_path):
    path = str(tmp_path / "t")
    release.repartition(3).write.parquet(path)
    plan = footer_figures(spark, path, "SentOn")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MAX(SentOn)]" in plan and "ReadSchema: struct<count(*):bigint,max(SentOn):date>" in plan
    assert read_footers(spark, path, "SentOn") == (1000, dt.date(2026, 3, 31))
    assert read_footers(spark, path, "gone") == (1000, None)
    assert read_footers(spark, [path, path])[0] == 2000 and read_footers(spark, []) == (0, None)
    assert "BatchScan" not in spark.read.parquet(path)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keep", ["true", "SentOn < '2026-03-01'", "false"])
def test_promotion_check_by_footers_agrees_with_the_scan(spark, release, tmp_path, keep):
    new = release.filter(keep).drop("Revenue").withColumns({"Note": F.lit("x"), "Extra": F.lit(1)})
    paths = [str(tmp_path / n) for n in ("new", "old")]
    new.write.parquet(paths[0])
    release.write.parquet(paths[1])
    assert rows(promotion_check_files(spark, *paths, allowed=["Extra"])) == rows(promotion_check(new, release, ["Extra"]))
    assert promotion_check_files(spark, paths[1], None).count() == 0


def test_updates_from_the_files_themselves(spark, release, tmp_path):
    release.limit(3).write.parquet(str(tmp_path / "erp"))
    updates = file_updates(spark, {"erp": str(tmp_path / "erp")})
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    fresh = freshness(updates, {"erp": dt.timedelta(hours=1), "stock": dt.timedelta(hours=1)}, now + dt.timedelta(minutes=1))
    assert {r["dataset"]: r["stale"] for r in fresh.collect()} == {"erp": False, "stock": True}


# stored figures


def test_figures_merge(release):
    fine = month_figures(release)
    assert fine.count() == 12
    merged = {r["ReportSource"]: r for r in merged_figures(fine, ["ReportSource"]).collect()}
    whole = {r["ReportSource"]: r for r in release.groupBy("ReportSource").agg(
        F.count("*").alias("rows"), F.sum("Quantity").alias("q"), F.max("SentOn").alias("newest"), F.count_distinct("NoPesanan").alias("orders")
    ).collect()}
    for source, want in whole.items():
        got = merged[source]
        assert (got["rows"], got["Quantity"], got["newest"]) == (want["rows"], want["q"], want["newest"])
        assert abs(got["orders"] - want["orders"]) <= 0.1 * want["orders"]
    assert fine.agg(F.sum("orders")).first()[0] == 1000


def test_guards_read_figures_and_rebuilt_months_alone(spark, release, tmp_path):
    path = str(tmp_path / "store")
    publish(spark, path, *(write_months_aside(df, path, t, "sale_month") for t, df in (("history", release), (FIGURES, month_figures(release)))))
    rebuilt = release.filter("sale_month = '2026-02'").withColumn("Quantity", F.col("Quantity") + 1)
    history = write_months_aside(rebuilt, path, "history", "sale_month")
    publish(spark, path, history, write_months_aside(month_figures(rebuilt), path, FIGURES, "sale_month"))
    figures = stored_figures(spark, path)
    assert all("/data/figures/" in f for f in figures.inputFiles())
    assert {f.split("run=")[0].split("sale_month=")[1].strip("/") for f in stored_figures(spark, path, months=["2026-02"]).inputFiles()} == {"2026-02"}
    units = {r["ym"]: r["actual"] for r in stored_units(figures, "A").collect()}
    now = read_months(spark, path, "history").filter("ReportSource = 'A' AND Channel = 'E-COMMERCE'")
    assert units == {r["sale_month"]: r["q"] for r in now.groupBy("sale_month").agg(F.sum("Quantity").alias("q")).collect()}
    compared = version_compare(figures, stored_figures(spark, path, 1)).collect()
    assert {(r["sale_month"], r["status"]) for r in compared} == {("2026-01", "MATCH"), ("2026-02", "DIFF"), ("2026-03", "MATCH")}


# months to rebuild


ORDERS = "Source string, `Order Status` string, SentOn timestamp_ntz, CreatedOn timestamp_ntz, n int"


def order_rows(spark, *lines):
    days = [(s, status, *(None if d is None else dt.datetime.fromisoformat(d) for d in (sent, created)), n) for s, status, sent, created, n in lines]
    return spark.createDataFrame(days, ORDERS)


def test_lines_age_in_exactly_at_the_limit(spark):
    lines = [("s", "DISPATCHED", f"2026-0{m}-{d:02d}T10:00:00", None, 1) for m, d in ((1, 31), (2, 1), (2, 15), (3, 1), (3, 2))]
    orders = order_rows(spark, *lines, ("s", "DELIVERED", "2026-04-01", None, 1), ("s", "DISPATCHED", None, "2026-02-10", 1), ("s", "DISPATCHED", None, None, 1))

    def months(before, after):
        return {r["ym"] for r in aged_months(orders, before, after).collect()}

    assert months(dt.date(2026, 2, 14), dt.date(2026, 2, 15)) == {"2026-02"}
    assert months(dt.date(2026, 2, 13), dt.date(2026, 2, 14)) == {"2026-01"}
    assert months(dt.date(2026, 2, 13), dt.date(2026, 3, 15)) == {"2026-01", "2026-02", "2026-03"}
    assert months(dt.date(2026, 3, 15), dt.date(2026, 2, 13)) == {"2026-01", "2026-02", "2026-03"}
    assert months(dt.date(2026, 2, 14), dt.date(2026, 2, 14)) == set()


def test_touched_months_agree_with_a_full_diff(spark):
    old = order_rows(
        spark, ("a", "DELIVERED", "2026-01-05", None, 1), ("a", "DELIVERED", "2026-02-05", None, 1), ("b", "DELIVERED", "2026-03-05", None, 1),
        ("b", "DISPATCHED", "2026-05-20", None, 1), ("c", "DELIVERED", "2026-04-01", None, 1), (None, "DELIVERED", "2026-06-01", None, 1),
        ("d", "CANCELLED", "2026-07-01", None, 1), ("d", "DELIVERED", None, None, 1),
    )
    new = old.filter("NOT (Source <=> 'c')").withColumn(
        "n", F.when((F.col("Source") == "a") & (F.col("SentOn") >= "2026-02-01"), 2).when(F.col("Source") == "d", 9).otherwise(F.col("n"))
    )
    got = touched_months(old, new, dt.date(2026, 6, 1), dt.date(2026, 6, 5), ["Source", "SentOn", "n"])
    assert {r["ym"] for r in got.collect()} == {"2026-02", "2026-04", "2026-05"}
    assert touched_months(old, old, dt.date(2026, 6, 1), dt.date(2026, 6, 1), ["n"]).count() == 0


# comparisons by buckets


def test_swapped_nulls_are_a_difference(spark):
    a = spark.sql("SELECT * FROM VALUES ('x', null), ('k', 'k') AS t(p, q)")
    b = spark.sql("SELECT * FROM VALUES (null, 'x'), ('k', 'k') AS t(p, q)")
    assert rows(multiset_compare(a, b)) == Counter([("x", None, 1, 0), (None, "x", 0, 1)])
    assert uneven_groups(a, b.filter("false"), ["p"]).count() == 2


@pytest.mark.parametrize("by", [None, "g"])
def test_compare_agrees_with_counting(spark, by):
    a = spark.range(4000).selectExpr("nullif(id % 13, 5) AS g", "id % 97 AS v", "CASE WHEN id % 11 = 0 THEN null ELSE 'x' END AS w")
    b = a.withColumn("v", F.when((F.col("g") == 3) & (F.col("v") % 10 == 0), 1000).when(F.col("g").isNull() & (F.col("v") == 1), 7).otherwise(F.col("v"))).union(a.limit(1))
    got = Counter({tuple(r)[:3]: r["a_rows"] - r["b_rows"] for r in multiset_compare(a, b, by).collect()})
    left, right = rows(a), rows(b)
    text = lambda r: tuple(None if x is None else str(x) for x in r)
    want = {text(k): left[k] - right[k] for k in {*left, *right} if left[k] != right[k]}
    assert dict(got) == want


def test_equal_tables_are_not_scanned_again(spark):
    a = spark.range(1000).selectExpr("id % 5 AS g", "id AS v")
    same = multiset_compare(a, a.orderBy(F.desc("v")), "g")
    assert same.count() == 0
    assert "Range" not in same._jdf.queryExecution().optimizedPlan().toString()


# zone maps


def test_zones_skip_files_and_keep_rows(spark, tmp_path):
    path = str(tmp_path / "orders of 26%")
    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    names = [f"26 {i + 1:02d} {m} ({p}) Report.xlsx" for i, m in enumerate(months) for p in (1, 2, 3)]
    orders = spark.range(3600).select(
        F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("id") % 36 + 1).cast("int")).alias("Source"),
        F.expr("date_add(date'2026-01-01', cast(id % 360 AS int))").alias("day"), "id",
    ).withColumn("Source", F.when(F.col("id") % 50 != 0, F.col("Source")))
    write_zoned(orders, path, ["Source", "day"], files=90)
    zones = Zones(spark, path)
    assert spark.read.parquet(path).count() == 3600  # the map is no part of the table
    from salesflow.operators.filters import quarter_scope

    scanned = zones.scan(quarter_files(zones, 2026, 8))
    assert len(scanned.inputFiles()) < len(spark.read.parquet(path).inputFiles())
    assert rows(quarter_scope(scanned, "Source", 2026, 8)) == rows(quarter_scope(orders, "Source", 2026, 8))
    lo, hi = dt.date(2026, 2, 1), dt.date(2026, 2, 5)
    some = zones.scan(zones.meets("day", lo, hi)).filter(F.col("day").between(lo, hi))
    assert rows(some) == rows(orders.filter(F.col("day").between(lo, hi)))
    assert zones.scan(zones.meets("day", dt.date(2030, 1, 1))).count() == 0
    nulls = zones.scan(zones.meets("Source", "zzz", None, or_null=True)).filter("Source IS NULL")
    assert nulls.count() == 72


# first rows by place


@pytest.mark.parametrize("limit", [10_000_000, -1])
def test_first_by_place(spark, broadcast_below, limit):
    broadcast_below(limit)
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),
        (5000 - F.col("id")).alias("place"), F.concat(F.lit("v"), "id").alias("v"),
    )
    assert rows(first_by_place(df, ["k"], "place")) == rows(keep_first(df, ["k"], ["place"]))
    with pytest.raises(ValueError, match="no whole number"):
        first_by_place(df, ["k"], "v")


def test_places_are_grouped_by_hashing(spark, tmp_path):
    path = str(tmp_path / "sheet.csv")
    lines = [f"k{i % 7},v{i}" for i in range(3000)]
    (tmp_path / "sheet.csv").write_text("k,v\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        sheet = spark.read.csv(path, header=True).withColumn("place", file_place())
        assert sheet.rdd.getNumPartitions() > 4
        grouped = sheet.groupBy("k").agg(F.min("place").alias("place"))
        plan = grouped._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan
        assert rows(first_by_place(sheet, ["k"], "place").select("k", "v")) == Counter((f"k{i}", f"v{i}") for i in range(7))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
