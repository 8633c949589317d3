"""What large tables cost: joins run once, dates worked out once, zone maps without a sort."""

import datetime as dt
import re

from pyspark.sql import DataFrameWriter, functions as F

from salesflow.functions.dates import parse_date
from salesflow.operators.filters import in_days, in_months, month_bounds
from salesflow.sources.zones import ZONES, write_zones
from workload.checks import promotion_by_footers


def test_releases_are_joined_once(spark, tmp_path, monkeypatch):
    day = "date_add(date'2001-05-01', cast(id % 60 AS int))"
    spark.range(100).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", f"{day} AS o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(7).selectExpr("id AS c_custkey", "'BUILDING' AS c_mktsegment", "id AS c_nationkey", "'n' AS c_name").write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(400).selectExpr(
        "id % 100 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "id % 7 AS l_linenumber", f"{day} AS l_shipdate",
        "id AS l_quantity", "id AS l_extendedprice",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    read, write = [], DataFrameWriter.parquet

    def seen(self, path, *args, **options):
        read.append(self._df.inputFiles())
        return write(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    found = promotion_by_footers(spark, str(tmp_path)).collect()
    assert sorted(r["rule"] for r in found) == ["dropped", "newest", "rows", "unexpected"]
    assert sum(any("lineitem" in f for f in files) for files in read) == 1 and len(read) == 2


def test_days_of_months_are_worked_out_once(spark):
    texts = spark.createDataFrame([("2026-07-01",), ("31/08/2026",), ("2026-06-30 23:59:59",), ("2026-09-01",), ("2025-07-15",), ("bad",), (None,)], "t string")
    days = texts.select("t", parse_date("t").alias("SentOn"))
    months = [(2026, 7), (2026, 8)]
    found = days.filter(in_months(days, "SentOn", months))
    assert {r["t"] for r in found.collect()} == {"2026-07-01", "31/08/2026"}
    plan = days.filter(in_months(days, "SentOn", months)).select("t")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"rlike|RLIKE", plan)) == 1
    moments = texts.select(F.lit(dt.datetime(2026, 7, 31, 12)).cast("timestamp_ntz").alias("SentOn")).limit(1)
    assert moments.filter(in_months(moments, "SentOn", months[:1])).count() == moments.filter(in_days("SentOn", *month_bounds(2026, 7))).count()


def test_zone_maps_sort_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    spark.range(900).selectExpr("concat('s', id % 9) AS s", "nullif(id, 5) AS n").repartition(3).write.parquet(path)
    plans, write = [], DataFrameWriter.parquet

    def seen(self, path, *args, **options):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    write_zones(spark, path, ["s", "n"])
    assert len(plans) == 1 and "Sort" not in plans[0]
    zones = spark.read.parquet(f"{path}/{ZONES}").collect()
    assert [(z["cols"], z["low_0"], z["high_0"], z["nulls_0"]) for z in zones] == [(["s", "n"], "s0", "s8", 0)] * 3
    assert sum(z["rows"] for z in zones) == 900 and sum(z["nulls_1"] for z in zones) == 1
