"""Sources: column scans, CSV folders, sheet grids, file and source selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesflow.functions import named
from salesflow.operators.filters import month_bounds, quarter_scope, sale_window
from salesflow.session import new_folder
from salesflow.sources.files import (
    list_files, read_delimited_master, read_facts, read_text_csvs, select_files,
)
from salesflow.sources.grid import grid_to_table, visible_sheets
from salesflow.sources.zones import Zones, quarter_files, write_zoned
from workload import query
from workload.standins import CITY_SHEET, MARKET_ORDERS, MONTH, YEAR, table


@query("scan_projection", "SELECT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem")
def scan_projection(spark, sf_dir):
    return read_facts(
        spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"]
    )


CSV_NAME = "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN NULL ELSE c_name END"


@query(
    "csv_mixed_headers",
    f"""
    SELECT n_name AS "Province", {CSV_NAME} AS "City", CAST(c_custkey AS varchar) AS "Order",
           CASE WHEN c_custkey % 2 = 1 THEN 'line one' || chr(10) || 'say "x", y' END AS "Note"
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
def csv_mixed_headers(spark, sf_dir):
    """Two kinds of CSV files with shared columns in different order, stacked by name."""
    nation = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "customer").join(nation, F.expr("c_nationkey = n_nationkey"))
    city = F.expr("CASE WHEN c_custkey % 7 = 0 THEN 'N/A' WHEN c_custkey % 7 = 1 THEN '' ELSE c_name END")
    order = F.col("c_custkey").cast("string").alias("Order")
    province, city = F.col("n_name").alias("Province"), city.alias("City")
    note = F.lit('line one\nsay "x", y').alias("Note")
    folder = new_folder(spark, "csv")
    options = {"header": True, "quote": '"', "escape": '"'}
    rows.filter("c_custkey % 2 = 0").select(province, city, order).write.options(**options).csv(f"{folder}/a")
    rows.filter("c_custkey % 2 = 1").select(note, order, city, province).write.options(**options).csv(f"{folder}/b")
    return read_text_csvs(spark, list_files(spark, folder, ".csv")).select("Province", "City", "Order", "Note")


@query(
    "delimited_master",
    f"""
    SELECT "row_no"::varchar AS "row_no", "City", "ADM2_NAME (STANDARDIZED)" AS standard, "ADM1"
    FROM {CITY_SHEET.sql}
    """,
)
def delimited_master(spark, sf_dir):
    """A ``;``-separated master with padded header names."""
    folder = new_folder(spark, "master")
    sheet = CITY_SHEET.df(spark, sf_dir).withColumnsRenamed({"City": " City ", "ADM1": "ADM1 "})
    sheet.write.options(
        header=True, sep=";", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(folder)
    wanted = ["City", "ADM2_NAME (STANDARDIZED)", "ADM1"]
    master = read_delimited_master(spark, folder, ";", wanted)
    return master.select("row_no", "City", named(wanted[1]).alias("standard"), "ADM1")


def part_grid(spark, sf_dir) -> DataFrame:
    """Parts as sheet rows; every fifth row ends early."""
    cells = F.expr(
        "array('', p_name, cast(p_retailprice as string), cast(p_size as string), '', p_type)"
    )
    kinds = F.expr("array('empty', 'text', 'float', 'int', 'text', 'text')")
    short = F.col("p_partkey") % 5 == 0
    return table(spark, sf_dir, "part").select(
        F.lit("1. Parts.xlsx").alias("source_file"),
        F.lit("Product").alias("sheet"),
        F.lit(0).alias("sheet_no"),
        F.lit("visible").alias("sheet_state"),
        F.col("p_partkey").cast("int").alias("row_no"),
        F.when(short, F.slice(cells, 1, 3)).otherwise(cells).alias("cells"),
        F.when(short, F.slice(kinds, 1, 3)).otherwise(kinds).alias("cell_types"),
    )


@query(
    "grid_positional_select",
    """
    SELECT CAST(p_partkey AS int) AS row_no, p_name AS item, CAST(NULL AS varchar) AS nothing,
           CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS bigint) AS varchar)
                ELSE CAST(p_retailprice AS varchar) END AS price,
           CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS kind
    FROM part WHERE p_partkey >= 3
    """,
)
def grid_positional_select(spark, sf_dir):
    return grid_to_table(part_grid(spark, sf_dir), {"item": 1, "nothing": 0, "price": 2, "kind": 5}, skip=3)


@query(
    "sheet_filter",
    """
    SELECT o_orderkey FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
    """,
)
def sheet_filter(spark, sf_dir):
    sheets = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("CASE WHEN o_orderpriority = '5-LOW' THEN ' Master_Data ' ELSE o_orderpriority END").alias("sheet"),
        F.expr("CASE WHEN o_orderstatus = 'P' THEN 'hidden' ELSE 'visible' END").alias("sheet_state"),
    )
    return visible_sheets(sheets).select("o_orderkey")


@query(
    "file_name_filter",
    r"""
    SELECT page_id, url FROM pages
    WHERE regexp_matches(url, '^https://.+/\d+') AND contains(lower(url), 'example')
      AND NOT contains(lower(url), 'blog') AND NOT contains(lower(url), '#top')
    """,
)
def file_name_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return select_files(pages, "url", include=r"^https://.+/\d+", keyword="Example", exclude=["Blog", "#top"])


QUARTER_TAGS = ["98 07 Jul", "98 08 Aug", "98 09 Sep", "98 06 Jun (3)"]


QUARTER_SQL = f"""
    SELECT "Order Number" AS order_number, "Source" AS source FROM {MARKET_ORDERS.sql}
    WHERE regexp_matches("Source", '{"|".join(t.replace("(", "[(]").replace(")", "[)]") for t in QUARTER_TAGS)}', 'i')
      AND contains(upper("Source"), 'REPORT') AND NOT contains("Source", '$')
    """


def quarter(spark, sf_dir, list_up_to=None):
    scoped = quarter_scope(MARKET_ORDERS.df(spark, sf_dir), "Source", YEAR, MONTH, list_up_to)
    return scoped.select(named("Order Number").alias("order_number"), named("Source").alias("source"))


@query("quarter_scope", QUARTER_SQL)
def scope_of_quarter(spark, sf_dir):
    return quarter(spark, sf_dir)


@query("quarter_scope_listed", QUARTER_SQL)
def listed_scope_of_quarter(spark, sf_dir):
    """The file names listed first, so that the scan gets an IN list."""
    return quarter(spark, sf_dir, 1000)


@query("quarter_scope_zoned", QUARTER_SQL)
def zoned_scope_of_quarter(spark, sf_dir):
    """The orders written by source with a zone map, which tells the files to open."""
    path = new_folder(spark, "zoned")
    write_zoned(MARKET_ORDERS.df(spark, sf_dir).select("Source", "Order Number"), path, ["Source"], files=24)
    zones = Zones(spark, path)
    scoped = quarter_scope(zones.scan(quarter_files(zones, YEAR, MONTH)), "Source", YEAR, MONTH)
    return scoped.select(named("Order Number").alias("order_number"), named("Source").alias("source"))


@query(
    "sale_window",
    """
    SELECT l_orderkey, l_linenumber, l_quantity FROM (
        SELECT *, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_shipdate END AS sent FROM lineitem
    ) JOIN orders ON l_orderkey = o_orderkey
    WHERE coalesce(sent, o_orderdate) >= DATE '1998-07-01' AND coalesce(sent, o_orderdate) < DATE '1998-08-01'
    """,
)
def window_of_sale(spark, sf_dir):
    lo, _ = month_bounds(YEAR, MONTH)
    end, _ = month_bounds(YEAR, MONTH + 1)
    lines = table(spark, sf_dir, "lineitem").withColumn("sent", F.expr("CASE WHEN l_linenumber = 1 THEN NULL ELSE l_shipdate END"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    rows = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return rows.filter(sale_window("sent", "o_orderdate", lo, end)).select("l_orderkey", "l_linenumber", "l_quantity")
