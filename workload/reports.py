"""Cleaned feeds, the monthly report, history, coverage and the sell-through table."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from salesflow.functions import named
from salesflow.operators.masters import marketplace_channels, product_master_upper
from salesflow.operators.packing import pack_days
from salesflow.operators.shape import union_all, union_relaxed
from salesflow.operators.summary import day_counts
from salesflow.plans.chain import build_months, release_months
from salesflow.plans.coverage import coverage_sales, write_coverage_sales
from salesflow.plans.history import combined, read_history, save_months, seed_history
from salesflow.plans.marketplace import Masters, marketplace_month
from salesflow.plans.sell_in import (
    clean_accounting, clean_erp, clean_stock, lost_marketplace, marketplace_rows, month_report,
    month_rows, offline_base,
)
from salesflow.plans.sell_through import compile_sheets
from salesflow.schemas import HISTORY_DATES
from salesflow.session import new_folder
from salesflow.sources.files import list_files
from salesflow.sources.releases import read_months, write_months_aside
from workload import query
from workload.masters import (
    AREA_SQL, CHANNEL_SQL, POSTCODE_SQL, PRODUCT_SQL, areas, channels, postcodes, products,
)
from workload.standins import (
    ACCOUNTING, AS_OF, ERP, ERP_FIRST_DAY, HISTORY, ITEM_SHEET, MARKET_CHANNEL_SHEET, MARKET_FACTS,
    MARKET_ORDERS, MONTH, STOCK, YEAR, date_sql, int_sql, round_sql, spark_sale_day, table,
)


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, so that both engines print them alike."""
    kinds = (DateType, TimestampType, TimestampNTZType)
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
    return df.withColumns({n: named(n).cast("date").cast("string") for n in names}) if names else df


def iso_sql(sql: str, *dates: str) -> str:
    shown = ", ".join(f'"{d}"::date::varchar AS "{d}"' for d in dates)
    return f"SELECT * REPLACE ({shown}) FROM {sql}"


STOCK_SQL = f"""(
    SELECT {date_sql('"CreatedOn"')} AS "CreatedOn", {date_sql('"SentOn"')} AS "SentOn",
           upper("SalesType") AS "SalesType", upper("City") AS "City",
           CAST(CAST("NoPesanan" AS bigint) AS varchar) AS "NoPesanan", upper("CustomerName") AS "CustomerName",
           upper("ItemName") AS "ItemName", {round_sql('"Quantity"')} AS "Quantity", 'STOCK' AS "ReportSource"
    FROM {STOCK.sql})"""

ERP_SQL = f"""(
    SELECT * FROM (
        SELECT "CreatedOn", upper("CustomerLevel1") AS "SalesType", upper("CustomerLevel2") AS "SubSalesType",
               upper(replace("CustomerState", ' (ID)', '')) AS "Province", upper("CustomerCity") AS "City",
               upper("CustomerName") AS "CustomerName", upper("ItemName") AS "ItemName",
               upper("OrderReference") AS "NoPesanan", {date_sql('"SentOn"')} AS "SentOn",
               upper("Delivery Status") AS "Status", "Payment Terms", {round_sql('"Quantity"')} AS "Quantity",
               "Customer & Address", "InvoiceOn", 'ERP' AS "ReportSource"
        FROM {ERP.sql} WHERE NOT contains("Checked", 'Reported'))
    WHERE "SentOn" >= DATE '{ERP_FIRST_DAY}')"""

ACCOUNTING_SQL = f"""(
    SELECT "CreatedOn"::date AS "CreatedOn", "SentOn", "SO Number", upper("DO Number") AS "NoPesanan",
           upper("Sales Type") AS "SalesType", upper("Customer") AS "CustomerName", "Province", upper("City") AS "City",
           upper("Item Name") AS "ItemName", "Qty Sales", "Revenue", "Qty Return",
           {round_sql('"Quantity"')} AS "Quantity", 'ACCOUNTING' AS "ReportSource"
    FROM {ACCOUNTING.sql} WHERE upper("Customer") NOT LIKE '%EMPLOYE%')"""


def stock(spark, sf_dir):
    return clean_stock(STOCK.df(spark, sf_dir), "Stock")


def erp(spark, sf_dir):
    return clean_erp(ERP.df(spark, sf_dir), "erp", ERP_FIRST_DAY)


def accounting(spark, sf_dir):
    return clean_accounting(ACCOUNTING.df(spark, sf_dir), "ACCOUNTING")


@query("clean_source_a", iso_sql(STOCK_SQL, "CreatedOn", "SentOn"))
def clean_source_a(spark, sf_dir):
    return dates_as_text(stock(spark, sf_dir))


@query("clean_source_b", iso_sql(ERP_SQL, "CreatedOn", "SentOn", "InvoiceOn"))
def clean_source_b(spark, sf_dir):
    return dates_as_text(erp(spark, sf_dir))


@query("clean_source_c", iso_sql(ACCOUNTING_SQL, "CreatedOn", "SentOn"))
def clean_source_c(spark, sf_dir):
    return dates_as_text(accounting(spark, sf_dir))


@query(
    "offline_union",
    f"""
    SELECT CAST(CAST("NoPesanan" AS bigint) AS varchar) AS number, "City" AS city, "Quantity" AS quantity,
           NULL::varchar AS sent, NULL::double AS revenue FROM {STOCK.sql}
    UNION ALL SELECT "OrderReference", NULL, "Quantity", "SentOn", NULL FROM {ERP.sql}
    UNION ALL SELECT CAST("SO Number" AS varchar), "City", CAST("Qty Sales" AS double), CAST("SentOn" AS varchar),
                     "Revenue" FROM {ACCOUNTING.sql}
    """,
)
def offline_union(spark, sf_dir):
    """Raw feeds stacked by name: double, text and whole order numbers meet, text and dates too."""
    a = STOCK.df(spark, sf_dir).select(
        named("NoPesanan").alias("number"), named("City").alias("city"), named("Quantity").alias("quantity")
    )
    b = ERP.df(spark, sf_dir).select(
        named("OrderReference").alias("number"), named("Quantity").alias("quantity"), named("SentOn").alias("sent")
    )
    c = ACCOUNTING.df(spark, sf_dir).select(
        named("SO Number").alias("number"), named("City").alias("city"), named("SentOn").alias("sent"),
        named("Qty Sales").alias("quantity"), named("Revenue").alias("revenue"),
    )
    return union_relaxed(a, b, c)


BASE_SQL = f"""(
    SELECT f.*, p."Brand", p."Category", p."SubCategory", p."Variant", p."Product Name", p."Type of Item",
           a."Region", c."Channel Group", c."Channel", c."Sub Channel"
    FROM (SELECT * FROM {STOCK_SQL} UNION ALL BY NAME SELECT * FROM {ERP_SQL}
          UNION ALL BY NAME SELECT * FROM {ACCOUNTING_SQL}) f
    LEFT JOIN {PRODUCT_SQL} p ON p."ItemName" IS NOT DISTINCT FROM f."ItemName"
    LEFT JOIN {AREA_SQL} a ON a."Province" IS NOT DISTINCT FROM f."Province"
    LEFT JOIN {CHANNEL_SQL} c ON c."SalesType" IS NOT DISTINCT FROM f."SalesType"
        AND c."SubSalesType" IS NOT DISTINCT FROM f."SubSalesType")"""


def base(spark, sf_dir):
    feeds = [stock(spark, sf_dir), erp(spark, sf_dir), accounting(spark, sf_dir)]
    return offline_base(feeds, products(spark, sf_dir), areas(spark, sf_dir), channels(spark, sf_dir))


@query("offline_base", iso_sql(BASE_SQL, "CreatedOn", "SentOn", "InvoiceOn"))
def offline_base_query(spark, sf_dir):
    return dates_as_text(base(spark, sf_dir))


MARKET_CHANNEL_SQL = f"""(
    SELECT "Channel Group", trim("SalesType") AS "SalesType", "Channel", "Sub Channel" FROM {MARKET_CHANNEL_SHEET.sql})"""
ITEM_SQL = f"""(
    SELECT upper("ItemName") AS "ItemName", upper("Brand") AS "Brand", upper("Category") AS "Category",
           upper("SubCategory") AS "Sub Category", upper("Variant") AS "Variant",
           upper("Product Name") AS "Product Name", upper("Type of Item") AS "Type of Item" FROM {ITEM_SHEET.sql})"""
MARKET_SQL = f"""(
    SELECT * FROM (
        SELECT "CreatedOn"::date AS "CreatedOn", {spark_sale_day()} AS "SentOn", s."SalesType",
               "Order Number" AS "NoPesanan", s."ItemName", {int_sql('"Ordered Quantity"')} AS "Quantity",
               {int_sql('"Unit Price"')} AS "Unit Price", coalesce(k."Province", '-') AS "Province",
               coalesce(k."City", '-') AS "City", c."Channel Group", c."Channel", c."Sub Channel", p."Brand",
               p."Category", p."Sub Category", p."Variant", p."Product Name", p."Type of Item"
        FROM (SELECT *, coalesce(nullif(trim("Shipping Postcode"), ''), '-') AS code, upper("Item Name") AS "ItemName",
                     upper(replace(CASE WHEN strpos("Marketplace", '_') > 0
                         THEN substr("Marketplace", strpos("Marketplace", '_') + 1) ELSE '' END, 'NEXUS', 'ENDORSE'))
                         AS "SalesType"
              FROM {MARKET_ORDERS.sql}
              WHERE trim("Order Status") = 'DELIVERED'
                 OR (trim("Order Status") = 'DISPATCHED' AND {spark_sale_day()} <= DATE '{AS_OF}' - 14)) s
        LEFT JOIN {POSTCODE_SQL} k ON k."Kode Pos" = s.code
        LEFT JOIN {MARKET_CHANNEL_SQL} c ON c."SalesType" = s."SalesType"
        LEFT JOIN {ITEM_SQL} p ON p."ItemName" IS NOT DISTINCT FROM s."ItemName")
    WHERE ("Type of Item" IS NULL OR "Type of Item" IN ('ACTIVITY', 'REGULER'))
      AND "SentOn" BETWEEN DATE '{YEAR}-{MONTH:02d}-01' AND last_day(DATE '{YEAR}-{MONTH:02d}-01'))"""
ITEM_COLUMNS = ["ItemName", "Brand", "Category", "SubCategory", "Variant", "Product Name", "Type of Item"]


def market_masters(spark, sf_dir) -> Masters:
    return Masters(
        postcodes(spark, sf_dir),
        marketplace_channels(MARKET_CHANNEL_SHEET.df(spark, sf_dir)),
        product_master_upper(ITEM_SHEET.df(spark, sf_dir), ITEM_COLUMNS),
    )


def market(spark, sf_dir):
    return marketplace_month(MARKET_ORDERS.df(spark, sf_dir), market_masters(spark, sf_dir), YEAR, MONTH, AS_OF)


@query("marketplace_month", iso_sql(MARKET_SQL, "CreatedOn", "SentOn"))
def marketplace_month_query(spark, sf_dir):
    return dates_as_text(market(spark, sf_dir))


ROWS_SQL = f"""(
    SELECT "CreatedOn", "SentOn", "NoPesanan", "SalesType", "SubSalesType", "Channel Group", "Channel", "Sub Channel",
           "Region", "Province", "City", "CustomerName", "Payment Terms", "Customer & Address", "InvoiceOn",
           "SO Number", "Qty Sales", "Revenue", "Qty Return", "ReportSource", "ItemName", "Quantity", "Status", "Brand",
           "Category", "SubCategory", "Variant", "Product Name", "Type of Item",
           CASE WHEN "Channel Group" = 'ONLINE' THEN 'Online' ELSE 'Offline' END AS side
    FROM (SELECT *, true AS own FROM {BASE_SQL} UNION ALL BY NAME
          SELECT * EXCLUDE ("Unit Price", "Sub Category"), "Sub Category" AS "SubCategory",
                 "SalesType" AS "CustomerName", 'MARKET' AS "ReportSource", false AS own FROM {MARKET_SQL})
    WHERE "SentOn" BETWEEN DATE '{YEAR}-{MONTH:02d}-01' AND last_day(DATE '{YEAR}-{MONTH:02d}-01')
      AND (own OR "Channel Group" = 'ONLINE'))"""


def marketplace_in_report(spark, sf_dir):
    return marketplace_rows(market(spark, sf_dir), "market")


@query("monthly_split", iso_sql(ROWS_SQL, "CreatedOn", "SentOn", "InvoiceOn"))
def monthly_split(spark, sf_dir):
    return dates_as_text(month_rows(base(spark, sf_dir), marketplace_in_report(spark, sf_dir), YEAR, MONTH))


@query(
    "month_report",
    f"""
    SELECT "NoPesanan", "SentOn"::varchar AS "SentOn", "ReportSource", "Quantity", '{YEAR}-{MONTH:02d}' AS sale_month,
           CASE WHEN side = 'Offline' THEN '1998 07 Jul Offline' WHEN day("SentOn") <= 10 THEN '1998 07 Jul Online (1)'
                WHEN day("SentOn") <= 20 THEN '1998 07 Jul Online (2)' ELSE '1998 07 Jul Online (3)' END AS part_name
    FROM {ROWS_SQL}
    """,
)
def month_report_query(spark, sf_dir):
    """A month's rows with their parts; without a capacity, only split days cut."""
    rows = month_report(base(spark, sf_dir), marketplace_in_report(spark, sf_dir), YEAR, MONTH, split_days=(10, 20))
    return dates_as_text(rows.select("NoPesanan", "SentOn", "ReportSource", "Quantity", "sale_month", "part_name"))


@query(
    "lost_marketplace",
    f"""
    SELECT "SalesType", count(*) AS rows, CAST(sum("Quantity") AS bigint) AS units FROM {MARKET_SQL}
    WHERE "Channel Group" IS DISTINCT FROM 'ONLINE' GROUP BY "SalesType"
    """,
)
def lost_rows(spark, sf_dir):
    return lost_marketplace(market(spark, sf_dir))


@query(
    "report_parts",
    """
    WITH RECURSIVE days AS (
        SELECT date_trunc('month', o_orderdate)::date AS month, o_orderdate::date AS day, count(*) AS n
        FROM orders GROUP BY ALL),
    ranges AS (
        SELECT DISTINCT month, unnest([month, month + 15]) AS lo, unnest([month + 14, last_day(month)]) AS hi FROM days),
    ranked AS (
        SELECT r.month, r.lo, r.hi, d.day, d.n, row_number() OVER (PARTITION BY r.lo ORDER BY d.day) AS rk
        FROM ranges r JOIN days d ON d.month = r.month AND d.day BETWEEN r.lo AND r.hi),
    cap AS (SELECT 4 * max(n) AS c FROM days),
    filled AS (
        SELECT month, lo, hi, rk, lo AS part_lo, n AS acc FROM ranked WHERE rk = 1
        UNION ALL
        SELECT k.month, k.lo, k.hi, k.rk, CASE WHEN f.acc + k.n > c THEN k.day ELSE f.part_lo END,
               CASE WHEN f.acc + k.n > c THEN k.n ELSE f.acc + k.n END
        FROM filled f JOIN ranked k ON k.lo = f.lo AND k.rk = f.rk + 1, cap),
    parts AS (SELECT lo, part_lo, max(acc) AS rows FROM filled GROUP BY ALL),
    whole AS (
        SELECT r.month, r.lo AS range_lo, r.hi, coalesce(p.part_lo, r.lo) AS part_lo, coalesce(p.rows, 0) AS rows
        FROM ranges r LEFT JOIN parts p ON p.lo = r.lo)
    SELECT month::varchar AS month, row_number() OVER (PARTITION BY month ORDER BY part_lo) AS part_no,
           part_lo::varchar AS lo,
           (coalesce(lead(part_lo) OVER (PARTITION BY range_lo ORDER BY part_lo) - 1, hi))::date::varchar AS hi,
           CAST(rows AS bigint) AS rows, count(*) OVER (PARTITION BY month) AS part_count
    FROM whole
    """,
)
def report_parts(spark, sf_dir):
    """Fewest parts of whole days per half month, four busy days filling one part."""
    counts = day_counts(table(spark, sf_dir, "orders"), "o_orderdate")
    cap = 4 * counts.agg(F.max("n")).first()[0]
    return dates_as_text(pack_days(counts, (15,), cap))


@query(
    "report_parts_uncapped",
    """
    WITH days AS (SELECT date_trunc('month', o_orderdate)::date AS month, o_orderdate::date AS day FROM orders),
    ranges AS (
        SELECT DISTINCT month, unnest([1, 2]) AS part_no, unnest([month, month + 15]) AS lo,
               unnest([month + 14, last_day(month)]) AS hi FROM days)
    SELECT r.month::varchar AS month, CAST(part_no AS bigint) AS part_no, lo::varchar AS lo, hi::varchar AS hi,
           count(day) AS rows, CAST(2 AS bigint) AS part_count
    FROM ranges r LEFT JOIN days d ON d.month = r.month AND day BETWEEN lo AND hi GROUP BY ALL
    """,
)
def report_parts_uncapped(spark, sf_dir):
    """Half months whole, however many rows they hold."""
    return dates_as_text(pack_days(day_counts(table(spark, sf_dir, "orders"), "o_orderdate")))


TWO_MONTHS_SQL = ROWS_SQL.replace(f"last_day(DATE '{YEAR}-{MONTH:02d}-01')", f"last_day(DATE '{YEAR}-{MONTH + 1:02d}-01')")
SPLIT_SQL = "CASE WHEN side = 'Offline' THEN '' WHEN day(\"SentOn\") <= 15 THEN ' (1)' ELSE ' (2)' END"


@query(
    "build_two_months",
    f"""
    WITH r AS (SELECT *, strftime("SentOn", '%Y-%m') AS sale_month,
                      strftime("SentOn", '%Y %m %b') || ' ' || side || {SPLIT_SQL} AS part_name FROM {TWO_MONTHS_SQL})
    SELECT 'report' AS kept_in, sale_month, part_name, "ReportSource" AS source, count(*) AS rows,
           CAST(coalesce(sum("Quantity"), 0) AS bigint) AS units FROM r GROUP BY ALL
    UNION ALL SELECT 'history', sale_month, NULL, "ReportSource", count(*), CAST(coalesce(sum("Quantity"), 0) AS bigint)
    FROM r GROUP BY ALL
    """,
)
def build_two_months(spark, sf_dir):
    """Two months built in one run, one of them twice, read back from the written report and history."""
    report, history = new_folder(spark, "report"), new_folder(spark, "history")
    for months in ([(YEAR, MONTH)], [(YEAR, MONTH), (YEAR, MONTH + 1)]):
        build_months(
            base(spark, sf_dir), MARKET_ORDERS.df(spark, sf_dir), market_masters(spark, sf_dir), months, AS_OF, "market", report, history
        )

    def figures(df, kept_in, part):
        return df.groupBy("sale_month", part.alias("part_name"), named("ReportSource").alias("source")).agg(
            F.count("*").alias("rows"), F.coalesce(F.sum("Quantity"), F.lit(0)).cast("long").alias("units")
        ).withColumn("kept_in", F.lit(kept_in))

    parts = spark.read.parquet(report).withColumn("sale_month", F.col("sale_month").cast("string"))
    return figures(parts, "report", F.col("part_name")).unionByName(
        figures(read_history(spark, history), "history", F.lit(None).cast("string"))
    )


@query(
    "release_two_months",
    f"""
    WITH r AS (SELECT *, strftime("SentOn", '%Y-%m') AS sale_month,
                      strftime("SentOn", '%Y %m %b') || ' ' || side || {SPLIT_SQL} AS part_name FROM {TWO_MONTHS_SQL}),
    v AS (SELECT unnest([1, 2]) AS version)
    SELECT version, 'report' AS kept_in, sale_month, part_name, "ReportSource" AS source, count(*) AS rows,
           CAST(coalesce(sum("Quantity"), 0) AS bigint) AS units FROM r, v WHERE version = 2 OR sale_month = '{YEAR}-{MONTH:02d}' GROUP BY ALL
    UNION ALL SELECT version, 'history', sale_month, NULL, "ReportSource", count(*), CAST(coalesce(sum("Quantity"), 0) AS bigint)
    FROM r, v WHERE version = 2 OR sale_month = '{YEAR}-{MONTH:02d}' GROUP BY ALL
    """,
)
def release_two_months(spark, sf_dir):
    """A month published, then both, then a run that dies before it publishes: both versions read back."""
    path, masters = new_folder(spark, "release"), market_masters(spark, sf_dir)
    orders, kept = MARKET_ORDERS.df(spark, sf_dir), base(spark, sf_dir)
    for months in ([(YEAR, MONTH)], [(YEAR, MONTH), (YEAR, MONTH + 1)]):
        release_months(kept, orders, masters, months, AS_OF, "market", path)
    broken = read_months(spark, path, "history").withColumn("Quantity", F.lit(0))
    write_months_aside(broken, path, "history", "sale_month")

    def figures(version: int, table: str, part):
        rows = read_months(spark, path, table, version, date_cols=HISTORY_DATES)
        return rows.groupBy("sale_month", part.alias("part_name"), named("ReportSource").alias("source")).agg(
            F.count("*").alias("rows"), F.coalesce(F.sum("Quantity"), F.lit(0)).cast("long").alias("units")
        ).withColumns({"kept_in": F.lit(table), "version": F.lit(version)})

    parts = [figures(v, "report", F.col("part_name")) for v in (1, 2)]
    parts += [figures(v, "history", F.lit(None).cast("string")) for v in (1, 2)]
    return union_all(parts)


ORDER_COLS = 'o_orderkey AS "NoPesanan", o_orderdate AS "SentOn", o_totalprice AS "Quantity"'


@query(
    "incremental_months",
    """
    SELECT CAST(o_orderkey AS varchar) AS "NoPesanan", o_orderdate::date::varchar AS "SentOn",
           CAST(trunc(o_totalprice) AS bigint) + CASE WHEN year(o_orderdate) = 1998 THEN 1000 ELSE 0 END AS "Quantity",
           strftime(o_orderdate, '%Y-%m') AS sale_month
    FROM orders WHERE year(o_orderdate) <> 1998 OR o_orderkey % 2 = 0
    """,
)
def incremental_months(spark, sf_dir):
    """All months saved, then those of one year rebuilt; the others must survive untouched."""
    rows = order_rows(spark, sf_dir)
    path = new_folder(spark, "months")
    save_months(rows, path)
    rebuilt = rows.filter("year(SentOn) = 1998 AND cast(NoPesanan as bigint) % 2 = 0")
    save_months(rebuilt.withColumn("Quantity", F.col("Quantity") + 1000), path)
    return saved_months(spark, path)


def order_rows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("NoPesanan"), F.col("o_orderdate").alias("SentOn"),
        F.col("o_totalprice").alias("Quantity"),
    )


def saved_months(spark, path: str) -> DataFrame:
    """The history as saved, under the keys it is stored by."""
    saved = read_history(spark, path).withColumn("sale_month", F.col("sale_month").cast("string"))
    return dates_as_text(saved.select("NoPesanan", "SentOn", "Quantity", "sale_month"))


@query(
    "emptied_month",
    """
    SELECT CAST(o_orderkey AS varchar) AS "NoPesanan", o_orderdate::date::varchar AS "SentOn",
           CAST(trunc(o_totalprice) AS bigint) AS "Quantity", strftime(o_orderdate, '%Y-%m') AS sale_month
    FROM orders WHERE strftime(o_orderdate, '%Y-%m') <> '1998-03'
    """,
)
def emptied_month(spark, sf_dir):
    """Two months rebuilt, one of which has no rows any more."""
    rows, path = order_rows(spark, sf_dir), new_folder(spark, "months")
    save_months(rows, path)
    save_months(rows.filter("date_format(SentOn, 'yyyy-MM') = '1998-04'"), path, months=["1998-03", "1998-04"])
    return saved_months(spark, path)


@query(
    "seed_then_rebuild",
    """
    SELECT CAST(o_orderkey AS varchar) AS "NoPesanan", o_orderdate::date::varchar AS "SentOn",
           CAST(trunc(o_totalprice) AS bigint) + CASE WHEN year(o_orderdate) = 1998 THEN 1000 ELSE 0 END AS "Quantity",
           strftime(o_orderdate, '%Y-%m') AS sale_month
    FROM orders
    """,
)
def seed_then_rebuild(spark, sf_dir):
    """All months seeded from exports named by month, then those of one year rebuilt: no month twice."""
    rows = order_rows(spark, sf_dir)
    raw, exports, path = new_folder(spark, "raw"), new_folder(spark, "exports"), new_folder(spark, "months")
    texts = rows.withColumns({"SentOn": F.col("SentOn").cast("date").cast("string"), "Quantity": F.col("Quantity").cast("string")})
    stems = texts.withColumn("stem", F.date_format(F.col("SentOn").cast("date"), "yyyy MM MMM"))
    stems.repartition("stem").write.partitionBy("stem").option("header", True).csv(raw)
    move_exports(spark, raw, exports)
    seed_history(spark, exports, path)
    rebuilt = rows.filter("year(SentOn) = 1998").withColumn("Quantity", F.col("Quantity") + 1000)
    save_months(rebuilt, path)
    return saved_months(spark, path)


def move_exports(spark, raw: str, exports: str) -> None:
    """Written part files as exports: ``1998 03 Mar_0.csv``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for i, file in enumerate(list_files(spark, raw, ".csv")):
        stem = unquote(file.split("stem=")[1].split("/")[0])
        target = hadoop.Path(f"{exports}/{stem}_{i}.csv")
        store = target.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(target.getParent())
        store.rename(hadoop.Path(file), target)


@query(
    "stack_unified_schema",
    """
    SELECT CAST(o_orderkey AS varchar) AS "NoPesanan",
           CASE WHEN year(o_orderdate) <> 1997 THEN o_orderdate::date::varchar END AS "SentOn",
           CASE WHEN year(o_orderdate) >= 1998 THEN o_totalprice END AS "Revenue",
           NULL::varchar AS "Status", CASE WHEN year(o_orderdate) = 1997 THEN o_orderpriority END AS "Extra"
    FROM orders
    """,
)
def stack_unified_schema(spark, sf_dir):
    """Three units: one with a blank number column, one with a blank date, one with dates as text."""
    orders = table(spark, sf_dir, "orders")
    number, nothing = F.col("o_orderkey").alias("NoPesanan"), F.lit(None)
    early = orders.filter("year(o_orderdate) < 1997").select(
        number.cast("string").alias("NoPesanan"), F.col("o_orderdate").alias("SentOn"), nothing.alias("Revenue"),
        nothing.alias("Status"),
    )
    middle = orders.filter("year(o_orderdate) = 1997").select(
        number, nothing.alias("SentOn"), F.col("o_orderpriority").alias("Extra"), F.lit(1).alias("__index_level_0__")
    )
    late = orders.filter("year(o_orderdate) > 1997").select(
        F.col("o_totalprice").alias("Revenue"), number, F.date_format("o_orderdate", "dd/MM/yyyy").alias("SentOn")
    )
    return dates_as_text(combined([early, middle, late]))


@query(
    "coverage_sales",
    f"""
    SELECT "Brand", "Category", "Channel", "CreatedOn"::varchar AS "CreatedOn", "City", "CustomerName",
           "NoPesanan" AS "Order Number", "Product Name", "Quantity", "SentOn"::varchar AS "SentOn", "Sub Channel",
           "Type of Item", "Variant" FROM {HISTORY.sql}
    UNION ALL
    SELECT "Brand", "Category", 'ONLINE', "CreatedOn"::date::varchar, "Shipping City", "Marketplace", "Order Number",
           "Product Name", "Ordered Quantity", "SentOn"::date::varchar, "Marketplace", "Type of Item", "Variant"
    FROM {MARKET_FACTS.sql}
    """,
)
def coverage(spark, sf_dir):
    return dates_as_text(coverage_sales(HISTORY.df(spark, sf_dir), MARKET_FACTS.df(spark, sf_dir)))


@query(
    "coverage_written",
    f"""
    SELECT 'E-COMMERCE and GENERAL' AS part, (SELECT count(*) FROM {HISTORY.sql}) AS rows,
           (SELECT count(*) FROM {HISTORY.sql}) + (SELECT count(*) FROM {MARKET_FACTS.sql}) AS written
    UNION ALL SELECT 'ONLINE', (SELECT count(*) FROM {MARKET_FACTS.sql}),
           (SELECT count(*) FROM {HISTORY.sql}) + (SELECT count(*) FROM {MARKET_FACTS.sql})
    """,
)
def coverage_written(spark, sf_dir):
    """The coverage table written in one pass that also counts it."""
    path = new_folder(spark, "coverage")
    written = write_coverage_sales(HISTORY.df(spark, sf_dir), MARKET_FACTS.df(spark, sf_dir), path)
    part = F.when(F.col("Channel") == "ONLINE", F.lit("ONLINE")).otherwise(F.lit("E-COMMERCE and GENERAL"))
    counts = spark.read.parquet(path).groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    return counts.withColumn("written", F.lit(written).cast("long"))


BOOK = (
    "case when o_orderkey % 50 = 0 then 'COPY-list.xlsx'"
    " else concat(cast(1 + o_custkey % 3 as string), '. Area Sell Through.xlsx') end"
)
SHEET = "case when o_orderkey % 3 = 0 then 'S0' when o_orderkey % 3 = 1 then 'S1' else ' Master_Data ' end"
STATE = "case when o_orderkey % 3 = 1 and o_custkey % 3 = 1 then 'hidden' else 'visible' end"
OUTLET = "concat('Outlet', chr(10), cast(o_custkey as string), ' ')"
CLASS = "case when o_orderkey % 4 = 0 then null else o_orderpriority end"
WHEN_KIND = "case when o_orderkey % 5 = 0 then 'int' when o_orderkey % 5 = 1 then 'empty' else 'text' end"
WHEN = (
    "case when o_orderkey % 5 = 0 then cast(45000 + o_orderkey % 900 as string) when o_orderkey % 5 = 1 then null"
    " when o_orderkey % 5 = 2 then concat(' ', cast(1 + o_orderkey % 28 as string), '/3/2026')"
    " when o_orderkey % 5 = 3 then '31/31/2026' else cast(cast(o_orderdate as date) as string) end"
)
TOTAL = "case when o_orderkey % 7 = 0 then 'n/a' when o_orderkey % 7 = 1 then ' ' else cast(o_orderkey % 100 as string) end"


def sales_grid(spark, sf_dir) -> DataFrame:
    """Orders as hand-kept sheets in two layouts, with stray files, hidden and excluded sheets."""
    rows = table(spark, sf_dir, "orders").select(
        F.expr(BOOK).alias("source_file"), F.expr(SHEET).alias("sheet"),
        F.expr("cast(o_orderkey % 3 as int)").alias("sheet_no"), F.expr(STATE).alias("sheet_state"),
        F.expr("cast(o_orderkey as int) + 1").alias("row_no"),
        F.expr(
            f"case when o_orderkey % 3 = 0 then array({OUTLET}, {CLASS}, {WHEN}, {TOTAL})"
            f" else array({WHEN}, {TOTAL}, 'junk', {CLASS}, {OUTLET}, 'pack 1') end"
        ).alias("cells"),
        F.expr(
            f"case when o_orderkey % 3 = 0 then array('text', 'text', {WHEN_KIND}, 'text')"
            f" else array({WHEN_KIND}, 'text', 'text', 'text', 'text', 'text') end"
        ).alias("cell_types"),
    )
    sheet = ["source_file", "sheet", "sheet_no", "sheet_state"]
    head = F.expr(
        "case when sheet_no = 0 then array('Outlet', 'KLASIFIKASI OUTLET ', 'Date', 'Total')"
        " else array('Date', 'Total', '', ' KLASIFIKASI OUTLET', 'Outlet', 'Quantity') end"
    )
    headers = rows.select(*sheet).distinct().select(
        *sheet, F.lit(0).alias("row_no"), head.alias("cells"),
        F.transform(head, lambda _: F.lit("text")).alias("cell_types"),
    )
    return rows.unionByName(headers)


@query(
    "sell_through_compile",
    rf"""
    SELECT 'Outlet ' || CAST(o_custkey AS varchar) AS "Outlet", {CLASS} AS "KLASIFIKASI OUTLET",
           coalesce(CASE WHEN o_orderkey % 5 = 0 THEN DATE '1899-12-30' + CAST({WHEN} AS int)
                    ELSE coalesce(try_strptime(trim({WHEN}), '%Y-%m-%d')::date,
                                  try_strptime(trim({WHEN}), '%d/%m/%Y')::date) END::varchar, '') AS "Date",
           coalesce(try_cast(trim({TOTAL}) AS double), 0) AS "Total",
           CASE WHEN o_orderkey % 3 = 1 THEN 'pack 1' END AS "Quantity",
           {BOOK} AS "SourceFile", {SHEET} AS "SheetName"
    FROM orders WHERE o_orderkey % 50 <> 0 AND o_orderkey % 3 < 2 AND {STATE} = 'visible'
    """,
)
def sell_through_compile(spark, sf_dir):
    return compile_sheets(sales_grid(spark, sf_dir))
