"""Master tables and lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from salesflow.functions import named
from salesflow.operators.joins import lookup, lookup_or_default
from salesflow.operators.masters import (
    area_master, channel_master, first_by_place, keep_first, lookup_fanout, place_master, postcode_master,
    product_master, standardise_places, unmatched_places,
)
from salesflow.plans.coverage import coverage_orders
from salesflow.plans.master_data import (
    AREA_CELLS, AREA_SKIP, MARKET_CHANNEL_NAMES, POSTCODE_NAMES, PRODUCT_CELLS, PRODUCT_HEADER_ROW, PRODUCT_NAMES,
    PRODUCT_SKIP, market_masters, report_masters,
)
from salesflow.session import new_folder
from salesflow.sources.files import list_files
from salesflow.sources.sinks import write_exceptions
from workload import query
from workload.standins import (
    AREA_SHEET, CHANNEL_SHEET, CITY_SHEET, MARKET_CHANNEL_SHEET, MARKET_ORDERS, PLACE_ORDERS, POSTCODE_SHEET, PRODUCT_SHEET,
    strip_sql, table,
)


def first_rows(sheet: str, key: str, order: str = "row_no") -> str:
    """The keep-first rule as SQL."""
    return (
        f"(SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS __rn"
        f" FROM {sheet}) WHERE __rn = 1)"
    )


PRODUCT_SQL = f"""(
    SELECT upper("ItemName") AS "ItemName", "Brand", "Category", "SubCategory", "Variant", "Product Name",
           "Type of Item" FROM {first_rows(PRODUCT_SHEET.sql, '"ItemName"')})"""
AREA_SQL = f"""(
    SELECT "Province", "Region" FROM {first_rows(AREA_SHEET.sql, '"Province"')}
    WHERE "Province" IS DISTINCT FROM '0')"""
CHANNEL_SQL = f"""(
    SELECT "SalesType", "SubSalesType", "Channel Group", "Channel", "Sub Channel" FROM {CHANNEL_SHEET.sql})"""
POSTCODE_KEYS = f"""(
    SELECT row_no, {strip_sql('"Kode Pos"')} AS "Kode Pos", "Area Level 1" AS "Province", "Area Level 2" AS "City"
    FROM {POSTCODE_SHEET.sql} WHERE {strip_sql('"Kode Pos"')} NOT IN ('', 'nan'))"""
POSTCODE_SQL = f"""(SELECT "Kode Pos", "Province", "City" FROM {first_rows(POSTCODE_KEYS, '"Kode Pos"')})"""


def products(spark, sf_dir):
    return product_master(PRODUCT_SHEET.df(spark, sf_dir), ["row_no"])


def areas(spark, sf_dir):
    return area_master(AREA_SHEET.df(spark, sf_dir), ["row_no"])


def channels(spark, sf_dir):
    return channel_master(CHANNEL_SHEET.df(spark, sf_dir))


def postcodes(spark, sf_dir):
    return postcode_master(POSTCODE_SHEET.df(spark, sf_dir), ["row_no"])


LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "keep_first_dedupe",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
    FROM {first_rows('lineitem', 'l_orderkey', ', '.join(LINE_ORDER))}
    """,
)
def keep_first_dedupe(spark, sf_dir):
    firsts = keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey"], LINE_ORDER)
    return firsts.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query(
    "first_by_place",
    """
    SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, o_totalprice
    FROM orders QUALIFY row_number() OVER (PARTITION BY CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END ORDER BY o_orderkey) = 1
    """,
)
def first_of_customer(spark, sf_dir):
    """Each customer's first order; a third of the orders share the null key."""
    orders = table(spark, sf_dir, "orders").withColumn("k", F.expr("CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END"))
    firsts = first_by_place(orders, ["k"], "o_orderkey")
    return firsts.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


query("product_master", f"SELECT * FROM {PRODUCT_SQL}")(products)
query("area_master", f"SELECT * FROM {AREA_SQL}")(areas)
query("channel_master", f"SELECT * FROM {CHANNEL_SQL}")(channels)
query("postcode_master", f"SELECT * FROM {POSTCODE_SQL}")(postcodes)


@query(
    "lookup_fanout",
    f"""
    SELECT "ItemName", count(*) AS master_rows FROM {PRODUCT_SQL} GROUP BY "ItemName" HAVING count(*) > 1
    """,
)
def fanout(spark, sf_dir):
    return lookup_fanout(products(spark, sf_dir), ["ItemName"])


CITY_OF = "case when c_custkey % 4 = 0 then null when c_custkey % 4 = 1 then 'NATION_99' else n_name end"


@query(
    "null_safe_lookup",
    f"""
    SELECT c_custkey, p AS "Province", a."Region" AS "Region"
    FROM (SELECT c_custkey, {CITY_OF} AS p FROM customer JOIN nation ON c_nationkey = n_nationkey) c
    LEFT JOIN {AREA_SQL} a ON a."Province" IS NOT DISTINCT FROM c.p
    """,
)
def null_safe_lookup(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    return lookup(rows.select("c_custkey", F.expr(CITY_OF).alias("Province")), areas(spark, sf_dir), ["Province"])


@query(
    "two_key_lookup",
    f"""
    SELECT o_orderkey, c."SalesType", c."SubSalesType", "Channel Group", "Channel", "Sub Channel"
    FROM (SELECT o_orderkey, c_mktsegment AS "SalesType", nullif(o_orderpriority, '4-NOT SPECIFIED') AS "SubSalesType"
          FROM orders JOIN customer ON o_custkey = c_custkey) c
    LEFT JOIN {CHANNEL_SQL} m ON m."SalesType" IS NOT DISTINCT FROM c."SalesType"
        AND m."SubSalesType" IS NOT DISTINCT FROM c."SubSalesType"
    """,
)
def two_key_lookup(spark, sf_dir):
    rows = lookup(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), [("o_custkey", "c_custkey")], "inner", False)
    keys = rows.select(
        "o_orderkey", F.col("c_mktsegment").alias("SalesType"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("SubSalesType"),
    )
    return lookup(keys, channels(spark, sf_dir), ["SalesType", "SubSalesType"])


HOT_CUSTOMER = "case when o_orderkey % 5 < 2 then 7 else o_custkey end"


@query(
    "salted_lookup",
    f"""
    SELECT l_orderkey, l_linenumber, l_suppkey, k, c."CustomerName" AS "CustomerName"
    FROM (SELECT *, {HOT_CUSTOMER} AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    LEFT JOIN (SELECT c_custkey, c_name AS "CustomerName" FROM customer WHERE c_custkey % 11 <> 3) c ON c_custkey = k
    """,
)
def salted_lookup(spark, sf_dir):
    """Order lines, two fifths of them under one customer, against a master not to be broadcast."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
    facts = lines.select("l_orderkey", "l_linenumber", "l_suppkey", F.expr(HOT_CUSTOMER).alias("k"))
    customers = table(spark, sf_dir, "customer").filter("c_custkey % 11 <> 3")
    master = customers.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("CustomerName"))
    return lookup(facts, master, ["k"], nulls_match=False, spread="salted", limit=0)


@query(
    "postcode_lookup",
    f"""
    SELECT "Order Number" AS order_number, code, coalesce("Province", '-') AS "Province", coalesce("City", '-') AS "City"
    FROM (SELECT "Order Number", CASE WHEN "Shipping Postcode" IS NULL OR trim("Shipping Postcode") = '' THEN '-'
                 ELSE "Shipping Postcode" END AS code FROM {MARKET_ORDERS.sql})
    LEFT JOIN {POSTCODE_SQL} ON code = "Kode Pos"
    """,
)
def postcode_lookup(spark, sf_dir):
    lines = MARKET_ORDERS.df(spark, sf_dir).select(
        named("Order Number").alias("order_number"), named("Shipping Postcode").alias("code")
    )
    return lookup_or_default(lines, postcodes(spark, sf_dir), "code", "Kode Pos")


PLACE_SHEET_SQL = f"""(SELECT {strip_sql("coalesce(City, 'nan')")} AS place,
    "ADM2_NAME (STANDARDIZED)" AS "ADM2_Standardized", "ADM1", row_no FROM {CITY_SHEET.sql})"""
PLACES_SQL = first_rows(PLACE_SHEET_SQL, "place")
FOUND_SQL = f"""(
    SELECT o.*, m."ADM2_Standardized", m."ADM1" FROM {PLACE_ORDERS.sql} o
    LEFT JOIN {PLACES_SQL} m ON {strip_sql("coalesce(o.City, 'nan')")} = m.place)"""


def places(spark, sf_dir):
    return place_master(CITY_SHEET.df(spark, sf_dir), "City", "ADM2_NAME (STANDARDIZED)", "ADM1", ["row_no"])


@query(
    "city_standardise",
    f"""
    SELECT DISTINCT "Province", "City", "Segment", "Day", coalesce("ADM2_Standardized", '-') AS "ADM2_Standardized",
           coalesce("ADM1", '-') AS "ADM1" FROM {FOUND_SQL}
    """,
)
def city_standardise(spark, sf_dir):
    return standardise_places(PLACE_ORDERS.df(spark, sf_dir), places(spark, sf_dir))


UNMATCHED_SQL = f"""
    SELECT DISTINCT {strip_sql('"Province"')} AS "Province", {strip_sql('"City"')} AS "City"
    FROM {FOUND_SQL} WHERE "ADM2_Standardized" IS NULL ORDER BY 1 NULLS LAST, 2 NULLS LAST
    """


@query("unmatched_places", UNMATCHED_SQL)
def places_unmatched(spark, sf_dir):
    return unmatched_places(PLACE_ORDERS.df(spark, sf_dir), places(spark, sf_dir))


@query("exceptions_file", UNMATCHED_SQL)
def exceptions_file(spark, sf_dir):
    """The unmatched places written as CSV and read back."""
    path = new_folder(spark, "unmatched")
    write_exceptions(places_unmatched(spark, sf_dir), path)
    return spark.read.csv(path, header=True)


@query(
    "coverage_orders",
    f"""
    SELECT DISTINCT 'orders' AS list, "Province", "City", "Segment", "Day",
           coalesce("ADM2_Standardized", '-') AS "ADM2_Standardized", coalesce("ADM1", '-') AS "ADM1" FROM {FOUND_SQL}
    UNION ALL SELECT 'unmatched', "Province", "City", NULL, NULL, NULL, NULL FROM ({UNMATCHED_SQL})
    """,
)
def order_files(spark, sf_dir):
    """The whole job: order files of two headers beside a stray, a master file, both results read back."""
    folder, sheet = new_folder(spark, "order-files"), new_folder(spark, "city-master")
    plain = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    orders = PLACE_ORDERS.df(spark, sf_dir)
    even = F.pmod(F.xxhash64(*orders.columns), F.lit(2)) == 0
    for name, rows in (
        ("Sales_Order_Number", orders.filter(even)),
        ("order_number_2", orders.filter(~even).select("Day", "City", "Segment", "Province")),
        ("stray", orders.limit(5).withColumn("City", F.lit("stray"))),
    ):
        rows.write.mode("append").options(**plain, **{"mapreduce.output.basename": name}).csv(folder)
    # a master is one file, and its order counts
    master = CITY_SHEET.df(spark, sf_dir).repartition(1).sortWithinPartitions("row_no").drop("row_no")
    master.write.options(**plain, sep=";").csv(sheet)
    out, listed = new_folder(spark, "places"), new_folder(spark, "unmatched")
    coverage_orders(spark, folder, list_files(spark, sheet, ".csv")[0], out, listed)
    found = spark.read.parquet(out).withColumn("list", F.lit("orders"))
    missing = spark.read.csv(listed, header=True).withColumn("list", F.lit("unmatched"))
    return found.unionByName(missing, allowMissingColumns=True)


def workbook(spark, sf_dir):
    """The master workbook as a grid: sheets by cell position, and one with its header in row 0."""

    def sheet(name: str, df, cells: list[str], row_no) -> DataFrame:
        values = F.array(*[F.col(f"`{c}`").cast("string") if c else F.lit("") for c in cells])
        kinds = F.transform(values, lambda v: F.when(v.isNull(), F.lit("empty")).otherwise(F.lit("text")))
        return df.select(
            F.lit("masters.xlsx").alias("source_file"), F.lit(name).alias("sheet"), F.lit("visible").alias("sheet_state"),
            row_no.cast("long").alias("row_no"), values.alias("cells"), kinds.alias("cell_types"),
        )

    at = F.col("row_no")
    channel_cells = ["Sub Channel", "SalesType", "Channel Group", "Channel", "SubSalesType"]
    channels_sheet = CHANNEL_SHEET.df(spark, sf_dir)
    header = spark.range(1).select(*[F.lit(c).alias(c) for c in channel_cells])
    parts = [
        sheet("Product", PRODUCT_SHEET.df(spark, sf_dir), ["", *PRODUCT_CELLS], at + PRODUCT_SKIP),
        sheet("Area", AREA_SHEET.df(spark, sf_dir), ["", *AREA_CELLS], at + AREA_SKIP),
        sheet("Channel", header, channel_cells, F.lit(0)),
        sheet("Channel", channels_sheet, channel_cells, F.monotonically_increasing_id() + 1),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "workbook_masters",
    f"""
    SELECT 'product' AS master, "ItemName" AS a, "Brand" AS b, "Category" AS c, "SubCategory" AS d, "Type of Item" AS e FROM {PRODUCT_SQL}
    UNION ALL SELECT 'area', "Province", "Region", NULL, NULL, NULL FROM {AREA_SQL}
    UNION ALL SELECT 'channel', "SalesType", "SubSalesType", "Channel Group", "Channel", "Sub Channel" FROM {CHANNEL_SQL}
    """,
)
def workbook_masters(spark, sf_dir):
    """Product, area and channel masters out of the workbook's sheets."""
    product, area, channel = report_masters(workbook(spark, sf_dir))

    def shown(df, name: str, *cols: str):
        filled = [F.col(f"`{c}`") for c in cols] + [F.lit(None).cast("string")] * (5 - len(cols))
        return df.select(F.lit(name).alias("master"), *[c.alias(n) for c, n in zip(filled, "abcde")])

    return (
        shown(product, "product", "ItemName", "Brand", "Category", "SubCategory", "Type of Item")
        .unionByName(shown(area, "area", "Province", "Region"))
        .unionByName(shown(channel, "channel", "SalesType", "SubSalesType", "Channel Group", "Channel", "Sub Channel"))
    )


MARKET_PRODUCT_SQL = f"""(
    SELECT upper("ItemName") AS "ItemName", upper("Brand") AS "Brand", upper("Category") AS "Category",
           upper("SubCategory") AS "SubCategory", upper("Type of Item") AS "Type of Item" FROM {PRODUCT_SHEET.sql})"""
MARKET_CHANNEL_SQL = f"""(
    SELECT "Channel Group", {strip_sql('"SalesType"')} AS "SalesType", "Channel", "Sub Channel" FROM {MARKET_CHANNEL_SHEET.sql})"""


def market_workbook(spark, sf_dir) -> DataFrame:
    """The same workbook as the marketplace reads it: header rows above all three sheets."""
    values = {
        "Kode Pos": (POSTCODE_SHEET.df(spark, sf_dir).withColumn("No", F.lit("x")), ["No", *POSTCODE_NAMES], 0),
        "Channel": (MARKET_CHANNEL_SHEET.df(spark, sf_dir), ["Sub Channel", *MARKET_CHANNEL_NAMES[:3]], 0),
        "Product": (PRODUCT_SHEET.df(spark, sf_dir).withColumnRenamed("SubCategory", "Sub Category"), PRODUCT_NAMES, PRODUCT_HEADER_ROW),
    }
    parts = []
    for sheet, (df, names, header_row) in values.items():
        cells = F.array(*[named(c).cast("string") for c in names])
        at = F.col("row_no") if "row_no" in df.columns else F.monotonically_increasing_id()
        rows = df.select((at + header_row + 1).cast("long").alias("row_no"), cells.alias("cells"))
        head = spark.range(1).select(F.lit(header_row).cast("long").alias("row_no"), F.array(*[F.lit(c) for c in names]).alias("cells"))
        kinds = F.transform("cells", lambda v: F.when(v.isNull(), F.lit("empty")).otherwise(F.lit("text")))
        lines = rows.unionByName(head).withColumn("cell_types", kinds)
        parts.append(lines.select(F.lit("masters.xlsx").alias("source_file"), F.lit(sheet).alias("sheet"), F.lit("visible").alias("sheet_state"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "workbook_market_masters",
    f"""
    SELECT 'postcode' AS master, "Kode Pos" AS a, "Province" AS b, "City" AS c, NULL AS d, NULL AS e FROM {POSTCODE_SQL}
    UNION ALL SELECT 'channel', "SalesType", "Channel Group", "Channel", "Sub Channel", NULL FROM {MARKET_CHANNEL_SQL}
    UNION ALL SELECT 'product', "ItemName", "Brand", "Category", "SubCategory", "Type of Item" FROM {MARKET_PRODUCT_SQL}
    """,
)
def workbook_market_masters(spark, sf_dir):
    """Postcode, channel and product masters of the marketplace out of the workbook's sheets."""
    found = market_masters(market_workbook(spark, sf_dir))

    def shown(df, name: str, *cols: str):
        filled = [F.col(f"`{c}`") for c in cols] + [F.lit(None).cast("string")] * (5 - len(cols))
        return df.select(F.lit(name).alias("master"), *[c.alias(n) for c, n in zip(filled, "abcde")])

    return (
        shown(found.postcode, "postcode", "Kode Pos", "Province", "City")
        .unionByName(shown(found.channel, "channel", "SalesType", "Channel Group", "Channel", "Sub Channel"))
        .unionByName(shown(found.product, "product", "ItemName", "Brand", "Category", "Sub Category", "Type of Item"))
    )
