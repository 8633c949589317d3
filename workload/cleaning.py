"""Scalar cleaning rules and row predicates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from salesflow.functions import named
from salesflow.functions.dates import month_key, month_label, month_start, parse_date, repair_date_cell
from salesflow.functions.numbers import coerce_int, round_int
from salesflow.functions.text import (
    cell_text, clean_text, last_part, na_to_null, remove_text, replace_first, suffix_after,
)
from salesflow.operators.filters import (
    counted, drop_sentinel, has_key, not_contains, sale_day, type_filter,
)
from salesflow.operators.shape import conform, move_after, rename_drop, typed
from salesflow.plans.marketplace import sales_type
from workload import query
from workload.standins import (
    ACCOUNTING, AS_OF, ERP, MARKET_FACTS, MARKET_ORDERS, STOCK, date_sql, dirty_number, int_sql,
    mixed_date_text, round_sql, spark_sale_day, strip_sql, table,
)

DATE_TEXT = mixed_date_text("cast(o_orderdate as date)", "o_orderkey")


@query(
    "parse_dates_multi",
    f"SELECT o_orderkey, {date_sql('t')}::varchar AS day FROM (SELECT o_orderkey, {DATE_TEXT} AS t FROM orders)",
)
def parse_dates_multi(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(DATE_TEXT).alias("t"))
    return texts.select("o_orderkey", parse_date("t").cast("string").alias("day"))


HALF = "cast(o_orderkey % 41 - 20 as double) / 2"


@query("round_half_even", f"SELECT o_orderkey, {round_sql(HALF)} AS whole FROM orders")
def round_half_even(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", round_int(F.expr(HALF)).alias("whole"))


DIRTY = dirty_number("l_extendedprice", "l_orderkey")


@query(
    "coerce_int",
    f"SELECT l_orderkey, l_linenumber, t, {int_sql('t')} AS whole"
    f" FROM (SELECT l_orderkey, l_linenumber, {DIRTY} AS t FROM lineitem)",
)
def coerce_ints(spark, sf_dir):
    texts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(DIRTY).alias("t"))
    return texts.withColumn("whole", coerce_int("t"))


DATE_CELL = (
    "case when o_orderkey % 7 = 0 then cast(36000 + o_orderkey % 30000 as string)"
    " when o_orderkey % 7 = 1 then concat(' ', cast(1 + o_orderkey % 31 as string), '/',"
    " cast(1 + o_orderkey % 14 as string), '/2026 ')"
    " when o_orderkey % 7 = 2 then '45597' when o_orderkey % 7 = 3 then null"
    " when o_orderkey % 7 = 4 then '99/99/2026' else cast(cast(o_orderdate as date) as string) end"
)
DMY_SQL = r"try_strptime(trim(t), '%d/%m/%Y')::date"


@query(
    "repair_date_cells",
    rf"""
    SELECT o_orderkey, CASE
        WHEN o_orderkey % 7 = 0 AND try_cast(t AS double) BETWEEN 36526 AND 60000
            THEN (DATE '1899-12-30' + CAST(t AS int))::varchar
        WHEN o_orderkey % 7 <> 0 AND regexp_full_match(t, '\s*\d{{1,2}}/\d{{1,2}}/\d{{4}}\s*') AND {DMY_SQL} IS NOT NULL
            THEN {DMY_SQL}::varchar
        ELSE t END AS cell
    FROM (SELECT o_orderkey, {DATE_CELL} AS t FROM orders)
    """,
)
def repair_date_cells(spark, sf_dir):
    cells = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(DATE_CELL).alias("t"))
    return cells.select("o_orderkey", repair_date_cell("t", F.col("o_orderkey") % 7 == 0).alias("cell"))


CELL_KIND = (
    "case when o_orderkey % 6 = 0 then 'empty' when o_orderkey % 6 = 1 then 'bool' when o_orderkey % 6 = 2 then"
    " 'float' when o_orderkey % 6 = 3 then 'int' when o_orderkey % 6 = 4 then 'date' else 'text' end"
)
CELL_VALUE = (
    "case when o_orderkey % 6 = 0 then '' when o_orderkey % 6 = 1 then 'true' when o_orderkey % 6 = 2 then"
    " concat(cast(o_orderkey as string), case when o_orderkey % 12 = 2 then '.0' else '.25' end)"
    " when o_orderkey % 6 = 3 then cast(o_orderkey as string) when o_orderkey % 6 = 4 then"
    " cast(cast(o_orderdate as date) as string) when o_orderkey % 12 = 5 then '' else o_orderpriority end"
)


@query(
    "cell_text",
    f"""
    SELECT o_orderkey, CASE kind WHEN 'empty' THEN NULL WHEN 'bool' THEN upper(v)
        WHEN 'float' THEN replace(v, '.0', '') ELSE nullif(v, '') END AS text
    FROM (SELECT o_orderkey, {CELL_KIND} AS kind, {CELL_VALUE} AS v FROM orders)
    """,
)
def cell_texts(spark, sf_dir):
    cells = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr(CELL_KIND).alias("kind"), F.expr(CELL_VALUE).alias("v")
    )
    return cells.select("o_orderkey", cell_text("v", "kind").alias("text"))


PLACE = "concat(c_name, ' (ID), ', c_mktsegment, ' (ID)')"


@query("literal_replace", f"SELECT c_custkey, replace({PLACE}, ' (ID)', '') AS place FROM customer")
def literal_replace(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", remove_text(F.expr(PLACE), " (ID)").alias("place"))


LAST = "upper(m)"


@query(
    "marketplace_suffix",
    f"""
    SELECT "Order Number" AS order_number, m AS marketplace,
        upper(replace(CASE WHEN strpos(m, '_') > 0 THEN substr(m, strpos(m, '_') + 1) ELSE '' END,
                      'NEXUS', 'ENDORSE')) AS first_rule,
        regexp_replace(split_part({LAST}, '_', -1), 'NEXUS', 'ENDORSE') AS last_rule
    FROM (SELECT *, "Marketplace" AS m FROM {MARKET_ORDERS.sql})
    """,
)
def marketplace_suffix(spark, sf_dir):
    """The job's rule and the guard's rule side by side."""
    return MARKET_ORDERS.df(spark, sf_dir).select(
        named("Order Number").alias("order_number"),
        named("Marketplace").alias("marketplace"),
        sales_type("Marketplace").alias("first_rule"),
        replace_first(last_part(F.upper("Marketplace")), "NEXUS", "ENDORSE").alias("last_rule"),
    )


@query(
    "clean_text",
    rf"""
    SELECT doc_id, {strip_sql(r"regexp_replace(text, '[\n\r]+', ' ', 'g')")} AS text FROM documents
    """,
)
def clean_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("text"))


TOKEN = (
    "case when c_custkey % 6 = 0 then 'N/A' when c_custkey % 6 = 1 then '' when c_custkey % 6 = 2 then 'nan'"
    " when c_custkey % 6 = 3 then 'Nan' when c_custkey % 6 = 4 then null else c_name end"
)


@query(
    "na_tokens",
    f"SELECT c_custkey, CASE WHEN t NOT IN ('N/A', '', 'nan') THEN t END AS t"
    f" FROM (SELECT c_custkey, {TOKEN} AS t FROM customer)",
)
def na_tokens(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", na_to_null(F.expr(TOKEN)).alias("t"))


@query(
    "month_labels",
    """
    SELECT o_orderkey, date_trunc('month', o_orderdate)::date::varchar AS start,
           strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%Y %m %b') AS label
    FROM orders
    """,
)
def month_labels(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        month_start("o_orderdate").cast("string").alias("start"),
        month_key("o_orderdate").alias("ym"),
        month_label("o_orderdate").alias("label"),
    )


@query(
    "typed_frame",
    f"""
    SELECT "NoPesanan", {date_sql('"SentOn"')}::varchar AS "SentOn", NULL::varchar AS "InvoiceOn",
           {int_sql('"Quantity"')} AS "Quantity", 0::bigint AS "Revenue", coalesce("City", '') AS "City",
           '' AS "Status", "extra"
    FROM (SELECT CAST(CAST("NoPesanan" AS bigint) AS varchar) AS "NoPesanan", "SentOn",
                 CAST("Quantity" AS varchar) AS "Quantity", "City", "CustomerName" AS extra FROM {STOCK.sql})
    """,
)
def typed_frame(spark, sf_dir):
    """Text columns typed by list; known columns that are absent are filled."""
    stock = STOCK.df(spark, sf_dir)
    texts = stock.select(
        named("NoPesanan").cast("bigint").cast("string").alias("NoPesanan"), "SentOn",
        named("Quantity").cast("string").alias("Quantity"), "City", named("CustomerName").alias("extra"),
    )
    out = typed(texts, ["SentOn", "InvoiceOn"], ["Quantity", "Revenue"], ["NoPesanan", "City", "Status"])
    return out.withColumns({c: named(c).cast("string") for c in ("SentOn", "InvoiceOn")})


@query(
    "not_contains_null_drops",
    f"""SELECT "OrderReference" AS ref, "Checked" AS checked FROM {ERP.sql} WHERE NOT contains("Checked", 'Reported')""",
)
def not_contains_null_drops(spark, sf_dir):
    kept = ERP.df(spark, sf_dir).filter(not_contains("Checked", "Reported"))
    return kept.select(named("OrderReference").alias("ref"), named("Checked").alias("checked"))


@query(
    "sentinel_and_blank_keys",
    """
    SELECT s_suppkey, k FROM (
        SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN '0' WHEN s_suppkey % 5 = 1 THEN NULL
            WHEN s_suppkey % 5 = 2 THEN ' nan ' WHEN s_suppkey % 5 = 3 THEN '  ' ELSE s_name END AS k FROM supplier)
    WHERE k IS DISTINCT FROM '0' AND trim(k) NOT IN ('', 'nan')
    """,
)
def sentinel_and_blank_keys(spark, sf_dir):
    key = (
        "CASE WHEN s_suppkey % 5 = 0 THEN '0' WHEN s_suppkey % 5 = 1 THEN NULL"
        " WHEN s_suppkey % 5 = 2 THEN ' nan ' WHEN s_suppkey % 5 = 3 THEN '  ' ELSE s_name END"
    )
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.expr(key).alias("k"))
    return rows.filter(drop_sentinel("k", "0") & has_key("k"))


ITEM_KIND = 'upper("Type of Item")'


@query(
    "type_filter",
    f"""
    SELECT "Order Number" AS order_number, {ITEM_KIND} AS kind,
           coalesce({ITEM_KIND} IN ('ACTIVITY', 'REGULER'), false) AS strict
    FROM {MARKET_FACTS.sql} WHERE {ITEM_KIND} IS NULL OR {ITEM_KIND} IN ('ACTIVITY', 'REGULER')
    """,
)
def type_filters(spark, sf_dir):
    """Rows that pass with null kept, flagged by whether they pass without."""
    rows = MARKET_FACTS.df(spark, sf_dir).select(
        named("Order Number").alias("order_number"), F.upper(named("Type of Item")).alias("kind")
    )
    kept = rows.filter(type_filter("kind"))
    return kept.withColumn("strict", F.coalesce(type_filter("kind", keep_null=False), F.lit(False)))


@query(
    "counting_rule",
    f"""
    SELECT "Order Number" AS order_number, {spark_sale_day()}::varchar AS sale_day, trim("Order Status") AS status
    FROM {MARKET_ORDERS.sql}
    WHERE trim("Order Status") = 'DELIVERED'
       OR (trim("Order Status") = 'DISPATCHED' AND {spark_sale_day()} <= DATE '{AS_OF}' - 14)
    """,
)
def counting_rule(spark, sf_dir):
    day = sale_day("SentOn", "CreatedOn")
    status = F.trim(named("Order Status"))
    rows = MARKET_ORDERS.df(spark, sf_dir).filter(counted(status, day, AS_OF))
    return rows.select(
        named("Order Number").alias("order_number"), day.cast("string").alias("sale_day"), status.alias("status")
    )


CONFORMED = StructType(
    [
        StructField("Revenue", LongType()), StructField("SentOn", DateType()), StructField("SO Number", StringType()),
        StructField("Region", StringType()), StructField("InvoiceOn", DateType()),
    ]
)


@query(
    "conform_schema",
    f"""
    SELECT CAST(trunc("Revenue") AS bigint) AS revenue, CAST("SentOn" AS varchar) AS sent,
           CAST("SO Number" AS varchar) AS so_number, NULL::varchar AS region, NULL::varchar AS invoiced
    FROM {ACCOUNTING.sql}
    """,
)
def conform_schema(spark, sf_dir):
    out = conform(ACCOUNTING.df(spark, sf_dir), CONFORMED)
    return out.select(
        named("Revenue").alias("revenue"), named("SentOn").cast("string").alias("sent"),
        named("SO Number").alias("so_number"), named("Region").alias("region"),
        named("InvoiceOn").cast("string").alias("invoiced"),
    )


@query(
    "rename_drop_move",
    "SELECT c_custkey AS customer, c_mktsegment AS segment, c_name AS name, c_acctbal AS c_acctbal FROM customer",
)
def rename_drop_move(spark, sf_dir):
    renamed = rename_drop(
        table(spark, sf_dir, "customer"),
        {"c_custkey": "customer", "c_name": "name", "c_mktsegment": "segment", "c_absent": "x"},
        ["c_nationkey", "c_missing"],
    )
    return move_after(renamed, "segment", "customer")
