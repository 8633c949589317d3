"""Sales feeds, masters and sheets derived from the driver's tables.

Each stand-in is a join of tables and a list of columns written in the SQL both engines
read, so the Spark query and its SQL twin start from the same rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesflow.functions.text import BLANKS
from salesflow.operators.joins import lookup


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once a session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/{name}.parquet")
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(key[1])
    return _TABLES[key]


@dataclass
class Standin:
    """Columns over ``base`` joined by key to further tables."""

    base: str
    cols: dict[str, str]
    joins: list[tuple[str, str, str]] = field(default_factory=list)
    where: str | None = None
    distinct: bool = False

    def df(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, self.base)
        for name, left, right in self.joins:
            rows = lookup(rows, table(spark, sf_dir, name), [(left, right)], "inner", nulls_match=False)
        if self.where:
            rows = rows.filter(self.where)
        rows = rows.select(*[F.expr(text).alias(name) for name, text in self.cols.items()])
        return rows.distinct() if self.distinct else rows

    @property
    def sql(self) -> str:
        joins = "".join(f" JOIN {name} ON {left} = {right}" for name, left, right in self.joins)
        cols = ", ".join(f'{text} AS "{name}"' for name, text in self.cols.items())
        where = f" WHERE {self.where}" if self.where else ""
        return f"(SELECT {'DISTINCT ' if self.distinct else ''}{cols} FROM {self.base}{joins}{where})"

    def also(self, **cols: str) -> "Standin":
        """The same stand-in with columns added or redefined."""
        renamed = {name.replace("_", " "): text for name, text in cols.items()}
        return Standin(self.base, {**self.cols, **renamed}, self.joins, self.where, self.distinct)


def iso(col: str) -> str:
    return f"cast(cast({col} as date) as string)"


def later(col: str, days: str) -> str:
    return f"cast({col} as date) + cast({days} as int)"


def mixed_date_text(day: str, key: str) -> str:
    """Three accepted layouts, bad text and null, by a key."""
    text = f"cast({day} as string)"
    dmy = f"concat(substr({text}, 9, 2), '/', substr({text}, 6, 2), '/', substr({text}, 1, 4))"
    return (
        f"case when {key} % 11 = 0 then concat({text}, ' 10:20:30') when {key} % 11 = 1 then 'n/a'"
        f" when {key} % 11 = 2 then null when {key} % 2 = 0 then {dmy} else {text} end"
    )


def dirty_number(number: str, key: str) -> str:
    """A whole number as text, with fractions, junk, blanks and nulls by a key."""
    return (
        f"case when {key} % 17 = 0 then '12.7' when {key} % 17 = 1 then '1d' when {key} % 17 = 2 then ' '"
        f" when {key} % 17 = 3 then null when {key} % 17 = 4 then '-3.9' when {key} % 17 = 5 then '1e3'"
        f" else cast(cast(floor({number}) as bigint) as string) end"
    )


CUSTOMER = ("customer", "o_custkey", "c_custkey")
NATION = ("nation", "c_nationkey", "n_nationkey")
ITEM = "cast(o_orderkey % 30 as string)"
HALVES = "cast(o_orderkey % 9 - 2 as double) / 2"
SENT = later("o_orderdate", "o_orderkey % 20")

# Source A: the stock feed.
STOCK = Standin(
    "orders",
    {
        "CreatedOn": mixed_date_text("cast(o_orderdate as date)", "o_orderkey"),
        "SentOn": mixed_date_text(f"({SENT})", "o_orderkey + 1"),
        "SalesType": "lower(c_mktsegment)",
        "City": "case when o_custkey % 13 = 0 then null else concat('City ', cast(c_nationkey as string)) end",
        "NoPesanan": "cast(o_orderkey + 1000000000 as double)",
        "CustomerName": "c_name",
        "ItemName": f"concat('brand#', {ITEM})",
        "Quantity": f"case when o_orderkey % 17 = 0 then null else {HALVES} end",
    },
    [CUSTOMER, NATION],
)

# Source B: the ERP feed.
ERP = Standin(
    "orders",
    {
        "CreatedOn": "cast(o_orderdate as date)",
        "SentOn": mixed_date_text(f"({SENT})", "o_orderkey"),
        "InvoiceOn": f"case when o_orderkey % 6 = 0 then null else {SENT} end",
        "Quantity": HALVES,
        "CustomerState": "concat(n_name, ' (ID)')",
        "CustomerCity": "concat('city ', cast(c_nationkey as string))",
        "CustomerName": "c_name",
        "CustomerLevel1": "c_mktsegment",
        "CustomerLevel2": "nullif(o_orderpriority, '4-NOT SPECIFIED')",
        "ItemName": f"concat('Brand#', {ITEM})",
        "OrderReference": "concat('so', cast(o_orderkey as string))",
        "Delivery Status": "case when o_orderkey % 2 = 0 then 'full' else 'partial' end",
        "Payment Terms": "concat(cast(o_orderkey % 4 * 15 as string), ' days')",
        "Customer & Address": "concat(c_name, ', ', n_name)",
        "Checked": (
            "case when o_orderkey % 7 = 0 then null when o_orderkey % 7 = 1 then 'Reported in May'"
            " when o_orderkey % 7 = 2 then 'reported' else '' end"
        ),
        "SalesPerson": "'someone'",
        "Status": "'open'",
        "DO Number": "cast(o_orderkey as string)",
    },
    [CUSTOMER, NATION],
)

# Source C: the accounting feed.
ACCOUNTING = Standin(
    "orders",
    {
        "CreatedOn": "o_orderdate",
        "SentOn": SENT,
        "SO Number": "o_orderkey",
        "DO Number": "concat('do-', cast(o_orderkey as string))",
        "Sales Type": "lower(c_mktsegment)",
        "Customer": (
            "case when o_orderkey % 9 = 0 then concat('Employee ', c_name) when o_orderkey % 9 = 1 then null"
            " else c_name end"
        ),
        "Province": "case when o_custkey % 5 = 0 then null else n_name end",
        "City": "concat('city ', cast(c_nationkey as string))",
        "Item Name": f"concat('bRand#', {ITEM})",
        "Qty Sales": "o_orderkey % 50",
        "Revenue": "o_totalprice",
        "Qty Return": "o_orderkey % 3",
        "Quantity": HALVES,
    },
    [CUSTOMER, NATION],
)

# Product sheet: names that differ only by case, many rows a name.
PRODUCT_SHEET = Standin(
    "part",
    {
        "row_no": "p_partkey",
        "ItemName": "case when p_partkey % 3 = 0 then lower(p_brand) else p_brand end",
        "Brand": "p_brand",
        "Category": "p_type",
        "SubCategory": "case when p_size < 25 then 'SMALL' else 'LARGE' end",
        "Variant": "cast(p_size as string)",
        "Product Name": "p_name",
        "Type of Item": (
            "case when p_partkey % 4 = 0 then null when p_partkey % 4 = 1 then 'Activity'"
            " when p_partkey % 4 = 2 then 'Reguler' else 'Other' end"
        ),
    },
)

# The marketplace's product sheet: one row an item, as the lines name them.
ITEM_SHEET = PRODUCT_SHEET.also(ItemName="concat('Item ', cast(p_partkey as string))")

AREA_SHEET = Standin(
    "customer",
    {
        "row_no": "c_custkey",
        "City": "c_name",
        "Region": "r_name",
        "Province": "case when c_nationkey = 7 then '0' when c_nationkey = 9 then null else n_name end",
    },
    [("nation", "c_nationkey", "n_nationkey"), ("region", "n_regionkey", "r_regionkey")],
)

CHANNEL_SHEET = Standin(
    "customer",
    {
        "Channel Group": (
            "case when c_mktsegment in ('BUILDING', 'FURNITURE') then 'ONLINE'"
            " when c_mktsegment = 'MACHINERY' then null else 'OFFLINE' end"
        ),
        "SalesType": "c_mktsegment",
        "SubSalesType": (
            "case when c_custkey % 5 = 0 then '1-URGENT' when c_custkey % 5 = 1 then '2-HIGH'"
            " when c_custkey % 5 = 2 then '3-MEDIUM' when c_custkey % 5 = 3 then '5-LOW' else null end"
        ),
        "Channel": "case when c_custkey % 10 = 3 then 'MODERN' else 'GENERAL' end",
        "Sub Channel": "concat('SUB ', c_mktsegment)",
    },
    distinct=True,
)

# Channels by sales type alone, as the marketplace reads them: padded, one duplicate type.
MARKET_CHANNEL_SHEET = Standin(
    "customer",
    {
        "Channel Group": CHANNEL_SHEET.cols["Channel Group"],
        "SalesType": "concat(' ', c_mktsegment, ' ')",
        "Channel": "'E-COMMERCE'",
        "Sub Channel": "case when c_mktsegment = 'BUILDING' and c_custkey % 2 = 0 then 'B2' else c_mktsegment end",
    },
    distinct=True,
)

POSTCODE_SHEET = Standin(
    "supplier",
    {
        "row_no": "s_suppkey",
        "Kode Pos": (
            "case when s_suppkey % 31 = 0 then ' ' when s_suppkey % 31 = 1 then 'nan'"
            " else concat(' ', cast(10000 + s_nationkey as string), ' ') end"
        ),
        "Area Level 1": "case when s_suppkey % 7 = 0 then null else n_name end",
        "Area Level 2": "concat('CITY ', cast(s_nationkey as string))",
    },
    [("nation", "s_nationkey", "n_nationkey")],
)

CITY_SHEET = Standin(
    "supplier",
    {
        "row_no": "s_suppkey",
        "City": "case when s_suppkey % 17 = 0 then null else concat(' ', n_name, ' ') end",
        "ADM2_NAME (STANDARDIZED)": "case when s_nationkey = 4 then null else concat('STD ', n_name) end",
        "ADM1": "concat('AREA ', cast(n_regionkey as string))",
    },
    [("nation", "s_nationkey", "n_nationkey")],
    "s_nationkey % 5 <> 3",
)

PLACE_ORDERS = Standin(
    "orders",
    {
        "Province": "case when o_custkey % 11 = 0 then null else concat(' P', cast(n_regionkey as string), ' ') end",
        "City": (
            "case when o_custkey % 19 = 0 then null when o_custkey % 2 = 0 then concat(n_name, ' ') else n_name end"
        ),
        "Segment": "c_mktsegment",
        "Day": iso("o_orderdate"),
    },
    [CUSTOMER, NATION],
)

ORDER_DAY = iso("o_orderdate")
MONTH_NAMES = "'JanFebMarAprMayJunJulAugSepOctNovDec'"
SOURCE_FILE = (
    f"concat(substr({ORDER_DAY}, 3, 2), ' ', substr({ORDER_DAY}, 6, 2), ' ',"
    f" substr({MONTH_NAMES}, 3 * cast(substr({ORDER_DAY}, 6, 2) as int) - 2, 3), ' (',"
    f" case when substr({ORDER_DAY}, 9, 2) <= '10' then '1' when substr({ORDER_DAY}, 9, 2) <= '20' then '2'"
    f" else '3' end, case when l_orderkey % 29 = 0 then ') List.xlsx' else ') Report.xlsx' end)"
)

# Marketplace order lines.
MARKET_ORDERS = Standin(
    "lineitem",
    {
        "Source": f"case when l_orderkey % 23 = 0 then concat('~$', {SOURCE_FILE}) else {SOURCE_FILE} end",
        "Marketplace": (
            "case when l_orderkey % 13 = 0 then null when l_orderkey % 13 = 1 then c_mktsegment"
            " when l_orderkey % 13 = 2 then concat('MP_X_', c_mktsegment) when l_orderkey % 13 = 3 then 'MP_NEXUS_NEXUS'"
            " else concat('MP_', c_mktsegment) end"
        ),
        "CreatedOn": "o_orderdate",
        "SentOn": "case when l_linenumber = 1 then null else l_shipdate end",
        "Order Number": "cast(l_orderkey as string)",
        "Item Name": (
            "case when l_partkey % 41 = 0 then null else concat('Item ', cast(l_partkey as string)) end"
        ),
        "Order Status": (
            "case when l_returnflag = 'R' then ' DELIVERED ' when l_returnflag = 'A' then 'DISPATCHED'"
            " else 'CANCELLED' end"
        ),
        "Shipping Postcode": (
            "case when l_orderkey % 19 = 0 then null when l_orderkey % 19 = 1 then '  ' when l_orderkey % 19 = 2 then"
            " '99999' else cast(10000 + c_nationkey as string) end"
        ),
        "Ordered Quantity": dirty_number("l_quantity", "l_orderkey"),
        "Unit Price": dirty_number("l_extendedprice", "l_partkey"),
    },
    [("orders", "l_orderkey", "o_orderkey"), CUSTOMER],
)

# The same lines as the coverage table and the guard read them: numbers as numbers.
MARKET_FACTS = MARKET_ORDERS.also(
    Ordered_Quantity="cast(l_quantity as bigint)",
    Order_Status="trim(case when l_returnflag = 'R' then 'Delivered' when l_returnflag = 'A' then 'Dispatched' else 'x' end)",
    Shipping_City="concat('CITY ', cast(c_nationkey as string))",
    Brand="concat('BRAND ', cast(l_partkey % 25 as string))",
    Category="'CATEGORY'",
    Product_Name="concat('PRODUCT ', cast(l_partkey as string))",
    Variant="cast(null as string)",
)
MARKET_FACTS.cols["Type of Item"] = (
    "case when l_partkey % 10 = 0 then null when l_partkey % 10 = 1 then 'Other' when l_partkey % 10 < 6"
    " then 'Activity' else 'Reguler' end"
)

# A published history: one row an order line.
HISTORY = Standin(
    "lineitem",
    {
        "CreatedOn": "cast(o_orderdate as date)",
        "SentOn": "cast(l_shipdate as date)",
        "NoPesanan": "cast(l_orderkey as string)",
        "Channel": "case when c_mktsegment = 'BUILDING' then 'GENERAL' else 'E-COMMERCE' end",
        "Sub Channel": "c_mktsegment",
        "City": "concat('CITY ', cast(c_nationkey as string))",
        "CustomerName": "c_name",
        "ReportSource": "case when l_linenumber % 3 = 0 then 'STOCK' when l_linenumber % 3 = 1 then 'ERP' else 'MARKET' end",
        "Brand": "concat('BRAND ', cast(l_partkey % 25 as string))",
        "Category": "'CATEGORY'",
        "Product Name": "concat('PRODUCT ', cast(l_partkey as string))",
        "Type of Item": "'REGULER'",
        "Variant": "''",
        "Quantity": "cast(l_quantity as bigint)",
        "Qty Sales": "cast(l_linenumber as bigint)",
        "Revenue": "cast(round(l_extendedprice * 100) as bigint)",
        "Qty Return": "l_suppkey % 2",
    },
    [("orders", "l_orderkey", "o_orderkey"), CUSTOMER],
)

# Day as of which marketplace orders are counted, and the month looked at.
AS_OF = dt.date(1998, 7, 31)
YEAR, MONTH = 1998, 7
ERP_FIRST_DAY = dt.date(1996, 1, 1)


# SQL spellings of the cleaning rules, for the twins.

def strip_sql(x: str) -> str:
    return f"trim({x}, '{BLANKS}')"


def date_sql(x: str) -> str:
    return (
        f"coalesce(try_strptime({x}, '%Y-%m-%d %H:%M:%S')::date, try_strptime({x}, '%Y-%m-%d')::date,"
        f" try_strptime({x}, '%d/%m/%Y')::date)"
    )


def double_sql(x: str) -> str:
    number = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"
    return f"coalesce(case when regexp_full_match({x}, '{number}') then try_cast(trim({x}) as double) end, 0)"


def int_sql(x: str) -> str:
    return f"cast(trunc({double_sql(x)}) as bigint)"


def round_sql(x: str) -> str:
    return f"cast(round_even({x}, 0) as bigint)"


def spark_sale_day(sent: str = '"SentOn"', created: str = '"CreatedOn"') -> str:
    return f"coalesce(cast({sent} as date), cast({created} as date))"
