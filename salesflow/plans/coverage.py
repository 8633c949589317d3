"""City coverage: all sales in one schema, and order numbers with standardised places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from salesflow.functions import named
from salesflow.operators.joins import prepared
from salesflow.operators.masters import place_master, standardise_places, unmatched_places
from salesflow.operators.shape import conform, rename_drop
from salesflow.schemas import COVERAGE_SCHEMA
from salesflow.sources.files import list_files, read_delimited_master, read_text_csvs
from salesflow.sources.sinks import write_exceptions, write_union

OFFLINE_RENAMES = {"NoPesanan": "Order Number"}
ONLINE_RENAMES = {
    "Shipping City": "City",
    "Marketplace": "CustomerName",
    "Ordered Quantity": "Quantity",
}
ORDER_KEYWORD = "order_number"
MASTER_CITY, MASTER_STANDARD, MASTER_AREA = "City", "ADM2_NAME (STANDARDIZED)", "ADM1"


def coverage_sales(history: DataFrame, marketplace: DataFrame) -> DataFrame:
    """Offline history and marketplace orders in one 13-column table."""
    online = rename_drop(marketplace, ONLINE_RENAMES, ["Channel", "City", "CustomerName", "Quantity"])
    online = online.withColumns({"Channel": F.lit("ONLINE"), "Sub Channel": named("CustomerName")})
    offline = rename_drop(history, OFFLINE_RENAMES)
    return conform(offline, COVERAGE_SCHEMA).unionByName(conform(online, COVERAGE_SCHEMA))


def write_coverage_sales(history: DataFrame, marketplace: DataFrame, path: str) -> int:
    """Write the coverage table in one pass; returns its row count."""
    return write_union(coverage_sales(history, marketplace), path)


def city_master(sheet: DataFrame, order: list[str], by_place: bool = False) -> DataFrame:
    return place_master(sheet, MASTER_CITY, MASTER_STANDARD, MASTER_AREA, order, by_place)


def coverage_orders(
    spark: SparkSession, folder: str, master_path: str, out: str, unmatched_out: str | None = None
) -> DataFrame:
    """Order-number files with standardised places, written; returns the unmatched places.

    The master keeps its first row per city, in file order.
    """
    files = [p for p in list_files(spark, folder, ".csv", recursive=False) if ORDER_KEYWORD in p.rsplit("/", 1)[-1].lower()]
    if not files:
        raise ValueError(f"no CSV with '{ORDER_KEYWORD}' in its name in {folder}")
    orders = read_text_csvs(spark, files)
    sheet = read_delimited_master(
        spark, master_path, required=[MASTER_CITY, MASTER_STANDARD, MASTER_AREA], row_no="row_no"
    )
    one_file = not isinstance(sheet.schema["row_no"].dataType, StructType)
    master = prepared(city_master(sheet, ["row_no"], by_place=one_file))
    write_union(standardise_places(orders, master), out)
    missing = unmatched_places(orders, master)
    if unmatched_out:
        write_exceptions(missing, unmatched_out)
    return missing
