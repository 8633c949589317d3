"""Fixed target schemas. Names, order and types are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

DATE, LONG, TEXT = DateType(), LongType(), StringType()

# Typed monthly history: which columns are dates, whole numbers and texts.
HISTORY_DATES = ["CreatedOn", "SentOn", "InvoiceOn"]
HISTORY_LONGS = ["Qty Sales", "Revenue", "Qty Return", "Quantity"]
HISTORY_TEXTS = [
    "NoPesanan", "SalesType", "SubSalesType", "Channel Group", "Channel", "Sub Channel",
    "Region", "Province", "City", "CustomerName", "Payment Terms", "Customer & Address",
    "SO Number", "ReportSource", "ItemName", "Status", "Brand", "Category", "SubCategory",
    "Variant", "Product Name", "Type of Item",
]

# Monthly report, 29 columns in report order.
REPORT_COLUMNS = [
    "CreatedOn", "SentOn", "NoPesanan", "SalesType", "SubSalesType", "Channel Group", "Channel",
    "Sub Channel", "Region", "Province", "City", "CustomerName", "Payment Terms",
    "Customer & Address", "InvoiceOn", "SO Number", "Qty Sales", "Revenue", "Qty Return",
    "ReportSource", "ItemName", "Quantity", "Status", "Brand", "Category", "SubCategory",
    "Variant", "Product Name", "Type of Item",
]

# Marketplace month, 18 columns.
MARKETPLACE_COLUMNS = [
    "CreatedOn", "SentOn", "SalesType", "NoPesanan", "ItemName", "Quantity", "Unit Price",
    "Province", "City", "Channel Group", "Channel", "Sub Channel", "Brand", "Category",
    "Sub Category", "Variant", "Product Name", "Type of Item",
]

# Coverage sales, 13 columns.
COVERAGE_COLUMNS = [
    "Brand", "Category", "Channel", "CreatedOn", "City", "CustomerName", "Order Number",
    "Product Name", "Quantity", "SentOn", "Sub Channel", "Type of Item", "Variant",
]


def typed_struct(names: list[str]) -> StructType:
    """The given columns with the history's types; a name it does not list is text."""
    kinds = {**dict.fromkeys(HISTORY_DATES, DATE), **dict.fromkeys(HISTORY_LONGS, LONG)}
    return StructType([StructField(n, kinds.get(n, TEXT)) for n in names])


REPORT_SCHEMA = typed_struct(REPORT_COLUMNS)
COVERAGE_SCHEMA = typed_struct(COVERAGE_COLUMNS)
