"""The masters out of the master workbook's sheet grid.

Each sheet has its own layout: some are read by cell position below a heading, others by the
names in a header row. Positions, rows and names are fixed values of the workbook.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from salesflow.operators.masters import (
    CHANNEL_COLUMNS, area_master, channel_master, marketplace_channels, postcode_master, product_master,
    product_master_upper,
)
from salesflow.plans.marketplace import Masters
from salesflow.sources.grid import grid_to_table, one_sheet, promote_header

PRODUCT_CELLS = {
    "ItemName": 1, "Brand": 2, "Category": 3, "SubCategory": 4, "Variant": 5, "Product Name": 6, "Type of Item": 7,
}
PRODUCT_SKIP, PRODUCT_HEADER_ROW = 3, 2
PRODUCT_NAMES = ["ItemName", "Brand", "Category", "Sub Category", "Variant", "Product Name", "Type of Item"]
AREA_CELLS = {"City": 1, "Region": 2, "Province": 3}
AREA_SKIP = 5
POSTCODE_NAMES = ["Kode Pos", "Area Level 1", "Area Level 2"]
MARKET_CHANNEL_NAMES = ["Channel Group", "SalesType", "Channel", "Sub Channel"]


def report_masters(grid: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Product, area and channel masters as the offline feeds use them."""
    product = product_master(grid_to_table(one_sheet(grid, "Product"), PRODUCT_CELLS, PRODUCT_SKIP), ["row_no"])
    area = area_master(grid_to_table(one_sheet(grid, "Area"), AREA_CELLS, AREA_SKIP), ["row_no"])
    channel = channel_master(promote_header(one_sheet(grid, "Channel"), CHANNEL_COLUMNS))
    return product, area, channel


def market_masters(grid: DataFrame, blank_as_text: bool = False) -> Masters:
    """Postcode, channel and product masters as the marketplace uses them."""
    codes = promote_header(one_sheet(grid, "Kode Pos"), POSTCODE_NAMES)
    channel = promote_header(one_sheet(grid, "Channel"), MARKET_CHANNEL_NAMES)
    product = promote_header(one_sheet(grid, "Product"), PRODUCT_NAMES, PRODUCT_HEADER_ROW)
    return Masters(
        postcode_master(codes, ["row_no"]),
        marketplace_channels(channel),
        product_master_upper(product, PRODUCT_NAMES, blank_as_text),
    )
