"""Keep-first de-duplication, the master tables, and places standardised against a master."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, IntegralType

from salesflow.functions import named
from salesflow.functions.kinds import as_upper, column_as
from salesflow.functions.text import strip
from salesflow.operators.filters import drop_sentinel, has_key
from salesflow.operators.joins import MISSING, lookup, prepared

PRODUCT_COLUMNS = [
    "ItemName", "Brand", "Category", "SubCategory", "Variant", "Product Name", "Type of Item",
]
CHANNEL_COLUMNS = ["SalesType", "SubSalesType", "Channel Group", "Channel", "Sub Channel"]
# Text under which a missing place matches the master's blank row.
MISSING_PLACE = "nan"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key, null being a key, in the given order.

    Rows that tie in the order are taken by their other columns, so the result never depends
    on how the table is split. A grouped minimum over whole rows keeps one per key and map task,
    so only candidates are shuffled, also of a hot key; but each map task sorts its rows.
    ``first_by_place`` does not, where the order is a place.
    """
    rest = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    row = F.struct(*[named(c).alias(f"c{i}") for i, c in enumerate(rest)])
    firsts = df.groupBy(*[named(k) for k in keys]).agg(F.min(row).alias("__row"))
    spots = {c: F.col("__row").getField(f"c{i}") for i, c in enumerate(rest)}
    return firsts.select(*[spots[c].alias(c) if c not in keys else named(c) for c in df.columns])


def first_by_place(df: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """The first row of every key, null being a key, by a whole number that no two rows share.

    Only keys and places are grouped, by hashing and with one number per key and map task, so a
    hot key costs no more than others; the rows themselves are found again by key and place and
    are not shuffled while the keys' places fit a broadcast.
    """
    if not isinstance(df.schema[place].dataType, (IntegralType, DecimalType)):
        raise ValueError(f"{place} is no whole number")
    firsts = df.groupBy(*[named(k) for k in keys]).agg(F.min(named(place)).alias(place))
    return lookup(df, prepared(firsts), [*keys, place], "inner").select(*[named(c) for c in df.columns])


def product_master(sheet: DataFrame, order: Sequence[str]) -> DataFrame:
    """Distinct on the raw item name, then upper-cased.

    Names that differ only by case survive and become duplicate keys.
    """
    first = keep_first(sheet, ["ItemName"], order)
    return first.withColumn("ItemName", column_as(first, "ItemName", as_upper)).select(
        *[named(c) for c in PRODUCT_COLUMNS]
    )


def product_master_upper(
    sheet: DataFrame, columns: Sequence[str], blank_as_text: bool = False
) -> DataFrame:
    """The marketplace's product master: every row kept, every column upper-cased.

    ``blank_as_text`` writes a blank cell as the text NAN, which a later item type filter
    then drops; by default it stays null and is kept.
    """
    out = sheet.select(*[column_as(sheet, c, as_upper).alias(c) for c in columns])
    return out.na.fill("NAN") if blank_as_text else out


def area_master(sheet: DataFrame, order: Sequence[str], sentinel: str = "0") -> DataFrame:
    """Province to region: first row per province, then the sentinel row goes."""
    firsts = keep_first(sheet, ["Province"], order)
    return firsts.filter(drop_sentinel("Province", sentinel)).select("Province", "Region")


def channel_master(sheet: DataFrame) -> DataFrame:
    """Channel names by sales type and sub type, duplicates kept."""
    return sheet.select(*[named(c) for c in CHANNEL_COLUMNS])


def marketplace_channels(sheet: DataFrame) -> DataFrame:
    """Channel names by sales type alone, the type stripped, duplicates kept."""
    return sheet.select(
        named("Channel Group"), strip("SalesType").alias("SalesType"), named("Channel"), named("Sub Channel")
    )


def postcode_master(
    sheet: DataFrame, order: Sequence[str], key: str = "Kode Pos",
    province: str = "Area Level 1", city: str = "Area Level 2",
) -> DataFrame:
    """Postcode to province and city: stripped keys, blanks out, first row per key."""
    rows = sheet.withColumnsRenamed({province: "Province", city: "City"}).withColumn(key, strip(key))
    return keep_first(rows.filter(has_key(key)), [key], order).select(named(key), "Province", "City")


def lookup_fanout(master: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Master keys that would multiply rows, with how many rows each has."""
    return (
        master.groupBy(*[named(k) for k in keys])
        .agg(F.count("*").alias("master_rows"))
        .filter(F.col("master_rows") > 1)
    )


def place_key(city: str) -> Column:
    """Join key of a place: stripped, with missing matching missing."""
    return strip(F.coalesce(named(city), F.lit(MISSING_PLACE)))


def place_master(
    sheet: DataFrame, city: str, standard: str, area: str, order: Sequence[str], by_place: bool = False
) -> DataFrame:
    """Place key to standard name and area, first row per key; ``by_place`` where the order is one
    whole number that no two rows share."""
    names = [named(standard).alias("ADM2_Standardized"), named(area).alias("ADM1")]
    if by_place:
        rows = sheet.select(place_key(city).alias("__place"), *names, named(order[0]).alias("__order"))
        return first_by_place(rows, ["__place"], "__order").drop("__order")
    rows = sheet.select(place_key(city).alias("__place"), *names, F.struct(*[named(c) for c in order]).alias("__order"))
    return keep_first(rows, ["__place"], ["__order"]).drop("__order")


def _with_place(orders: DataFrame, master: DataFrame, city: str) -> DataFrame:
    return lookup(orders.withColumn("__place", place_key(city)), master, ["__place"], nulls_match=False).drop(
        "__place"
    )


def standardise_places(orders: DataFrame, master: DataFrame, city: str = "City") -> DataFrame:
    """Distinct order rows with standard name and area, ``-`` where there is none.

    The master has one row per key, so the rows are made distinct before the lookup: fewer
    and narrower rows are shuffled, with the same result.
    """
    found = _with_place(orders.distinct(), master, city)
    return found.withColumns(
        {c: F.coalesce(F.col(c), F.lit(MISSING)) for c in ("ADM2_Standardized", "ADM1")}
    )


def unmatched_places(
    orders: DataFrame, master: DataFrame, province: str = "Province", city: str = "City"
) -> DataFrame:
    """Distinct stripped places without a standard name, null last.

    A place found in the master with a null standard name is on the list too. The pairs are
    made distinct before the lookup, so only places are shuffled, not orders.
    """
    pairs = orders.select(named(province), named(city)).distinct()
    missing = _with_place(pairs, master, city).filter(F.col("ADM2_Standardized").isNull())
    return (
        missing.select(strip(province).alias(province), strip(city).alias(city))
        .distinct()
        .orderBy(named(province).asc_nulls_last(), named(city).asc_nulls_last())
    )
