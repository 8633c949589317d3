"""Parquet facts and delimited text files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Decimal
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesflow.functions import named
from salesflow.functions.text import NA_TOKENS, na_to_null, strip
from salesflow.operators.shape import require_columns, union_relaxed
from salesflow.sources.records import ends_inside, file_lines, first_records, header_names, parsed_records

# Regional workbooks are numbered; other files in the folder are strays.
REGIONAL_NAME = r"(?i)^\d+\. .+ Sell Through\.xlsx$"
# Words in the names of files that hold roll-ups rather than months.
ROLLUP_WORDS = ("report", "combined_sales")


def read_facts(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """Named columns of a parquet table; only these are read."""
    return require_columns(spark.read.parquet(path), cols).select(*[named(c) for c in cols])


def select_files(
    df: DataFrame, name: str, include: str | None = None, keyword: str | None = None,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Rows whose file name matches a pattern, holds a keyword and holds no excluded word.

    Keyword and excluded words ignore case.
    """
    col, out = named(name), df
    if include:
        out = out.filter(col.rlike(include))
    if keyword:
        out = out.filter(F.lower(col).contains(keyword.lower()))
    for word in exclude:
        out = out.filter(~F.lower(col).contains(word.lower()))
    return out


def list_files(spark: SparkSession, folder: str, suffix: str, recursive: bool = True) -> list[str]:
    """Paths below a folder, or in it alone, with a suffix, sorted; works on any store Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, recursive)
    paths = []
    while found.hasNext():
        paths.append(found.next().getPath().toString())
    return sorted(p for p in paths if p.endswith(suffix))


def _csv(spark: SparkSession, sep: str):
    # Quotes inside quoted cells are doubled.
    return spark.read.options(
        header=True, sep=sep, quote='"', escape='"', encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


# Rows of one read have smaller numbers.
BLOCK_SCALE = Decimal(2**63)


class FileShape(NamedTuple):
    """What one pass over the lines of a delimited file shows. The header is its first record."""

    header: str
    multiline: bool
    empty: bool


def file_shapes(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> dict[str, FileShape]:
    """Header, line breaks inside quoted cells, and whether only a header is there, of every file.

    One job for all files: a line that begins outside a quoted cell and ends inside one is cut by
    a break. Files without a line are left out. Where a header itself holds a break, one more job
    puts these together.
    """
    place = F.struct("block", "line")
    lines = file_lines(spark, paths).withColumn("cut", ends_inside(F.col("value"), sep, False))
    found = lines.filter(strip("value") != "").groupBy("file").agg(
        F.min_by(F.struct("value", "cut"), place).alias("first"), F.bool_or("cut").alias("multiline"), F.count("*").alias("lines")
    )
    shapes, broken = {}, []
    for row in found.collect():
        path = _without_scheme(unquote(row["file"]))
        shapes[path] = FileShape(row["first"]["value"].removesuffix("\r"), row["multiline"], row["lines"] < 2)
        if row["first"]["cut"]:
            broken.append(path)
    if broken:
        given = {_without_scheme(p): p for p in paths}
        for row in first_records(spark, [given[p] for p in broken], sep).collect():
            path = _without_scheme(unquote(row["file"]))
            shapes[path] = FileShape(row["header"], True, row["records"] < 2)
    return shapes


def _without_scheme(path: str) -> str:
    # Listings and metadata put one slash or three behind the scheme.
    return re.sub(r"^[A-Za-z0-9+.-]+:/+", "/", path)


def read_text_csvs(
    spark: SparkSession, paths: Sequence[str], na_tokens: Sequence[str] = NA_TOKENS,
    stem_col: str | None = None, skip_empty: bool = False,
) -> DataFrame:
    """CSV files as text, stacked by column name, "missing" texts as null.

    Headers may differ per file. Spark binds CSV columns by position, so files are read in
    groups of equal headers. One job over all files finds the headers and the files with line
    breaks inside cells; these too are read by all tasks (``records``), so a single large file
    never holds up the rest. ``stem_col`` adds the file name up to its first ``_``;
    ``skip_empty`` leaves out the columns of files without a row.
    """
    shapes = file_shapes(spark, paths)
    groups: dict[tuple[bool, str], list[str]] = {}
    for path in paths:
        shape = shapes.get(_without_scheme(path))
        if shape is not None and not (skip_empty and shape.empty):
            groups.setdefault((shape.multiline, shape.header), []).append(path)
    if not groups:
        raise ValueError(f"no CSV with a header among {len(paths)} files")
    parts = []
    for (multiline, header), files in groups.items():
        if multiline:
            names = header_names(header)
            raw, stem = parsed_records(spark, files, names), _stem(stem_col, F.element_at(F.split("__file", "/"), -1))
        else:
            raw, stem = _csv(spark, ",").csv(files), _stem(stem_col, F.col("_metadata.file_name"))
            names = raw.columns
        parts.append(raw.select(*[na_to_null(c, na_tokens).alias(c) for c in names], *stem))
    return union_relaxed(*parts)


def file_name(encoded: Column | None = None) -> Column:
    """Name of the file a row was read from; Spark keeps it percent-encoded."""
    encoded = F.col("_metadata.file_name") if encoded is None else encoded
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def file_place() -> Column:
    """Where in its file a row of a split file stands: block start and number of the row, in one number.

    Sorts in file order within a file; no two rows of one share it.
    """
    block = F.col("_metadata.file_block_start").cast("decimal(19,0)")
    return (block * F.lit(BLOCK_SCALE) + F.monotonically_increasing_id()).cast("decimal(38,0)")


def _stem(alias: str | None, encoded: Column) -> list[Column]:
    return [] if alias is None else [F.substring_index(file_name(encoded), "_", 1).alias(alias)]


def read_delimited_master(
    spark: SparkSession, path: str, sep: str = ";", required: Sequence[str] = (),
    na_tokens: Sequence[str] = NA_TOKENS, row_no: str | None = None,
) -> DataFrame:
    """A delimited master as text: header names stripped, "missing" as null.

    Bytes that are not UTF-8 become the replacement character. ``required`` columns are
    checked before the rows are read. ``row_no`` names a column by which rows sort in file order, a
    whole number where the path is one file; it may be a folder of files that share a header.
    """
    shapes = file_shapes(spark, [path], sep).values()
    if any(shape.multiline for shape in shapes):
        headers = {shape.header for shape in shapes}
        if len(headers) > 1:
            raise ValueError(f"master {path}: files with different headers")
        given = header_names(headers.pop(), sep)
        raw = parsed_records(spark, [path], given, sep)
        place = F.col("__number") if len(shapes) == 1 else F.struct("__file", "__number")
    else:
        raw = _csv(spark, sep).csv(path)
        given, place = raw.columns, file_place() if len(shapes) == 1 else F.struct(F.col("_metadata.file_path"), file_place())
    names = [c.strip().lstrip("\ufeff") for c in given]
    order = [] if row_no is None else [place.alias(row_no)]
    out = raw.select(*[na_to_null(old, na_tokens).alias(new) for old, new in zip(given, names)], *order)
    return require_columns(out, required, f"master {path}")


def with_lineage(df: DataFrame, report_source: str) -> DataFrame:
    """Mark each row with the feed it came from."""
    return df.withColumn("ReportSource", F.lit(report_source))
