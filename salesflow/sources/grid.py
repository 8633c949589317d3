"""Sheet grids: one row per sheet row, cells as arrays.

A grid has ``source_file, sheet, sheet_no, sheet_state, row_no, cells, cell_types``, where
``cells`` is ``array<string>``, ``cell_types`` tells what the sheet stored (empty, text, bool,
int, float, date, datetime) and ``row_no`` starts at 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from salesflow.functions import named
from salesflow.functions.text import cell_text, strip
from salesflow.operators.joins import lookup
from salesflow.session import staged

EXCLUDED_SHEETS = ("master_data",)
SHEET_KEYS = ["source_file", "sheet"]
LINEAGE = ["SourceFile", "SheetName"]


def visible_sheets(grid: DataFrame, excluded: Sequence[str] = EXCLUDED_SHEETS) -> DataFrame:
    """Rows of visible sheets whose stripped lower-case name is not excluded."""
    kept = ~F.lower(strip("sheet")).isin(list(excluded))
    return grid.filter((F.col("sheet_state") == "visible") & kept)


def cell(position: int | Column) -> Column:
    """A cell as text; null past the end of a short row."""
    at = F.lit(position) if isinstance(position, int) else position
    return cell_text(F.get("cells", at), F.get("cell_types", at))


def grid_to_table(
    grid: DataFrame, positions: Mapping[str, int], skip: int = 0, keep: Sequence[str] = ("row_no",)
) -> DataFrame:
    """Columns by cell position, the first rows skipped."""
    cols = [cell(at).alias(name) for name, at in positions.items()]
    return grid.filter(F.col("row_no") >= skip).select(*keep, *cols)


def promote_header(grid: DataFrame, names: Sequence[str], header_row: int = 0) -> DataFrame:
    """The named columns of one sheet, found in its header row; a grid of several sheets is an error."""
    found = grid.filter(F.col("row_no") == header_row).select("cells").take(2)
    if len(found) != 1:
        raise ValueError(f"{'no header' if not found else 'headers of several sheets'} in row {header_row}")
    header = found[0]
    missing = [n for n in names if n not in header["cells"]]
    if missing:
        raise ValueError(f"header lacks {missing}")
    return grid_to_table(grid, {n: header["cells"].index(n) for n in names}, header_row + 1)


def sheet_headers(grid: DataFrame) -> DataFrame:
    """One row per sheet with its ``header``: names stripped, blank ones null.

    A name that occurs again in the same sheet gets ``.1``, ``.2`` and so on.
    """
    def numbered(name: Column, at: Column) -> Column:
        before = F.size(F.filter(F.slice("cells", 1, at), lambda other: other == name))
        again = F.concat(name, F.lit("."), before.cast("string"))
        return F.nullif(strip(F.when(before > 0, again).otherwise(name)), F.lit(""))

    return grid.filter(F.col("row_no") == 0).select(
        *SHEET_KEYS, "sheet_no", F.transform("cells", numbered).alias("header")
    )


def column_names(headers: DataFrame) -> tuple[list[str], int]:
    """Header names in first-seen order over files, sheets and positions, and how many of
    them the first sheet has.

    Reduced to one row per name before it reaches the driver; ``Unnamed:`` columns are out.
    """
    seen = headers.select("source_file", "sheet_no", F.posexplode("header").alias("at", "name"))
    first = F.min(F.struct("source_file", "sheet_no", "at"))
    rows = (
        seen.filter(F.col("name").isNotNull() & ~F.col("name").startswith("Unnamed:"))
        .groupBy("name")
        .agg(first.alias("first"))
        .orderBy("first")
        .collect()
    )
    opening = [row for row in rows if row["first"][:2] == rows[0]["first"][:2]]
    return [row["name"] for row in rows], len(opening)


def number_mark(name: str) -> str:
    """Column that tells whether the sheet stored a number in ``name``."""
    return f"{name}__is_number"


def one_sheet(grid: DataFrame, sheet: str) -> DataFrame:
    return grid.filter(F.col("sheet") == sheet)


def stack_sheets(grid: DataFrame) -> tuple[DataFrame, list[str]]:
    """All sheets as one table of cell texts, matched by header name, and the column order.

    In the order, file and sheet name stand behind the columns of the first sheet; columns
    that only later sheets have come after them.

    The grid is read once for the headers, which are written aside, and once for the rows:
    every sheet's header becomes a list of cell positions, looked up by sheet, so that a
    column is one array access whatever order a sheet keeps. Each column has a
    ``number_mark`` column beside it.
    """
    headers = staged(sheet_headers(grid), "headers")
    names, opening = column_names(headers)
    spots = F.array(*[F.array_position("header", F.lit(n)).cast("int") - 1 for n in names])
    placed = lookup(
        grid.filter(F.col("row_no") > 0), headers.select(*SHEET_KEYS, spots.alias("__spots")), SHEET_KEYS
    )
    # A position of -1 means the sheet lacks the column.
    marks = [F.nullif(F.get("__spots", F.lit(i)), F.lit(-1)).alias(f"__at_{i}") for i in range(len(names))]
    placed = placed.select("cells", "cell_types", *SHEET_KEYS, *marks)
    cols = []
    for i, name in enumerate(names):
        at = F.col(f"__at_{i}")
        number = F.get("cell_types", at).isin("int", "float")
        cols += [cell(at).alias(name), F.coalesce(number, F.lit(False)).alias(number_mark(name))]
    lineage = [named("source_file").alias(LINEAGE[0]), named("sheet").alias(LINEAGE[1])]
    return placed.select(*cols, *lineage), [*names[:opening], *LINEAGE, *names[opening:]]
