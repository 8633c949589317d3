"""Records of delimited files whose quoted cells hold line breaks, found by all tasks at once.

Whether a line begins inside a quoted cell depends on all lines before it. But what a line does is a
small function: where it ends, inside or outside a quoted cell, when it begins outside, and where
when it begins inside. Such functions compose: a line keeps the state, turns it round, or sets it.
So every file block is first summed up by its function, a running composition over the blocks of a
file gives the state each begins in, and then all blocks cut their lines into records at the same
time. Only records of several lines are put together by a further shuffle; one may reach over any
number of blocks.

A quote opens a cell at the cell's start only; elsewhere outside a cell it is text. Inside, a quote
closes and a doubled one is a quote. Blank lines between records are none. A quote that is never
closed makes the rest of its file one record.
"""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from salesflow.functions.text import strip

OUTSIDE, INSIDE, PLAIN = 0, 1, 2  # PLAIN: outside, after a quote that is mere text
QUOTE = '"'


def ends_inside(line: Column, sep: str, begins_inside: bool) -> Column:
    """Whether a line that begins inside or outside a quoted cell ends inside one."""

    def pass_quote(state: Column, before: Column) -> Column:
        opens = before.endswith(sep) | ((state == OUTSIDE) & (before == ""))
        return F.when(state == INSIDE, OUTSIDE).when(opens, INSIDE).otherwise(PLAIN)

    pieces = F.split(line, QUOTE)
    before_quotes = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    walked = F.aggregate(before_quotes, F.lit(INSIDE if begins_inside else OUTSIDE), pass_quote)
    return F.when(F.contains(line, F.lit(QUOTE)), walked == INSIDE).otherwise(F.lit(begins_inside))


def file_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with their file, the start of their block, and a number that grows along the block."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value",
    )


def _xor(a: Column, b: Column) -> Column:
    return (a + b) % 2


def _running(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Adds what the functions (from_out, from_in) up to and before each row amount to.

    ``turns`` counts those that turn the state round, ``set`` is the state that the last one which
    sets it left, had none turned since; null if none did.
    """
    turns = (F.col("from_out") == 1) & (F.col("from_in") == 0)
    sets = F.col("from_out") == F.col("from_in")
    until = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    counted = df.withColumn("turns", F.sum(turns.cast("int")).over(until))
    marked = counted.withColumn("mark", F.when(sets, _xor(F.col("from_out"), F.col("turns"))))
    return marked.withColumns({
        "turns_before": F.coalesce(F.sum(turns.cast("int")).over(before), F.lit(0)),
        "set_before": F.last("mark", ignorenulls=True).over(before),
        "set": F.last("mark", ignorenulls=True).over(until),
    })


def records(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> DataFrame:
    """The records of the files: file, place (sorts in file order), number (from 1) and record."""
    lines = file_lines(spark, paths).withColumns(
        {"from_out": ends_inside(F.col("value"), sep, False).cast("int"), "from_in": ends_inside(F.col("value"), sep, True).cast("int")}
    )
    known = _running(lines, ["file", "block"], "line")
    # the state before the line, for a block that begins outside or inside
    at = {b: F.coalesce(_xor(F.col("set_before"), F.col("turns_before")), _xor(F.lit(b), F.col("turns_before"))) for b in (0, 1)}
    starts = {b: ((at[b] == OUTSIDE) & (strip("value") != "")).cast("long") for b in (0, 1)}
    so_far = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    known = known.withColumns({f"state{b}": at[b] for b in (0, 1)})
    known = known.withColumns({f"number{b}": F.sum(starts[b]).over(so_far) for b in (0, 1)})

    ends = F.max_by(F.struct("turns", "set", "number0", "number1"), "line")
    blocks = known.groupBy("file", "block").agg(ends.alias("last")).select("file", "block", "last.*")
    blocks = blocks.select(
        "file", "block", "number0", "number1",
        F.coalesce(_xor(F.col("set"), F.col("turns")), F.col("turns") % 2).alias("from_out"),
        F.coalesce(_xor(F.col("set"), F.col("turns")), _xor(F.lit(1), F.col("turns"))).alias("from_in"),
    )
    placed = _running(blocks, ["file"], "block")
    begins = F.coalesce(_xor(F.col("set_before"), F.col("turns_before")), F.col("turns_before") % 2)
    placed = placed.withColumn("begins", begins)
    placed = placed.withColumn("n", F.when(F.col("begins") == 0, F.col("number0")).otherwise(F.col("number1")))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select("file", "block", "begins", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))

    found = known.join(placed, ["file", "block"])
    outside_first = F.col("begins") == OUTSIDE
    state = F.when(outside_first, F.col("state0")).otherwise(F.col("state1"))
    number = F.col("earlier") + F.when(outside_first, F.col("number0")).otherwise(F.col("number1"))
    still = F.when(state == OUTSIDE, F.col("from_out")).otherwise(F.col("from_in"))
    rows = found.select(
        "file", F.struct("block", "line").alias("place"), number.alias("number"), "value",
        state.alias("state"), (still == INSIDE).alias("open"),
    )
    whole = rows.filter((F.col("state") == OUTSIDE) & ~F.col("open") & (strip("value") != ""))
    pieces = rows.filter((F.col("state") == INSIDE) | F.col("open")).groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("place", "value"))).alias("lines")
    )
    joined = pieces.select(
        "file", F.col("lines")[0]["place"].alias("place"), "number",
        F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("value"),
    )
    record = F.regexp_replace("value", "\r$", "").alias("record")
    return whole.select("file", "place", "number", record).unionByName(joined.select("file", "place", "number", record))


def header_names(header: str, sep: str = ",") -> tuple[str, ...]:
    """Column names in a header record, as Spark's reader names them: ``_c`` and the place for an
    empty one, the place behind names that repeat, whatever their case."""
    cells = next(csv.reader(io.StringIO(header.removeprefix("﻿"), newline=""), delimiter=sep))
    repeats = Counter(c.lower() for c in cells)
    return tuple(f"_c{i}" if not c else f"{c}{i}" if repeats[c.lower()] > 1 else c for i, c in enumerate(cells))


def first_records(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> DataFrame:
    """Per file its first record and how many records it has."""
    return records(spark, paths, sep).groupBy("file").agg(
        F.max(F.when(F.col("number") == 1, F.col("record"))).alias("header"), F.max("number").alias("records")
    )


def parsed_records(spark: SparkSession, paths: Sequence[str], names: Sequence[str], sep: str = ",") -> DataFrame:
    """The cells of files that share a header, as text under its names, with ``__file`` and ``__number``, the record's in its file."""
    # places keep names apart that differ by case alone
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE"}
    cells = F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    rows = records(spark, paths, sep).filter("number > 1").select("file", "number", cells.alias("cells"))
    return rows.select(
        *[F.col("cells")[f"c{i}"].alias(name) for i, name in enumerate(names)], F.col("file").alias("__file"), F.col("number").alias("__number")
    )
