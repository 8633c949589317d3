"""Audit of how filters interact: what each removes in every order in which they can be applied.

A document is summed up by its mask, one bit a filter that it fails. Documents are counted by part and
mask, so 32 cells at most are left of a part whatever its size. Each cell folds over the array of all
120 orders: along an order the first filter that the mask fails removes the cell's documents and the
later ones find them gone, which gives 600 structs of counts weighted by the cell; the cells of a part
are merged by elementwise sums. All of it is higher-order SQL functions on rows the size of the
calendar of orders, after one scan of the texts.

A filter on copies needs the whole table. A text is named by its SHA-256 and length. Documents are
counted by text, doc_id and part, then by text and part with the smallest doc_id on the way, so a text
that fills a third of the table is reduced before each shuffle; no join and no group of copies is met.

Defined cases: a null text is empty, a null part is the empty string. A null doc_id is neither smaller
nor larger than another, so such a row fails no copy filter and makes none fail; it has no labels.
Rows that share the smallest doc_id of a text all pass. A doc_id with several labels is good, or
toxic, if any of them says so. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.operators.joins import lookup
from salesflow.session import staged

FILTERS = "ABCDE"
COPY = FILTERS.index("E")
LEAST_WORDS = 100
LEAST_DISTINCT = 80  # percent of the words
MOST_CAPITALS = 10  # percent of the code points
SIGNS = "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: Column) -> Column:
    """The bits of the filters that look at one text alone, A to D."""
    words = F.array_remove(F.split(text, SPACE), "")
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    fails = [
        F.size(words) < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        100 * capitals > MOST_CAPITALS * F.length(text),
        text.rlike(SIGNS),
    ]
    return sum(F.when(fail, F.lit(1 << i)).otherwise(F.lit(0)) for i, fail in enumerate(fails))


def label_flags(labels: DataFrame) -> DataFrame:
    """One row a labelled doc_id: whether any label calls it good, or toxic."""
    def any_is_one(name: str) -> Column:
        return F.coalesce(F.bool_or(F.col(name) == 1), F.lit(False)).alias(name)

    named = labels.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
    return named.groupBy("doc_id").agg(any_is_one("quality"), any_is_one("toxic"))


def mask_cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts by part and mask: n documents, of these good ones and toxic ones."""
    whole = F.coalesce("text", F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(whole, 256)).alias("digest"), F.octet_length(whole).alias("bytes"), text_mask(whole).alias("mask"),
    )
    by_id = rows.groupBy("digest", "bytes", "doc_id", "part").agg(F.first("mask").alias("mask"), F.count("*").alias("n"))
    marked = lookup(staged(by_id, "masks"), staged(label_flags(labels), "label-flags"), ["doc_id"], nulls_match=False)
    flags = {name: F.coalesce(F.col(name), F.lit(False)) for name in ("quality", "toxic")}
    # within a text and part: all documents, those without a doc_id, and those of its smallest one
    copies = marked.withColumns(flags).groupBy("digest", "bytes", "part", "mask", "quality", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unknown"),
        F.min("doc_id").alias("low"), F.min_by("n", "doc_id").alias("low_n"),
    )
    of_text = Window.partitionBy("digest", "bytes")
    cells = copies.withColumn("least", F.min("low").over(of_text))
    first = F.col("unknown") + F.when(F.col("low") == F.col("least"), F.col("low_n")).otherwise(0)
    both = F.array(
        F.struct(F.col("mask").alias("mask"), first.alias("n")),
        F.struct((F.col("mask") + (1 << COPY)).alias("mask"), (F.col("n") - first).alias("n")),
    )
    split = cells.select("part", "quality", "toxic", F.inline(both)).where("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("quality"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def all_orders() -> Column:
    """The orders as one literal: each its name and the bits of its filters, first to last."""
    return F.array(*[
        F.struct(F.lit("".join(o)).alias("name"), F.array(*[F.lit(1 << FILTERS.index(f)) for f in o]).alias("bits"))
        for o in permutations(FILTERS)
    ])


def folded(cell: Column) -> Column:
    """One cell's weighted structs, order by order and step by step."""
    mask, n, good, toxic, none = cell["mask"], cell["n"], cell["good"], cell["toxic"], F.lit(0).cast("long")

    def step(state: Column, bit: Column) -> Column:
        fails, here = mask.bitwiseAND(bit) != 0, ~state["gone"]
        row = F.struct(
            F.when(here & ~fails, n).otherwise(none).alias("kept"),
            F.when(here & fails, n).otherwise(none).alias("removed"),
            F.when(~here & fails, n).otherwise(none).alias("redundant"),
            F.when(mask == bit, n).otherwise(none).alias("unique_fails"),
            F.when(here & fails, good).otherwise(none).alias("good_lost"),
            F.when(here & fails, toxic).otherwise(none).alias("toxic_lost"),
        )
        return F.struct((state["gone"] | fails).alias("gone"), F.concat(state["rows"], F.array(row)).alias("rows"))

    start = F.struct(F.lit(False).alias("gone"), empty_rows().alias("rows"))
    return F.flatten(F.transform(all_orders(), lambda order: F.aggregate(order["bits"], start, step, lambda s: s["rows"])))


def empty_rows() -> Column:
    return F.array().cast("array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>")


def plus(a: Column, b: Column) -> Column:
    return F.struct(*[(F.coalesce(a[c], F.lit(0).cast("long")) + b[c]).alias(c) for c in COUNTS])


def audit_filters(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order and step: what the step keeps and removes, and what its filter removes over all orders."""
    parts = mask_cells(documents, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    merged = F.aggregate("cells", empty_rows(), lambda total, cell: F.zip_with(total, folded(cell), plus))
    # the 600 rows are laid out by order, five steps each
    summed = parts.select("part", F.posexplode(merged).alias("at", "row"))
    n = len(FILTERS)
    placed = summed.select(
        "part", all_orders()[F.floor(F.col("at") / n).cast("int")]["name"].alias("filter_order"),
        (F.col("at") % n + 1).cast("int").alias("step"), "row.*",
    )
    named = placed.withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
    over_all = Window.partitionBy("part", "letter")
    return named.withColumn("shapley", F.sum("removed").over(over_all)).select("part", "filter_order", "step", *COUNTS, "shapley")
