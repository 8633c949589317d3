"""Sharding along a Hilbert curve over document metadata, by DataFrame functions alone.

Three dimensions, quantised to four bits each: source and language (by checksum: they have no order
that a range could use) and text size (by half powers of two). A row's place on the curve is the
index of its cell; runs of equally many rows are cut along the curve (law ``rows``), so each shard
holds few sources, languages and sizes and files can be pruned by any of them.

Equal texts are a group: all its rows lie in the cell of the row with the smallest doc_id, and inside a
cell rows are ordered by their text's hash, so a group stands together along the curve and is cut at
a border between shards only.

Ranks are exact without a global sort: rows are counted per cell and range of hashes, the counts run
up over 4096 cells and HASH_RANGES ranges, and rows are only numbered inside a range. A text that a
sketch finds to hold HOT_SHARE of the rows or more, at most 200 can, is cut into TURNS parts by a hash
of the doc_id, and a doc_id and text that do so together, rows that repeat, are dealt to as many in
turn. So a group of copies, or one repeated row, as large as a third of the table goes to many tasks.

Defined cases: a null text has no bytes, size 1 and the checksum of the empty string; null source or
language is a category of its own; a null doc_id comes after others in choosing a group's
cell; repeated rows each
get a slot of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.session import staged

BITS = 4
SHARDS = 8
HASH_RANGES = 1024
HOT_SHARE = 0.005
TURNS = 256


def coordinates() -> list[Column]:
    """The quantised dimensions, each 0 to 15."""
    category = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.pmod(F.crc32(F.col(c).cast("binary")), F.lit(15)) + 1)
    size = F.floor(F.log2(F.col("size").cast("double")) / 2)
    return [category("source").cast("int"), category("lang").cast("int"), F.least(size, F.lit(15)).cast("int")]


def hilbert_index(x: Column, y: Column, z: Column) -> Column:
    """The index of a cell on the three-dimensional Hilbert curve of BITS bits a side.

    Coordinates turn into the transposed index by undoing the excess work from the top bit down,
    then Gray encoding; the index interleaves its bits.
    """
    state = F.struct(x.alias("x"), y.alias("y"), z.alias("z"))

    def undo(s: Column, axis: str, q: Column) -> Column:
        set_ = s[axis].bitwiseAND(q) != 0
        low = q - 1
        swap = s["x"].bitwiseXOR(s[axis]).bitwiseAND(low)
        new_x = F.when(set_, s["x"].bitwiseXOR(low)).otherwise(s["x"].bitwiseXOR(swap))
        new_axis = F.when(set_, s[axis]).otherwise(s[axis].bitwiseXOR(swap))
        fields = {"x": new_x, axis: new_axis} if axis != "x" else {"x": F.when(set_, s["x"].bitwiseXOR(low)).otherwise(s["x"])}
        return F.struct(*[fields.get(c, s[c]).alias(c) for c in "xyz"])

    steps = F.array(*[F.struct(F.lit(axis).alias("axis"), F.lit(1 << b).alias("q")) for b in range(BITS - 1, 0, -1) for axis in "xyz"])
    turned = F.aggregate(
        steps, state,
        lambda s, t: F.when(t["axis"] == "x", undo(s, "x", t["q"])).when(t["axis"] == "y", undo(s, "y", t["q"])).otherwise(undo(s, "z", t["q"])),
    )

    def gray(s: Column) -> Column:
        y1 = s["y"].bitwiseXOR(s["x"])
        return F.struct(s["x"].alias("x"), y1.alias("y"), s["z"].bitwiseXOR(y1).alias("z"))

    coded = F.transform(F.array(turned), gray)[0]
    flip = lambda s: F.aggregate(
        F.array(*[F.lit(1 << b) for b in range(BITS - 1, 0, -1)]), F.lit(0),
        lambda t, q: F.when(s["z"].bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t),
    )
    final = F.transform(
        F.array(coded),
        lambda s: F.transform(F.array(flip(s)), lambda t: F.struct(*[s[c].bitwiseXOR(t).alias(c) for c in "xyz"]))[0],
    )[0]
    return F.transform(
        F.array(final),
        lambda s: sum(
            (F.shiftleft(F.shiftright(s[c], b).bitwiseAND(1), 3 * b + 2 - i) for b in range(BITS) for i, c in enumerate("xyz")), F.lit(0)
        ),
    )[0]


def hot(rows: DataFrame, value: Column) -> list[int]:
    """The values that HOT_SHARE of the rows or more hold, in order."""
    top = F.call_function("approx_top_k", value, F.lit(int(1 / HOT_SHARE)), F.lit(10_000))
    found = rows.agg(top.alias("top"), F.count("*").alias("n")).first()  # at most 1 / HOT_SHARE values
    return sorted(t["item"] for t in found["top"] or [] if t["count"] >= max(HOT_SHARE * found["n"], 2))


def salt(rows: DataFrame) -> Column:
    """A row's part of its cell, a number whose digits are: the range of its text's hash, hot texts
    before it, the part of a hot text, and the turn of a row that repeats."""
    pair = F.xxhash64("text_hash", "id")
    texts, pairs = hot(rows, F.col("text_hash")), hot(rows, pair)
    part = F.shiftrightunsigned("text_hash", 64 - HASH_RANGES.bit_length() + 1)
    if not texts:
        return part
    below = F.size(F.filter(F.array(*[F.lit(h) for h in texts]), lambda h: h < F.col("text_hash")))
    in_text = F.when(F.col("text_hash").isin(texts), F.col("id_turn") + 1).otherwise(0)
    in_pair = F.when(pair.isin(pairs), F.col("turn") + 1).otherwise(0) if pairs else F.lit(0)
    out = part
    for digit, size in ((below, 256), (in_text, TURNS + 1), (in_pair, TURNS + 1)):
        out = out * size + digit
    return out


def shards(documents: DataFrame, n_shards: int = SHARDS, keep: list[str] | None = None) -> DataFrame:
    """Every row with its size, text checksum, law, shard and slot; ``keep`` are the columns that stay."""
    keep = keep or ["doc_id"]
    body = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(body).cast("long") + 1
    rows = documents.select(
        F.struct(*keep).alias("row"), F.col("doc_id").cast("long").alias("id"), "source", "lang", size.alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("text_hash"),
    )
    x, y, z = coordinates()
    rows = rows.withColumns({"cell": x * 256 + y * 16 + z, "turn": F.pmod(F.monotonically_increasing_id(), F.lit(TURNS))})
    # written first: whichever step reads the rows again finds the same turns
    rows = staged(rows.drop("source", "lang"), "rows")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "cell"))["cell"]
    groups = rows.groupBy("text_hash").agg(first.alias("group_cell"), F.min("cell").alias("low"), F.max("cell").alias("high"))
    groups = staged(groups.where("low < high").select("text_hash", "group_cell"), "groups")
    rows = rows.join(groups, "text_hash", "left").withColumn("cell", F.coalesce("group_cell", "cell")).drop("group_cell")
    rows = rows.withColumn("id_turn", F.pmod(F.xxhash64("id"), F.lit(TURNS)))
    rows = rows.withColumn("salt", salt(rows))
    parts = rows.groupBy("cell", "salt").agg(F.count("*").alias("n"))
    cells = parts.groupBy("cell").agg(F.sum("n").alias("n"))
    place = hilbert_index(
        F.shiftright("cell", 8), F.shiftright("cell", 4).bitwiseAND(15), F.col("cell").bitwiseAND(15)
    )
    along = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)  # at most 4096 rows
    cells = cells.withColumn("curve", place).select(
        "cell", "curve", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("cell_from"), F.sum("n").over(Window.partitionBy()).alias("total")
    )
    inside = Window.partitionBy("cell").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("part_from", F.coalesce(F.sum("n").over(inside), F.lit(0))).drop("n").join(cells, "cell")
    number = F.row_number().over(Window.partitionBy("cell", "salt").orderBy("text_hash", "id_turn", "id"))
    ranked = rows.withColumn("number", number).join(starts, ["cell", "salt"]).withColumn(
        "rank", F.col("cell_from") + F.col("part_from") + F.col("number") - 1
    )
    # shard s holds the ranks from ceil(s * total / n) on: counts differ by one at most
    shard = F.expr(f"({n_shards} * rank) div total")
    first = F.expr(f"(shard * total + {n_shards - 1}) div {n_shards}")
    return ranked.withColumn("shard", shard.cast("int")).select(
        *[F.col("row")[c].alias(c) for c in keep], "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("rank") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve",
    )
