"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots, each a block of about BLOCK words. Slot i takes the source in whose share of the
cumulative weights the fractional part of i times the golden ratio falls, so every stretch of the
mix has every source close to its weight. Slots are ranked per source; each source's documents,
shuffled by a hash and laid end to end, are cut into blocks of equally many words (BLOCK, or a little
less so that the last is full too), and its r-th slot takes its block r, starting over after the last. The join of slots and blocks gives the words
taken from each document.

Targets: sources in code-point order, null last, weigh 5, 2, 1, 5, 2, 1, ... and share all words; no
target exceeds CEILING times its source's words, the excess going to the others by weight. Slots
past that ceiling are void, so no document is taken more than CEILING times.

Defined cases: null and empty texts have size 0 and nothing taken; a null source is a source; a
null doc_id is shuffled like any other; repeated rows each have their own words; an empty table, or
one without words, gives target and taken 0.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.frames import SALTS, before
from salesflow.session import staged

WEIGHTS = (5, 2, 1)
CEILING = 3
BLOCK = 64
GUIDE = 4096  # cells of the guide table
GOLDEN = "CAST('11400714819323198485' AS DECIMAL(20,0))"  # 2**64 over the golden ratio
TURN = "CAST('18446744073709551616' AS DECIMAL(20,0))"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """Per source its words, weight and target, from a frame of source and source_size (one row a source).

    The level is the number of words one unit of weight gets. Sources stop in the order of their
    ceiling over their weight; the level is what is left after the first j of them, over the weight
    that is left, for the smallest j whose next source does not stop.
    """
    place = Window.orderBy(F.col("source").isNull(), F.col("source"))
    kinds = F.array(*[F.lit(w) for w in weights])
    known = sizes.withColumn("place", F.row_number().over(place) - 1).withColumn(
        "weight", F.element_at(kinds, (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    ).withColumn("most", F.lit(ceiling) * F.col("source_size"))
    stops = Window.orderBy(F.col("most") / F.col("weight"), "place")
    earlier = stops.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    known = known.select(
        "*", F.sum("source_size").over(everything).alias("all_words"), F.sum("weight").over(everything).alias("all_weight"),
        F.coalesce(F.sum("most").over(earlier), F.lit(0)).alias("gone"), F.coalesce(F.sum("weight").over(earlier), F.lit(0)).alias("gone_weight"),
    ).withColumn("level", (F.col("all_words") - F.col("gone")).cast("double") / (F.col("all_weight") - F.col("gone_weight")))
    fits = F.col("level") * F.col("weight") <= F.col("most")
    known = known.withColumn("final", F.min(F.when(fits, F.struct(F.col("most") / F.col("weight"), "place", "level"))).over(everything)["level"])
    target = F.least(F.col("most").cast("double"), F.col("final") * F.col("weight"))
    return known.select("source", "source_size", "place", "weight", F.coalesce(target, F.lit(0.0)).alias("target"), "all_words")


def word_count(text: str = "text"):
    """Words of `[^\\x20\\x09-\\x0D]+`."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix(documents: DataFrame, block: int = BLOCK, keep: list[str] | None = None) -> DataFrame:
    """Per row: the columns ``keep``, size, source_size, target (the source's) and taken."""
    keep = keep or ["doc_id"]
    rows = documents.select(
        F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("id"), word_count().alias("size"),
        F.xxhash64("text").alias("body"), *[F.col(c).alias(f"keep_{c}") for c in keep],
    )
    rows = staged(rows, "sized")
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    about = F.expr(f"greatest((source_size + {block - 1}) div {block}, 1)")
    plan = plan.withColumn("about", about).withColumn("width", F.expr("greatest((source_size + about - 1) div about, 1)"))
    plan = plan.withColumn("blocks", F.expr("(source_size + width - 1) div width")).drop("about")
    due = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("due", due.cast("decimal(28,6)"))  # slots the target asks for; sums in any order agree
    plan = staged(plan, "targets")
    shuffled = before(rows, ["source"], [F.xxhash64("id", "body"), F.col("id"), F.col("body")], F.col("size"), "start", F.xxhash64("id", "body", F.lit(1)))
    shuffled = shuffled.join(plan.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    shuffled = staged(shuffled, "laid")

    # the guide: each cell of [0, 1) lists the sources whose share of the weights meets it
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    shares = plan.where("due > 0").withColumn("share", (F.col("due") / F.sum("due").over(Window.partitionBy())).cast("double"))
    shares = shares.withColumn("high", F.sum("share").over(upto)).withColumn("last", F.max("place").over(Window.partitionBy()))
    shares = shares.withColumn("high", F.when(F.col("place") == F.col("last"), F.lit(1.0)).otherwise(F.col("high")))
    shares = shares.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("place")), F.lit(0.0)))
    guide = shares.select(
        "place", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * GUIDE).cast("long"), F.least(F.floor(F.col("high") * GUIDE), F.lit(GUIDE - 1)).cast("long"))).alias("cell")
    )
    n_slots = math.ceil(plan.agg(F.sum("due")).first()[0] or 0)
    point = F.expr(f"CAST((CAST(id AS DECIMAL(18,0)) * {GOLDEN}) % {TURN} AS DOUBLE)") / F.lit(2.0**64)
    slots = documents.sparkSession.range(n_slots).select(F.col("id").alias("slot"), point.alias("at"))
    slots = slots.withColumn("cell", F.least(F.floor(F.col("at") * GUIDE), F.lit(GUIDE - 1)).cast("long"))
    slots = slots.join(guide, "cell").where("at >= low AND at < high").select("place", "slot")
    ranked = before(slots, ["place"], [F.col("slot")], F.lit(1), "r", F.expr(f"{SALTS}L * slot div {max(n_slots, 1)}"))

    size = plan.select(F.col("place").alias("p"), "blocks")
    times = (
        ranked.join(size, F.col("place") == F.col("p")).where(f"r < {CEILING} * blocks")
        .groupBy("place", F.expr("r % blocks").alias("piece")).agg(F.count("*").alias("times"))
    )
    pieces = shuffled.where("size > 0").select(
        "place", "start", "size", "width", F.explode(F.sequence(F.expr("start div width"), F.expr("(start + size - 1) div width"))).alias("piece"),
    ).withColumn("part", F.least(F.col("start") + F.col("size"), (F.col("piece") + 1) * F.col("width")) - F.greatest(F.col("start"), F.col("piece") * F.col("width")))
    taken = (
        pieces.join(times, ["place", "piece"]).groupBy("place", "start").agg(F.sum(F.col("part") * F.col("times")).alias("words"))
        .select(F.col("place").alias("p"), F.col("start").alias("s"), "words")
    )
    out = shuffled.join(taken, (F.col("place") == F.col("p")) & (F.col("start") == F.col("s")) & (F.col("size") > 0), "left")
    return out.select(
        *[F.col(f"keep_{c}").alias(c) for c in keep], "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken")
    )


def mixed(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """The documents, all columns as they are, as often as the mix takes them: a document stands once
    for each whole time its words are taken, halves rounded up. Of repeated rows each stands as often
    as their average; what is taken less than half, or has no words, leaves.
    """
    docs = documents.withColumn("_body", F.xxhash64("text"))
    taken = mix(docs.select("doc_id", "source", "text", "_body"), block, ["doc_id", "source", "_body"])
    times = taken.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_of"), F.col("_body").alias("_hash")).agg(
        F.floor(F.sum("taken") / F.count("*") / F.greatest(F.max("size"), F.lit(1)) + 0.5).cast("int").alias("_times")
    ).where("_times > 0")
    on = docs["doc_id"].eqNullSafe(F.col("_id")) & docs["source"].eqNullSafe(F.col("_of")) & (docs["_body"] == F.col("_hash"))
    out = docs.join(times, on).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return out.select(*[out[c] for c in documents.columns])
