"""Lookups against master data, and comparisons of aggregated tables.

Broadcasting is decided by size. A master within the session's broadcast limit goes to every
executor, so the fact table is never shuffled and no hot key can hurt. The size of a plain scan,
renamed or with columns dropped, is that of its files and costs no job; any other master is probed
by counting that ends once the limit is passed. A larger master is joined by shuffle, except for
the fact table's hottest keys: their master rows are few, so those facts stay where they are and
only the rest is shuffled. Facts that are themselves dear to compute are left to adaptive execution
where it can split them; else they are written once, their hot keys found on the way, and hot facts
dealt over copies of their master rows by a salt.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import BinaryType, DataType, FractionalType, IntegralType, StringType

from salesflow.functions import named
from salesflow.functions.text import blank_to
from salesflow.session import staged

# A key is hot when it alone holds this share of the fact rows; so there are at most 200.
HOT_SHARE = 0.005
# Keys the frequency sketch tracks; its counts are off by far less than the share.
SKETCH_ITEMS = 10_000
# Plan steps whose size is that of their files or their literal rows.
LEAVES = {"LogicalRelation", "Relation", "LocalRelation"}
# Rows that the first look at a master's size takes.
FIRST_ROWS = 4096
# A hot key's facts are spread over so many copies of its master rows at most.
MOST_SALTS = 1024
# Plan steps that make a table dearer to compute than to read.
COSTLY = {"Aggregate", "Distinct", "Generate", "Join", "Sort", "Window"}
MISSING = "-"


def broadcast_limit(df: DataFrame) -> int:
    """The session's automatic broadcast threshold in bytes (-1 switches broadcasting off)."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return int(conf.autoBroadcastJoinThreshold())


def _optimized(df: DataFrame):
    return df._jdf.queryExecution().optimizedPlan()


def _steps(plan) -> set[str]:
    children = plan.children()
    below = [_steps(children.apply(i)) for i in range(children.size())]
    return {plan.nodeName().split(" ")[0]}.union(*below)


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a table's size, from its files; starts no job."""
    return int(_optimized(df).stats().sizeInBytes())


def _renames(project) -> bool:
    """Whether a projection keeps every column, perhaps under another name, and computes nothing."""
    columns = project.projectList()
    kinds = []
    for i in range(columns.size()):
        column = columns.apply(i)
        column = column.child() if column.getClass().getSimpleName() == "Alias" else column
        kinds.append(column.getClass().getSimpleName())
    return set(kinds) <= {"AttributeReference"} and len(kinds) == project.child().output().size()


def scan_bytes(df: DataFrame) -> int | None:
    """The bytes of the files or literal rows that a table is, under whatever column names.

    None where it is anything else: columns dropped or computed, rows filtered, joined or
    grouped. Starts no job.
    """
    plan = _optimized(df)
    while (step := plan.nodeName().split(" ")[0]) not in LEAVES:
        if step != "Project" or not _renames(plan):
            return None
        plan = plan.child()
    return int(plan.stats().sizeInBytes())


def row_bytes(df: DataFrame) -> Column:
    """A row's size: text by its length, other columns by eight bytes."""
    sizes = [F.lit(8 * len(df.columns))]
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            sizes.append(F.coalesce(F.octet_length(named(field.name)), F.lit(0)))
        elif field.dataType.simpleString().startswith(("array", "map", "struct")):
            sizes.append(F.coalesce(F.octet_length(F.to_json(named(field.name))), F.lit(0)))
    return reduce(add, sizes).cast("long")


def passes(df: DataFrame, limit: int) -> bool:
    """Whether a table's rows hold more than ``limit`` bytes, by counting no further than that.

    The first rows come from as few tasks as have them. If they are not all, they tell how many
    rows it should take to pass the limit, and so many are looked at, then twice as many, until
    there are no more or the limit is passed.
    """
    sizes = df.select(row_bytes(df).alias("bytes"))
    first = [r["bytes"] for r in sizes.limit(FIRST_ROWS).collect()]
    total, rows = sum(first), FIRST_ROWS
    if total > limit or len(first) < rows:
        return total > limit
    rows = int(1.25 * limit / (total / len(first))) + rows
    while True:
        seen = sizes.limit(rows).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).first()
        if seen["bytes"] > limit or seen["n"] < rows:
            return seen["bytes"] > limit
        rows *= 2


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether a table may be sent whole to every executor: within ``limit`` bytes, by default the session's.

    A scan of whole files, columns renamed or not, is as large as these and starts no job. Any
    other plan's estimate may be far off either way (rows that an array is exploded to count
    nothing, a long text counts twenty bytes), so its rows are counted until the limit is passed.
    """
    limit = broadcast_limit(df) if limit is None else limit
    if limit <= 0:
        return False
    known = scan_bytes(df)
    return known <= limit if known is not None else not passes(df, limit)


def prepared(master: DataFrame) -> DataFrame:
    """A master, written once to the shared folder where it is dear to compute: a job that looks
    it up then neither probes nor computes it again."""
    return staged(master, "master") if dear(master) else master


def _matches(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], nulls_match: bool = True
) -> Column:
    pairs = [(left[f"`{a}`"], right[f"`{b}`"]) for a, b in keys]
    return reduce(and_, [a.eqNullSafe(b) if nulls_match else a == b for a, b in pairs])


def lookup(
    facts: DataFrame,
    master: DataFrame,
    on: Sequence[str] | Sequence[tuple[str, str]],
    how: str = "left",
    nulls_match: bool = True,
    spread: str = "auto",
    limit: int | None = None,
) -> DataFrame:
    """Join a master on one or more keys, null matching null unless switched off.

    Keys are names, or (fact name, master name) pairs. The master's keys are not repeated in
    the result, and duplicate master keys multiply rows. ``how`` is left or inner. Keys that
    are never null join faster with ``nulls_match`` off.

    ``spread`` says what becomes of the hot keys of facts that are dear to compute, where the
    master is too large to broadcast: ``adaptive`` leaves them to adaptive execution, ``salted``
    writes the facts once and deals hot ones over copies of their master rows, ``auto`` does the
    latter where adaptive execution could not split them. ``limit`` stands in for the session's
    broadcast limit.
    """
    if spread not in ("auto", "adaptive", "salted"):
        raise ValueError(f"unknown spread {spread!r}")
    keys = [(k, k) if isinstance(k, str) else k for k in on]
    # Own names for the master's keys keep the two sides apart in self-joins.
    hidden = {b: f"__master_key_{i}" for i, (_, b) in enumerate(keys)}
    side = master.withColumnsRenamed(hidden)
    pairs = [(a, hidden[b]) for a, b in keys]

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, _matches(left, right, pairs, nulls_match), how).drop(*hidden.values())

    if fits_broadcast(master, limit):
        return joined(facts, F.broadcast(side))
    probe = [a for a, _ in pairs]
    alike = all(_alike(facts.schema[a].dataType, side.schema[b].dataType) for a, b in pairs)
    if not alike:
        return joined(facts, side)
    if dear(facts):
        plain = joined(facts, side)
        if spread == "adaptive" or (spread == "auto" and _splits_skew(plain)):
            return plain
        return _salted(facts, side, pairs, how, nulls_match)
    hot = hot_keys(facts, probe)
    if not hot:
        return joined(facts, side)
    hot_side = side.filter(_key_hash([named(b) for _, b in pairs]).isin(hot))
    if not fits_broadcast(hot_side, limit):
        return joined(facts, side)
    in_hot = _key_hash([named(a) for a in probe]).isin(hot)
    stay, move = facts.filter(in_hot), facts.filter(~in_hot)
    return joined(stay, F.broadcast(hot_side)).unionByName(joined(move, side))


def _salted(
    facts: DataFrame, side: DataFrame, pairs: Sequence[tuple[str, str]], how: str, nulls_match: bool
) -> DataFrame:
    """The join of dear facts with a large master: the facts are computed once and scanned once.

    While they are written, a sketch finds their hot keys. A hot key's facts then take turns
    over as many salts as bring each share below that of a task, and its master rows, few as
    they are, are copied to each salt; all other rows have the one salt 0.
    """
    spark, seen = facts.sparkSession, Observation("hot")
    probe = [named(a) for a, _ in pairs]
    found = facts.observe(seen, _top(_key_hash(probe)).alias("top"), F.count(F.lit(1)).alias("n"))
    kept = staged(found, "facts")
    hot = _hot_counts(seen.get["top"], seen.get["n"], HOT_SHARE)
    if not hot:
        return kept.join(side, _matches(kept, side, pairs, nulls_match), how).drop(*[b for _, b in pairs])
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = min(MOST_SALTS, max(2, math.ceil(tasks * max(hot.values()) / seen.get["n"])))
    in_hot = _key_hash(probe).isin(list(hot))
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    left = kept.withColumn("__salt", F.when(in_hot, turn).otherwise(F.lit(0)))
    copies = F.when(_key_hash([named(b) for _, b in pairs]).isin(list(hot)), F.sequence(F.lit(0), F.lit(salts - 1)))
    right = side.withColumn("__copy", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
    on = _matches(left, right, pairs, nulls_match) & (left["__salt"] == right["__copy"])
    return left.join(right, on, how).drop("__salt", "__copy", *[b for _, b in pairs])


def _alike(a: DataType, b: DataType) -> bool:
    """Whether equal keys of the two types have equal texts, so that hashes agree."""
    if isinstance(a, IntegralType) and isinstance(b, IntegralType):
        return True
    return a == b and not isinstance(a, FractionalType)


def _key_hash(keys: Sequence[Column]) -> Column:
    """One number per key; of its text, since whole numbers may differ in width."""
    return F.xxhash64(*[F.coalesce(k.cast("string"), F.lit("\0")) for k in keys])


def _splits_skew(joined: DataFrame) -> bool:
    """Whether adaptive execution can split the left side of a table's topmost join: it can where
    that side is shuffled for this join, not where it lies by the key already."""
    conf = joined.sparkSession._jsparkSession.sessionState().conf()
    plan = joined._jdf.queryExecution().executedPlan()
    if not (plan.nodeName() == "AdaptiveSparkPlan" and conf.getConfString("spark.sql.adaptive.skewJoin.enabled", "true") == "true"):
        return False
    plan = plan.initialPlan()
    while plan.nodeName() != "SortMergeJoin":
        if plan.children().size() != 1:
            return True  # no sort-merge join
        plan = plan.children().apply(0)
    left = plan.left()
    return left.nodeName() == "Sort" and left.child().nodeName() == "Exchange"


def dear(facts: DataFrame) -> bool:
    """Whether a table has to be joined, grouped or sorted first, so that it should be computed once."""
    return bool(COSTLY & _steps(_optimized(facts)))


def _top(hashes: Column, share: float = HOT_SHARE) -> Column:
    """The most frequent hashes, by a sketch that tasks fill and Spark merges."""
    return F.call_function("approx_top_k", hashes, F.lit(int(1 / share)), F.lit(SKETCH_ITEMS))


def _hot_counts(top, n: int, share: float) -> dict[int, int]:
    return {item["item"]: item["count"] for item in top or [] if item["count"] >= max(share * n, 2)}


def hot_keys(facts: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that each hold about ``share`` of the rows or more.

    A frequency sketch, merged over the tasks, answers in one pass over the key columns and
    without a shuffle; at most ``1 / share`` hashes reach the driver. Which keys it finds
    only decides how rows travel. Facts that would have to be joined first are not read for this.
    """
    if dear(facts):
        return []
    hashes = facts.select(_key_hash([named(k) for k in keys]).alias("h"))
    row = hashes.agg(_top(F.col("h"), share).alias("top"), F.count("*").alias("n")).first()
    return list(_hot_counts(row["top"], row["n"], share))


def lookup_or_default(
    facts: DataFrame, master: DataFrame, left: str, right: str, default: str = MISSING
) -> DataFrame:
    """Look up by differently named keys; a miss, and a null in the master, is the default.

    A null or blank fact key becomes the default before the join; other keys are used as
    they stand, padding included.
    """
    probe = facts.withColumn(left, blank_to(left, default))
    values = [c for c in master.columns if c != right]
    out = lookup(probe, master, [(left, right)], nulls_match=False)
    return out.withColumns({c: F.coalesce(named(c), F.lit(default)) for c in values})


def full_compare(a: DataFrame, b: DataFrame, key: str, metrics: Sequence[str], suffix: str) -> DataFrame:
    """Full join of two aggregated tables on one key, missing metrics as 0.

    The second table's metrics take the suffix.
    """
    other = b.withColumnsRenamed({m: m + suffix for m in metrics})
    return a.join(other, key, "full").na.fill(0, subset=[*metrics, *[m + suffix for m in metrics]])
