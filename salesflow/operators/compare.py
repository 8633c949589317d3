"""Differences between two tables: values, columns, whole rows and groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import FractionalType, StringType, StructField, StructType

from salesflow.functions import named
from salesflow.functions.kinds import to_text
from salesflow.operators.filters import any_differs
from salesflow.operators.joins import full_compare, lookup
from salesflow.session import staged

# Parts that the rows of a group are dealt to for a first look at what differs.
BUCKETS = 256
# Groups that differ are named to the scan up to so many.
LISTED_GROUPS = 1000


def _both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both tables stacked, with row weights for the left and right side."""
    left = a.withColumns({"__a": F.lit(1), "__b": F.lit(0)})
    return left.unionByName(b.withColumns({"__a": F.lit(0), "__b": F.lit(1)}))


def set_diff(a: DataFrame, b: DataFrame, col: str, names: tuple[str, str] = ("missing", "new")) -> DataFrame:
    """Values on one side only: ``missing`` are in ``a`` alone, ``new`` in ``b`` alone.

    One grouped pass over both sides; each map task sends a value once.
    """
    sides = (
        _both(a.select(named(col)), b.select(named(col)))
        .groupBy(named(col))
        .agg(F.max("__a").alias("__a"), F.max("__b").alias("__b"))
    )
    only = sides.filter(F.col("__a") != F.col("__b"))
    return only.select(
        named(col), F.when(F.col("__a") == 1, F.lit(names[0])).otherwise(F.lit(names[1])).alias("side")
    )


def schema_changes(old: DataFrame, new: DataFrame, allowed: Sequence[str] = ()) -> list[tuple[str, str]]:
    """(kind, column) for each added, unexpectedly added, dropped or moved column."""
    added = [c for c in new.columns if c not in old.columns]
    dropped = [c for c in old.columns if c not in new.columns]
    changes = [("added" if c in allowed else "unexpected", c) for c in added]
    changes += [("dropped", c) for c in dropped]
    shared_old = [c for c in old.columns if c in new.columns]
    shared_new = [c for c in new.columns if c in old.columns]
    changes += [("moved", was) for was, now in zip(shared_old, shared_new) if was != now]
    return changes


def schema_diff(old: DataFrame, new: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """The schema changes as a table; reads no data."""
    schema = StructType([StructField("kind", StringType()), StructField("column", StringType())])
    return old.sparkSession.createDataFrame(schema_changes(old, new, allowed), schema)


def _comparable(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """The shared columns, as text where the sides differ in type or hold fractions.

    Values of one other type are equal exactly when their texts are, and are narrower.
    """
    cols = sorted(set(a.columns) & set(b.columns))

    def as_is(name: str) -> bool:
        kind = a.schema[name].dataType
        return kind == b.schema[name].dataType and not isinstance(kind, FractionalType)

    def side(df: DataFrame) -> DataFrame:
        return df.select(*[named(c) if as_is(c) else to_text(df, c).alias(c) for c in cols])

    return side(a), side(b), cols


def _bucketed(a: DataFrame, b: DataFrame, buckets: int) -> tuple[DataFrame, list[str]]:
    """Both sides over the shared columns, each row with its bucket and the halves of two hashes."""
    left, right, cols = _comparable(a, b)
    # hashes skip nulls, so where a row has them is hashed too
    row = [x for c in cols for x in (named(c), named(c).isNull())]
    rows = _both(left, right).withColumns({"__h0": F.xxhash64(*row), "__h1": F.xxhash64(F.lit(1), *row)})
    return rows.withColumn("__bucket", F.pmod("__h0", F.lit(buckets)).cast("int")), cols


def _uneven_buckets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups and buckets in which the two sides' counts or sums of hashes differ.

    Halves of 32 bits, so that the sums stay within 64. Each task sends one line of figures per
    group and bucket, whatever it reads.
    """
    sign = (F.col("__a") - F.col("__b")).cast("long")
    halves = [h for i in (0, 1) for h in (F.shiftright(f"__h{i}", 32), F.col(f"__h{i}").bitwiseAND(F.lit(0xFFFFFFFF)))]
    sums = [F.sum(sign).alias("__rows"), *[F.sum(sign * h).alias(f"__s{i}") for i, h in enumerate(halves)]]
    figures = rows.groupBy(*[named(k) for k in keys], "__bucket").agg(*sums)
    names = ["__rows", *[f"__s{i}" for i in range(len(halves))]]
    return figures.filter(any_differs([(F.col(n), F.lit(0)) for n in names])).select(*[named(k) for k in keys], "__bucket")


def uneven_groups(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups whose rows, over the shared columns, the two tables do not hold equally often.

    Told by the number of rows and the sums of two 64-bit hashes, without comparing a row: each
    task sends one line of figures per group.
    """
    rows, _ = _bucketed(a, b, 1)
    return _uneven_buckets(rows, keys).drop("__bucket")


def multiset_compare(a: DataFrame, b: DataFrame, by: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Rows, over the shared columns as text, that the two tables do not hold equally often.

    Empty means equal whatever the order. A first pass sums up both sides by group (``by``, a
    month say) and bucket of rows; only rows of groups and buckets whose figures differ are then
    counted exactly, and groups that are equal are skipped by the second scan. What the first pass
    takes for equal agrees in its number of rows and in the sums of two 64-bit hashes. The exact
    count is one grouped pass, so copies are counted before the shuffle and no join is needed.
    """
    rows, cols = _bucketed(a, b, buckets)
    keys = [] if by is None else [by]
    uneven = staged(_uneven_buckets(rows, keys), "uneven")
    if by is not None:
        groups = [r[0] for r in uneven.select(named(by)).distinct().limit(LISTED_GROUPS + 1).collect()]
        if len(groups) <= LISTED_GROUPS:
            known = [g for g in groups if g is not None]
            rows = rows.filter(named(by).isin(known) | (named(by).isNull() & F.lit(None in groups)))
    rows = lookup(rows, uneven, [*keys, "__bucket"], "inner")
    counts = (
        rows.groupBy(*[named(c) for c in cols])
        .agg(F.sum("__a").alias("a_rows"), F.sum("__b").alias("b_rows"))
        .filter(F.col("a_rows") != F.col("b_rows"))
    )
    return counts.select(*[to_text(counts, c).alias(c) for c in cols], "a_rows", "b_rows")


def differing_columns(a: DataFrame, b: DataFrame) -> DataFrame:
    """Shared columns whose values, taken alone, are not the same multiset on both sides."""
    left, right, cols = _comparable(a, b)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), to_text(left, c).alias("value")) for c in cols])
    values = _both(left, right).select(F.inline(pairs), "__a", "__b")
    uneven = (
        values.groupBy("column", "value")
        .agg(F.sum(F.col("__a") - F.col("__b")).alias("surplus"))
        .filter(F.col("surplus") != 0)
    )
    return uneven.groupBy("column").agg(F.count("*").alias("uneven_values"))


def same_columns(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
    """Per group and shared column, whether both sides hold the same values: ``same``.

    A cheap look before the exact comparisons: each column is reduced to its count and the
    sum of its values' hashes in one pass, so no rows are shuffled, only one line of figures
    per group and task. A group found the same needs no exact comparison.
    """
    left, right, cols = _comparable(a, b)
    both = _both(left, right)
    sign = (F.col("__a") - F.col("__b")).cast("decimal(38,0)")
    shared = [c for c in cols if c != by]
    sums = [F.sum(sign * F.xxhash64(to_text(both, c)).cast("decimal(20,0)")).alias(f"__{i}") for i, c in enumerate(shared)]
    figures = both.groupBy(named(by)).agg(F.sum(sign).alias("__rows"), *sums)
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), ((F.col("__rows") == 0) & (F.col(f"__{i}") == 0)).alias("same")) for i, c in enumerate(shared)]
    )
    return figures.select(to_text(figures, by).alias(by), F.inline(pairs))


def group_diff(a: DataFrame, b: DataFrame, key: str, quantity: str, suffix: str = "_b") -> DataFrame:
    """Rows and units per group on both sides, for a look at where tables differ."""
    def grouped(df: DataFrame) -> DataFrame:
        return df.groupBy(named(key)).agg(
            F.count("*").alias("rows"), F.sum(named(quantity)).alias("units")
        )

    return full_compare(grouped(a), grouped(b), key, ["rows", "units"], suffix)
