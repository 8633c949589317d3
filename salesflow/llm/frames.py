"""Helpers on frames: distributed ranks and running totals, connected components, Arrow maps."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesflow.session import staged

SALTS = 1024


def map_batches(df: DataFrame, run: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """``run`` on every Arrow batch of the frame."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := run(batch)) is not None:
                yield out
        give_back()

    return df.mapInArrow(each, schema)


def give_back() -> None:
    """Returns a worker's freed memory to the system: Spark keeps workers for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is planned and run inside sends at most ``rows`` rows at a time to Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def keep_rows(df: DataFrame, test: Callable[[pa.Array], pa.Array], uses: str = "text") -> DataFrame:
    """The rows of the frame, all columns as they are, for which ``test`` holds. The test gets
    the column ``uses`` alone, so the names of the others don't matter."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(test(batch.column(uses)))

    return map_batches(df, run, df.schema)


def before(df: DataFrame, groups: list[str], order: list[Column], value: Column, name: str, spread: Column) -> DataFrame:
    """Adds ``name``: the total of ``value`` over all rows of the group that come earlier.

    Rows are ordered by the salt that ``spread`` hashes to, then by ``order``. Each group is cut
    into SALTS parts; totals per part are aggregated before the shuffle, run up over at most SALTS
    rows a group, and only inside a part are rows sorted. So no group, however large, meets in one
    task, and the order depends on the rows alone.
    """
    salted = df.withColumn("_salt", F.pmod(spread, F.lit(SALTS)).cast("int")).withColumn("_value", value.cast("long"))
    keys = [*groups, "_salt"]
    parts = salted.groupBy(*keys).agg(F.sum("_value").alias("_part"))
    run = Window.partitionBy(*groups).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_from", F.coalesce(F.sum("_part").over(run), F.lit(0))).drop("_part")
    starts = starts.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_from")
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = salted.withColumn("_local", F.coalesce(F.sum("_value").over(inner), F.lit(0)))
    on = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    joined = local.join(starts, on, "left").withColumn(name, F.col("_from") + F.col("_local"))
    return joined.drop("_salt", "_value", "_local", "_from", *[f"_of_{k}" for k in keys])


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of edges: every node of an edge list to the smallest node it reaches."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a) :]
    low = np.arange(len(nodes))
    while True:
        least = np.minimum(low[u], low[v])
        new = low.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if (new == low).all():
            return nodes, nodes[low]
        low = new


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge list (columns a, b): node and comp, the smallest node reachable.

    Alternates large-star and small-star steps until the edges no longer change; each round is
    written to the shared folder, so a lost executor costs one round at most. A node without an
    edge to another node has no row.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, state = staged(now, "edges"), None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
            )
        state = seen
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(low.select("a", F.col("low").alias("b")))
        )
        now = staged(small.where("a <> b").distinct(), "edges")
