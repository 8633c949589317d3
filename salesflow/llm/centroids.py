"""Clustering of vectors around centroids with exact whole-number distances, on bit planes.

A component x becomes the integer floor(256 * x). The 64 components of a vector are kept as bit
planes: plane i is one 64-bit word that holds bit i of every component, in two's complement, so the
last plane counts negative. The dot product of a vector and a centroid is the sum over all pairs of
planes of their weights times the number of ones in their AND, exact in 64-bit integers, and with the
squared norms it gives the exact squared distance. A vector has as many planes as its own widest
component needs, ten for components within one.

The planes are written once to the shared folder. A round is one scan of them: each task keeps one
running sum and count a centroid, these are added up by Spark, and as many rows as there are
centroids reach the driver. So a round shuffles centroids x tasks small rows, a hot cluster costs
nothing extra, and a lost executor costs its part of a round.

Defined cases: vectors that are null, of another length, or hold null or non-finite components are
left out. Repeated rows count as often as they stand there. Vectors of one vec_id that both start
are ordered by components; those without a vec_id come last. Fewer vectors than centroids give fewer
centroids, no vectors no rows. A component beyond 2 ** 20 either way is an error, since squared
distances and their sums would leave 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.frames import map_batches
from salesflow.session import staged

COMPONENTS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = 2
LARGEST = 1 << 20
ROWS_AT_ONCE = 1024


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The vectors that take part: vec_id and their components as doubles."""
    parts = F.col(embedding).cast("array<double>")
    finite = F.forall(parts, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    kept = F.coalesce((F.size(parts) == COMPONENTS) & finite, F.lit(False))
    return vectors.where(kept).select(F.col(vec_id).cast("long").alias("vec_id"), parts.alias("parts"))


def quantised(parts: Column, scale: int = SCALE) -> Column:
    return F.transform(parts, lambda x: F.floor(F.lit(float(scale)) * x))


def to_planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The planes of every row of 64 integers, as many as its widest value needs, and their number a row."""
    widest = np.maximum(values, ~values).max(axis=1, initial=0)
    width = 1 + np.ceil(np.log2(widest.astype(np.float64) + 1)).astype(np.int64)
    most = int(width.max(initial=1))
    bits = (values[:, None, :] >> np.arange(most)[None, :, None]) & 1
    planes = np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]
    return planes[np.arange(most)[None, :] < width[:, None]], width


def square_planes(flat: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Rows of equally many planes: a narrower row's sign plane is repeated."""
    most = int(width.max(initial=1))
    first = np.cumsum(width) - width
    return flat[first[:, None] + np.minimum(np.arange(most)[None, :], width[:, None] - 1)]


def weights(n: int) -> np.ndarray:
    """What a one in each of n planes is worth."""
    worth = np.int64(1) << np.arange(n, dtype=np.int64)
    worth[-1] = -worth[-1]
    return worth


def from_planes(planes: np.ndarray) -> np.ndarray:
    """The integers that rows of planes stand for."""
    bits = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(*planes.shape, 8), axis=2, bitorder="little")
    return np.tensordot(weights(planes.shape[1]), bits.astype(np.int64), axes=(0, 1))


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of all rows of planes ``a`` with all rows of planes ``b``, by popcounts."""
    out = np.zeros((len(a), len(b)), np.int64)
    for i, worth in enumerate(weights(a.shape[1])):
        ones = np.zeros(out.shape, np.int64)
        for j, other in enumerate(weights(b.shape[1])):
            ones += other * np.bitwise_count(a[:, i, None] & b[None, :, j])
        out += worth * ones
    return out


def nearest(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Slice by slice of a batch: its planes, and each row's nearest centroid and squared distance."""
    flat, width = to_planes(centroids)
    near, norms = square_planes(flat, width), (centroids * centroids).sum(axis=1)
    for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(lo, ROWS_AT_ONCE)
        lists = part.column("planes")
        planes = square_planes(lists.flatten().to_numpy().view(np.uint64), np.diff(lists.offsets.to_numpy()).astype(np.int64))
        away = part.column("norm").to_numpy()[:, None] - 2 * dots(planes, near) + norms[None, :]
        cluster = away.argmin(axis=1)
        yield planes, cluster, away[np.arange(len(away)), cluster]


def packed(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """Per usable vector: vec_id, its planes and its squared norm."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.floor(scale * batch.column("parts").flatten().to_numpy()).reshape(-1, COMPONENTS)
        if len(values) and np.abs(values).max() > scale * LARGEST:
            raise ValueError(f"a component beyond {LARGEST} has no exact distances in 64 bits")
        values = values.astype(np.int64)
        flat, width = to_planes(values)
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(width)]).astype(np.int32)), pa.array(flat.view(np.int64))
        )
        return pa.RecordBatch.from_pydict(
            {"vec_id": batch.column("vec_id"), "planes": lists, "norm": (values * values).sum(axis=1)}
        )

    return map_batches(vectors, run, "vec_id long, planes array<long>, norm long")


def starts(vectors: DataFrame, n: int, seed: int, scale: int = SCALE) -> np.ndarray:
    """The vectors with the smallest hashes of seed and vec_id, in ascending order; n rows at most."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    ordered = vectors.select(digest.alias("digest"), quantised(F.col("parts"), scale).alias("parts"))
    rows = ordered.orderBy(F.col("digest").asc_nulls_last(), "parts").limit(n).collect()
    return np.array([r["parts"] for r in rows], np.int64).reshape(-1, COMPONENTS)


def moved(planes: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: every non-empty one at the exact floor of its vectors' mean."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, COMPONENTS), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for part, cluster, _ in nearest(batch, centroids):
                np.add.at(total, cluster, from_planes(part))
                count += np.bincount(cluster, minlength=k)
        met = np.flatnonzero(count)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(met) + 1, dtype=np.int32) * np.int32(COMPONENTS)), pa.array(total[met].ravel())
        )
        yield pa.RecordBatch.from_pydict({"cluster": met.astype(np.int32), "n": count[met], "total": lists})

    parts = planes.mapInArrow(run, "cluster int, n long, total array<long>")
    sums = [F.sum(F.col("total")[i]).alias(f"c{i}") for i in range(COMPONENTS)]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():
        out[row["cluster"]] = [row[f"c{i}"] // row["n"] for i in range(COMPONENTS)]
    return out


def cluster_vectors(
    vectors: DataFrame, n: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """Per usable vector: vec_id, cluster, squared distance, the distances summed over its cluster
    (cluster_inertia) and over all (inertia), and the final centroid as a list of integers."""
    spark = vectors.sparkSession
    known = usable(vectors, vec_id, embedding)
    planes = staged(packed(known, scale), "planes")
    centroids = starts(known, n, seed, scale)
    if not len(centroids):
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
        )
    for _ in range(rounds):
        centroids = moved(planes, centroids)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(c, d) for _, c, d in nearest(batch, centroids)]
        return pa.RecordBatch.from_pydict({
            "vec_id": batch.column("vec_id"), "cluster": np.concatenate([c for c, _ in found]).astype(np.int32),
            "distance": np.concatenate([d for _, d in found]),
        })

    assigned = staged(map_batches(planes, run, "vec_id long, cluster int, distance long"), "clusters")
    spread = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    rows = [(c, spread[c], sum(spread.values()), centroids[c].tolist()) for c in sorted(spread)]
    per_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    # as many rows as there are centroids
    return assigned.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def digest_of(centroid: Column) -> Column:
    """sha256 of the components as decimal integers, joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ","), 256)
