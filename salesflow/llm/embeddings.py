"""Near-duplicate embeddings over a robust-pruned flat graph.

Equal vectors are one class with a count. Pivots, a bounded sample of the classes, cut the space:
each vector is owned by its nearest pivot and is a guest of the next OVERLAP - 1.

Build: in each overlapping shard every member's nearest candidates are pruned robustly: the nearest
stays and drops those that lie closer to it, by the factor ALPHA, than to the member, and so on. The
adjacency lists of the shards, with their reverse edges, are united per vector.

Search: every vector is a query, first in the shards around it. From the shard's medoid, and from
itself where it is a member, a greedy search expands the best nodes met; then every node near the
threshold is expanded until none is new. Edges that lead from there to vectors of other shards that
can lie in range, by the triangle inequality, send the query on, until no query has a shard left.

Each vector has one owner, so links are counted once: a task returns counts and a spanning set of
edges, never the pairs. Cosines are confirmed in double precision. ``audit`` measures recall
against brute force.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
vec_id, link with nothing and are kept; vectors of different lengths never link; rows that share
vec_id and vector are one vector, each row answered alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.frames import components, map_batches, spanning
from salesflow.session import staged

THRESHOLD = 0.9
SHARD = 600
MAX_PIVOTS = 32_768
OVERLAP = 3
CANDIDATES, DEGREE, ALPHA = 48, 24, 1.2
EXPAND, ROUNDS = 4, 12
SLACK = 0.08
SUB_SHARD = 6_000
QUERIES_A_TASK = 8_192


def matrix(column: pa.ChunkedArray | pa.Array, kind=np.float32) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1, in double precision; scaled first, so that no square overflows."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def sub_shards(x: np.ndarray, limit: int) -> list[np.ndarray]:
    """Members in overlapping parts of about ``limit``, around members taken at even steps."""
    if len(x) <= limit:
        return [np.arange(len(x))]
    pivots = x[np.linspace(0, len(x) - 1, 2 * -(-len(x) // limit)).astype(int)]
    near = np.concatenate([np.argsort(-(x[a : a + 4096] @ pivots.T), axis=1)[:, :OVERLAP] for a in range(0, len(x), 4096)])
    return [part for p in range(len(pivots)) if len(part := np.flatnonzero((near == p).any(axis=1)))]


def pruned_edges(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directed edges of a robust-pruned graph over unit rows: from, to, cosine."""
    n = len(x)
    wide = min(CANDIDATES, n - 1)
    src, dst, cosine = [], [], []
    for lo in range(0, n if wide > 0 else 0, 256):
        rows = np.arange(lo, min(n, lo + 256))
        sims = x[rows] @ x.T
        sims[np.arange(len(rows)), rows] = -2
        near = np.argpartition(-sims, wide - 1, axis=1)[:, :wide]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, 1), axis=1, kind="stable"), 1)
        own = np.take_along_axis(sims, near, 1)
        far = np.sqrt(np.maximum(0, 2 - 2 * own))
        y = x[near]
        between = np.sqrt(np.maximum(0, 2 - 2 * (y @ y.transpose(0, 2, 1))))
        alive = np.ones(near.shape, bool)
        line = np.arange(len(rows))
        for _ in range(min(DEGREE, wide)):
            some = alive.any(axis=1)
            if not some.any():
                break
            pick = alive.argmax(axis=1)
            live = line[some]
            src.append(rows[some])
            dst.append(near[live, pick[some]])
            cosine.append(own[live, pick[some]])
            alive[live, pick[some]] = False
            alive &= ~((ALPHA * between[line, pick] <= far) & some[:, None])
    if not src:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    a, b, c = np.concatenate(src), np.concatenate(dst), np.concatenate(cosine)
    both = np.unique(np.concatenate([a * n + b, b * n + a]), return_index=True)
    at = both[1] % len(a)
    return both[0] // n, both[0] % n, c[at]


def build(members: pa.Table) -> pa.Table:
    """One overlapping shard: the adjacency list of every member."""
    members = members.sort_by("vec_id")
    x = unit(matrix(members["embedding"])).astype(np.float32)
    ids, owner = members["vec_id"].to_numpy(), members["owner"].to_numpy()
    out = []
    for part in sub_shards(x, SUB_SHARD):
        a, b, cosine = pruned_edges(x[part])
        starts = np.searchsorted(a, np.arange(len(part) + 1)).astype(np.int32)
        to = pa.StructArray.from_arrays([pa.array(ids[part[b]]), pa.array(owner[part[b]]), pa.array(cosine.astype(np.float32))], ["id", "owner", "cosine"])
        out.append(pa.Table.from_pydict({"vec_id": ids[part], "near": pa.ListArray.from_arrays(pa.array(starts), to)}))
    return pa.concat_tables(out)


def expand(pairs: tuple[np.ndarray, np.ndarray], start: np.ndarray, to: np.ndarray, sims: np.ndarray, q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores the neighbours not met yet of (query, node) pairs; returns the new pairs."""
    row, node = pairs
    degree = start[node + 1] - start[node]
    row = np.repeat(row, degree)
    nbr = to[np.repeat(start[node] - np.cumsum(degree) + degree, degree) + np.arange(int(degree.sum()))]
    fresh = np.isneginf(sims[row, nbr])
    code = np.unique(row[fresh] * len(x) + nbr[fresh])
    row, nbr = code // len(x), code % len(x)
    sims[row, nbr] = np.einsum("ij,ij->i", q[row], x[nbr])
    return row, nbr


def search(x: np.ndarray, start: np.ndarray, to: np.ndarray, q: np.ndarray, seeds: list[tuple[np.ndarray, np.ndarray]], floor: float) -> np.ndarray:
    """Cosines of all nodes met, minus infinity elsewhere: greedy from the seeds, then every node
    above ``floor`` is expanded until none is new."""
    sims = np.full((len(q), len(x)), -np.inf, np.float32)
    for row, node in seeds:
        sims[row, node] = np.einsum("ij,ij->i", q[row], x[node])
    open_ = np.where(np.isneginf(sims), -np.inf, sims)
    done = np.zeros(sims.shape, bool)
    line = np.arange(len(q))
    for _ in range(ROUNDS):
        wide = min(EXPAND, len(x))
        best = np.argpartition(-open_, wide - 1, axis=1)[:, :wide]
        row, node = np.repeat(line, wide), best.ravel()
        live = ~np.isneginf(open_[row, node])
        row, node = row[live], node[live]
        if not len(row):
            break
        done[row, node] = True
        open_[row, node] = -np.inf
        r, n = expand((row, node), start, to, sims, q, x)
        open_[r, n] = sims[r, n]
    row, node = np.nonzero((sims >= floor) & ~done)
    while len(row):
        done[row, node] = True
        r, n = expand((row, node), start, to, sims, q, x)
        close = sims[r, n] >= floor
        row, node = r[close], n[close]
        again = ~done[row, node]
        row, node = row[again], node[again]
    return sims


def searcher(threshold: float):
    """The task of one shard: its nodes (left) against the queries sent to it (right)."""
    floor = threshold - SLACK

    def run(nodes: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list[np.ndarray]] = {k: [] for k in ("kind", "a", "b", "n", "shard")}

        def tell(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, shard: np.ndarray) -> None:
            for k, v in zip(out, (np.full(len(a), kind), a, b, n, shard)):
                out[k].append(np.asarray(v, np.int64))

        if len(nodes) and len(queries):
            nodes = nodes.sort_by("vec_id")
            here = int(nodes["owner"][0].as_py())
            ids, mult = nodes["vec_id"].to_numpy(), nodes["copies"].to_numpy()
            exact = unit(matrix(nodes["embedding"]))
            x = exact.astype(np.float32)
            near = nodes["near"].combine_chunks()
            at, flat = near.offsets.to_numpy(), near.values
            src = np.repeat(np.arange(len(ids)), np.diff(at))
            dst, owner, cosine = (flat.field(i).to_numpy()[at[0] : at[-1]] for i in range(3))
            local = owner == here
            to = np.searchsorted(ids, dst[local]).clip(max=len(ids) - 1)
            start = np.searchsorted(src[local], np.arange(len(ids) + 1))
            away = ~local & (cosine >= -1)
            a_src, a_dst, a_owner = src[away], dst[away], owner[away]
            a_angle = np.arccos(np.clip(cosine[away], -1, 1))
            a_start = np.searchsorted(a_src, np.arange(len(ids) + 1))
            medoid = int(np.argmax(x @ x.mean(axis=0)))
            reach = np.arccos(threshold) + 0.05
            q_ids, entry = queries["vec_id"].to_numpy(), queries["entry"].to_numpy()
            q_exact = unit(matrix(queries["embedding"]))
            edges_a, edges_b = [], []
            for lo in range(0, len(q_ids), 256):
                part = slice(lo, lo + 256)
                q, n = q_exact[part].astype(np.float32), len(q_ids[part])
                first = np.searchsorted(ids, entry[part]).clip(max=len(ids) - 1)
                known = np.flatnonzero(ids[first] == entry[part])
                seeds = [(known, first[known]), (np.arange(n), np.full(n, medoid))]
                sims = search(x, start, to, q, seeds, floor)
                row, node = np.nonzero(sims >= threshold - 1e-4)
                good = np.einsum("ij,ij->i", q_exact[part][row], exact[node]) >= threshold
                row, node = row[good], node[good]
                other = ids[node] != q_ids[part][row]
                row_o, node_o = row[other], node[other]
                links = np.bincount(row_o, weights=mult[node_o], minlength=n).astype(np.int64)
                some = np.flatnonzero(links)
                tell(0, q_ids[part][some], q_ids[part][some], links[some], np.full(len(some), here))
                if len(row_o):
                    a, b = spanning(q_ids[part][row_o], ids[node_o])
                    edges_a.append(a)
                    edges_b.append(b)
                row, node = np.nonzero(sims >= floor)
                degree = a_start[node + 1] - a_start[node]
                r = np.repeat(row, degree)
                e = np.repeat(a_start[node] - np.cumsum(degree) + degree, degree) + np.arange(int(degree.sum()))
                angle = np.repeat(np.arccos(np.clip(sims[row, node], -1, 1)), degree)
                can = a_angle[e] - angle <= reach
                nearest = np.argsort(a_angle[e[can]], kind="stable")
                r, e = r[can][nearest], e[can][nearest]
                _, one = np.unique(r * (1 << 32) + a_owner[e], return_index=True)
                tell(2, q_ids[part][r[one]], a_dst[e[one]], np.zeros(len(one)), a_owner[e[one]])
            if edges_a:
                a, b = spanning(np.concatenate(edges_a), np.concatenate(edges_b))
                tell(1, a[a != b], b[a != b], np.zeros(int((a != b).sum())), np.zeros(int((a != b).sum())))
        empty = np.zeros(0, np.int64)
        return pa.Table.from_pydict({k: np.concatenate([empty, *v]) for k, v in out.items()})

    return run


def link_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """Per row: vec_id, n_links, component_id (smallest vec_id reachable) and kept."""
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", fine) & F.exists("embedding", lambda x: x != 0)
    good = rows.where(usable).distinct()
    classes = staged(good.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")), "classes")
    lengths = [r[0] for r in classes.select(F.size("embedding").alias("n")).distinct().collect()]
    counts, edges = None, None
    for length in lengths:  # vectors of one length at a time; as a rule there is one
        own = classes.where(F.size("embedding") == length)
        c, e = _linked(spark, own, threshold, shard, max_pivots)
        counts, edges = (c, e) if counts is None else (counts.union(c), edges.union(e))
    if counts is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    comps = components(edges)
    per_class = classes.join(counts.groupBy("id").agg(F.sum("n").alias("n")), F.col("vec_id") == F.col("id"), "left").join(comps, F.col("vec_id") == F.col("node"), "left")
    per_class = per_class.select(
        F.col("embedding").alias("of"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("comp", "vec_id").alias("comp")
    )
    out = rows.withColumn("key", F.when(usable, F.col("embedding"))).join(per_class, F.col("key") == F.col("of"), "left")
    component = F.coalesce("comp", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _linked(spark, classes: DataFrame, threshold: float, shard: int, max_pivots: int) -> tuple[DataFrame, DataFrame]:
    """Link counts (id, n) and spanning edges (a, b) of classes of one vector length."""
    n = classes.count()
    k = min(max_pivots, max(1, -(-n // shard)))
    taken = classes.orderBy(F.xxhash64("embedding"), "vec_id").limit(k).select("embedding").collect()  # at most max_pivots vectors
    pivots = spark.sparkContext.broadcast(unit(np.array([r[0] for r in taken], np.float64)).astype(np.float32))

    def assign(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = unit(matrix(batch.column("embedding"))).astype(np.float32)
        p = pivots.value
        near = np.concatenate([np.argsort(-(x[a : a + 512] @ p.T), axis=1, kind="stable")[:, :OVERLAP] for a in range(0, len(x), 512)])
        at = np.arange(len(x) + 1, dtype=np.int32) * near.shape[1]
        return pa.RecordBatch.from_pydict({
            **{c: batch.column(c) for c in ("vec_id", "copies", "embedding")}, "owner": near[:, 0].astype(np.int64),
            "shards": pa.ListArray.from_arrays(pa.array(at), pa.array(near.ravel().astype(np.int64))),
        })

    placed = staged(map_batches(classes, assign, "vec_id long, copies long, embedding array<float>, owner long, shards array<long>"), "placed")
    members = placed.select("vec_id", "embedding", "owner", F.explode("shards").alias("shard"))
    lists = members.groupBy("shard").applyInArrow(build, "vec_id long, near array<struct<id:long,owner:long,cosine:float>>")
    united = lists.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))  # OVERLAP lists a vector
    empty = F.array().cast("array<struct<id:bigint,owner:bigint,cosine:float>>")
    graph = staged(placed.drop("shards").join(united, "vec_id", "left").withColumn("near", F.coalesce("near", empty)), "graph")

    vectors = placed.select("vec_id", "embedding")
    queries = members.select("vec_id", "embedding", "shard", F.col("vec_id").alias("entry"))
    visited = staged(queries.select("vec_id", "shard"), "visited")
    counts, edges = None, None
    while True:
        parts = queries.groupBy("shard").agg(F.ceil(F.count("*") / QUERIES_A_TASK).cast("int").alias("parts"))
        asked = queries.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        nodes = graph.join(parts, F.col("owner") == F.col("shard")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        nodes = nodes.select("vec_id", "copies", "embedding", "owner", "near", "part")
        asked = asked.select("vec_id", "embedding", "entry", "shard", "part")
        told = nodes.groupBy("owner", "part").cogroup(asked.groupBy("shard", "part")).applyInArrow(
            searcher(threshold), "kind long, a long, b long, n long, shard long"
        )
        told = staged(told, "searched")
        c, e = told.where("kind = 0").select(F.col("a").alias("id"), "n"), told.where("kind = 1").select("a", "b")
        counts, edges = (c, e) if counts is None else (counts.union(c), edges.union(e))
        onward = told.where("kind = 2").groupBy(F.col("a").alias("vec_id"), "shard").agg(F.min("b").alias("entry"))
        onward = staged(onward.join(visited, ["vec_id", "shard"], "left_anti"), "onward")
        if onward.isEmpty():
            return counts, edges
        visited = staged(visited.union(onward.select("vec_id", "shard")), "visited")
        queries = onward.join(vectors, "vec_id").select("vec_id", "embedding", "shard", "entry")


def audit(embeddings: DataFrame, linked: DataFrame, threshold: float = THRESHOLD, every: int = 50, block: int = 4096) -> float:
    """Recall of the links of the vectors whose id ``every`` divides, against brute force in blocks."""
    spark = embeddings.sparkSession
    rows = embeddings.where("embedding IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    asked = rows.where(F.col("vec_id") % every == 0)
    parts = 1 + asked.count() // block
    found = linked.select("vec_id", "n_links")
    true = right = 0
    for i in range(parts):  # a block of queries at a time, against all rows
        some = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == i).collect()
        if not some:
            continue
        ids = np.array([r[0] for r in some])
        sent = spark.sparkContext.broadcast((ids, unit(np.array([r[1] for r in some], np.float64))))

        def count(batch: pa.RecordBatch) -> pa.RecordBatch:
            names, q = sent.value
            hit = unit(matrix(batch.column("embedding"))) @ q.T >= threshold
            hit &= batch.column("vec_id").to_numpy()[:, None] != names[None, :]
            return pa.RecordBatch.from_pydict({"vec_id": names, "n": hit.sum(axis=0).astype(np.int64)})

        exact = map_batches(rows, count, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
        both = exact.join(found, "vec_id").agg(F.sum("n"), F.sum(F.least("n", "n_links"))).first()
        true, right = true + (both[0] or 0), right + (both[1] or 0)
    return right / true if true else 1.0
