"""Removal of long repeated byte strings by suffix arrays over content-dealt shards.

A 200-byte string holds exactly one leftmost minimum of its 32-byte hashes, its anchor, and equal
strings have equal anchors. So the strings that start at consecutive places with one anchor are one
stretch of text, the context, and two equal strings can only lie in contexts of one anchor hash.

1. Each text is cut into contexts; only (anchor hash, digest of the context, place) is written down.
2. Anchor hashes met once are done. Where all contexts of a hash are equal, all their strings repeat.
3. Of the other hashes each distinct context goes, as text, to the shard of its hash. There the
   suffix array is built by induced sorting, and a string repeats where the permuted common prefix
   with a neighbour in the array reaches 200 bytes. A hash with more than GROUP distinct contexts is
   instead counted by the hashes of its strings, spread over all tasks, which gives the same rows.
4. The repeated stretches meet per document and its bytes are cut.

Defined cases: a null or empty text has 0 bytes and the checksum of no bytes; texts under 200 bytes
lose nothing; rows that repeat a document are documents of their own, so from 200 bytes on both
lose everything; null ids are allowed, and rows of one id are told apart by 64 bits of their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.frames import give_back, map_batches
from salesflow.llm.suffixes import common_prefix_reaches, induced_suffix_array
from salesflow.llm.tokens import Slice, buffers, mix, prefix_sums, slices, span_hash
from salesflow.session import staged

LENGTH = 200
GRAM = 32
SHARD_BYTES = 2 << 20
GROUP = 4096


def sliding_minimum(value: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values, by running minima of blocks from both sides."""
    n = len(value) - width + 1
    rows = -(-len(value) // width)
    padded = np.full(rows * width, np.iinfo(value.dtype).max, value.dtype)
    padded[: len(value)] = value
    block = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def contexts(piece: Slice, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """The contexts of a slice: text, first start within it, number of starts, anchor hash and digest."""
    n = len(piece.data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none
    sums = prefix_sums(piece.data)
    at = np.arange(n - gram + 1)
    key = span_hash(sums, at, at + gram)
    place = (key >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)  # ties: leftmost
    anchor = (sliding_minimum(place, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(piece.n), np.diff(piece.offsets))[: len(anchor)]
    start = np.flatnonzero(np.arange(len(anchor)) + length <= piece.offsets[1:][text])
    if not len(start):
        return none, none, none, none, none
    anchor, text = anchor[start], text[start]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    count = np.diff(np.append(first, len(start)))
    begin = start[first]
    digest = span_hash(sums, begin, begin + count - 1 + length)
    return text[first], begin - piece.offsets[text[first]], count, key[anchor[first]], mix(digest + count.astype(np.uint64))


def ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    """The runs of true places, with exclusive ends."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [tuple(x) for x in edge.reshape(-1, 2).tolist()]


def repeated_in_shard(stretches: list[bytes], many: list[bool], length: int) -> list[list[tuple[int, int]]]:
    """Per distinct context of a shard, the ranges of starts whose strings stand anywhere else."""
    sizes = np.array([len(s) + 1 for s in stretches], np.int64)
    begin = np.cumsum(sizes) - sizes
    # bytes of UTF-8 end at 0xF4: moved up by two, 1 separates and 0 ends
    text = np.frombuffer(b"".join(s + b"\xff" for s in stretches) + b"\xfe", np.uint8) + np.uint8(2)
    valid = np.zeros(len(text), bool)
    for a, s in zip(begin.tolist(), sizes.tolist()):
        valid[a : a + s - length] = True
    found = common_prefix_reaches(text, induced_suffix_array(text), length, valid)
    return [[(0, s - length)] if m else ranges(found[a : a + s - length]) for a, s, m in zip(begin.tolist(), sizes.tolist(), many)]


def binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def cut_repeats(documents: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, group: int = GROUP, gram: int = GRAM) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans."""
    docs = documents.select("doc_id", F.xxhash64("text").alias("body"), F.coalesce("text", F.lit("")).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for piece in slices(batch.column("text")):
            text, start, count, key, digest = contexts(piece, length, gram)
            take = pa.array(text + piece.first)
            rows.append(pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").take(take), "body": batch.column("body").take(take),
                "start": start.astype(np.int32), "n": count.astype(np.int16), "key": key.astype(np.int64), "digest": digest.astype(np.int64),
            }))
        return pa.Table.from_batches(rows).combine_chunks().to_batches()[0] if sum(r.num_rows for r in rows) else None

    place_type = f"doc_id {id_type}, body long, start int, n short"
    places = staged(map_batches(docs, cut, f"{place_type}, key long, digest long"), "contexts")
    keys = places.groupBy("key").agg(F.count("*").alias("met"), F.min("digest").alias("low"), F.max("digest").alias("high"))
    # written first: a join of two plain shuffles can have a hot key's partition split
    keys = staged(keys.where("met > 1").select("key", (F.col("low") != F.col("high")).alias("mixed")), "keys")
    again = staged(places.join(keys, "key"), "repeated")

    plain = again.where("NOT mixed").select("doc_id", "body", F.col("start").alias("first"), (F.col("start") + F.col("n") - 1 + length).alias("end"))
    classes = again.where("mixed").groupBy("key", "digest").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "body", "start", "n")).alias("at"))
    classes = staged(classes, "classes")
    sizes = classes.groupBy("key").agg((F.count("*") > group).alias("large")).where("large")
    wanted = (
        classes.join(sizes, "key", "left").withColumn("large", F.coalesce("large", F.lit(False))).groupBy(F.col("at.doc_id").alias("w_id"), F.col("at.body").alias("w_body"))
        .agg(F.collect_list(F.struct("key", "digest", "copies", "large", F.col("at.start").alias("start"), F.col("at.n").alias("n"))).alias("wanted"))
    )
    with_text = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("body") == F.col("w_body")))

    def take_text(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = buffers(batch.column("text"))
        out: dict[str, list] = {k: [] for k in ("key", "digest", "many", "large", "stretch")}
        for row, wants in enumerate(batch.column("wanted").to_pylist()):
            for w in wants:
                a = offsets[row] + w["start"]
                out["key"].append(w["key"])
                out["digest"].append(w["digest"])
                out["many"].append(w["copies"] > 1)
                out["large"].append(w["large"])
                out["stretch"].append(raw[a : a + w["n"] - 1 + length].tobytes())
        return pa.RecordBatch.from_pydict(out)

    stretches = staged(
        map_batches(with_text.select("text", "wanted"), take_text, "key long, digest long, many boolean, large boolean, stretch binary"), "stretches"
    )

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: list[int] = []
        digest: list[int] = []
        many: list[bool] = []
        text: list[bytes] = []
        size = 0

        def solve(n: int) -> pa.RecordBatch:
            found = repeated_in_shard(text[:n], many[:n], length)
            flat = [(key[i], digest[i], a, b) for i, spans in enumerate(found) for a, b in spans]
            return pa.RecordBatch.from_pydict({
                "key": pa.array([x[0] for x in flat], pa.int64()), "digest": pa.array([x[1] for x in flat], pa.int64()),
                "low": pa.array([x[2] for x in flat], pa.int32()), "high": pa.array([x[3] for x in flat], pa.int32()),
            })

        for batch in batches:
            for k, d, m, s in zip(*(batch.column(c).to_pylist() for c in ("key", "digest", "many", "stretch"))):
                if size >= shard_bytes and k != key[-1]:  # equal strings share a key: shards end between keys
                    yield solve(len(key))
                    key, digest, many, text, size = [], [], [], [], 0
                if key and (key[-1], digest[-1]) == (k, d):
                    continue  # a repeated row gives the same stretch again
                key.append(k)
                digest.append(d)
                many.append(m)
                text.append(s)
                size += len(s)
        if key:
            yield solve(len(key))
        give_back()

    def strings(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        raw, offsets = binary(batch.column("stretch"))
        sums = prefix_sums(raw)
        width = np.diff(offsets) - length + 1
        row = np.repeat(np.arange(batch.num_rows), width)
        low = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
        at = offsets[:-1][row] + low
        pick = pa.array(row)
        return pa.RecordBatch.from_pydict({
            "key": batch.column("key").take(pick), "digest": batch.column("digest").take(pick), "many": batch.column("many").take(pick),
            "low": low.astype(np.int32), "string": span_hash(sums, at, at + length).astype(np.int64),
        })

    in_shards = stretches.where("NOT large").repartition("key").sortWithinPartitions("key", "digest").mapInArrow(shard, "key long, digest long, low int, high int")
    single = map_batches(stretches.where("large").dropDuplicates(["key", "digest"]), strings, "key long, digest long, many boolean, low int, string long")
    single = staged(single, "strings")
    twice = single.groupBy("key", "string").agg((F.count("*") + F.max(F.col("many").cast("int"))).alias("met")).where("met > 1").select("key", "string")
    counted = single.join(twice, ["key", "string"]).select("key", "digest", "low", (F.col("low") + 1).alias("high"))
    found = staged(in_shards.union(counted), "found")
    mixed = again.where("mixed").join(found, ["key", "digest"]).select(
        "doc_id", "body", (F.col("start") + F.col("low")).alias("first"), (F.col("start") + F.col("high") - 1 + length).alias("end")
    )
    # rows that repeat a document have its spans once; written first, so that a join with many such rows can be split
    spans = plain.union(mixed).groupBy(F.col("doc_id").alias("s_id"), F.col("body").alias("s_body")).agg(
        F.array_sort(F.collect_set(F.struct("first", "end"))).alias("spans")
    )
    spans = staged(spans, "spans")
    joined = docs.join(spans, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("body") == F.col("s_body")), "left").select("doc_id", "text", "spans")

    def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = buffers(batch.column("text"))
        size = np.diff(offsets)
        column = batch.column("spans")
        bounds = column.offsets.to_numpy()
        missing = column.is_null().to_numpy(zero_copy_only=False)
        first, end = (column.values.field(i).to_numpy() for i in (0, 1))
        removed, n_spans, digest, out = [], [], [], []
        for row in range(batch.num_rows):
            a, b = offsets[row], offsets[row + 1]
            lo, hi = (0, 0) if missing[row] else (bounds[row], bounds[row + 1])
            f, e = first[lo:hi].astype(np.int64), end[lo:hi].astype(np.int64)
            if not len(f):
                removed.append(0)
                n_spans.append(0)
                digest.append(hashlib.sha256(raw[a:b].tobytes()).hexdigest())
                out.append([])
                continue
            reach = np.maximum.accumulate(e)
            new = np.concatenate([[True], f[1:] > reach[:-1]])
            low, high = f[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(f) - 1)]
            mark = np.zeros(int(b - a) + 1, np.int8)
            mark[low] += 1
            mark[high] -= 1
            left = np.cumsum(mark[:-1], dtype=np.int8) == 0
            removed.append(int((high - low).sum()))
            n_spans.append(len(low))
            digest.append(hashlib.sha256(raw[a:b][left].tobytes()).hexdigest())
            out.append([{"first": x, "end": y} for x, y in zip(low.tolist(), high.tolist())])
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_bytes": size.astype(np.int64), "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(digest, pa.string()),
            "spans": pa.array(out, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
        })

    return map_batches(
        joined, remove,
        f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<first:long,end:long>>",
    )

