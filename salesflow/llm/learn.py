"""Shared by the classifiers: the labelled sample, training in one bounded task, and scoring.

Models are fitted on at most MAX_ROWS labelled documents, those whose doc_id hashes lowest among the
rows held in (crc32 of the id as text, modulo FOLDS, not 0). The bound is a parameter. Only the text
reaches the features.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.frames import give_back, map_batches
from salesflow.llm.tokens import Slice, slices

MAX_ROWS = 12_000
FOLDS = 5
BITS = 20

#: A slice's hashed terms: text index and bin of each occurrence.
Terms = Callable[[Slice], tuple[np.ndarray, np.ndarray]]


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def labelled(documents: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """doc_id, text and y of the training sample. Repeated labels of a document: the largest counts."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & (fold() != 0))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # at most max_rows ids: bounded whatever the tables hold
    return texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def counted(text: np.ndarray, bin_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, bin) with their counts, in order."""
    packed = np.sort((text.astype(np.int64) << BITS) | bin_)
    lead = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]])) if len(packed) else np.zeros(0, np.int64)
    return packed[lead] >> BITS, packed[lead] & ((1 << BITS) - 1), np.diff(np.append(lead, len(packed)))


def fit(sample: DataFrame, terms: Terms, train: Callable[[np.ndarray, list[np.ndarray], list[np.ndarray]], bytes]) -> bytes:
    """Hashes the sample's terms in parallel, then trains on the sparse rows in one task.

    ``train`` gets the labels and, per row, bins and counts, in an order that the ids alone decide.
    """

    def sparse(batch: pa.RecordBatch) -> pa.RecordBatch:
        bins, counts, offsets = [], [], [0]
        for piece in slices(batch.column("text")):
            text, bin_, count = counted(*terms(piece))
            bins.append(bin_.astype(np.int32))
            counts.append(count.astype(np.int32))
            offsets.extend((offsets[-1] + np.searchsorted(text, np.arange(1, piece.n + 1))).tolist())
        at = pa.array(np.array(offsets, np.int32))
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "y": batch.column("y"),
            "bins": pa.ListArray.from_arrays(at, pa.array(np.concatenate(bins))),
            "counts": pa.ListArray.from_arrays(at, pa.array(np.concatenate(counts))),
        })

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, bins, counts = [], [], []
        for batch in batches:
            y.extend(batch.column("y").to_pylist())
            for name, out in (("bins", bins), ("counts", counts)):
                column = batch.column(name)
                at = column.offsets.to_numpy()
                values = column.values.to_numpy()
                out.extend(values[a:b] for a, b in zip(at[:-1], at[1:]))
        model = train(np.array(y, np.float64), bins, counts)
        bins, counts = [], []
        give_back()
        yield pa.RecordBatch.from_pydict({"model": pa.array([model], pa.binary())})

    rows = map_batches(sample.select("doc_id", "y", "text"), sparse, "doc_id long, y int, bins array<int>, counts array<int>")
    one = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    made = one.mapInArrow(whole, "model binary").first()
    return bytes(made["model"]) if made else train(np.zeros(0), [], [])  # no labelled rows: no partition


def scored(documents: DataFrame, keep: list[str], score: Callable[[Slice], np.ndarray], cut: float) -> DataFrame:
    """Every row of the documents: the columns ``keep``, held_out, score and predicted."""
    source = documents.select(F.struct(*keep).alias("_row"), F.coalesce("text", F.lit("")).alias("_text"), (fold() == 0).alias("held_out"))
    kind = source.schema["_row"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        value = np.concatenate([score(piece) for piece in slices(batch.column("_text"))])
        return pa.RecordBatch.from_pydict({
            "_row": batch.column("_row"), "held_out": batch.column("held_out"), "score": value, "predicted": (value >= cut).astype(np.int32),
        })

    out = map_batches(source, run, f"_row {kind}, held_out boolean, score double, predicted int")
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], "held_out", "score", "predicted")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
