"""Texts to token ids in fixed-width packed files, and back.

Every whole text is encoded by a tokenizer of the tokenizers library, whose file is a parameter: the
driver reads it and each task gets its text, so executors need no file. An end id closes every
document. The ids are written next to the doc_id as whole numbers of 16 or 32 bits, dealt to ranges
of ascending doc_id, and written by the ``packed_ids`` format at the vocabulary's least width.

Where a tokenizer's file says that words stand alone (``words_stand_alone``: white space ends every
token and nothing looks past it), a text's ids are those of its words in a row, and those of a word
of letters, digits and plain marks are those of its runs of each. Then numpy finds all runs of about
4 MB of texts at once and names them by 64-bit hashes; the tokenizer's model gets every run that its
worker has not met lately, once, and any other word is encoded as it is. What is kept is bounded.
Tokenizers without that property get whole texts.

Rows are dealt by doc_id, a hash of the ids and a number fixed when the ids are written, so rows that
share a doc_id, even a third of the table, go to many files; no task sorts more than its range.
The files a run writes are about FILE_IDS ids each, and at least as many as the cluster has cores.

Defined cases: a null or empty text has the end id alone. Null doc_ids come first. Rows that share a
doc_id are documents of their own, in the order of that hash. An empty table writes a manifest
without files and reads back as no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm.packed import register, row_type
from salesflow.llm.tokens import LOWER, Slice, prefix_sums, slices, span_hash
from salesflow.session import new_folder, remove_folder

END_ID = 1
FILE_IDS = 64 << 20
BYTES_AT_ONCE = 4 << 20
# runs that a worker remembers the ids of, and the bytes of the longest that is kept
RUNS_KEPT = 3 << 17
LONGEST_KEPT = 64
#: Kinds of bytes. An odd one makes its whole word odd: apostrophes may start contractions, ``<`` special
#: tokens, and beyond ASCII only the Latin-1 letters are known to stay as they are but for their case.
WHITE, LETTER, DIGIT, MARK, ODD = range(5)
KINDS = np.full(256, ODD, np.uint8)
KINDS[33:127] = MARK
for _signs, _kind in ((b" \t\n\r", WHITE), (b"0123456789", DIGIT), (b"'<", ODD), (bytes([*range(65, 91), *range(97, 123)]), LETTER)):
    KINDS[list(_signs)] = _kind
#: Steps before splitting that look at no neighbour beyond white space.
PLAIN_STEPS = {"NFC", "Replace", "Lowercase"}
#: Patterns that words are split by: contractions aside, one of each of these.
LETTER_RUNS, DIGITS, MARK_RUNS = {r"[\p{L}]+", r"\p{L}+"}, {r"[\p{N}]", r"\p{N}"}, {r"[^\s\p{L}\p{N}]+"}


def words_stand_alone(tokenizer: str) -> bool:
    """Whether a tokenizer's file says that the ids of a text are those of its words, one after another,
    and the ids of letters and of marks behind them those of each.

    So it is if its normaliser only composes, lowers and replaces white space, if its first step
    keeps contractions, runs of letters, single digits, and runs of marks, and drops the rest, and if
    what follows only spells bytes.
    """
    parts = json.loads(tokenizer)
    normal = parts.get("normalizer") or {"type": "Sequence", "normalizers": []}
    steps = normal["normalizers"] if normal["type"] == "Sequence" else [normal]
    before = parts.get("pre_tokenizer") or {"type": None}
    first, *after = before["pretokenizers"] if before["type"] == "Sequence" else [before]
    if first["type"] != "Split" or first["behavior"] != "Removed" or not first["invert"]:
        return False
    patterns = [p for p in first["pattern"].get("Regex", "").split("|") if not re.fullmatch("'[a-z]+", p)]
    kinds = (LETTER_RUNS, DIGITS, MARK_RUNS)
    replaced = all(s["pattern"].get("Regex") == r"\s+" and s["content"] == " " for s in steps if s["type"] == "Replace")
    return (
        {s["type"] for s in steps} <= PLAIN_STEPS and {"type": "Lowercase"} in steps and replaced
        and len(patterns) == 3 and all(kind & set(patterns) for kind in kinds)
        and all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in after) and len(after) == 1
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or not re.fullmatch(r"<\|\w+\|>", t["content"]) for t in parts["added_tokens"])
    )


def byte_signs() -> dict[int, str]:
    """How byte-level models write the bytes that are no visible Latin-1 sign: from 256 on, in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {byte: chr(256 + i) for i, byte in enumerate(b for b in range(256) if b not in visible)}


BYTE_SIGNS = byte_signs()


class Memory:
    """Ids of runs by hash, kept while they are met: two generations of at most ``most`` each."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def missing(self, hashes: list[int]) -> list[int]:
        """The places of the hashes that are not known."""
        young, old, out = self.young, self.old, []
        for i, h in enumerate(hashes):
            if h not in young:
                if (known := old.get(h)) is None:
                    out.append(i)
                else:
                    young[h] = known
        return out

    def settle(self) -> None:
        if len(self.young) > self.most:
            self.old, self.young = {h: v for h, v in self.young.items() if len(v) <= 4 * LONGEST_KEPT}, {}


@dataclass
class Runs:
    """Runs in order: byte start and end, text index, kind and hash, over the folded bytes."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    kind: np.ndarray
    hash: np.ndarray


def runs(piece: Slice) -> Runs:
    """The runs of a slice's texts: of letters, of marks, single digits, and odd words whole."""
    raw, kind = piece.data, KINDS[piece.data]
    n, data = len(raw), LOWER[piece.data]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    low = raw[lead + 1]
    letter = (low >= 0x80) & (low != 0x97) & (low != 0xB7)  # not the signs of times and division
    kind[lead[letter]] = kind[lead[letter] + 1] = LETTER
    data[lead[letter & (low <= 0x9E)] + 1] += 0x20
    begins = np.zeros(n, bool)
    begins[piece.offsets[:-1][piece.offsets[:-1] < n]] = True
    inside = kind != WHITE
    first = inside.copy()
    first[1:] &= ~inside[:-1] | begins[1:]
    words = np.flatnonzero(first)
    if not len(words):
        none = np.zeros(0, np.int64)
        return Runs(data, none, none, none, none, none.astype(np.uint64))
    odd = np.add.reduceat((kind == ODD).astype(np.int32), words) > 0
    spread = np.repeat(odd, np.diff(np.append(words, n)))
    odd_byte = np.concatenate([np.zeros(words[0], bool), spread]) & inside
    kind[odd_byte] = ODD
    data[odd_byte] = raw[odd_byte]
    new = first.copy()
    new[1:] |= inside[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
    last = inside.copy()
    last[:-1] &= ~inside[1:] | new[1:]
    start, end = np.flatnonzero(new), np.flatnonzero(last) + 1
    text = np.searchsorted(piece.offsets, start, side="right") - 1
    return Runs(data, start, end, text, kind[start], span_hash(prefix_sums(data), start, end))


@lru_cache(maxsize=1)
def encoder(tokenizer: str, end_id: int, kind: str) -> Callable[[pa.Array], Iterator[tuple[int, pa.Array]]]:
    """Texts to their ids as whole numbers in a row, each closed by the end id: for some texts at a
    time, how many and their ids. A worker keeps the last one, with what it remembers."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    model, memory, dtype = Tokenizer.from_str(tokenizer), Memory(RUNS_KEPT), np.dtype(kind)
    code = "H" if dtype.itemsize == 2 else "I"

    def whole(texts: list[str]) -> list[bytes]:
        return [array(code, e.ids).tobytes() for e in model.encode_batch_fast(texts, add_special_tokens=False)]

    def spelt(run: bytes) -> bytes:
        signs = run.decode() if run.isascii() else run.decode("latin-1").translate(BYTE_SIGNS)
        return array(code, [t.id for t in model.model.tokenize(signs)]).tobytes()

    def learn(found: Runs, hashes: list[int], places: np.ndarray) -> None:
        """The ids of the runs that lie at the given places."""
        text = [found.data[a:b].tobytes() for a, b in zip(found.start[places].tolist(), found.end[places].tolist())]
        odd = (found.kind[places] == ODD).tolist()
        encoded = iter(whole([t.decode() for t, o in zip(text, odd) if o]))
        memory.young.update((h, next(encoded) if o else spelt(t)) for h, t, o in zip(hashes, text, odd))

    def by_runs(piece: Slice) -> pa.Array:
        found = runs(piece)
        distinct, at, which = np.unique(found.hash, return_index=True, return_inverse=True)
        hashes = distinct.tolist()
        if new := memory.missing(hashes):
            learn(found, [hashes[i] for i in new], at[new])
        known = [memory.young[h] for h in hashes]
        memory.settle()
        ids = np.frombuffer(b"".join(known), dtype)
        size = np.fromiter(map(len, known), np.int64, len(known)) // dtype.itemsize
        first, each = np.cumsum(size) - size, size[which]
        place = np.repeat(first[which] - np.cumsum(each) + each, each) + np.arange(int(each.sum()))
        per_text = np.bincount(found.text, weights=each, minlength=piece.n).astype(np.int64)
        closed = np.insert(ids[place], np.cumsum(per_text), dtype.type(end_id))
        return binaries(closed, per_text + 1)

    def binaries(ids: np.ndarray, per_text: np.ndarray) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(per_text * dtype.itemsize)]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(per_text), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.astype(dtype).tobytes())])

    def encode(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
        for piece in slices(texts, BYTES_AT_ONCE):
            if alone:
                yield piece.n, by_runs(piece)
            else:
                some = [t or "" for t in texts.slice(piece.first, piece.n).to_pylist()]
                yield piece.n, pa.array([ids + np.array([end_id], dtype).tobytes() for ids in whole(some)], pa.binary())

    alone = words_stand_alone(tokenizer)
    return encode


def token_rows(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Per document: doc_id and its ids as whole numbers in a binary."""
    from tokenizers import Tokenizer

    kind = row_type(Tokenizer.from_str(tokenizer).get_vocab_size())
    shared = documents.sparkSession.sparkContext.broadcast(tokenizer)  # a vocabulary, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value, end_id, kind.str)
        for batch in batches:
            low = 0
            for n, ids in encode(batch.column("text")):
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").slice(low, n), "ids": ids})
                low += n

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids binary")


def write_token_ids(documents: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encodes the documents and writes their ids in ascending doc_id order."""
    from tokenizers import Tokenizer

    spark = documents.sparkSession
    register(spark)
    vocabulary = Tokenizer.from_str(tokenizer).get_vocab_size()
    # encoded once: finding ranges and dealing rows to them both read these
    rows = token_rows(documents, tokenizer, end_id).withColumn("place", F.monotonically_increasing_id())
    aside = new_folder(spark, "token-ids")
    rows.write.option("compression", "zstd").parquet(aside)
    rows = spark.read.schema(rows.schema).parquet(aside)
    total = rows.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    files = max(spark.sparkContext.defaultParallelism, -(-total // (FILE_IDS * row_type(vocabulary).itemsize)))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), F.col("place")]
    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    dealt.select("doc_id", "ids").write.format("packed_ids").option("vocabulary", vocabulary).mode("append").save(folder)
    remove_folder(spark, aside)


def read_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """What a folder of packed ids holds: doc_id, start and the ids as unsigned 32-bit integers."""
    register(spark)
    return spark.read.format("packed_ids").load(folder)


def tokenised(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Per document, as read back from files written to the shared folder: doc_id, start (ids of all
    documents before it), n_tokens, and ids_crc32 over its ids as little-endian 32-bit integers."""
    folder = new_folder(documents.sparkSession, "packed-ids")
    write_token_ids(documents, folder, tokenizer, end_id)
    rows = read_token_ids(documents.sparkSession, folder)
    return rows.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
