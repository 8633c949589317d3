"""A file format for token ids, and the Spark data source that writes and reads it.

A folder holds one ``manifest.json`` and data files. A data file holds whole documents, one after
another in order. Ids are stored at a fixed width, the least number of bits that the vocabulary
needs, lowest bit first, in blocks of BLOCK ids that each begin on a byte:

    magic "PKIDS1\\0\\0"
    blocks of packed ids
    byte offset of every block, and of the end of the last        int64, blocks + 1
    doc_id of every document, 0 for none                          int64, documents
    whether the document has a doc_id                             uint8, documents
    first id of every document within the file, and the end       int64, documents + 1
    width, BLOCK, ids, blocks, documents                          int64, 5
    magic

All numbers are little-endian. Id i of a file is in block i // BLOCK; with the block offsets any range
of ids is one read and one vectorised unpacking (``PackedFolder.ids``), and so is any document.

The manifest lists the files in document order with their numbers of documents and ids, so a file's
place in the whole is a running sum, and the cuts at which readers split it. It is written last, by
the driver, from the messages of the tasks that committed: what a lost or repeated task left behind
is in no manifest and is never read.

    rows.write.format("packed_ids").option("vocabulary", 49408).mode("append").save(folder)
    spark.read.format("packed_ids").load(folder)      # doc_id, start, ids (uint32 as binary)

Rows to write have a doc_id and ``ids`` as little-endian unsigned integers of 16 bits, or of 32 where
the vocabulary needs more; partitions and rows are taken in order. Files are reached through Arrow's
file systems: local and mounted folders, HDFS, S3, GCS and Azure.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

MAGIC = b"PKIDS1\0\0"
BLOCK = 8192
MANIFEST = "manifest.json"
# a reader's task takes about so many ids, and unpacks so many at a time
IDS_A_SPLIT = 4 << 20
IDS_AT_ONCE = 1 << 18


def width_of(vocabulary: int) -> int:
    """Bits that every id below the size of the vocabulary fits in."""
    return max(1, (vocabulary - 1).bit_length())


def row_type(vocabulary: int) -> np.dtype:
    """The whole integers in which rows hold their ids on the way to the files."""
    return np.dtype("<u2") if width_of(vocabulary) <= 16 else np.dtype("<u4")


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids at a fixed width, lowest bit first, padded to a whole byte."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)[None, :]) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed bytes."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * width).reshape(n, width)
    return bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    local = re.match(r"^(?:file:)?/+(?=[^/])", folder)
    if local:
        return fs.LocalFileSystem(), "/" + folder[local.end() :].rstrip("/")
    system, path = fs.FileSystem.from_uri(folder)
    return system, path.rstrip("/")


@dataclass
class FileFacts(WriterCommitMessage):
    """One data file as the manifest lists it. ``cuts`` are documents at which readers may split."""

    name: str
    place: int
    documents: int
    ids: int
    cuts: list[int]


class FileWriter:
    """Appends documents to one data file; holds less than a block of ids, and the document index."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.rest = np.zeros(0, np.uint32)
        self.blocks, self.ids, self.cuts = [len(MAGIC)], 0, []
        self.doc_ids, self.known, self.starts = [], [], []
        out.write(MAGIC)

    def add(self, doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        """A batch of documents: their ids in a row, and how many each has."""
        before = sum(map(len, self.doc_ids))
        starts = self.ids + np.cumsum(lengths) - lengths
        split = starts // IDS_A_SPLIT
        last = self.cuts[-1][1] if self.cuts else 0
        for at in np.flatnonzero(np.diff(split, prepend=last)):
            self.cuts.append((before + int(at), int(split[at])))
        self.starts.append(starts)
        self.known.append(np.asarray(doc_ids.is_valid()).astype(np.uint8))
        self.doc_ids.append(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        self.ids += int(lengths.sum())
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK * BLOCK
        if whole:
            data = pack(ids[:whole], self.width)
            self.out.write(data)
            size = BLOCK * self.width // 8
            self.blocks.extend(range(self.blocks[-1] + size, self.blocks[-1] + len(data) + 1, size))
        self.rest = ids[whole:]

    def close(self) -> tuple[int, int, list[int]]:
        """Writes what is left and the index; returns documents, ids and cuts."""
        if len(self.rest):
            data = pack(self.rest, self.width)
            self.out.write(data)
            self.blocks.append(self.blocks[-1] + len(data))
        documents = sum(map(len, self.doc_ids))
        for kind, parts in (("<i8", [self.blocks]), ("<i8", self.doc_ids), ("u1", self.known), ("<i8", [*self.starts, [self.ids]])):
            for part in parts:
                self.out.write(np.asarray(part).astype(kind).tobytes())
        self.out.write(np.array([self.width, BLOCK, self.ids, len(self.blocks) - 1, documents], "<i8").tobytes() + MAGIC)
        return documents, self.ids, [document for document, _ in self.cuts]


class FileReader:
    """Random access to one data file."""

    def __init__(self, system: fs.FileSystem, path: str):
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(5 * 8 + len(MAGIC), size - 5 * 8 - len(MAGIC))
        if tail[-len(MAGIC) :] != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is no file of packed ids")
        self.width, self.block, self.ids, self.n_blocks, self.documents = np.frombuffer(tail, "<i8", 5).tolist()
        self.index = size - len(tail) - 8 * (self.n_blocks + 1) - 17 * self.documents - 8

    def __enter__(self) -> FileReader:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def _numbers(self, offset: int, first: int, n: int, kind: str = "<i8") -> np.ndarray:
        size = np.dtype(kind).itemsize
        return np.frombuffer(self.file.read_at(n * size, self.index + offset + first * size), kind)

    def offsets(self, first: int, n: int) -> np.ndarray:
        """Byte offsets of blocks."""
        return self._numbers(0, first, n)

    def doc_ids(self, first: int, n: int) -> pa.Array:
        after = 8 * (self.n_blocks + 1)
        known = self._numbers(after + 8 * self.documents, first, n, "u1")
        return pa.array(self._numbers(after, first, n), mask=known == 0)

    def starts(self, first: int, n: int) -> np.ndarray:
        """First ids of documents; that of the last's successor is the end."""
        return self._numbers(8 * (self.n_blocks + 1) + 9 * self.documents, first, n)

    def slice(self, first: int, n: int) -> np.ndarray:
        """Ids ``first`` to ``first + n`` of the file: one read of the blocks that hold them."""
        if not n:
            return np.zeros(0, np.uint32)
        low, high = first // self.block, (first + n - 1) // self.block + 1
        at = self.offsets(low, high - low + 1)
        data = self.file.read_at(int(at[-1] - at[0]), int(at[0]))
        held = min(high * self.block, self.ids) - low * self.block
        return unpack(data, self.width, held)[first - low * self.block :][:n]


class PackedFolder:
    """A written folder: its manifest, and ids by place without reading anything else."""

    def __init__(self, folder: str):
        self.system, self.path = store(folder)
        with self.system.open_input_stream(f"{self.path}/{MANIFEST}") as file:
            listed = json.loads(file.read())
        self.files = [FileFacts(**f) for f in listed["files"]]
        self.first = np.concatenate([[0], np.cumsum([f.ids for f in self.files], dtype=np.int64)])

    def open(self, at: int) -> FileReader:
        return FileReader(self.system, f"{self.path}/{self.files[at].name}")

    def ids(self, first: int, n: int) -> np.ndarray:
        """``n`` ids from place ``first`` of the whole, as trainers take them; they may span files."""
        parts, end = [np.zeros(0, np.uint32)], min(first + n, int(self.first[-1]))
        at = int(np.searchsorted(self.first, first, side="right")) - 1
        while first < end:
            take = min(end, int(self.first[at + 1])) - first
            with self.open(at) as file:
                parts.append(file.slice(first - int(self.first[at]), take))
            first, at = first + take, at + 1
        return np.concatenate(parts)


class PackedWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, vocabulary: int):
        self.folder, self.vocabulary = folder, vocabulary

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, path = store(self.folder)
        kind, writer, out = row_type(self.vocabulary), None, None
        name = f"ids-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(f"{path}/{name}")
                writer = FileWriter(out, width_of(self.vocabulary))
            column = batch.column(batch.schema.get_field_index("ids")).cast(pa.large_binary())
            at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            held = column.buffers()[2] if at[-1] > at[0] else b""
            ids = np.frombuffer(held, np.uint8)[at[0] : at[-1]].view(kind).astype(np.uint32)
            if len(ids) and int(ids.max()) >= self.vocabulary:
                raise ValueError(f"id {int(ids.max())} is not below the vocabulary's {self.vocabulary}")
            writer.add(batch.column(batch.schema.get_field_index("doc_id")), np.diff(at) // kind.itemsize, ids)
        if writer is None:
            return FileFacts("", TaskContext.get().partitionId(), 0, 0, [])
        documents, ids, cuts = writer.close()
        out.close()
        return FileFacts(name, TaskContext.get().partitionId(), documents, ids, cuts)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files = sorted((m for m in messages if m is not None and m.documents), key=lambda m: m.place)
        system, path = store(self.folder)
        system.create_dir(path, recursive=True)
        listed = {"vocabulary": self.vocabulary, "width": width_of(self.vocabulary), "files": [asdict(f) for f in files]}
        with system.open_output_stream(f"{path}/{MANIFEST}.new") as out:
            out.write(json.dumps(listed).encode())
        system.move(f"{path}/{MANIFEST}.new", f"{path}/{MANIFEST}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, path = store(self.folder)
        for message in messages:
            if message is not None and message.name:
                system.delete_file(f"{path}/{message.name}")


class Split(InputPartition):
    """Documents ``low`` to ``high`` of one file, which begins at id ``base`` of the whole."""

    def __init__(self, at: int, base: int, low: int, high: int):
        super().__init__((at, low))
        self.at, self.base, self.low, self.high = at, base, low, high


class PackedReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        known = PackedFolder(self.folder)
        return [
            Split(at, int(known.first[at]), low, high)
            for at, file in enumerate(known.files)
            for low, high in zip([0, *file.cuts], [*file.cuts, file.documents]) if low < high
        ]

    def read(self, partition: Split | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a folder without documents
            return
        with PackedFolder(self.folder).open(partition.at) as file:
            n = partition.high - partition.low
            starts, doc_ids = file.starts(partition.low, n + 1), file.doc_ids(partition.low, n)
            low = 0
            while low < n:
                high = max(low + 1, int(np.searchsorted(starts, starts[low] + IDS_AT_ONCE, side="right")) - 1)
                high = min(high, n)
                ids = file.slice(int(starts[low]), int(starts[high] - starts[low])).astype("<u4")
                at = (starts[low : high + 1] - starts[low]) * 4
                binary = pa.Array.from_buffers(
                    pa.binary(), high - low, [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())]
                )
                yield pa.RecordBatch.from_pydict({
                    "doc_id": doc_ids.slice(low, high - low), "start": partition.base + starts[low:high], "ids": binary,
                })
                low = high


class PackedIds(DataSource):
    """Token ids at a fixed number of bits. Options: path, and for writing ``vocabulary``, the number of ids."""

    @classmethod
    def name(cls) -> str:
        return "packed_ids"

    def schema(self) -> str:
        return "doc_id long, start long, ids binary"

    def reader(self, schema) -> PackedReader:
        return PackedReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> PackedWriter:
        return PackedWriter(self.options["path"], int(self.options["vocabulary"]))


def register(spark: SparkSession) -> None:
    """Makes the format known to a session under ``packed_ids``."""
    spark.dataSource.register(PackedIds)
