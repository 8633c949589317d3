"""Benchmark decontamination by an FM-index over each training shard.

Every shard's words become ids of the benchmark's vocabulary. A word that no benchmark word pair
covers can stand in no window of two or more words, so such words are cut out (exactly: the test
only ever lets too much through) and the runs that stay are joined with separators. Over that text
a suffix array is sorted, its Burrows-Wheeler transform goes into a wavelet tree, all windows are
searched backwards at once through the tree's ranks, and hits are located from sampled suffix
positions by walking the last-to-first mapping. The located spans are merged per document.

The benchmark is dealt to blocks of a bounded number of text bytes. Only one block at a time is held,
by the driver and by the tasks: all documents are searched with it, what it hits is written down by
text, and it is let go before the next. So a larger benchmark means more passes, not more memory. A
benchmark of one block needs no such notes, and its hits are counted as they are found.

Defined cases: a null or empty text has no words, is never hit and lists no items; an item without
words has no windows; an item whose id is null marks words but is not listed; rows that share an
item_id are one item; every row of the documents gets a row, repeated rows alike.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.frames import map_batches
from salesflow.llm.suffixes import suffix_array
from salesflow.llm.tokens import ALNUM, Slice, Words, slices, words
from salesflow.session import new_folder, staged

WINDOW = 13
SHARE = 20
BLOCK_BYTES = 16 << 20
SAMPLE = 8
PAIR_BITS = 1 << 24
SCHEMA = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class Phrases:
    """One block of the benchmark: vocabulary, distinct windows with their items, and pair filter."""

    def __init__(self, rows: list[tuple[object, str | None]], window: int) -> None:
        texts = [(text or "").encode() for _, text in rows]
        offsets = np.cumsum([0, *map(len, texts)])
        piece = Slice(np.frombuffer(b"".join(texts), np.uint8), offsets, 0)
        found = words(piece, ALNUM)
        self.vocabulary = np.unique(found.hash)
        ids = np.searchsorted(self.vocabulary, found.hash) + 1
        names = [None if key is None else str(key) for key, _ in rows]
        self.names = sorted({x for x in names if x is not None})
        place = {x: i for i, x in enumerate(self.names)}
        windows: dict[tuple[int, ...], set[int]] = {}
        begins = np.searchsorted(found.text, np.arange(len(rows) + 1))
        for row, name in enumerate(names):
            line = ids[begins[row] : begins[row + 1]].tolist()
            if not line:
                continue
            for i in range(max(1, len(line) - window + 1)):
                windows.setdefault(tuple(line[i : i + window]), set()).update(() if name is None else (place[name],))
        order = sorted(windows)
        self.length = np.array([len(x) for x in order], np.int64)
        self.table = np.zeros((len(order), window), np.int64)
        for i, x in enumerate(order):
            self.table[i, window - len(x) :] = x
        self.item_start = np.cumsum([0, *(len(windows[x]) for x in order)])
        self.items = np.array([i for x in order for i in sorted(windows[x])], np.int64)
        self.pairs = np.zeros(PAIR_BITS // 8, np.uint8)
        self.alone = np.zeros(len(self.vocabulary) + 1, bool)
        for x in order:
            if len(x) == 1:
                self.alone[x[0]] = True
        inside = np.flatnonzero(found.text[1:] == found.text[:-1])
        at = self.pair_bit(ids[inside], ids[inside + 1])
        np.bitwise_or.at(self.pairs, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def pair_bit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left * 0x5851F42D + right * 0x27D4EB2F) % PAIR_BITS

    def may_touch(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        at = self.pair_bit(left, right)
        return (self.pairs[at >> 3] >> (at & 7) & 1).astype(bool) & (left > 0) & (right > 0)


class WaveletTree:
    """Ranks of any symbol in any prefix of a sequence, by one bit array a level."""

    def __init__(self, sequence: np.ndarray, top: int) -> None:
        self.levels = max(1, int(top).bit_length())
        self.zeros, self.ones = [], []
        now = sequence
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level) & 1
            ones = np.zeros(len(now) + 1, np.int64)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(now) - int(ones[-1]))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        low, high = np.zeros_like(at), at.copy()
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            one = (symbol >> level) & 1 == 1
            ones, zeros = self.ones[i], self.zeros[i]
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low


class FmIndex:
    """Backward search and location over a sequence whose last symbol is its only 0."""

    def __init__(self, text: np.ndarray, top: int) -> None:
        self.text = text
        order = suffix_array(text)
        self.bwt = text[order - 1]
        self.tree = WaveletTree(self.bwt, top)
        counts = np.bincount(text, minlength=top + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        kept = order % SAMPLE == 0
        self.kept_rank = np.concatenate([[0], np.cumsum(kept)])
        self.kept = kept
        self.samples = order[kept]

    def search(self, table: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase, right-aligned in the table, its interval of the suffix array."""
        low = np.zeros(len(table), np.int64)
        high = np.full(len(table), len(self.text), np.int64)
        width = table.shape[1]
        for back in range(width):
            live = np.flatnonzero((length > back) & (high > low))
            if not len(live):
                continue
            symbol = table[live, width - 1 - back]
            low[live] = self.first[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffix-array rows: walk back to a sampled one."""
        at, steps, place = rows.copy(), np.zeros_like(rows), np.empty_like(rows)
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.kept[at[open_]]
            ended = open_[done]
            place[ended] = self.samples[self.kept_rank[at[ended]]] + steps[ended]
            open_ = open_[~done]
            symbol = self.bwt[at[open_]]
            at[open_] = self.first[symbol] + self.tree.rank(symbol, at[open_])
            steps[open_] += 1
        return place


def occurrences(ids: np.ndarray, text: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Word places where windows start, and which window, over a shard's ids."""
    none = np.zeros(0, np.int64)
    if len(ids) == 0 or len(phrases.length) == 0:
        return none, none
    touch = phrases.may_touch(ids[:-1], ids[1:]) & (text[:-1] == text[1:])
    stay = phrases.alone[ids].copy()
    stay[:-1] |= touch
    stay[1:] |= touch
    where = np.flatnonzero(stay)
    if not len(where):
        return none, none
    joined = np.zeros(len(where), bool)
    joined[1:] = (where[1:] == where[:-1] + 1) & touch[where[:-1].clip(max=len(touch) - 1)] if len(touch) else False
    run = np.cumsum(~joined) - 1
    long_enough = np.bincount(run)[run] >= phrases.length.min()
    where, joined, run = where[long_enough], joined[long_enough], run[long_enough]
    if not len(where):
        return none, none
    run = np.cumsum(~joined)
    flat = np.ones(len(where) + int(run[-1]) + 1, np.int64)  # 1 separates the runs, 0 ends the text
    flat[-1] = 0
    back = np.full(len(flat), -1, np.int64)
    spot = np.arange(len(where)) + run
    flat[spot], back[spot] = ids[where] + 1, where
    index = FmIndex(flat, len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.table + 1, phrases.length)
    found = np.flatnonzero(high > low)
    sizes = (high - low)[found]
    which = np.repeat(found, sizes)
    rows = np.repeat(low[found] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    return back[index.locate(rows)], which


def blocks(benchmark: DataFrame, block_bytes: int) -> tuple[int, DataFrame]:
    """How many blocks of about ``block_bytes`` the distinct rows make, and these with their block,
    by a hash of item and text, stored apart."""
    rows = benchmark.select("item_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + int(total) // block_bytes
    rows = rows.distinct().withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int"))
    if n == 1:
        return n, rows
    path = new_folder(benchmark.sparkSession, "benchmark")
    rows.write.partitionBy("block").parquet(path)
    return n, benchmark.sparkSession.read.schema(rows.schema).parquet(path)


def sent_block(rows: DataFrame, block: int, window: int) -> Broadcast:
    """One block's windows, made ready on the driver and sent to the tasks; bounded by the block."""
    found = rows.where(F.col("block") == block).select("item_id", "text").collect()
    return rows.sparkSession.sparkContext.broadcast(Phrases([tuple(x) for x in found], window))


def searched(phrases: Phrases, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
    """Per text its number of words, the merged spans that a block hits, and the items it names."""
    n_words, cut, named = np.zeros(len(texts), np.int64), [], []
    for piece in slices(texts):
        found = words(piece, ALNUM)
        count = found.per_text(piece.n)
        n_words[piece.first : piece.first + piece.n] = count
        hit = np.zeros(len(found.hash) + 1, np.int64)
        names: list[set[str]] = [set() for _ in range(piece.n)]
        _search(phrases, found, hit, names)
        spans: list[list[tuple[int, int]]] = [[] for _ in range(piece.n)]
        for text, first, end in merged(np.cumsum(hit)[:-1] > 0, found.text, count):
            spans[text].append((first, end))
        cut += spans
        named += names
    return n_words, cut, named


def _search(phrases: Phrases, found: Words, hit: np.ndarray, named: list[set[str]]) -> None:
    if not len(phrases.vocabulary):
        return
    at = np.searchsorted(phrases.vocabulary, found.hash).clip(max=len(phrases.vocabulary) - 1)
    ids = np.where(phrases.vocabulary[at] == found.hash, at + 1, 0)
    start, which = occurrences(ids, found.text, phrases)
    np.add.at(hit, start, 1)
    np.add.at(hit, start + phrases.length[which], -1)
    sizes = np.diff(phrases.item_start)[which]
    place = np.repeat(phrases.item_start[which] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    pairs = np.unique(np.stack([np.repeat(found.text[start], sizes), phrases.items[place]]), axis=1)
    for text, item in pairs.T.tolist():
        named[text].add(phrases.names[item])


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges of several blocks as disjoint ones, in order."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def verdicts(n_words: np.ndarray, cut: list[list[tuple[int, int]]], named: list[set[str]], share: int, spans: bool) -> dict[str, object]:
    """The columns of the result, from what all blocks hit."""
    n_hit = np.array([sum(e - f for f, e in c) for c in cut], np.int64)
    out = {
        "n_words": n_words, "n_hit": n_hit, "n_items": np.array([len(x) for x in named], np.int64),
        "items_sha256": [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in named],
        "contaminated": (n_hit > 0) & (share * n_hit >= n_words),
    }
    if spans:
        listed = [[{"first": f, "end": e} for f, e in c] for c in cut]
        out["spans"] = pa.array(listed, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))
    return out


def notes(source: DataFrame, rows: DataFrame, n: int, window: int) -> DataFrame:
    """What each block hits, by text (``_body``): spans and items. Blocks are searched one after another."""

    def noting(sent: Broadcast):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            _, cut, named = searched(sent.value, batch.column("_text"))
            hit = [i for i, c in enumerate(cut) if c]
            return pa.RecordBatch.from_pydict({
                "_body": batch.column("_body").take(pa.array(hit, pa.int64())),
                "first": pa.array([[f for f, _ in cut[i]] for i in hit], pa.list_(pa.int64())),
                "end": pa.array([[e for _, e in cut[i]] for i in hit], pa.list_(pa.int64())),
                "items": pa.array([sorted(named[i]) for i in hit], pa.list_(pa.string())),
            })

        return run

    kept = []
    for block in range(n):
        sent = sent_block(rows, block, window)
        found = map_batches(source.select("_body", "_text"), noting(sent), "_body binary, first array<long>, end array<long>, items array<string>")
        # rows that repeat a text hit the same
        kept.append(staged(found.dropDuplicates(["_body"]), "hits"))
        sent.destroy()
    every = reduce(DataFrame.unionByName, kept)
    gathered = every.groupBy("_body").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("first", "end", "items")])
    return staged(gathered, "notes")


def merged(covered: np.ndarray, text: np.ndarray, count: np.ndarray) -> list[tuple[int, int, int]]:
    """The runs of covered words within each text: text, first word and exclusive end."""
    base = np.cumsum(count) - count
    at = np.flatnonzero(covered)
    if not len(at):
        return []
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]])])
    first, last = at[new], at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
    owner = text[first]
    return list(zip(owner.tolist(), (first - base[owner]).tolist(), (last - base[owner] + 1).tolist()))


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, block_bytes: int = BLOCK_BYTES,
    keep: list[str] | None = None, spans: bool = False,
) -> DataFrame:
    """Words hit by benchmark windows, per document row.

    Returns the columns ``keep`` (doc_id alone by default) with n_words, n_hit, n_items,
    items_sha256 and contaminated, true when something is hit and ``share`` * n_hit >= n_words.
    With ``spans`` also the merged removal spans, as word ranges with an exclusive end.
    """
    keep = keep or ["doc_id"]
    n, rows = blocks(benchmark, block_bytes)
    body = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    source = documents.select(F.struct(*keep).alias("_row"), F.col("text").alias("_text"), *([] if n == 1 else [body.alias("_body")]))
    kind = source.schema["_row"].dataType.simpleString()
    schema = f"_row {kind}, {SCHEMA}" + (", spans array<struct<first:long,end:long>>" if spans else "")
    if n == 1:
        sent = sent_block(rows, 0, window)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = searched(sent.value, batch.column("_text"))
            return pa.RecordBatch.from_pydict({"_row": batch.column("_row"), **verdicts(*found, share, spans)})

        out = map_batches(source, run, schema)
    else:
        told = source.join(notes(source, rows, n, window), "_body", "left").select("_row", "_text", "first", "end", "items")

        def gather(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_words = np.zeros(batch.num_rows, np.int64)
            for piece in slices(batch.column("_text")):
                n_words[piece.first : piece.first + piece.n] = words(piece, ALNUM).per_text(piece.n)
            first, end, items = (batch.column(c).to_pylist() for c in ("first", "end", "items"))
            cut = [united(list(zip(f or [], e or []))) for f, e in zip(first, end)]
            return pa.RecordBatch.from_pydict({"_row": batch.column("_row"), **verdicts(n_words, cut, [set(x or []) for x in items], share, spans)})

        out = map_batches(told, gather, schema)
    rest = [x.name for x in out.schema if x.name != "_row"]
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], *rest)


def without_contaminated(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, all columns as they are, that are not contaminated."""
    wrapped = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_kept"), "text")
    judged = decontaminate(wrapped, benchmark, block_bytes=block_bytes, keep=["_kept"])
    return judged.where("NOT contaminated").select("_kept.*")
