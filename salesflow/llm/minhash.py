"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates.

Each document's distinct shingle hashes are sorted; their top bits are the bin, so the first hash of
each bin is that bin's minimum. Empty bins are filled by optimal densification: every bin has its
own fixed random order of the other bins and copies the first one that is not empty. Bands of six
bins are hashed to bucket keys; at similarity 0.8 a pair misses all 42 bands with probability 3e-6.

Documents with equal shingle sets are one class and go on as one representative. In every bucket a
star is drawn from a hub to the members, never all pairs: the hub is the member that meets the most
others. Members that are clearly unlike their hub go no further: two bits a bin differ in 38 of 256
bins on average at similarity 0.8, and more than 70 (over five deviations) rule a pair out. All others are confirmed
on the full sets.

A link between two members that are both unlike the hub would be missed by the stars. Where a bucket
still holds members of different components, those that were no hub are compared among themselves
in blocks inside the tasks, first by the two bits, then, where any may be alike, on the full sets;
only the links found become rows. Groups that the stars have joined need none of this.

Defined cases: a null or empty text, or one without words, has 0 shingles, links with nothing and is
kept. A text of one to k - 1 words has its whole word sequence as its one shingle. Rows that share a
doc_id are one document, linked by any of its texts; each of its rows is returned with its own count.
A null doc_id takes part in no link: its component_id is null and kept is true.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.frames import batches_of, components, give_back, map_batches, spanning
from salesflow.llm.tokens import SPACED, Slice, mix, shingles, slices, words
from salesflow.session import staged

SHINGLE = 5
SHARE = 80
BINS = 256
ROWS = 6
BANDS = BINS // ROWS
SKETCH_BINS = 256
FURTHEST = 70  # of SKETCH_BINS two-bit values; 38 differ on average at similarity 0.8
LEAST_SKETCHED = 16
BLOCK = 256
PAIRS_A_BATCH = 512
SETS_A_BATCH = 64
TRIPLES = 1 << 20
ODD_BITS = np.uint64(0x5555555555555555)
HASH_BITS = 52
_ORDERS = np.argsort(np.random.default_rng(5).random((BINS, BINS)), axis=1)


def sorted_sets(piece: Slice, k: int) -> np.ndarray:
    """The distinct shingles of each text as sorted words: text index above HASH_BITS bits of hash."""
    where, value = shingles(words(piece, SPACED), piece.n, k)
    packed = np.sort((where.astype(np.uint64) << np.uint64(HASH_BITS)) | (value >> np.uint64(64 - HASH_BITS)))
    return packed[np.concatenate([[True], packed[1:] != packed[:-1]])] if len(packed) else packed


def signatures(sets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts that have shingles, and their densified one-permutation signatures."""
    bits = HASH_BITS - BINS.bit_length() + 1
    cell = sets >> np.uint64(bits)  # text and bin
    lead = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
    text, bin_ = (cell[lead] // np.uint64(BINS)).astype(np.int64), (cell[lead] % np.uint64(BINS)).astype(np.int64)
    have = np.unique(text)
    row = np.searchsorted(have, text)
    filled = np.zeros((len(have), BINS), bool)
    filled[row, bin_] = True
    sketch = np.zeros((len(have), BINS), np.uint64)
    sketch[row, bin_] = sets[lead] & np.uint64((1 << bits) - 1)
    out = sketch.copy()
    open_row, open_bin = np.nonzero(~filled)
    for step in range(BINS):
        if not len(open_row):
            break
        source = _ORDERS[open_bin, step]
        good = filled[open_row, source]
        out[open_row[good], open_bin[good]] = sketch[open_row[good], source[good]]
        open_row, open_bin = open_row[~good], open_bin[~good]
    return have, out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One bucket key a band, the band's number hashed in."""
    bands = sketch[:, : BANDS * ROWS].reshape(len(sketch), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), bands.shape[:2])
    for i in range(ROWS):
        key = mix(key ^ bands[:, :, i])
    return key.astype(np.int64)


def two_bits(sketch: np.ndarray) -> np.ndarray:
    """Two hashed bits of each of the first SKETCH_BINS bins, packed 32 bins to a word."""
    bits = (mix(sketch[:, :SKETCH_BINS]) >> np.uint64(62)).reshape(len(sketch), -1, 32)
    return (bits << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=2, dtype=np.uint64).astype(np.int64)


def features(documents: DataFrame, k: int) -> DataFrame:
    """Per document: the text's hash, the set's size, a 128-bit digest of the set and its band keys."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        size, one, two = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        keys, bits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        lengths = np.zeros(n, np.int64)
        for piece in slices(batch.column("text")):
            sets = sorted_sets(piece, k)
            text = (sets >> np.uint64(HASH_BITS)).astype(np.int64)
            value = mix(sets & np.uint64((1 << HASH_BITS) - 1))
            have, sketch = signatures(sets, piece.n)
            at = slice(piece.first, piece.first + piece.n)
            size[at] = np.bincount(text, minlength=piece.n)
            if len(have):
                begin = np.searchsorted(text, have)
                one[piece.first + have] = np.add.reduceat(value, begin)
                two[piece.first + have] = np.add.reduceat(mix(value + np.uint64(77)), begin)
                lengths[piece.first + have] = 1
                keys.append(band_keys(sketch).ravel())
                bits.append(two_bits(sketch).ravel())
        at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "tag": batch.column("tag"), "n_shingles": size, "one": one.astype(np.int64), "two": two.astype(np.int64),
            "bands": pa.ListArray.from_arrays(pa.array(at * np.int32(BANDS)), pa.array(np.concatenate(keys))),
            "bits": pa.ListArray.from_arrays(pa.array(at * np.int32(SKETCH_BINS // 32)), pa.array(np.concatenate(bits))),
        })

    return map_batches(
        documents, run,
        "doc_id long, tag long, n_shingles long, one long, two long, bands array<long>, bits array<long>",
    )


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, share: int) -> DataFrame:
    """The candidate pairs (hub, rep) whose full sets agree enough."""
    right = texts.select(F.col("doc_id").alias("rep"), "tag", F.col("text").alias("right"))
    left = texts.select(F.col("doc_id").alias("hub"), F.col("tag").alias("hub_tag"), F.col("text").alias("left"))
    sides = pairs.join(right, ["rep", "tag"]).join(left, ["hub", "hub_tag"])

    def sets(column: pa.Array, row: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        parts = [(p.first, sorted_sets(p, k)) for p in slices(column)]
        text = [(s >> np.uint64(HASH_BITS)).astype(np.int64) + first for first, s in parts]
        value = [s & np.uint64((1 << HASH_BITS) - 1) for _, s in parts]
        return np.concatenate([np.zeros(0, np.int64), *text]), np.concatenate([np.zeros(0, np.uint64), *value])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        good = []
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            n = part.num_rows
            lt, lv = sets(part.column("left"), lo, n)
            rt, rv = sets(part.column("right"), lo, n)
            both = np.sort(np.concatenate([(lt.astype(np.uint64) << np.uint64(HASH_BITS)) | lv, (rt.astype(np.uint64) << np.uint64(HASH_BITS)) | rv]))
            shared = both[1:][both[1:] == both[:-1]]
            meet = np.bincount((shared >> np.uint64(HASH_BITS)).astype(np.int64), minlength=n)
            union = np.bincount(lt, minlength=n) + np.bincount(rt, minlength=n) - meet
            good.append((100 * meet >= share * union) & (union > 0))
        return batch.select(["hub", "rep"]).filter(pa.array(np.concatenate(good)))

    return map_batches(sides.select("hub", "rep", "left", "right"), run, "hub long, rep long")


def near_duplicates(documents: DataFrame, k: int = SHINGLE, share: int = SHARE) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept."""
    # the tag tells apart the texts that a doc_id may stand for
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), "text")
    found = staged(features(docs, k), "shingles")
    known = found.where("doc_id IS NOT NULL AND n_shingles > 0")
    # written first: a join of two plain shuffles can have a large group's partition split
    classes = staged(known.groupBy("one", "two").agg(F.min("doc_id").alias("rep")), "classes")
    members = known.join(classes, ["one", "two"])
    same = members.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    same = staged(same, "copies")

    own = members.where("doc_id = rep")
    entries = own.select("rep", "tag", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    crowded = entries.groupBy("key").agg(F.count("*").alias("met"), F.min("rep").alias("low"), F.max("rep").alias("high"))
    crowded = staged(crowded.where("low <> high").select("key", "met"), "crowded")
    buckets = staged(entries.join(crowded, "key").distinct(), "buckets")
    degree = buckets.groupBy("rep", "tag").agg(F.sum("met").alias("degree"))
    sketches = own.groupBy("rep", "tag").agg(F.first("bits").alias("bits")).join(degree, ["rep", "tag"])
    texts = staged(docs.join(degree.select(F.col("rep").alias("doc_id"), "tag"), ["doc_id", "tag"]), "candidates")
    texts = staged(texts.dropDuplicates(["doc_id", "tag"]), "candidate-texts")  # rows may repeat
    # a hub is the smallest of these: most met, then smallest id
    ranked = staged(
        buckets.join(sketches, ["rep", "tag"]).select("key", "rep", "tag", "n", F.struct((-F.col("degree")).alias("less"), "rep", "tag").alias("first"), "bits"),
        "ranked",
    )

    heads = staged(ranked.groupBy("key").agg(F.min("first").alias("first")), "hubs").select("key", "first.rep", "first.tag")
    with batches_of(docs.sparkSession, PAIRS_A_BATCH):  # two whole texts a row
        links = staged(stars(ranked, heads, texts, k, share), "links")
    comp = staged(components(same.union(links)), "components")
    # hubs have met their whole bucket: only pairs among the others are untried
    left = ranked.join(heads, ["key", "rep", "tag"], "left_anti").join(comp, F.col("rep") == F.col("node"), "left")
    left = staged(left.select("key", "rep", "tag", "n", "bits", F.coalesce("comp", "rep").alias("comp")), "left")
    untried = in_blocks(left)
    likely = untried.mapInArrow(comparing(share, None), "key long, rep long, tag long").distinct()
    likely = staged(likely, "likely")
    sets = texts.join(likely.select(F.col("rep").alias("doc_id"), "tag").distinct(), ["doc_id", "tag"])
    sets = staged(map_batches(sets, set_rows(k), "rep long, tag long, members array<long>"), "sets")
    again = in_blocks(left.join(likely, ["key", "rep", "tag"]), sets)
    with batches_of(docs.sparkSession, SETS_A_BATCH):  # a whole set a row
        new = staged(again.mapInArrow(comparing(share, meeting), "a long, b long").distinct(), "late-links")
    comp = components(comp.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(new))
    return labelled(found, comp)


def stars(ranked: DataFrame, heads: DataFrame, texts: DataFrame, k: int, share: int) -> DataFrame:
    """The confirmed links (a, b) between each bucket's hub and its members."""
    own = ranked.join(heads, ["key", "rep", "tag"], "left_semi").select(
        F.col("key").alias("hub_key"), F.col("rep").alias("hub"), F.col("tag").alias("hub_tag"), F.col("n").alias("hub_n"), F.col("bits").alias("hub_bits")
    )
    differ = sum(
        F.bit_count(F.expr(f"(bits[{i}] ^ hub_bits[{i}] | shiftrightunsigned(bits[{i}] ^ hub_bits[{i}], 1)) & {int(ODD_BITS)}L"))
        for i in range(SKETCH_BINS // 32)
    )
    alike = (F.least("n", "hub_n") < LEAST_SKETCHED) | (differ <= FURTHEST)
    sizes = 100 * F.least("n", "hub_n") >= share * F.greatest("n", "hub_n")
    pairs = ranked.join(own, (F.col("key") == F.col("hub_key")) & (F.col("rep") != F.col("hub")) & sizes & alike)
    # a pair that meets with either as the hub is one
    hub, rep = F.struct(F.col("hub").alias("id"), F.col("hub_tag").alias("tag")), F.struct(F.col("rep").alias("id"), "tag")
    pairs = pairs.select(F.least(hub, rep).alias("low"), F.greatest(hub, rep).alias("high")).select(
        F.col("low.id").alias("hub"), F.col("low.tag").alias("hub_tag"), F.col("high.id").alias("rep"), F.col("high.tag").alias("tag")
    )
    return confirmed(pairs.distinct(), texts, k, share).select(F.col("rep").alias("a"), F.col("hub").alias("b"))


def in_blocks(entries: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Buckets with members of different components, dealt to tasks in blocks and in order.

    Members of a bucket's largest component need not meet each other. The r others have r / BLOCK
    blocks by a hash of the member; a block's owners come first, then as guests the members of the
    later blocks and of the largest component. So every pair that may be new meets in one block, no
    pair is a row, and a block's owners are all that a task holds.
    """
    sizes = entries.groupBy("key", "comp").agg(F.count("*").alias("m"))
    open_ = sizes.groupBy("key").agg(F.max(F.struct("m", "comp")).alias("main"), F.sum("m").alias("all")).where("all > main.m")
    open_ = open_.select("key", F.col("main.comp").alias("main"), F.ceil((F.col("all") - F.col("main.m")) / BLOCK).cast("int").alias("blocks"))
    rows = entries.join(open_, "key")
    own = F.when(F.col("comp") == F.col("main"), F.col("blocks")).otherwise(F.pmod(F.xxhash64("rep", "tag"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("own", own).withColumn("block", F.explode(F.sequence(F.lit(0), F.least("own", F.col("blocks") - 1))))
    rows = rows.withColumn("guest", F.col("own") != F.col("block")).drop("own", "blocks", "main")
    if extra is not None:
        rows = rows.join(extra, ["rep", "tag"])
    return rows.repartition("key", "block").sortWithinPartitions("key", "block", "guest", "rep", "tag")


def comparing(share: int, meet):
    """A task over blocks in order: compares owners with each other and with the guests.

    Pairs within one component, of too different sizes or too far apart by their two bits are out
    first. With ``meet``, which counts the shingles that given pairs share, the others are decided
    and spanning links returned; without, the members of any such pair.
    """

    def told(key: int, left: pa.RecordBatch, i: np.ndarray, right: pa.RecordBatch, j: np.ndarray) -> pa.RecordBatch:
        if meet is not None:
            a, b = spanning(left.column("rep").to_numpy()[i], right.column("rep").to_numpy()[j])
            return pa.RecordBatch.from_pydict({"a": a[a != b], "b": b[a != b]})
        both = pa.Table.from_batches([x.select(["key", "rep", "tag"]).take(pa.array(np.unique(at))) for x, at in ((left, i), (right, j))])
        return both.combine_chunks().to_batches()[0]

    def pairs(key: int, left: pa.RecordBatch, right: pa.RecordBatch, same: bool) -> Iterator[pa.RecordBatch]:
        good = left.column("comp").to_numpy()[:, None] != right.column("comp").to_numpy()[None, :]
        if same:
            good &= np.tri(len(good), k=-1, dtype=bool)
        if good.any():
            good &= alike_bits(left, right, share)
            if meet is not None and good.any():
                good &= alike_sets(left, right, good, meet, share)
            i, j = np.nonzero(good)
            if len(i):
                yield told(key, left, i, right, j)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, owners, met = None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            key, block, guest = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "block", "guest"))
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1]) | (guest[1:] != guest[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                here = (int(key[lo]), int(block[lo]))
                part = batch.slice(lo, hi - lo)
                if not guest[lo]:
                    if here != place and not met:
                        yield from pairs(place[0], owners, owners, True)
                    owners = pa.Table.from_batches([owners, part]).combine_chunks().to_batches()[0] if here == place else part
                    place, met = here, False
                    continue
                if here != place:
                    continue  # a block without owners
                if not met:
                    yield from pairs(place[0], owners, owners, True)
                    met = True
                for at in range(0, part.num_rows, BLOCK):
                    yield from pairs(place[0], owners, part.slice(at, BLOCK), False)
        if place is not None and not met:
            yield from pairs(place[0], owners, owners, True)
        give_back()

    return run


def near_sizes(left: pa.RecordBatch, right: pa.RecordBatch, share: int) -> tuple[np.ndarray, np.ndarray]:
    """The smaller size of each pair, and whether the sizes allow the share."""
    n, m = left.column("n").to_numpy()[:, None], right.column("n").to_numpy()[None, :]
    return np.minimum(n, m), 100 * np.minimum(n, m) >= share * np.maximum(n, m)


def alike_bits(left: pa.RecordBatch, right: pa.RecordBatch, share: int) -> np.ndarray:
    """Which pairs' sizes and two bits allow the share."""
    least, good = near_sizes(left, right, share)
    a, b = (x.column("bits").flatten().to_numpy().view(np.uint64).reshape(x.num_rows, -1) for x in (left, right))
    differ = np.zeros(good.shape, np.int32)
    for w in range(a.shape[1]):
        x = a[:, w][:, None] ^ b[:, w][None, :]
        differ += np.bitwise_count((x | (x >> np.uint64(1))) & ODD_BITS)
    return good & ((least < LEAST_SKETCHED) | (differ <= FURTHEST))


def alike_sets(left: pa.RecordBatch, right: pa.RecordBatch, good: np.ndarray, meet, share: int) -> np.ndarray:
    """Which of the pairs that are still good share enough shingles; others count as unlike."""
    i, j = np.flatnonzero(good.any(axis=1)), np.flatnonzero(good.any(axis=0))
    n, m = left.column("n").to_numpy()[i], right.column("n").to_numpy()[j]
    shared = meet(left.column("members").take(pa.array(i)), right.column("members").take(pa.array(j)))
    out = np.zeros(good.shape, bool)
    out[np.ix_(i, j)] = 100 * shared >= share * (n[:, None] + m[None, :] - shared)
    return out


def meeting(left: pa.ListArray, right: pa.ListArray) -> np.ndarray:
    """How many shingles each set on the left shares with each on the right.

    The right sets' shingles are looked up among the left's in portions, so that what is held at a
    time is bounded by TRIPLES however long the texts are.
    """
    (a, n), (b, m) = ((x.flatten().to_numpy(), np.diff(x.offsets.to_numpy())) for x in (left, right))
    owner, guest = np.repeat(np.arange(len(n), dtype=np.int32), n), np.repeat(np.arange(len(m), dtype=np.int32), m)
    order = np.argsort(a, kind="stable")
    a, owner = a[order], owner[order]
    shared = np.zeros(len(n) * len(m), np.int64)
    step = max(1, TRIPLES // len(n))
    for lo in range(0, len(b), step):
        part = b[lo : lo + step]
        low = np.searchsorted(a, part, "left")
        count = np.searchsorted(a, part, "right") - low
        at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        shared += np.bincount(owner[at].astype(np.int64) * len(m) + np.repeat(guest[lo : lo + step], count), minlength=len(shared))
    return shared.reshape(len(n), len(m))


def set_rows(k: int):
    """Each text's distinct shingle hashes as one list."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, values = [np.zeros(1, np.int32)], [np.zeros(0, np.int64)]
        total = 0
        for piece in slices(batch.column("text")):
            sets = sorted_sets(piece, k)
            ends = np.searchsorted(sets >> np.uint64(HASH_BITS), np.arange(1, piece.n + 1, dtype=np.uint64))
            at.append((total + ends).astype(np.int32))
            values.append((sets & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64))
            total += len(sets)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(at)), pa.array(np.concatenate(values)))
        return pa.RecordBatch.from_pydict({"rep": batch.column("doc_id"), "tag": batch.column("tag"), "members": lists})

    return run


def labelled(found: DataFrame, comp: DataFrame) -> DataFrame:
    """The rows of the result, from the features and the components."""
    out = found.select("doc_id", "n_shingles").join(comp, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("comp", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def without_near_duplicates(documents: DataFrame, k: int = SHINGLE, share: int = SHARE) -> DataFrame:
    """The documents, all columns as they are, of which one of each group stays: the smallest doc_id.

    Rows that share a doc_id are one document and stay or go together.
    """
    gone = near_duplicates(documents, k, share).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone, documents["doc_id"] == gone["_gone"], "left_anti")
