"""Words and their hashes straight from Arrow text buffers, whole columns at a time.

A text column arrives as one byte buffer with offsets. Words are byte runs under a 256-entry
class, which equals the contracts' character classes because every byte of a non-ASCII
character is 0x80 or above. A null text has no bytes and so no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.random.default_rng(20).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BYTE = np.random.default_rng(21).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
AS_IS = np.arange(256, dtype=np.uint8)

#: Words of `[^\x20\x09-\x0D]+`.
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False

#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, taken after lower-casing.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1024)
        inverse = pow(int(_ODD), -1, 1 << 64)
        up, down = np.full(size, _ODD), np.full(size, np.uint64(inverse))
        up[0] = down[0] = 1
        table = {"up": np.multiply.accumulate(up), "down": np.multiply.accumulate(down)}
        if n > SLICE_BYTES + 1024:  # a document longer than a slice: not kept
            return table["up"][:n], table["down"][:n]
        _powers.update(table)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of the bytes; ``span_hash`` reads any span's hash from two."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data))[0], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start])


@dataclass
class Slice:
    """Some consecutive texts of a batch: bytes, offsets (one more than texts), first row."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at.astype(np.int64)


def slices(column: pa.Array | pa.ChunkedArray, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The column cut between texts into slices of about ``size`` bytes; a longer text is one slice."""
    raw, at = buffers(column)
    row, n = 0, len(at) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, side="right")) - 1)
        end = min(end, n, row + 2048)
        yield Slice(raw[at[row] : at[end]], at[row : end + 1] - at[row], row)
        row = end


@dataclass
class Words:
    """Words in order: byte start and end, text index within the slice, and 64-bit hash."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray

    def per_text(self, n: int) -> np.ndarray:
        return np.bincount(self.text, minlength=n).astype(np.int64)


def words(piece: Slice, letters: np.ndarray, fold: np.ndarray = LOWER) -> Words:
    """The words of a slice under a byte class, after folding bytes."""
    data = fold[piece.data]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64))
    inside = letters[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = piece.offsets[:-1]
    edges = edges[edges < n]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(piece.offsets, start, side="right") - 1
    return Words(start, end, text, span_hash(prefix_sums(data), start, end))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive words, starting at each place that has k words from it."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * _GRAM[0]
    for i in range(1, k):
        total = total + hashes[i : i + n] * _GRAM[i]
    return mix(total + np.uint64(k))


def shingles(found: Words, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the hashes of its k-word shingles, repeats included; a text of fewer words, but
    some, has the whole sequence as one. Returns text index and hash."""
    full = grams(found.hash, k)
    if len(full):
        inside = found.text[: len(full)] == found.text[k - 1 :]
        where, value = found.text[: len(full)][inside], full[inside]
    else:
        where, value = np.zeros(0, np.int64), full
    counts = found.per_text(n)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        begin = np.searchsorted(found.text, short)
        total = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            more = counts[short] > i
            total[more] += found.hash[begin[more] + i] * _GRAM[i]
        where = np.concatenate([where, short])
        value = np.concatenate([value, mix(total + counts[short].astype(np.uint64))])
    return where, value
