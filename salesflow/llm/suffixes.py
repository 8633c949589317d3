"""Suffix arrays of one shard's text in memory: induced sorting over bytes, doubling over wide alphabets."""

from __future__ import annotations

import numpy as np

from salesflow.llm.tokens import prefix_sums, span_hash


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling: each round sorts (rank, rank further on, place) packed in one word."""
    n = len(text)
    bits = max(1, int(n).bit_length())
    rank = np.unique(text, return_inverse=True)[1].astype(np.uint64)
    far, place = 1, np.arange(n, dtype=np.uint64)
    mask = np.uint64((1 << bits) - 1)
    order = np.argsort(rank, kind="stable")
    while True:
        ahead = np.zeros(n, np.uint64)
        ahead[: max(0, n - far)] = rank[far:] + np.uint64(1)
        if 3 * bits + 1 <= 64:
            packed = np.sort((rank << np.uint64(2 * bits + 1)) | (ahead << np.uint64(bits)) | place)
            order = (packed & mask).astype(np.int64)
            new = np.concatenate([[0], np.cumsum(packed[1:] >> np.uint64(bits) != packed[:-1] >> np.uint64(bits))])
        else:
            order = np.lexsort((ahead, rank))
            a, b = rank[order], ahead[order]
            new = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
        rank = np.empty(n, np.uint64)
        rank[order] = new.astype(np.uint64)
        far *= 2
        if int(new[-1]) == n - 1 or far >= n:
            return order


class Buckets:
    """The suffix array under construction: one stretch per first byte, filled from either end."""

    def __init__(self, text: np.ndarray) -> None:
        self.text = text
        counts = np.bincount(text, minlength=256)
        self.end = np.cumsum(counts)
        self.start = self.end - counts
        self.smaller = smaller_than_next(text)
        self.array = np.empty(len(text), np.int64)

    def put(self, at: np.ndarray, cursor: np.ndarray, down: bool) -> None:
        """Appends suffixes, in their order, to their buckets: upwards from the head or down from the tail."""
        first = self.text[at]
        order = np.argsort(first, kind="stable")
        ranked = first[order]
        counts = np.bincount(ranked, minlength=256)
        nth = np.arange(len(at)) - (np.cumsum(counts) - counts)[ranked]
        if down:
            self.array[cursor[ranked] - 1 - nth] = at[order]
            cursor -= counts
        else:
            self.array[cursor[ranked] + nth] = at[order]
            cursor += counts

    def induce(self, minima: np.ndarray) -> np.ndarray:
        """The suffix array that follows from the leftmost-smaller suffixes in the given order.

        Each bucket is worked off in waves: what stands in it induces the suffixes one place
        before, and those of the same first byte form the next wave.
        """
        text, larger = self.text, ~self.smaller
        first = text[minima]
        by_byte = np.argsort(first, kind="stable")
        edges = np.searchsorted(first[by_byte], np.arange(257))
        head = self.start.copy()
        for byte in range(256):
            seen = int(self.start[byte])
            if self.start[byte] == self.end[byte]:
                continue
            while seen < head[byte]:
                wave = self.array[seen : head[byte]]
                seen = int(head[byte])
                before = wave[wave > 0] - 1
                self.put(before[larger[before]], head, down=False)
            seeds = minima[by_byte[edges[byte] : edges[byte + 1]]]
            before = seeds[seeds > 0] - 1
            self.put(before[larger[before]], head, down=False)
        tail = self.end.copy()
        for byte in range(255, -1, -1):
            seen = int(self.end[byte])
            if self.start[byte] == self.end[byte]:
                continue
            while seen > tail[byte]:
                wave = self.array[tail[byte] : seen][::-1]
                seen = int(tail[byte])
                before = wave[wave > 0] - 1
                self.put(before[~larger[before]], tail, down=True)
            rest = self.array[self.start[byte] : head[byte]][::-1]
            before = rest[rest > 0] - 1
            self.put(before[~larger[before]], tail, down=True)
        # a leftmost-smaller suffix that nothing induces: the last one
        return self.array


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last counts as smaller."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    up = text[change] < text[change + 1]
    run = np.searchsorted(change, np.arange(n))
    return np.append(up, True)[run]


def induced_suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array of bytes whose last one is the only 0."""
    work = Buckets(text)
    s = work.smaller
    minima = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    if len(minima) < 2:
        return suffix_array(text)
    sorted_once = seeded(work, minima)
    place = np.full(len(text), -1, np.int64)
    place[minima] = np.arange(len(minima))
    which = place[sorted_once]
    which = which[which >= 0]  # leftmost-smaller substrings in order
    sums = prefix_sums(text)
    ends = np.append(minima[1:] + 1, len(text))
    value = span_hash(sums, minima, ends)
    length = ends - minima
    new = np.ones(len(which), bool)
    new[1:] = (value[which[1:]] != value[which[:-1]]) | (length[which[1:]] != length[which[:-1]])
    name = np.empty(len(which), np.int64)
    name[which] = np.cumsum(new) - 1
    order = which if new.all() else suffix_array(name)
    return seeded(Buckets(text), minima[order]).copy()


def seeded(work: Buckets, minima: np.ndarray) -> np.ndarray:
    """Induces from the seeds; the sentinel suffix, first of all, is put in its place by hand."""
    array = work.induce(minima)
    array[0] = len(work.text) - 1
    return array


def common_prefix_reaches(text: np.ndarray, array: np.ndarray, length: int, valid: np.ndarray) -> np.ndarray:
    """For each place, whether its permuted common prefix, with the suffix before it or after it in
    order, is ``length`` or longer. Only ``valid`` places are compared; eight bytes a step."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    eight = np.zeros(n, np.uint64)
    for i in range(8):
        eight |= padded[i : i + n] << np.uint64(8 * i)
    right, left = array[1:], array[:-1]
    both = valid[right] & valid[left]
    right, left = right[both], left[both]
    steps = [*range(0, length - 7, 8)]
    if length % 8:
        steps.append(length - 8)
    for at in steps:
        same = eight[right + at] == eight[left + at]
        right, left = right[same], left[same]
    out = np.zeros(n, bool)
    out[right] = out[left] = True
    return out
