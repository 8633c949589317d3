"""The numpy kernels against plain Python."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from salesflow.llm.decontaminate import FmIndex
from salesflow.llm.frames import components
from salesflow.llm.suffixes import common_prefix_reaches, induced_suffix_array, suffix_array
from salesflow.llm.tokens import ALNUM, AS_IS, LOWER, SPACED, slices, words
from tests.llm import brute
from tests.llm.conftest import ODD_TEXTS


@pytest.mark.parametrize("letters, fold, pattern", [(SPACED, LOWER, brute.SPACED), (ALNUM, LOWER, brute.ALNUM), (SPACED, AS_IS, brute.SPACED)])
@pytest.mark.parametrize("size", [7, 1 << 20])
def test_words(letters, fold, pattern, size):
    found, by_hash = [], defaultdict(set)
    column = pa.array(["left out", *ODD_TEXTS * 3], pa.string()).slice(1)
    for piece in slices(column, size):
        got = words(piece, letters, fold)
        for a, b, t, h in zip(got.start, got.end, got.text, got.hash):
            word = bytes(fold[piece.data[a:b]]).decode()
            found.append((piece.first + int(t), word))
            by_hash[int(h)].add(word)
    plain = brute.fold if fold is LOWER else (lambda t: t or "")
    assert found == [(i, w) for i, t in enumerate(ODD_TEXTS * 3) for w in pattern.findall(plain(t))]
    assert all(len(w) == 1 for w in by_hash.values()) and len(by_hash) == len({w for _, w in found})


@pytest.mark.parametrize("seed", range(40))
def test_suffix_arrays(seed):
    r = random.Random(seed)
    text = [r.randrange(1, 2 + seed % 5) for _ in range(r.randrange(1, 150))]
    text = np.array(text * (1 + seed % 3) + [0], np.uint8)
    plain = sorted(range(len(text)), key=lambda i: bytes(text[i:]))
    assert induced_suffix_array(text).tolist() == plain == suffix_array(text).tolist()
    length = 8 + seed % 7
    valid = np.arange(len(text)) + length < len(text)
    reaches = common_prefix_reaches(text, np.array(plain), length, valid)
    met = Counter(bytes(text[i : i + length]) for i in range(len(text)) if valid[i])
    assert reaches.tolist() == [bool(valid[i]) and met[bytes(text[i : i + length])] > 1 for i in range(len(text))]


@pytest.mark.parametrize("seed", range(10))
def test_backward_search_and_location(seed):
    r = np.random.default_rng(seed)
    text = np.append(r.integers(1, 4, 300), 0)
    index = FmIndex(text, 3)
    phrases = [tuple(r.integers(1, 4, n)) for n in (1, 2, 3, 5) for _ in range(4)]
    table = np.zeros((len(phrases), 5), np.int64)
    for i, p in enumerate(phrases):
        table[i, 5 - len(p) :] = p
    low, high = index.search(table, np.array([len(p) for p in phrases]))
    for p, a, b in zip(phrases, low, high):
        plain = [i for i in range(len(text)) if tuple(text[i : i + len(p)]) == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == plain


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    got = {x["node"]: x["comp"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute.roots({x for e in edges for x in e}, edges)
    met = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {n: want[n] for n in met}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
