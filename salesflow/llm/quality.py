"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Terms are one and two consecutive words, lower-cased, and one and two consecutive word shapes (the
kinds of characters in a word with runs of one kind taken once, so that shouted or symbol-ridden
words meet in one term). A five-word sequence that the same text holds more than once counts as a
term of its own. A text's value for a term is its count over the square root of its number of terms,
and its score is the sigmoid of one sparse dot product.

Defined cases: null and empty texts have no terms and score the model's intercept; a null doc_id is
scored with held_out null; a label that is null or not 0 or 1 is not learnt from; with no labelled
rows every text scores 0.5. Every row gets a row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from salesflow.llm.learn import BITS, MAX_ROWS, fit, labelled, scored, sigmoid
from salesflow.llm.tokens import SPACED, Slice, grams, mix, prefix_sums, span_hash, words

CUT = 0.3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.3, 1.0
PASSES = 4

_KIND = np.arange(256, dtype=np.uint8)
_KIND[97:123] = _KIND[128:] = ord("a")
_KIND[65:91] = ord("A")
_KIND[48:58] = ord("0")
_MASK = np.uint64((1 << BITS) - 1)


def terms(piece: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Text index and bin of every term of a slice."""
    found = words(piece, SPACED)
    n = len(found.hash)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kinds = _KIND[piece.data]
    keep = np.ones(len(kinds), bool)
    keep[1:] = kinds[1:] != kinds[:-1]
    keep[found.start] = True
    upto = np.concatenate([[0], np.cumsum(keep)])
    shape = span_hash(prefix_sums(kinds[keep]), upto[found.start], upto[found.end])
    same = found.text[1:] == found.text[:-1]
    text, value = [found.text, found.text], [found.hash, mix(shape + np.uint64(3))]
    for salt, source in ((5, found.hash), (7, shape)):
        text.append(found.text[:-1][same])
        value.append(mix(grams(source, 2)[same] + np.uint64(salt)))
    long = grams(found.hash, 5)
    if len(long):
        where = found.text[: len(long)]
        inside = where == found.text[4:]
        packed = np.sort((where[inside].astype(np.uint64) << np.uint64(48)) | (long[inside] >> np.uint64(16)))
        again = packed[1:][packed[1:] == packed[:-1]] >> np.uint64(48)
        text.append(again.astype(np.int64))
        value.append(np.full(len(again), np.uint64(11)))
    return np.concatenate(text), (mix(np.concatenate(value)) & _MASK).astype(np.int64)


def follow_the_leader(y: np.ndarray, bins: list[np.ndarray], counts: list[np.ndarray]) -> bytes:
    """Per-coordinate FTRL: each row updates z and n of its terms; weights follow in closed form."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    rows = [(np.append(b, size - 1), np.append(c / np.sqrt(max(c.sum(), 1)), 1.0)) for b, c in zip(bins, counts)]

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zi = z[at]
        over = np.sign(zi) * L1 - zi
        return np.where(np.abs(zi) <= L1, 0.0, over / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(PASSES):
        for label, (at, x) in zip(y, rows):
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return weights(slice(None)).astype(np.float32).tobytes()


def score_quality(
    documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, cut: float = CUT, keep: list[str] | None = None
) -> DataFrame:
    """Every row with held_out, score (0 to 1) and predicted."""
    model = fit(labelled(documents, labels, "quality", max_rows), terms, follow_the_leader)
    sent = documents.sparkSession.sparkContext.broadcast(np.frombuffer(model, np.float32) if model else None)

    def score(piece: Slice) -> np.ndarray:
        weight = sent.value
        text, bin_ = terms(piece)
        total = np.bincount(text, weights=weight[bin_], minlength=piece.n)
        return sigmoid(weight[-1] + total / np.sqrt(np.maximum(np.bincount(text, minlength=piece.n), 1)))

    return scored(documents, keep or ["doc_id"], score, cut)


