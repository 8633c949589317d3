"""Toxicity classifier: a factorization machine over hashed terms.

Every lower-cased word and its beginnings are hashed to bins. Of the bins met in the training sample
two kinds stay: those whose smoothed log-odds between toxic and clean documents lie at least Z
standard errors from 0, and, however neutral alone, those that tell together with another: among the
rows that hold the other, their log-odds lie PAIR_Z standard errors from 0. For the latter every pair
of bins that a SHARED part of the toxic rows hold is tried. The machine has a weight and a vector of
FACTORS numbers for each bin, and scores a text's set of bins by intercept, weights and all pairwise
products of vectors (by the usual square-of-sums identity), so that two terms together may count
more or less than each adds.

Defined cases: null and empty texts have no terms and score the intercept, the rate of toxic rows; a
null doc_id is scored with held_out null; a label that is null or not 0 or 1 is not learnt from; with
no labelled rows every text scores 0. Repeated words count once. Every row gets a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesflow.llm.frames import keep_rows
from salesflow.llm.learn import BITS, MAX_ROWS, counted, fit, labelled, scored, sigmoid
from salesflow.llm.tokens import ALNUM, LOWER, Slice, mix, prefix_sums, slices, span_hash, words

CUT = 0.5
PARTS = (4, 6, 8)
FACTORS = 4
Z = 3.0
LEAST = 3
SHARED, PAIR_Z, PAIR_ROWS = 0.05, 6.0, 1024
PASSES, BATCH, RATE, DECAY = 40, 64, 0.3, 2e-4


def terms(piece: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Text index and bin of every word of a slice, and of its beginnings of PARTS bytes."""
    found = words(piece, ALNUM)
    sums = prefix_sums(LOWER[piece.data])
    value = [mix(found.hash + np.uint64(13))]
    for n in PARTS:
        value.append(mix(span_hash(sums, found.start, np.minimum(found.end, found.start + n)) + np.uint64(17 + n)))
    return np.tile(found.text, len(value)), (np.concatenate(value) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def log_odds(a, b, c, d) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed log-odds of toxic with and without, against clean with and without; and its standard error."""
    a, b, c, d = (x + 0.5 for x in (a, b, c, d))
    return np.log(a * d / (b * c)), np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)


def chosen(y: np.ndarray, bins: list[np.ndarray]) -> np.ndarray:
    """The bins that tell toxic from clean rows, alone or together with another."""
    size, good = 1 << BITS, int(y.sum())
    everywhere = np.bincount(np.concatenate(bins), minlength=size) if len(bins) else np.zeros(size, np.int64)
    toxic = np.concatenate([np.zeros(0, np.int64), *[b for b, label in zip(bins, y) if label]])
    held = np.bincount(toxic.astype(np.int64), minlength=size)
    odds, error = log_odds(held, good - held, everywhere - held, len(y) - good - everywhere + held)
    tells = (everywhere >= LEAST) & (np.abs(odds) >= Z * error)
    tried = np.flatnonzero((held >= max(LEAST, SHARED * good)) & (everywhere >= LEAST))
    tells[tried[tell_together(y, bins, tried, ~tells[tried])]] = True
    return np.flatnonzero(tells)


def tell_together(y: np.ndarray, bins: list[np.ndarray], tried: np.ndarray, neutral: np.ndarray) -> np.ndarray:
    """Which of the tried bins are neutral alone but tell among the rows that hold another, and these others.

    Counts of pairs are products of the rows' marks, PAIR_ROWS rows and as many bins at a time.
    """
    place = np.full(1 << BITS, -1, np.int32)
    place[tried] = np.arange(len(tried))
    n = len(tried)
    both = {label: np.zeros((n, n), np.float32) for label in (0, 1)}
    for label, counts in both.items():
        rows = np.flatnonzero(y == label)
        for lo in range(0, len(rows), PAIR_ROWS):
            marks = np.zeros((min(PAIR_ROWS, len(rows) - lo), n), np.float32)
            for i, row in enumerate(rows[lo : lo + PAIR_ROWS]):
                at = place[bins[row]]
                marks[i, at[at >= 0]] = 1
            counts += marks.T @ marks
    alone = {label: np.diag(counts).copy()[:, None] for label, counts in both.items()}
    out = np.zeros(n, bool)
    for lo in range(0, n, PAIR_ROWS):
        part = slice(lo, lo + PAIR_ROWS)  # rows: the bin held; columns: the other that may tell
        odds, error = log_odds(both[1][part], alone[1][part] - both[1][part], both[0][part], alone[0][part] - both[0][part])
        told = (np.abs(odds) >= PAIR_Z * error) & neutral[None, :]
        out |= told.any(axis=0)
        out[part] |= told.any(axis=1)
    return out


def machine(row: np.ndarray, at: np.ndarray, n: int, bias: float, weight: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores of n texts whose distinct terms are (row, at), and each text's sum of vectors."""
    total = np.zeros((n, factor.shape[1]))
    square = np.zeros((n, factor.shape[1]))
    for f in range(factor.shape[1]):
        v = factor[at, f]
        total[:, f] = np.bincount(row, weights=v, minlength=n)
        square[:, f] = np.bincount(row, weights=v * v, minlength=n)
    return bias + np.bincount(row, weights=weight[at], minlength=n) + 0.5 * (total**2 - square).sum(1), total


def train(y: np.ndarray, bins: list[np.ndarray], counts: list[np.ndarray]) -> bytes:
    """AdaGrad on the logistic loss, in batches, in an order drawn once from a fixed seed."""
    pick = chosen(y, bins) if len(y) else np.zeros(0, np.int64)
    place = np.full(1 << BITS, -1, np.int64)
    place[pick] = np.arange(len(pick))
    rows = [place[b][place[b] >= 0] for b in bins]
    random = np.random.default_rng(11)
    rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 1e-16
    bias, weight, factor = float(np.log(rate / (1 - rate))), np.zeros(len(pick)), random.normal(0, 0.01, (len(pick), FACTORS))
    seen_w, seen_v, seen_b = np.full(len(pick), 1e-6), np.full(factor.shape, 1e-6), 1.0
    for _ in range(PASSES if len(pick) else 0):
        order = random.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            batch = order[lo : lo + BATCH]
            at = np.concatenate([rows[i] for i in batch])
            row = np.repeat(np.arange(len(batch)), [len(rows[i]) for i in batch])
            raw, total = machine(row, at, len(batch), bias, weight, factor)
            g = (sigmoid(raw) - y[batch]) / len(batch)
            seen_b += g.sum() ** 2
            bias -= RATE * g.sum() / np.sqrt(seen_b)
            touched, where = np.unique(at, return_inverse=True)
            gw = np.bincount(where, weights=g[row], minlength=len(touched)) + DECAY * weight[touched]
            seen_w[touched] += gw * gw
            weight[touched] -= RATE * gw / np.sqrt(seen_w[touched])
            each = g[row, None] * (total[row] - factor[at])
            gv = np.stack([np.bincount(where, weights=each[:, f], minlength=len(touched)) for f in range(FACTORS)], 1) + DECAY * factor[touched]
            seen_v[touched] += gv * gv
            factor[touched] -= RATE * gv / np.sqrt(seen_v[touched])
    table = np.concatenate([[[bias, *[0.0] * (FACTORS + 1)]], np.column_stack([pick, weight, factor])]) if len(pick) else np.array([[bias, *[0.0] * (FACTORS + 1)]])
    return table.astype(np.float64).tobytes()


class Scorer:
    """A trained machine, ready for slices."""

    def __init__(self, model: bytes) -> None:
        table = np.frombuffer(model, np.float64).reshape(-1, FACTORS + 2)
        self.bias, self.weight, self.factor = float(table[0, 0]), table[1:, 1], table[1:, 2:]
        self.place = np.full(1 << BITS, -1, np.int32)
        self.place[table[1:, 0].astype(np.int64)] = np.arange(len(table) - 1)

    def __call__(self, piece: Slice) -> np.ndarray:
        text, bin_ = terms(piece)
        known = self.place[bin_] >= 0
        row, at, _ = counted(text[known], self.place[bin_[known]])
        return sigmoid(machine(row, at, piece.n, self.bias, self.weight, self.factor)[0])


def toxicity_model(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS):
    """A broadcast scorer, trained on the labelled sample."""
    model = fit(labelled(documents, labels, "toxic", max_rows), terms, train)
    return documents.sparkSession.sparkContext.broadcast(Scorer(model))


def score_toxicity(
    documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, cut: float = CUT, keep: list[str] | None = None
) -> DataFrame:
    """Every row with held_out, score (0 to 1) and predicted."""
    sent = toxicity_model(documents, labels, max_rows)
    return scored(documents, keep or ["doc_id"], lambda piece: sent.value(piece), cut)


def without_toxic(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, cut: float = CUT) -> DataFrame:
    """The documents, all columns as they are, that score below ``cut``."""
    sent = toxicity_model(documents, labels, max_rows)
    return keep_rows(documents, lambda texts: pa.array(np.concatenate([sent.value(piece) for piece in slices(texts)]) < cut))
