"""The learnt operators against plain versions of their arithmetic, and on cases made for their method."""

import math
import random
import string
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from salesflow.llm import quality, toxicity
from salesflow.llm.minhash import meeting, near_duplicates
from salesflow.llm.repeats import cut_repeats
from salesflow.llm.secrets import SHAPE, Automaton, infer, level_of, scan_secrets, thousandth
from salesflow.llm.toxicity import FACTORS, score_toxicity
from tests.llm import brute
from tests.llm.conftest import words


# toxicity


def test_pairwise_score_spelt_out():
    r = np.random.default_rng(1)
    weight, factor, bias = r.normal(size=30), r.normal(size=(30, FACTORS)), 0.7
    texts = [[], [3], [1, 2], [5, 9, 11, 29], list(range(30))]
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got, _ = toxicity.machine(row, np.array([b for t in texts for b in t], np.int64), len(texts), bias, weight, factor)
    want = [bias + sum(weight[a] for a in t) + sum(float(factor[a] @ factor[b]) for a, b in combinations(t, 2)) for t in texts]
    assert np.allclose(got, want)


def test_terms_that_tell_only_together(spark):
    """An insult and a group word, each as common among clean texts, toxic where both stand."""
    r = random.Random(3)
    filler = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(5000):
        kind = i % 4 if i < 3200 else 4
        text = [r.choice(filler) for _ in range(30)]
        text += ["dolt"] * (kind in (1, 3)) + ["zorgians"] * (kind in (2, 3)) + ["vile"] * (kind == 4)
        r.shuffle(text)
        rows.append((i, " ".join(text), kind))
        labels.append((i, int(kind in (3, 4))))
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind int")
    scored = score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), keep=["doc_id", "kind"]).where("held_out").collect()
    hits = defaultdict(list)
    for x in scored:
        hits[x["kind"]].append(x["predicted"])
    rate = {kind: np.mean(p) for kind, p in hits.items()}
    assert rate[3] > 0.95 and rate[4] > 0.95
    assert max(rate[0], rate[1], rate[2]) < 0.05


# quality


def test_one_pass_of_follow_the_regularised_leader(monkeypatch):
    """The trained weights against the update written out term by term."""
    r = np.random.default_rng(2)
    bins = [np.sort(r.choice(50, 12, replace=False)).astype(np.int64) for _ in range(200)]
    counts = [r.integers(1, 5, 12).astype(np.int64) for _ in bins]
    y = np.array([float(b[:6].sum() % 2) for b in bins])
    monkeypatch.setattr(quality, "PASSES", 1)
    model = np.frombuffer(quality.follow_the_leader(y, bins, counts), np.float32)

    last, z, n = len(model) - 1, defaultdict(float), defaultdict(float)

    def weight(t):
        if abs(z[t]) <= quality.L1:
            return 0.0
        return (math.copysign(quality.L1, z[t]) - z[t]) / ((quality.BETA + math.sqrt(n[t])) / quality.ALPHA + quality.L2)

    for label, b, c in zip(y, bins, counts):
        x = {int(t): k / math.sqrt(c.sum()) for t, k in zip(b, c)} | {last: 1.0}
        w = {t: weight(t) for t in x}
        p = 1 / (1 + math.exp(-sum(w[t] * v for t, v in x.items())))
        for t, v in x.items():
            g = (p - label) * v
            z[t] += g - (math.sqrt(n[t] + g * g) - math.sqrt(n[t])) / quality.ALPHA * w[t]
            n[t] += g * g
    known = [*range(50), last]
    assert np.allclose(model[known], [weight(t) for t in known], atol=1e-6) and np.count_nonzero(model) > 10


# near duplicates


def test_shared_shingles_in_portions(monkeypatch):
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 400, n)) for n in (0, 5, 50, 300, 120, 80)]
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets)))
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    for bound in (1, 100, 1 << 20):
        monkeypatch.setattr("salesflow.llm.minhash.TRIPLES", bound)
        assert meeting(lists, lists).tolist() == want


def test_long_texts_meet_in_bounded_memory():
    import tracemalloc

    sets = [np.sort(np.random.default_rng(i).choice(1 << 40, 20_000, replace=False)) for i in range(64)]
    sets[1] = sets[0]
    at = (np.arange(65) * 20_000).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets)))
    tracemalloc.start()
    shared = meeting(lists, lists)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert shared[0, 1] == 20_000 and peak < 150 << 20


def test_many_rows_of_two_near_ids(spark):
    base = words(41, 200)
    near = [*base[:100], "changed", *base[101:]]
    rows = [(1, " ".join(base))] * 1500 + [(2, " ".join(near))] * 1500 + [(3, " ".join(words(42, 50)))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 4)
    count = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in got.collect())
    assert count == Counter({(1, 1, True): 1500, (2, 1, False): 1500, (3, 3, True): 1})


def test_one_id_with_many_texts(spark):
    texts = [" ".join(words(50 + i, 60)) for i in range(6)]
    rows = [(1, t) for t in texts[:3]] + [(2, t + " more") for t in texts[1:4]] + [(3, texts[3]), (4, texts[5])] + [(1, texts[0])] * 5
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect()) == brute.near_duplicates(rows, 4)


# repeated byte strings


def test_many_rows_of_one_id(spark):
    text = " ".join(words(61, 800))
    rows = [(7, text)] * 6000 + [(None, text)] * 500 + [(8, text + " tail"), (9, "short")]
    got = cut_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    count = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got.collect())
    n = len(text.encode())
    assert count == Counter({(7, n, n, 1): 6000, (None, n, n, 1): 500, (8, n + 5, n, 1): 1, (9, 5, 0, 0): 1})


# secrets


def made(kind, r):
    signs = {"mixed": string.ascii_letters + string.digits, "card": string.digits, "word": "etaoinshrdlu"}[kind]
    return "".join(r.choice(signs) for _ in range({"mixed": 24, "card": 16, "word": r.randrange(8, 16)}[kind]))


def test_credentials_without_a_keyword_are_found_and_numbers_are_not(spark):
    r = random.Random(8)
    rows = [(i, f'config token = "{made("mixed", r)}" and {made("word", r)} {made("word", r)}') for i in range(300)]
    rows += [(1000 + i, f"plain {made('word', r)} words, {made('mixed', r)} between {made('word', r)}") for i in range(100)]
    rows += [(2000 + i, f"card {made('card', r)} of {made('word', r)}") for i in range(200)]
    rows += [(3000 + i, " ".join(made("word", r) for _ in range(20))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    found = defaultdict(list)
    for x in scan_secrets(docs).collect():
        for span in filter(None, x["spans"].split(",")):
            kind, a, b = span.split(":")
            if kind == "grammar":
                found[x["doc_id"] // 1000].append(text[x["doc_id"]][int(a) : int(b)])
    assert len(found[1]) >= 90 and all(len(v) == 24 for v in found[1])
    assert not found[2] and not found[3] and not found[0]


def test_automata_learn_from_every_value(spark):
    r = random.Random(10)
    values = [made("mixed", r) for _ in range(3000)]
    tokens = [made("word", r) for _ in range(6000)]
    rows = [(kind, [v], []) for kind in ("assign", "hex") for v in [*values, *values[:500]]] + [("assign", [], tokens[i : i + 4]) for i in range(0, 6000, 3)]
    spans = [([(kind, 0, 24, v) for v in base], [(0, 8, t, True) for t in more] + [(1, 8, "x" + t, False) for t in more]) for kind, base, more in rows]
    found = spark.createDataFrame(spans, "base array<struct<kind:string,start:int,end:int,value:string>>, more array<struct<start:int,end:int,value:string,whole:boolean>>")
    judge = infer(found)
    assert judge.kinds.keys() == {"assign", "hex"}
    whole = Automaton(set(values))

    def learnt(machine):
        return sum(machine.ends[q] for q in range(len(machine.into)) if machine.into[q] == q)

    for machine in judge.kinds.values():
        assert learnt(machine) == len(set(values)) and machine.count == whole.count and machine.next == whole.next
        scores = sorted(thousandth(machine.score(v)) for v in set(values))
        assert machine.level == whole.level == scores[int(0.02 * len(scores))] / 1000
    assert learnt(judge.background) == len(set(tokens))
    assert level_of({}) == math.inf and "aZ9-g".translate(SHAPE) == "fA0-z"


def test_ends_count():
    r = random.Random(9)
    machine = Automaton(["".join(r.choice("0123456789abcdef") for _ in range(40)) for _ in range(300)])
    value = "".join(r.choice("0123456789abcdef") for _ in range(40))
    assert math.isfinite(machine.likelihood(value)) and machine.likelihood("xyz") == -math.inf
    assert math.isfinite(machine.likelihood("xyz", 1e-3))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "no credential here at all, only words")]])
def test_no_credentials_no_automata(spark, rows):
    out = scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["spans"] for r in out] == [""] * len(rows)
