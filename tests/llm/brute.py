"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def fold(text):
    return (text or "").translate(UPPER)


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text, k):
    words = SPACED.findall(fold(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def near_duplicates(rows, k=4, share=80):
    sets = [(d, shingle_set(t, k)) for d, t in rows]
    links = []
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and a is not None and b is not None and 100 * len(s & t) >= share * len(s | t):
                links.append((a, b))
    root = roots({d for d, _ in rows if d is not None}, links)
    return Counter((d, len(s), root.get(d), d is None or root[d] == d) for d, s in sets)


def decontaminate(docs, items, window=13):
    windows = defaultdict(set)
    for key, text in items:
        words = ALNUM.findall(fold(text))
        if words:
            for i in range(max(1, len(words) - window + 1)):
                windows[tuple(words[i : i + window])].add(key)
    sizes = {len(w) for w in windows}
    out = Counter()
    for d, text in docs:
        words = ALNUM.findall(fold(text))
        hit, named = set(), set()
        for k in sizes:
            for i in range(len(words) - k + 1):
                if (w := tuple(words[i : i + k])) in windows:
                    hit.update(range(i, i + k))
                    named |= {str(x) for x in windows[w] if x is not None}
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out[d, len(words), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(words)] += 1
    return out


def licenses(text, phrases):
    words = ALNUM.findall(fold(text))
    found = []
    for phrase, label in phrases.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    places = [i for i, _ in found]
    return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def secrets(text):
    text = text or ""
    kinds = [
        ("assign", r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 8),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    ]
    spans = [(m.start(), i, m.end(), kind) for i, (kind, pattern, good) in enumerate(kinds) for m in re.finditer(pattern, text, re.ASCII) if good(m)]
    spans.sort()
    joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
    counts = Counter(kind for *_, kind in spans)
    return counts["assign"], counts["access"], counts["hex"], hashlib.sha256(joined.encode()).hexdigest(), joined


def cut_repeats(rows, length=200):
    """Rows of (doc_id, text): n_bytes, n_removed, n_spans and checksum of each, in order."""
    texts = [(t or "").encode() for _, t in rows]
    met = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if met[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def targets(sizes, weights=(5, 2, 1), ceiling=3):
    """Targets of a dict of source sizes: share, stop, share the excess, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > ceiling * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = float(ceiling * sizes[s])
            left -= target[s]
            open_.discard(s)
    return target
