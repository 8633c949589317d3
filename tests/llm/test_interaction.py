"""The filter audit against a plain walk of every document through every order."""

import re
from collections import Counter
from itertools import permutations

import pytest

from salesflow.llm.interaction import COUNTS, audit_filters
from tests.llm.brute import SPACED


def fails(docs):
    """(part, letters failed, doc_id) of every document."""
    out = []
    for d, text, lang in docs:
        t = text or ""
        words = SPACED.findall(t)
        bad = set()
        if len(words) < 100:
            bad.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t):
            bad.add("C")
        if re.search(r"[#$%&*|]", t):
            bad.add("D")
        if d is not None and any((u or "") == t and e is not None and e < d for e, u, _ in docs):
            bad.add("E")
        out.append((lang or "", bad, d))
    return out


def plain(docs, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    rows, shapley = {}, Counter()
    for part, bad, d in fails(docs):
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                row = rows.setdefault((part, order, step), [0] * 6)
                removed = not gone and f in bad
                row[0] += not gone and f not in bad
                row[1] += removed
                row[2] += gone and f in bad
                row[3] += bad == {f}
                row[4] += removed and d in good
                row[5] += removed and d in toxic
                shapley[part, f] += removed
                gone |= f in bad
    return Counter((*key, *row, shapley[key[0], key[1][key[2] - 1]]) for key, row in rows.items())


def rows_of(docs, labels):
    out = audit_filters(docs, labels).select("part", "filter_order", "step", *COUNTS, "shapley")
    return Counter(tuple(r) for r in out.collect())


@pytest.fixture(scope="module")
def documents(spark, odd_documents):
    """On top of the odd documents: every filter alone and together, and hot copies in several parts."""
    long = " ".join(f"w{i}" for i in range(100))
    more = [
        (600, long, "en"), (601, long, "de"), (602, long, None), (600, long, "en"), (600, long, "fr"), (None, long, "en"), (None, long, "en"),
        (603, long + " $", "en"), (604, "x " * 120, "en"), (605, "X" + long.upper(), "en"), (606, "A#", "de"), (607, "Ab cdefghi", ""),
        *[(700 + i, "copied line", "en" if i % 2 else "es") for i in range(60)],
    ]
    first = odd_documents.select("doc_id", "text", "lang")
    rows = first.union(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    return rows.selectExpr("*", "true AS quality", "'x' AS toxic", "1 AS n", "'y' AS mask", "2 AS part")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(600, 1, 0), (601, 0, 1), (603, 1, 1), (604, None, 1), (606, 1, None), (0, 1, 0), (0, 0, 1), (None, 1, 1), (9999, 1, 1)]
    return spark.createDataFrame(rows + [(700 + i, i % 2, i % 3 == 0 and 1 or 0) for i in range(60)], "doc_id long, quality int, toxic int")


def test_audit(documents, labels, broadcast_below):
    docs = [tuple(r) for r in documents.select("doc_id", "text", "lang").collect()]
    want = plain(docs, [tuple(r) for r in labels.collect()])
    assert rows_of(documents, labels) == want
    broadcast_below(-1)
    assert rows_of(documents, labels) == want


def test_every_part_has_all_steps(documents, labels):
    count = Counter(r["part"] for r in audit_filters(documents, labels).select("part").collect())
    assert set(count.values()) == {600} and "" in count


def test_empty_tables(documents, labels):
    assert audit_filters(documents.where("1 = 0"), labels).count() == 0
    bare = audit_filters(documents, labels.where("1 = 0"))
    assert bare.where("good_lost > 0 OR toxic_lost > 0").count() == 0 and bare.count() > 0


def test_plan_has_no_python_and_no_cross_join(documents, labels):
    plan = audit_filters(documents, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
