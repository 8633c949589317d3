"""Centroid clustering against a plain version in Python integers."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesflow.llm.centroids import (
    cluster_vectors, digest_of, dots, from_planes, square_planes, to_planes,
)

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance double, planes int"


def plain(rows, n=40, rounds=5, seed=2):
    kept = [
        (v, [math.floor(256 * float(np.float32(x))) for x in e]) for v, e in rows
        if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)
    ]
    hashed = lambda v: hashlib.sha256(f"{seed}:{v}".encode()).hexdigest()
    starts = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashed(r[0]), r[1]))
    centroids = [q for _, q in starts[:n]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c)), i) for i, c in enumerate(centroids)) for _, q in kept]

    for _ in range(rounds):
        members = defaultdict(list)
        for (_, q), (_, i) in zip(kept, assigned()):
            members[i].append(q)
        for i, qs in members.items():
            centroids[i] = [sum(column) // len(qs) for column in zip(*qs)]
    last = assigned()
    spread = Counter()
    for d, i in last:
        spread[i] += d
    return Counter(
        (v, i, d, spread[i], sum(spread.values()), hashlib.sha256(",".join(map(str, centroids[i])).encode()).hexdigest())
        for (v, _), (d, i) in zip(kept, last)
    )


def got(vectors, **options):
    rows = cluster_vectors(vectors, **options).withColumn("sha", digest_of(F.col("centroid")))
    return Counter(tuple(r) for r in rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "sha").collect())


@pytest.fixture(scope="module")
def vectors(spark):
    """A hot group, repeated rows, ties, null and odd vectors, repeated and null ids, clashing columns."""
    r = random.Random(7)
    middles = [[r.gauss(0, 0.3) for _ in range(64)] for _ in range(8)]
    rows = [(i, [x + r.gauss(0, 0.02) for x in middles[0 if i % 3 == 0 else i % 8]]) for i in range(150)]
    rows += [(200, [0.5] * 64)] * 60 + [(201, [0.0] * 64), (201, [-0.001] * 64), (202, [1e5] + [-3.0] * 63), (203, [1.0, -1.0] * 32)]
    rows += [(300, None), (301, []), (302, [0.1] * 63), (303, [0.1] * 65), (304, [None] + [0.1] * 63), (305, [math.nan] * 64)]
    rows += [(306, [math.inf] + [0.0] * 63), (None, [0.25] * 64), (None, [0.25] * 64), (None, None)]
    return spark.createDataFrame([(*row, "x", 1.0, 3) for row in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("options", [{}, {"n": 3, "rounds": 2, "seed": 9}, {"n": 500, "rounds": 1}])
def test_clusters(vectors, options):
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.select("vec_id", "embedding").collect()]
    assert got(vectors, **options) == plain(rows, **options)


def test_no_vectors(vectors):
    none = cluster_vectors(vectors.where("1 = 0"))
    assert none.count() == 0 and "centroid" in none.columns
    assert cluster_vectors(vectors.where("vec_id BETWEEN 300 AND 306")).count() == 0


def test_components_too_large_for_exact_distances(vectors):
    far = vectors.where("vec_id = 200").limit(1).withColumn("embedding", F.array_repeat(F.lit(1e9), 64))
    with pytest.raises(Exception, match="no exact distances"):
        cluster_vectors(far).collect()


def test_planes_hold_the_integers():
    r = np.random.default_rng(3)
    values = r.integers(-300, 300, (50, 64))
    values[0], values[1], values[2, 5] = 0, -1, -(1 << 27)
    flat, width = to_planes(values)
    planes = square_planes(flat, width)
    assert width[0] == 1 and width[1] == 1 and width[2] == 28
    assert (from_planes(planes) == values).all()
    others = r.integers(-70, 70, (9, 64))
    assert (dots(planes, square_planes(*to_planes(others))) == values @ others.T).all()
