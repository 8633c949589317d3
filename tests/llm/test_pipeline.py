"""The pipeline's stages, each on its own input, against plain versions."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from salesflow.llm.toxicity import score_toxicity
from tests.llm import brute
from tests.llm.conftest import pairs

SF_DIR = "/root/testdata/sf0.001"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def as_rows(df, columns=None):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


@pytest.fixture(scope="module")
def docs(spark, odd_documents):
    tables = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source")
    return odd_documents.select("doc_id", "text", "lang", "source", "kept", "score", "shard", "key").unionByName(tables, allowMissingColumns=True).cache()


def test_toxicity(spark, docs):
    kept = stage("toxicity")(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    scores = score_toxicity(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"), keep=docs.columns)
    assert as_rows(kept) == Counter(tuple(r[c] for c in docs.columns) for r in _plain(scores).where("predicted = 0").collect())


def _plain(scores):
    # the documents here hold a column score too: the last of that name is the model's
    names = [c if scores.columns.index(c) == i else f"{c}_model" for i, c in enumerate(scores.columns)]
    return scores.toDF(*names)


def test_near_dedup(spark, docs):
    kept = stage("minhash_near_dedup")(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    root = {}
    for (d, _, component, stays), _n in brute.near_duplicates(pairs(docs), 5).items():
        root[d] = stays
    assert as_rows(kept, ["doc_id", "text"]) == Counter((d, t) for d, t in pairs(docs) if root[d])


def test_decontamination(spark, docs):
    kept = stage("benchmark_decontamination")(spark, docs, SF_DIR)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = Counter()
    for d, t in pairs(docs):
        ((*_, hit), _n), = brute.decontaminate([(d, t)], items).items()
        want[d, t] += not hit
    assert as_rows(kept, ["doc_id", "text"]) == +want
    assert kept.columns == docs.columns


def test_mixing(spark, docs):
    out = stage("source_mixing")(spark, docs, SF_DIR)
    assert out.columns == docs.columns
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in docs.collect():
        sizes[r["source"]] += len(brute.SPACED.findall(r["text"] or ""))
    known = Counter(pairs(docs))
    for r in out.collect():
        taken[r["source"]] += len(brute.SPACED.findall(r["text"] or ""))
    assert all(n <= 3 * known[key] for key, n in Counter(pairs(out)).items())
    target = brute.targets(dict(sizes))
    large = {s for s in sizes if sizes[s] > 3000}
    assert large
    for s in large:
        assert abs(taken[s] - target[s]) <= 0.5 * target[s]


def test_sharding(spark, docs):
    out = stage("hilbert_sharding")(spark, docs, SF_DIR)
    assert as_rows(out, ["doc_id", "text", "lang", "source"]) == as_rows(docs, ["doc_id", "text", "lang", "source"])
    count = Counter(r["shard"] for r in out.collect())
    assert max(count.values()) - min(count.values()) <= 1


def test_every_stage_takes_no_rows(spark, docs):
    none = docs.where("1 = 0")
    for _, run in corpus_pipeline.STAGES:
        assert run(spark, none, SF_DIR).count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    ids = {r["doc_id"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert 0 < len({r["doc_id"] for r in rows.collect()} & ids) <= len(ids)
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} <= set(rows.columns)
