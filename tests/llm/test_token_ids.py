"""Token ids written, read back and compared with the tokenizer called directly."""

import json
import tempfile
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from salesflow.llm.packed import BLOCK, PackedFolder, pack, unpack, width_of
from salesflow.llm.queries import tokenizer_text
from salesflow.llm.token_ids import (
    read_token_ids, tokenised, words_stand_alone, write_token_ids,
)

NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(public_tokenizers.path(NAME))


def plain(rows, encode):
    """(doc_id, n_tokens, crc) of every row."""
    out = Counter()
    for d, text in rows:
        ids = [*encode(text or ""), 1]
        out[d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    return out


ODD = [
    "two\x0bwords\x0cand\x1cmore\x85\xa0  end", "é ́alone ạ́", "ΣΣ Σ", "<|endoftext|> x<|startoftext|>y <|endof text|>",
    "don't I'LL 's 've 's", "1234 5٦½", "ＦＵＬＬ ﬁ Ⅳ", "﻿bom ​zero", "a\u0000b", "漢字 かな 한국어 ไทย", "🙂🙂 👩‍👩‍👧", "ǅ ŉ ﬀ İ",
    "x" * 70_000, "word " * 40_000, "#" * 300 + " " + "-" * 300,
]


@pytest.fixture(scope="module")
def documents(spark, odd_documents):
    more = [(900 + i, t) for i, t in enumerate(ODD)] + [(None, "same row")] * 40 + [(5000, f"t{i}") for i in range(30)]
    extra = spark.createDataFrame([(*r, 1, "x", 2.0) for r in more], "doc_id long, text string, start int, ids string, n_tokens double")
    return odd_documents.unionByName(extra, allowMissingColumns=True).repartition(7)


@pytest.mark.parametrize("vocabulary", [NAME, "byte_bpe_50k.json"])
def test_read_back(spark, documents, vocabulary):
    model = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = tokenised(documents, tokenizer_text(vocabulary)).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == plain(rows, lambda t: model.encode(t, add_special_tokens=False).ids)
    found.sort(key=lambda r: r["start"])
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert ids == sorted(ids)
    assert [r["start"] for r in found] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in found])[:-1]]).tolist()


def test_words_stand_alone_by_the_tokenizers_file():
    assert words_stand_alone(tokenizer_text(NAME))
    assert not words_stand_alone(tokenizer_text("byte_bpe_50k.json"))
    parts = json.loads(tokenizer_text(NAME))
    for change in (
        lambda p: p["normalizer"]["normalizers"].append({"type": "Strip", "strip_left": True, "strip_right": True}),
        lambda p: p["pre_tokenizer"]["pretokenizers"][0].update(pattern={"Regex": r" ?\p{L}+"}),
        lambda p: p["pre_tokenizer"]["pretokenizers"][0].update(behavior="Isolated"),
        lambda p: p["added_tokens"][0].update(rstrip=True),
    ):
        other = json.loads(json.dumps(parts))
        change(other)
        assert not words_stand_alone(json.dumps(other))


def test_random_access(spark, documents, tmp_path):
    folder = str(tmp_path / "ids")
    write_token_ids(documents, folder, tokenizer_text(NAME))
    whole = PackedFolder(folder)
    rows = sorted(read_token_ids(spark, folder).collect(), key=lambda r: r["start"])
    every = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows])
    assert len(every) == whole.first[-1] > 3 * BLOCK and len(whole.files) > 1
    for first, n in [(0, 1), (BLOCK - 1, 2), (17, 3 * BLOCK), (len(every) - 5, 5), (len(every) - 5, 50), (100, 0)]:
        assert (whole.ids(first, n) == every[first : first + n]).all()
    for at in range(len(whole.files)):
        assert (whole.ids(int(whole.first[at]) - 3 if at else 0, 6) == every[max(0, int(whole.first[at]) - 3 * (at > 0)) :][:6]).all()


def test_files_of_lost_tasks_are_not_read(spark, documents, tmp_path):
    folder = tmp_path / "ids"
    write_token_ids(documents, str(folder), tokenizer_text(NAME))
    before = read_token_ids(spark, str(folder)).count()
    known = next(folder.glob("ids-*.bin"))
    (folder / "ids-000000-left.bin").write_bytes(known.read_bytes()[:100])
    assert read_token_ids(spark, str(folder)).count() == before


def test_no_documents(no_documents):
    assert tokenised(no_documents, tokenizer_text(NAME)).count() == 0


@pytest.mark.parametrize("width", [1, 5, 8, 15, 16, 17, 24, 32])
def test_packing(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 3 * BLOCK + 77, np.uint64).astype(np.uint32)
    data = pack(ids, width)
    assert len(data) == -(-len(ids) * width // 8) and (unpack(data, width, len(ids)) == ids).all()


def test_least_widths():
    assert [width_of(n) for n in (1, 2, 3, 256, 257, 32_000, 49_408, 65_537)] == [1, 1, 2, 8, 9, 15, 16, 17]


def test_ids_outside_the_vocabulary_are_refused(spark):
    from salesflow.llm.packed import register

    register(spark)
    rows = spark.createDataFrame([(1, bytearray(np.array([40], "<u2").tobytes()))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="not below the vocabulary"):
        rows.write.format("packed_ids").option("vocabulary", 32).mode("append").save(tempfile.mkdtemp(prefix="run-") + "/x")
