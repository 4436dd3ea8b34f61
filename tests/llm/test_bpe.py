"""BPE against the library that the vocabulary comes from."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from rowmill.llm import bpe
from rowmill.llm.queries import QUERIES

POOLS = ("abc  \n\t'sdre ll ve", "éèß日本語한글٣٤½ ", "՘࢏ᛖ \u0085\x1c\x1f​ ", "!?.'\"0123456789")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.default_vocabulary())


def made_up(rng: random.Random) -> str:
    text = "".join(rng.choice(rng.choice(POOLS)) for _ in range(rng.randrange(60)))
    if rng.random() < 0.3:
        text = text[:10] + "<|endoftext|>" + text[10:]
    if rng.random() < 0.1:
        text += rng.choice("a \n!é1") * rng.randrange(3000)
    if rng.random() < 0.2:
        text += "".join(map(chr, (rng.randrange(0xE000, 0x110000) for _ in range(5))))
    return text


def test_random_texts(codec, library):
    rng = random.Random(5)
    texts = [made_up(rng) for _ in range(3000)]
    ids, counts = codec.encode(texts)
    lists = np.split(ids, np.cumsum(counts)[:-1])
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in lists] == expected
    assert codec.decode(ids, counts).to_pylist() == [library.decode(e, skip_special_tokens=False) for e in expected]


def test_ids_that_are_no_text(codec, library):
    rng = random.Random(6)
    lists = [[rng.randrange(50_257) for _ in range(rng.randrange(6))] for _ in range(3000)]
    flat = np.array([i for ids in lists for i in ids], np.int32)
    got = codec.decode(flat, np.array([len(ids) for ids in lists])).to_pylist()
    assert got == [library.decode(ids, skip_special_tokens=False) for ids in lists]
    assert codec.decode(np.array([-5, 64, 60_000], np.int32), np.array([3])).to_pylist() == ["a"]


def test_held_pieces_are_bounded(codec, monkeypatch, library):
    monkeypatch.setattr(bpe, "HELD", 50)
    for at in range(0, 300, 20):
        texts = [f"word{at + i} thing" for i in range(20)]
        ids, counts = codec.encode(texts)
        assert ids.tolist() == [i for e in library.encode_batch(texts) for i in e.ids]
        assert len(codec.numbers) < 200


def test_query(spark, folder, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op11_bpe"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        whole = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(whole.encode()).hexdigest(),
        )


def test_edges(spark, library):
    path = bpe.default_vocabulary()
    long = "é" * 40_000 + " x" * 20_000
    rows = [(1, None, "k"), (1, "", None), (None, "a b", "k"), (1, "a b", "k"), (1, "a b", "k"), (2, long, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = bpe.encode(df, path)
    assert encoded.columns == ["doc_id", "ids"]
    got = sorted(bpe.decode(encoded, path).collect(), key=lambda r: (r.doc_id or 0, r.decoded))
    ab = library.encode("a b").ids
    assert [(r.doc_id, r.decoded, r.ids) for r in got] == [
        (None, "a b", ab), (1, "", []), (1, "", []), (1, "a b", ab), (1, "a b", ab),
        (2, long, library.encode(long).ids),
    ]
    nulls = bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), path)
    assert [tuple(r) for r in nulls.collect()] == [(1, None, "")]
    assert bpe.digest(bpe.decode(bpe.encode(df.limit(0), path), path)).collect() == []
