"""BPE ids, decoded texts and counts equal the public library's."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from cohortix.llm import bpe, queries, token_counts
from cohortix.llm.pretokens import ByteLevel

from .conftest import SF

TEXTS = ["", " ", "a<|endoftext|>b <|endoftext|>", "x" * 3000, "ab" * 1500 + " c", "ՠ 漢字かな交じり文  \n\n x",
         "’quoted’ don't we'll  \t\n 12345 €", "a b\x0b\x0c\x1c\x85z", "ﷺ\U0001f600\U0001f600 é é", "࢏ ꟎ x",
         "1" * 100, "   lead", "trail   ", "\r\n\r\n"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.vocabulary())


@pytest.fixture(scope="module")
def own():
    with open(queries.vocabulary(), encoding="utf-8") as f:
        return bpe.SegmentBpe(ByteLevel(f.read()))


def test_ids_and_text(own, library):
    rng = random.Random(5)
    noise = ["".join(rng.choice("ab c\n'strelé漢1２ \tŠ") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    texts = TEXTS + noise
    for text, ids in zip(texts, own.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text[:50]
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_partial_bytes_decode_as_the_library(own, library):
    rng = random.Random(6)
    for _ in range(200):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(0, 30))]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_tree_widths_agree(own):
    """Words merged side by side come out as from the tree of one long word."""
    rng = random.Random(7)
    words = [" " + "".join(rng.choice("abcdeéerthin") for _ in range(n)) for n in range(1, 60) for _ in range(5)]
    own.known.clear()
    own.learn(words)
    assert all(own.known[w] == own._one(w.encode()) for w in words)


def test_small_cache_changes_nothing(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    for _ in range(2):
        assert list(own.encode(TEXTS)) == [library.encode(t, add_special_tokens=False).ids for t in TEXTS]


def test_queries_against_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = {k: library.encode(t, add_special_tokens=False).ids for k, t in docs.items()}
    got = queries.op2_bpe_round_trip(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        want = ids[r["doc_id"]]
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(
            library.decode(want, skip_special_tokens=False).encode()).hexdigest()
    for r in queries.op8_token_counts(spark, SF).collect():
        assert r["n_tokens"] == len(ids[r["doc_id"]]) and r["over_limit"] == (r["n_tokens"] > 512)
        assert r["n_bytes"] == len(docs[r["doc_id"]].encode())


def test_round_trip_through_tables(spark, docs):
    coded = bpe.encode_documents(docs, queries.vocabulary())
    back = {r["doc_id"]: r["text"] for r in bpe.decode_documents(coded, queries.vocabulary()).collect()}
    assert back == {r["doc_id"]: r["text"] or "" for r in docs.collect()}


def test_second_tier_is_bounded(monkeypatch, library):
    with open(queries.vocabulary(), encoding="utf-8") as f:
        text = f.read()
    monkeypatch.setattr(token_counts, "CACHE", 2)
    x = token_counts.Lengths({" the": 1}, text)
    assert [x.count(t) for t in TEXTS * 2] == [len(library.encode(t, add_special_tokens=False).ids) for t in TEXTS * 2]
