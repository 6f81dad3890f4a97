"""Aligned tokens, SentencePiece ids and vector codes equal the libraries' and plain loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cohortix.llm import piece_bpe, queries, token_align, vector_codes

from .test_tokens import TEXTS

ODD = [*TEXTS, "a▁b", "▁", "<s></s><unk><0x41>", "x\0y", "日本語𝔘", "  a", " " * 40, "=" * 300, "-=" * 500,
       "ab" * 900, "word,word;word.Word!\nIt's 12 3.5%\t\tok", "᠎ a", "a​ b", "​ ﻿"]


def made(seed, n):
    rng = random.Random(seed)
    letters = ["a", " ", "b", "e", "t", "h", "日", "𝔘", "\n", "\t", "é", "  ", "th", "ing", "=", "-", "́", "1", "'s", ","]
    return ["".join(rng.choice(letters[:rng.randint(1, len(letters))]) for _ in range(rng.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.pieces())


@pytest.fixture(scope="module")
def own():
    return piece_bpe.PieceBpe(piece_bpe.model_bytes(queries.pieces()))


def test_piece_ids_and_text(own, library):
    texts = ODD + made(1, 3000)
    got = list(own.encode(texts))
    assert got == library.encode(texts)
    assert [own.decode([*x, own.end_id]) for x in got] == [library.decode([*x, own.end_id]) for x in got]


def test_rounds_end_in_a_heap(own, monkeypatch):
    texts = ODD + made(2, 300)
    want = list(own.encode(texts))
    for rounds in (0, 1, 3):
        monkeypatch.setattr(piece_bpe, "ROUNDS", rounds)
        own.known.clear()
        assert list(own.encode(texts)) == want
    own.known.clear()


def test_decodes_any_ids(own, library):
    rng = random.Random(3)
    ids = [[rng.choice([rng.randrange(32_000), rng.randrange(3, 259), 0, 1, 2, 28705, 259])
            for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    assert [own.decode(x) for x in ids] == [library.decode(x) for x in ids]


def test_piece_digests(spark, docs, library):
    got = {r["doc_id"]: r for r in piece_bpe.digests(docs, queries.pieces()).collect()}
    back = {r["doc_id"]: r["text"] for r in piece_bpe.decode_documents(
        piece_bpe.encode_documents(docs, queries.pieces()), queries.pieces()).collect()}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "", add_eos=True)
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids)
        assert g["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert back[r["doc_id"]] == library.decode(ids)


def aligned(texts, library):
    """Every document's row by the libraries and a loop over all token pairs."""
    tok = Tokenizer.from_file(queries.vocabulary())
    tok.encode_special_tokens = True
    from cohortix.llm.pretokens import byte_letters

    letters = byte_letters()
    vocab = {i: t for t, i in tok.get_vocab().items()}
    per, count = [], Counter()
    for t in texts:
        raw = (" " + (t or "")).encode()
        a = tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = library.encode(t) if t else []
        bytes_a = [bytes(letters[c] for c in vocab[i]) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode()
                   for i in b for p in [library.id_to_piece(i)]]
        if not t or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            per.append(([], [], [], ""))
            continue
        ea, eb = (np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b))
        links, lo = [], 0
        for i, e in enumerate(ea):
            s = e - len(bytes_a[i])
            links += [(a[i], b[j]) for j, f in enumerate(eb) if s < f and f - len(bytes_b[j]) < e]
        groups, lo = [], 0
        for e in [x for x in ea if x in set(eb)]:
            side = lambda ids, ends: ",".join(str(i) for i, x in zip(ids, ends) if lo < x <= e)  # noqa: B023, E731
            groups.append(f"{side(a, ea)}|{side(b, eb)}")
            lo = e
        count.update(links)
        per.append((a, b, links, ";".join(groups)))
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    docs = Counter(p for _, _, links, _ in per for p in set(links))
    rows = [(len(a), len(b), g.count(";") + bool(g), len(links), sum(count[p] == best[p[1]] for p in links),
             sum(count[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "") for a, b, links, g in per]
    return rows, count, docs, best


@pytest.mark.parametrize("parts", [3, 40])
def test_alignment(spark, library, parts):
    texts = [None, *ODD, *made(4, 250), "the same text", "the same text"]
    rows, count, docs, best = aligned(texts, library)
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)],
                               "doc_id long, text string, pair string, block int, n_links int")
    df = df.repartition(parts, "doc_id")  # blocks are made in tasks
    got = {r["doc_id"]: tuple(r)[1:] for r in token_align.align_documents(
        df, queries.vocabulary(), queries.pieces()).collect()}
    bad = [(texts[i], got[i], r) for i, r in enumerate(rows) if got[i] != r]
    assert not bad, bad[:3]
    pairs = {(r["a_id"], r["b_id"]): r for r in token_align.pair_counts(
        token_align.inverted(df, queries.vocabulary(), queries.pieces())).collect()}
    assert {k: r["n_links"] for k, r in pairs.items()} == dict(count)
    assert {k: r["n_docs"] for k, r in pairs.items()} == dict(docs)
    assert all(r["best"] == (r["n_links"] == best[k[1]]) for k, r in pairs.items())


def test_bitmaps_and_planes():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 300, 9000, 32_768):
        at = np.sort(rng.choice(32_768, n, replace=False))
        assert (token_align.unpack(token_align.pack(at)) == at).all()
    key = np.sort(rng.choice(4000, 900, replace=False)) + (rng.integers(0, 3, 900) << 16)
    key, n = token_align.summed([key, key[:50]], [rng.integers(1, 40, 900), np.full(50, 7)])
    for r in token_align.bitmaps(key, n, 32_000).to_pylist():
        mine = key >> 16 == r["pair"]
        total = np.zeros(65_536, np.int64)
        for k, p in enumerate(r["planes"]):
            if p is not None:
                total[token_align.unpack(p)] += 1 << k
        assert (total[key[mine] & 0xFFFF] == n[mine]).all() and total.sum() == n[mine].sum() == r["n_links"]
        assert (total > 0).sum() == r["n_docs"]


def test_texts_apart_and_together():
    al = token_align.Aligner(open(queries.vocabulary(), encoding="utf-8").read(),
                             piece_bpe.model_bytes(queries.pieces()))
    texts = made(6, 60)
    rows, key, n = al.documents(texts)
    one = [al.documents([t]) for t in texts]
    assert rows == [r for o in one for r in o[0]]
    k2, n2 = token_align.summed([o[1] + i for i, o in enumerate(one)], [o[2] for o in one])
    assert (key == k2).all() and (n == n2).all()
    assert al.documents([])[0] == [] and al.documents(["", "▁"])[0] == [(0, 0, 0, 0, "")] * 2


def test_gnat_equals_brute_force():
    rng = np.random.default_rng(7)
    for width in (1, 2, 4, 9):
        for spread in (1, 3, 50, 2 ** 24):
            for m in (1, 5, 64, 200):
                e = rng.integers(-spread, spread, (m, width))
                x = np.concatenate([rng.integers(-spread, spread, (300, width)), e])
                code, d = vector_codes.Gnat(e).nearest(x)
                q = vector_codes.squares(x, e)
                assert (code == q.argmin(1)).all() and (d == q.min(1)).all()
    assert vector_codes.Gnat(np.full((50, 3), 7)).nearest(np.zeros((2, 3), np.int64))[0].tolist() == [0, 0]


def vectors(spark, seed=8, n=300):
    rng = np.random.default_rng(seed)
    rows = [(i if i % 50 else None, [float(v) for v in rng.normal(0, 2, 32)], int(i % 4) if i % 5 else None, "x")
            for i in range(n)]
    rows += [(3, [0.5] * 32, 1, "y")] * 40 + [(900, None, 1, "z"), (901, [float("nan")] * 32, 1, "z"),
                                              (902, [None] + [1.0] * 31, 1, "z"), (903, [float("-inf")] * 32, 1, "z")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code string").repartition(5)


def test_codes_equal_a_plain_loop(spark):
    df = vectors(spark)
    rows = [r for r in df.collect() if r["embedding"] and r["vec_id"] not in (901, 902, 903)]
    rows.sort(key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, r["embedding"]))
    x = [np.floor(np.array(r["embedding"]) * 256).astype(int).reshape(16, -1) for r in rows]
    books = [[x[i][p] for i in range(64)] for p in range(16)]

    def near(p, v):
        return min((int(((v - e) ** 2).sum()), i) for i, e in enumerate(books[p]))

    for _ in range(2):
        at = [[near(p, v[p])[1] for v in x] for p in range(16)]
        for p in range(16):
            for e in set(at[p]):
                mine = [v[p] for v, c in zip(x, at[p]) if c == e]
                books[p][e] = sum(mine) // len(mine)
    want = []
    for r, v in zip(rows, x):
        d = [near(p, v[p]) for p in range(16)]
        want.append((r["vec_id"], "".join(f"{i:02x}" for _, i in d), sum(q for q, _ in d), r["label"]))
    per = Counter()
    for w in want:
        per[w[3]] += w[2]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    got = vector_codes.compress(df).collect()
    key = str
    assert sorted(map(tuple, got), key=key) == sorted(((i, c, e, per[lab], sha) for i, c, e, lab in want), key=key)
    books2 = vector_codes.train(df)
    assert (vector_codes.decode(want[0][1], books2) == np.concatenate(
        [books[p][int(want[0][1][2 * p:2 * p + 2], 16)] for p in range(16)])).all()


def test_codes_of_odd_tables(spark):
    df = vectors(spark)
    assert vector_codes.compress(df.limit(0)).collect() == []
    assert vector_codes.compress(df.where("vec_id >= 900")).collect() == []
    few = vector_codes.compress(df.where("vec_id in (1, 2)")).collect()  # fewer vectors than entries
    assert [r["error"] for r in few] == [0, 0]
    with pytest.raises(Exception, match="components"):
        vector_codes.compress(df.selectExpr("vec_id", "slice(embedding, 1, 30) embedding", "label")).collect()
    with pytest.raises(Exception, match="64 bits"):
        vector_codes.compress(df.selectExpr("vec_id", "transform(embedding, x -> x * 1e9) embedding", "label")).collect()
