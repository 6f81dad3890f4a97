"""Jaccard join and substring removal against brute force, with hot groups over many blocks and shards."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortix.llm import jaccard_join as jj
from cohortix.llm import substring as ss
from cohortix.llm.fm_index import FmIndex, WaveletMatrix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_classes(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(t or "")
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = Counter()
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) / len(a | sets[j]) >= 0.8:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {rows[i][0]: (rows[find(i)][0], links[i]) for i in range(len(rows))}


def near_copies(n, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 6)))
    base = [word() for _ in range(90)]
    rows = []
    for i in range(n):
        kind = i % 3
        w = list(base) if kind < 2 else [word() for _ in range(rng.randint(1, 40))]
        if kind == 1:
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    return rows


def test_join_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jj, "SET_BLOCK", 32)
    monkeypatch.setattr(jj, "SKETCH_BLOCK", 40)
    monkeypatch.setattr(jj, "SMALL", 8)
    rows = near_copies(360)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jj.jaccard_join(df).collect()}
    assert got == brute_classes(rows)


def test_join_on_documents(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jj.jaccard_join(docs).collect()}
    assert got == brute_classes(rows)


def test_runs_follow_the_recall():
    assert jj.needed_runs(0.8, 0.9) < jj.needed_runs(0.8, 0.999) < jj.needed_runs(0.8, 0.99999)


def test_shared_sizes():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (1, 5, 30, 50, 50)]
    got = jj.shared_sizes(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(np.intersect1d(a, b))


def brute_removed(rows, window=13):
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot", [2000, 3])
def test_removal_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(ss, "HOT", hot)
    monkeypatch.setattr(ss, "SHARD_WORDS", 400)
    rng = random.Random(hot)
    passages = [[rng.choice("the of a in to and x yy zzz".split()) for _ in range(rng.randint(10, 60))] for _ in range(6)]
    rows = []
    for i in range(150):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += rng.choice(passages) if rng.random() < 0.5 else [rng.choice("abcdefg") * rng.randint(1, 4)
                                                                 for _ in range(rng.randint(0, 30))]
        rows.append((i, " ".join(w)))
    rows.append((200, "same " * 500))
    rows.append((201, "same " * 40))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in ss.remove_repeats(df).collect()}
    assert got == brute_removed(rows)


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(3)
    seqs = [rng.integers(1, 4, n) for n in (3, 40, 17, 80)]
    index = FmIndex(seqs, np.array([9, 4, 7, 2]), 4, 5)
    text = index.text
    ends = np.array([e for e in range(5, len(text) + 1) if 0 not in text[e - 5:e]])
    which, lo, hi = index.matches(ends, 5)
    owner = np.repeat([9, 4, 7, 2], [len(s) + 1 for s in seqs])
    least = dict(zip(which.tolist(), zip(lo, hi, index.least_owner(lo, hi))))
    for i, e in enumerate(ends):
        at = [j for j in range(len(text) - 4) if (text[j:j + 5] == text[e - 5:e]).all()]
        if len(at) == 1:
            assert i not in least
        else:
            a, b, m = least[i]
            assert b - a == len(at) and m == min(owner[j] for j in at)


def test_wavelet_ranks():
    rng = np.random.default_rng(4)
    seq = rng.integers(0, 37, 500)
    w = WaveletMatrix(seq, 37)
    c, lo, hi = rng.integers(0, 37, 200), rng.integers(0, 501, 200), rng.integers(0, 501, 200)
    a, b = w.follow(c, np.array([lo, hi])) - w.follow(c, np.zeros((1, 200), np.int64))
    assert all(a[i] == (seq[:lo[i]] == c[i]).sum() and b[i] == (seq[:hi[i]] == c[i]).sum() for i in range(200))


def test_words_are_those_of_the_pattern():
    texts = ["", " a  bb\t\nccc\x0b\x0cd\r", "\u00e9\u00a0x \u6f22\u5b57 \x1c y", "", "one", "  "]
    w = ss.Words(texts)
    want = [WORD.findall(t) for t in texts]
    assert w.n.tolist() == [len(x) for x in want]
    flat = [w.buffer[a:b].decode() for a, b in zip(w.start, w.end)]
    assert flat == [x for ws in want for x in ws]
    again = ss.Words(["one zz one", "zz"])
    assert again.hash[0] == again.hash[2] == w.hash[-1] and again.hash[1] == again.hash[3] != again.hash[0]


def test_recall_of_contained_pairs_in_third_level_buckets():
    # a copy cut at its end: 80 of 100 tokens, similarity 0.8, the worst case at the threshold
    rng = np.random.default_rng(11)
    runs = jj.needed_runs(jj.THRESHOLD, jj.RECALL)
    sh = jj.Shingler(jj.SHINGLE, jj.THRESHOLD, runs, 42)

    def leaves(s):
        paths, ends = sh.chains(s)
        return set(map(tuple, paths[ends == jj.DEPTH].tolist()))

    pairs = 4000
    missed = 0
    for _ in range(pairs):
        whole = rng.integers(0, 2 ** 63, 100).astype(np.uint64)
        missed += leaves(np.sort(whole)).isdisjoint(leaves(np.sort(whole[:80])))
    assert runs == 15
    assert missed <= 2 * (1 - jj.RECALL) * pairs


def test_chain_arrays():
    paths = np.arange(9).reshape(3, 3)
    got = jj.chain_arrays([(paths, np.array([1, 3, 2])), None, (paths[:0], np.zeros(0, int))]).to_pylist()
    assert got == [[{"a": 0, "b": None, "c": None}, {"a": 3, "b": 4, "c": 5}, {"a": 6, "b": 7, "c": None}], None, []]
    assert jj.chain_arrays([]).to_pylist() == [] and jj.chain_arrays([None]).to_pylist() == [None]


def test_spot_signature_matches_equal_brute_force(spark):
    from cohortix.llm import spotsigs

    rng = random.Random(21)
    words = [f"w{i}" for i in range(300)] + ["the", "of", "and", "a"] * 25
    texts = []
    for _ in range(30):
        base = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        texts.append(base)
        for _ in range(rng.choice([0, 0, 1, 3, 12])):
            near = list(base)
            for _ in range(rng.randint(0, 4)):
                near[rng.randrange(len(near))] = rng.choice(words)
            texts.append(near)
    hot = [rng.choice(words) for _ in range(80)]  # many near copies of one text: several blocks
    for i in range(90):
        near = list(hot)
        near[rng.randrange(80)] = f"x{i}"
        texts.append(near[rng.randint(0, 2):])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(1000, ""), (1001, None), (None, " ".join(hot)), (1002, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' cls", "1 part").repartition(5)
    sigs = {r["doc_id"]: set(r["sigs"]) for r in spotsigs.signatures(F.col("text"), df, "sigs").collect()}
    ids = [r[0] for r in rows if r[0] is not None]
    root = {i: i for i in [*ids, None]}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = [*ids, None]
    for a in range(len(order)):
        for b in range(a):
            x, y = sigs[order[a]], sigs[order[b]]
            if x and y and len(x & y) / len(x | y) >= 0.8:
                p, q = find(order[a]), find(order[b])
                if p != q:
                    root[max((p, q), key=lambda v: (v is None, v or 0))] = min((p, q), key=lambda v: (v is None, v or 0))
    got = spotsigs.match(df).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: find(i) for i in order}
    assert len({r["class_id"] for r in got}) < len(rows) - 80
    assert spotsigs.match(df.limit(0)).collect() == []


def test_ids_that_are_no_integers_are_refused(spark):
    from cohortix.llm import spotsigs

    df = spark.createDataFrame([("a", "some text")], "doc_id string, text string")
    for op in (spotsigs.fingerprints, ss.remove_repeats):
        with pytest.raises(TypeError, match="integer"):
            op(df)
