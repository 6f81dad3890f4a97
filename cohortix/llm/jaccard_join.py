"""N-gram Jaccard join by chosen paths."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, ready, stored, text_of, worker_state
from .components import components

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.999
#: Levels of the recursion; a bucket that is still large after it is compared in blocks.
DEPTH = 3
#: Sets in a bucket that are compared at once; larger buckets are split on a further token.
SMALL = 64
#: Sets in a block when a large bucket (sketches) or cluster (whole sets) is compared in pairs of blocks.
SKETCH_BLOCK, SET_BLOCK = 1024, 512
#: One-byte minima in a sketch; a pair goes on if its estimate is within 4.4 deviations of the threshold.
SKETCH = 64
WORDS_KEPT = 300_000
#: Documents whose sets and paths a task holds at once.
AT_ONCE = 512
_WORD = re.compile(WORD)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class Shingler:
    """Sets of shingle hashes and the paths that they choose."""

    def __init__(self, shingle: int, threshold: float, runs: int, seed: int):
        rng = np.random.default_rng(seed)
        odd = lambda n: rng.integers(0, 2 ** 63, n, dtype=np.uint64) * _U(2) + _U(1)
        self.shingle, self.rate = shingle, 1 / threshold
        self.places, self.short = odd(shingle), odd(1)[0]
        self.mul, self.add = odd(SKETCH), odd(SKETCH)
        self.roots = odd(runs)
        self.words: dict[str, int] = {}

    def shingles(self, text: str) -> np.ndarray:
        """Sorted distinct hashes of the text's runs of words (of all its words, if fewer)."""
        ws = _WORD.findall(text)
        if not ws:
            return np.zeros(0, np.uint64)
        known = self.words
        if len(known) > WORDS_KEPT:
            known.clear()
        for w in set(ws).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
        k = self.shingle
        if len(h) < k:
            return mix((h * self.places[:len(h)]).sum(keepdims=True) + np.array([self.short]) * _U(len(h)))
        n = len(h) - k + 1
        s = h[:n] * self.places[0]
        for i in range(1, k):
            s += h[i:i + n] * self.places[i]
        return np.unique(mix(s))

    def sketch(self, s: np.ndarray) -> bytes:
        low = np.full(SKETCH, 2 ** 64 - 1, np.uint64)
        for lo in range(0, len(s), 8192):
            low = np.minimum(low, (s[None, lo:lo + 8192] * self.mul[:, None] + self.add[:, None]).min(1))
        return (mix(low) & _U(255)).astype(np.uint8).tobytes()

    def choose(self, s: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the parent path, new path) for the tokens that each path samples:
        1 / threshold of the set's tokens on average, the same ones in every set."""
        bound = _U(min(2 ** 64 - 1, int(2.0 ** 64 * min(1.0, self.rate / len(s)))))
        parent, new = [], []
        for lo in range(0, len(s), 8192):
            h = mix(s[None, lo:lo + 8192] ^ at[:, None])
            p, t = np.nonzero(h <= bound)
            parent.append(p)
            new.append(mix(h[p, t] + at[p]))
        return np.concatenate(parent), np.concatenate(new)

    def chains(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Root-to-leaf paths of all runs: their tokens of level 1, 2 and 3, and how many levels each has."""
        level, paths = self.roots, np.zeros((len(self.roots), DEPTH), np.int64)
        done, ends = [], []
        for depth in range(DEPTH):
            parent, new = self.choose(s, level) if len(level) else (np.zeros(0, np.int64), level)
            if depth:  # paths without a sampled token end here
                has = np.zeros(len(paths), bool)
                has[parent] = True
                done.append(paths[~has])
                ends.append(np.full(len(done[-1]), depth))
            paths = paths[parent]
            paths[:, depth] = new.view(np.int64)
            level = new
        return np.concatenate([*done, paths]), np.concatenate([*ends, np.full(len(paths), DEPTH)])


def chain_arrays(chains: list[tuple[np.ndarray, np.ndarray] | None]) -> pa.Array:
    """Paths of many sets as one Arrow list array over flat numbers (null for no set)."""
    there = [c for c in chains if c is not None]
    size = [len(c[1]) if c is not None else 0 for c in chains]
    paths = np.concatenate([c[0] for c in there]) if there else np.zeros((0, DEPTH), np.int64)
    ends = np.concatenate([c[1] for c in there]) if there else np.zeros(0, np.int64)
    levels = [pa.array(paths[:, i], pa.int64(), mask=ends <= i) for i in range(DEPTH)]
    flat = pa.StructArray.from_arrays(levels, names=list("abc"[:DEPTH]))
    offsets = np.append(0, np.cumsum(size)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pa.array([c is None for c in chains], pa.bool_()))


def shingler(*key) -> Shingler:
    return worker_state("shingles", key, make=lambda: Shingler(*key))


def class_of(s: np.ndarray) -> bytes | None:
    """128-bit name of a shingle set; none for the empty set."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def runs_of(batches, keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Groups of equal ``keys`` from sorted Arrow batches, one group in memory at a time."""
    key, rows = None, []
    for b in batches:
        for lo in range(0, b.num_rows, AT_ONCE):
            for r in b.slice(lo, AT_ONCE).to_pylist():
                k = tuple(r[c] for c in keys)
                if k != key:
                    if rows:
                        yield key, rows
                    key, rows = k, []
                rows.append(r)
    if rows:
        yield key, rows


def slices(n: int, rows: int = 128) -> Iterator[slice]:
    """Rows of an n x n comparison that are in memory as numbers at once."""
    return (slice(lo, lo + rows) for lo in range(0, n, rows))


def forest(links: np.ndarray) -> np.ndarray:
    """Least member that each member of a symmetric link matrix reaches."""
    m = len(links)
    root = np.arange(m, dtype=np.int32)
    while True:
        low = np.empty(m, np.int32)
        for s in slices(m):
            low[s] = np.where(links[s], root[None, :], np.int32(m)).min(1, initial=m)
        new = np.minimum(root, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def in_blocks(df: DataFrame, key: list[str], count: str, block: int, name: str) -> DataFrame:
    """Rows of a group with the pairs of blocks they are compared in: ``lo`` <= ``hi``, own block ``at``.

    A group of up to ``block`` rows is one block. A larger one is dealt to
    ceil(count / block) blocks by a hash, and each row goes to every pair with
    its block, so no task holds more than two blocks of a group.
    """
    n = F.ceil(F.col(count) / block).cast("int")
    own = F.pmod(F.xxhash64(F.col(name), F.lit(7)), n).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda j: F.struct(
        F.least(j, F.col("at")).alias("lo"), F.greatest(j, F.col("at")).alias("hi")))
    return df.withColumn("_n", n).withColumn("at", own).withColumn("_p", F.explode(pair)).select(
        *[c for c in df.columns], "at", F.col("_p.lo").alias("lo"), F.col("_p.hi").alias("hi"))


def _cross(rows: list[dict], key: tuple, s: slice) -> np.ndarray:
    """Which pairs of these rows this task compares: all in one block, only those across two."""
    at = np.array([r["at"] for r in rows])
    if key[-2] == key[-1]:
        return np.ones((len(at[s]), len(rows)), bool)
    return at[s, None] != at[None, :]


def _unique(rows: list[dict], name: str) -> list[dict]:
    return list({r[name]: r for r in sorted(rows, key=lambda r: r[name])}.values())


def candidate_edges(batches, threshold: float):
    """Spanning edges of the pairs in each bucket whose sketches may reach the threshold."""
    cut = math.floor(SKETCH * (threshold - 4.4 * math.sqrt(threshold * (1 - threshold) / SKETCH)))
    out: list[tuple[int, int]] = []
    for key, rows in runs_of(batches, ["bucket", "lo", "hi"]):
        rows = _unique(rows, "id")
        if len(rows) < 2:
            continue
        sk = np.frombuffer(b"".join(r["sketch"] for r in rows), np.uint8).reshape(len(rows), SKETCH)
        n = np.array([r["n"] for r in rows], float)
        links = np.zeros((len(rows), len(rows)), bool)
        for s in slices(len(rows), 32):
            links[s] = ((sk[s, None, :] == sk[None, :, :]).sum(2, dtype=np.uint8) >= cut) & _cross(rows, key, s) & (
                np.minimum(n[s, None], n[None, :]) >= threshold * np.maximum(n[s, None], n[None, :]))
        root = forest(links)
        out += [(rows[i]["id"], rows[r]["id"]) for i, r in enumerate(root.tolist()) if r != i]
        if len(out) > 50_000:
            yield _arrow(out, "u", "v")
            out = []
    yield _arrow(out, "u", "v")


def _arrow(rows: list[tuple[int, int]], *names: str) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=list(names))


def shared_sizes(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from the tokens that at least two sets have."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    token, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = times[place] > 1
    owner, place = owner[keep], place[keep]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((m, m), np.float32)
    names = np.unique(place)
    for lo in range(0, len(names), 1024):
        part = names[lo:lo + 1024]
        a, b = np.searchsorted(place, part[0]), np.searchsorted(place, part[-1], "right")
        x = np.zeros((m, len(part)), np.float32)
        x[owner[a:b], np.searchsorted(part, place[a:b])] = 1
        out += x @ x.T
    return out


def exact_links(batches, threshold: float):
    """(cls, links, root) of each block pair: documents of other classes with the
    similarity or more, and the least class that the pair's links reach."""
    for key, rows in runs_of(batches, ["cluster", "lo", "hi"]):
        rows = _unique(rows, "cls")
        sets = [np.frombuffer(r["set"], np.uint64) for r in rows]
        n = np.array([len(s) for s in sets], float)
        both = shared_sizes(sets)
        copies = np.array([r["copies"] for r in rows], np.int64)
        links, count = np.zeros(both.shape, bool), np.zeros(len(rows), np.int64)
        for s in slices(len(rows)):
            shared = both[s].astype(float)
            links[s] = (shared / (n[s, None] + n[None, :] - shared) >= threshold) & _cross(rows, key, s)
            links[s][np.arange(len(shared)), np.arange(len(rows))[s]] = False
            count[s] = links[s] @ copies
        root = forest(links)
        yield pa.RecordBatch.from_arrays([
            pa.array([r["cls"] for r in rows], pa.binary()),
            pa.array(count, pa.int64()),
            pa.array([rows[i]["cls"] for i in root.tolist()], pa.binary()),
            pa.array([r["large"] for r in rows], pa.bool_())], names=["cls", "links", "root", "large"])


def needed_runs(threshold: float, recall: float) -> int:
    """Runs until a pair at the threshold is together in a last-level bucket of one with this probability."""
    # tokens that both sets sample at a node, on average: 2 / (1 + threshold) for sets of equal size,
    # and 1, the least, if one holds the other
    shared = 1.0
    meet = 1.0
    for _ in range(DEPTH):
        meet = 1 - math.exp(-shared * meet)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 threshold: float = THRESHOLD, recall: float = RECALL, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, th (64-bit hash of its text) and
    first (whether it is the one of its class that stays: least id, then least th).

    Two documents are linked if the Jaccard similarity of their sets of
    ``shingle``-word runs is ``threshold`` or more. n_links is the number of
    other documents linked to this one, class_id the least doc_id in its
    connected component of links.

    1. Documents with equal sets are one class (128-bit name).
    2. Chosen paths: in each of R runs a class samples 1 / threshold of its
       tokens by a shared hash and goes to those buckets; a bucket with over
       ``SMALL`` classes is split on further sampled tokens, ``DEPTH`` times.
       Small buckets (and what is still large, in pairs of blocks) are
       compared by sketches. R follows from ``recall`` (:func:`needed_runs`).
    3. Components of these candidate pairs are compared exactly, all pairs
       with whole sets, in blocks. Pairs missed by all runs are found here
       too if other members join them.

    Texts without a word have no set and no links; their class is their own
    id. Fewer words than ``shingle``: one run of all words. Null or repeated
    ids: each row is a document of its own (null ids do not name a class
    that has others). Empty table: no rows. Further columns are not read.

    Scale: texts are shuffled once, narrow class rows otherwise. Buckets and
    clusters are dealt to tasks in blocks, and a task emits a spanning forest
    and counts, never its pairs. Nothing per document reaches the driver.
    """
    args = (shingle, threshold, needed_runs(threshold, recall), seed)
    docs = ready(df).select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn(
        "th", F.xxhash64("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def named(batches):
        sh = shingler(*args)
        for whole in batches:
            for lo in range(0, whole.num_rows, AT_ONCE):
                b = whole.slice(lo, AT_ONCE)
                rows = []
                for t in b.column("text"):
                    s = sh.shingles(t.as_py())
                    rows.append((class_of(s), len(s), sh.sketch(s), sh.chains(s)) if len(s) else (None, 0, None, None))
                cls, n, sketch, chains = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id"), b.column("th"), pa.array(cls, pa.binary()), pa.array(n, pa.int32()),
                    pa.array(sketch, pa.binary()), chain_arrays(chains)],
                    names=["doc_id", "th", "cls", "n", "sketch", "chains"])

    rows = stored(docs.mapInArrow(
        named, f"doc_id {id_type}, th bigint, cls binary, n int, sketch binary, "
               "chains array<struct<a:bigint,b:bigint,c:bigint>>"), "shingled")
    classes = stored(rows.where("cls is not null").groupBy("cls").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(
            F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("rep"),
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("chains").alias("chains")), "classes")

    # the recursion: a level's large buckets go on to the next level's. Candidates
    # go by a 64-bit number of their class; two classes with one number are just
    # compared as well, by their sets
    numbered = classes.withColumn("id", F.xxhash64("cls"))
    at = numbered.select("id", F.explode("chains").alias("x")).select("id", "x.*")
    buckets = None
    for depth, name in enumerate("abc"[:DEPTH]):
        last = depth == DEPTH - 1
        level = at.where(F.col(name).isNotNull())
        once = (numbered.select("id", F.explode(F.array_distinct(F.transform("chains", lambda x: x["a"]))).alias(name))
                if depth == 0 else level.select("id", name).distinct())
        size = once.groupBy(name).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        level = level.join(size, name)
        small = level if last else level.where(F.col("size") <= SMALL)
        small = small.select(F.col(name).alias("bucket"), "id", "size").distinct()
        buckets = small if buckets is None else buckets.unionByName(small)
        if not last:
            at = level.where(F.col("size") > SMALL).drop("size", name)
    met = buckets.join(numbered.select("id", "n", "sketch"), "id")
    met = in_blocks(met, ["bucket"], "size", SKETCH_BLOCK, "id")
    met = met.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    edges = met.select("bucket", "lo", "hi", "at", "id", "n", "sketch").mapInArrow(
        lambda b: candidate_edges(b, threshold), "u bigint, v bigint")
    near = components(edges)

    # exact similarities inside the candidate components
    near = near.join(near.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "root")
    wanted = stored(near.select(F.col("node").alias("id"), F.col("root").alias("cluster"), "size").join(
        numbered.select("id", "cls", "copies", "rep"), "id").select(
            "cls", "cluster", "size", "copies", F.col("rep.doc_id").alias("_id"), F.col("rep.th").alias("_th")), "near")
    # a merge join at every size: the wanted texts grow with the corpus
    texts = docs.join(wanted.hint("merge"), docs["doc_id"].eqNullSafe(wanted["_id"]) & (docs["th"] == wanted["_th"]))

    def with_sets(batches):
        sh = shingler(*args)
        for whole in batches:
            for lo in range(0, whole.num_rows, AT_ONCE):
                b = whole.slice(lo, AT_ONCE)
                sets = [sh.shingles(t.as_py()) for t in b.column("text")]
                right = pa.array([class_of(s) == c.as_py() for s, c in zip(sets, b.column("cls"))], pa.bool_())
                out = pa.RecordBatch.from_arrays(
                    [b.column("cls"), b.column("cluster"), b.column("size"), b.column("copies"),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["cls", "cluster", "size", "copies", "set"])
                yield out.filter(right)

    sets = texts.select("cls", "cluster", "size", "copies", "text").mapInArrow(
        with_sets, "cls binary, cluster bigint, size bigint, copies bigint, set binary")
    sets = in_blocks(sets, ["cluster"], "size", SET_BLOCK, "cls").withColumn("large", F.col("size") > SET_BLOCK)
    sets = sets.repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi")
    linked = stored(sets.select("cluster", "lo", "hi", "at", "cls", "copies", "large", "set").mapInArrow(
        lambda b: exact_links(b, threshold), "cls binary, links bigint, root binary, large boolean"), "links")
    joined = components(linked.where("large").select(F.col("cls").alias("u"), F.col("root").alias("v")))
    root = linked.where("not large").select("cls", "root").unionByName(joined.select(F.col("node").alias("cls"), "root"))
    links = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    per = classes.select("cls", "copies", "rep").join(links, "cls", "left").join(
        root, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    per = per.join(per.groupBy("root").agg(F.min("rep").alias("first")), "root")
    out = rows.select("doc_id", "th", "cls").join(
        per.select("cls", "first", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "cls", "left")
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))
    return out.select(
        "doc_id", F.coalesce("first.doc_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "th",
        (F.col("cls").isNull() | own).alias("first"))


def keep_first(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` that stay when one document of each class does, with all their columns.

    Rows that are equal in id and text are one document.
    """
    first = jaccard_join(df, **options).where("first").select(
        F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct()
    x = df.select(F.struct(*df.columns).alias("row"), F.col(options.get("id_col", "doc_id")).alias("id"),
                  F.xxhash64(text_of(options.get("text_col", "text"))).alias("th"))
    x = x.join(first, x["id"].eqNullSafe(first["_id"]) & (x["th"] == first["_th"]), "left_semi")
    return x.dropDuplicates(["id", "th"]).select("row.*")

