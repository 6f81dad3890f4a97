"""Alignment of two tokenizers' tokens, counted by inverted bitmaps of id pairs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import SegmentBpe, chunks
from .common import ready, stored, text_of, worker_state
from .piece_bpe import PieceBpe, model_bytes
from .pretokens import ByteLevel

#: Places of documents in a block: a container's 16-bit numbers.
BLOCK_DOCS = 32_768
#: Postings after which a block ends although it holds fewer documents.
BLOCK_POSTINGS = 3_000_000
#: Pre-tokens and words that a worker remembers, each.
CACHE = 200_000


class Words:
    """Ids of the words that an encoder has met, one after the other in one array."""

    def __init__(self, encoder, split: Callable[[str], list[str]]):
        self.encoder, self.split = encoder, split
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, new: list[str]) -> None:
        self.encoder.learn(new)
        got = list(map(self.encoder.known.__getitem__, new))
        self.encoder.known.clear()
        self.number.update(zip(new, range(len(self.size), len(self.size) + len(new))))
        size = np.fromiter(map(len, got), np.int64, len(got))
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), np.int64, size.sum())])
        self.size = np.concatenate([self.size, size])

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        split = [self.split(t) for t in texts]
        if len(self.size) > CACHE:
            self.forget()
        self.learn([w for w in set(chain.from_iterable(split)) if w not in self.number])
        words = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, words.sum())
        size = self.size[at]
        end = np.cumsum(size)
        first = (np.cumsum(self.size) - self.size)[at]
        ids = self.ids[np.repeat(first - (end - size), size) + np.arange(size.sum())]
        return ids, per_text(size, words)


def per_text(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the values of each text, which has ``n`` of them in a row."""
    return np.diff(np.append(0, np.cumsum(values))[np.append(0, np.cumsum(n))])


class Aligner:
    """Both tokenizers of a worker, and the alignment of their tokens by byte offsets."""

    def __init__(self, spec: str, model: bytes):
        a, b = SegmentBpe(ByteLevel(spec)), PieceBpe(model)
        # A takes a space and the text, special strings as plain text; B puts the space itself
        self.a, self.b = Words(a, lambda t: a.vocab.plain(" " + t) if t else []), Words(b, b.segments)
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (a.vocab.token_bytes, b.id_bytes))
        # ids as they stand in the digest: followed by a comma, or by what ends their side of a group
        n, self.size_b = len(self.a_size), b.size
        self.n_a = n
        self.written = ([f"{i}," for i in range(n)] + [f"{i}|" for i in range(n)]
                        + [f"{i}," for i in range(b.size)] + [f"{i};" for i in range(b.size)])

    def documents(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """Per text (n_a, n_b, n_groups, n_links, digest), and the postings of all texts: sorted
        numbers ``(a id * size of B + b id) << 16 | place of the text``, and times linked.

        Two tokens overlap in one run of bytes, and such runs are what the ends
        of all tokens cut a text into: each is one link. Where tokens of both
        end, a group ends.
        """
        (ia, n_a), (ib, n_b) = self.a.tokens(texts), self.b.tokens(texts)
        n_bytes = np.fromiter((len(t.encode()) + 1 if t else 0 for t in texts), np.int64, len(texts))
        # tokens of both are made of the text's own bytes in order; only for the letter that B
        # writes for a space they are not, and that shows in their length
        right = (per_text(self.a_size[ia], n_a) == n_bytes) & (per_text(self.b_size[ib], n_b) == n_bytes)
        if not right.all():
            ia, ib = ia[np.repeat(right, n_a)], ib[np.repeat(right, n_b)]
            n_a, n_b = n_a * right, n_b * right
        end_a, end_b = np.cumsum(self.a_size[ia]), np.cumsum(self.b_size[ib])
        both = np.concatenate([end_a, end_b])
        both.sort()
        new = np.ones(len(both), bool)
        new[1:] = both[1:] != both[:-1]
        ends = both[new]  # one link each
        group = np.flatnonzero(np.append(~new[1:], False)[new])  # ends that both have
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        doc = np.repeat(np.arange(len(texts)), n_a)[at_a]
        n_links = np.bincount(doc, minlength=len(texts))
        n_groups = np.bincount(doc[group], minlength=len(texts))
        key = (ia[at_a] * self.size_b + ib[at_b]) << 16 | doc
        key.sort()
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(first)
        # the ids as written, in the order of the groups: A's before B's
        last_a, last_b = np.zeros(len(ia), bool), np.zeros(len(ib), bool)
        last_a[at_a[group]] = last_b[at_b[group]] = True
        before_a = np.append(0, at_b[group] + 1)[np.cumsum(last_a) - last_a]
        before_b = (at_a[group] + 1)[np.cumsum(last_b) - last_b]
        code = np.empty(len(ia) + len(ib), np.int64)
        code[np.arange(len(ia)) + before_a] = ia + last_a * self.n_a
        code[np.arange(len(ib)) + before_b] = 2 * self.n_a + ib + last_b * self.size_b
        words, rows, lo = list(map(self.written.__getitem__, code.tolist())), [], 0
        for na, nb, ng, nl in zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist()):
            hi = lo + na + nb
            rows.append((na, nb, ng, nl, hashlib.sha256("".join(words[lo:hi])[:-1].encode()).hexdigest() if na else ""))
            lo = hi
        return rows, key[first], np.diff(np.append(first, len(key)))


def summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted postings, equal ones added up."""
    key, n = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


# A compressed bitmap of the places 0 .. 65535 of a block: sorted 16-bit numbers, or the bits
# themselves if that is shorter. The length tells: bits are written with one byte more.


def pack(places: np.ndarray) -> bytes:
    top = int(places[-1]) >> 3
    if 2 * len(places) <= top + 2:
        return places.astype("<u2").tobytes()
    bits = np.zeros(8 * (top + 1), np.uint8)
    bits[places] = 1
    data = np.packbits(bits, bitorder="little").tobytes()
    return data + b"\0" * (1 + len(data) % 2)  # an odd length


def unpack(data: bytes) -> np.ndarray:
    if len(data) % 2 == 0:
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))


def bitmaps(key: np.ndarray, times: np.ndarray, size_b: int) -> pa.RecordBatch:
    """One row per pair of a block, from its sorted postings: multiplicity planes and their populations.

    Plane k is the bitmap of the documents whose number of links has bit k
    (null if none has). n_docs is the population of the planes' OR, n_links
    the sum of the planes' populations times 2^k.
    """
    pair, doc = key >> 16, key & 0xFFFF
    new = np.ones(len(pair), bool)
    new[1:] = pair[1:] != pair[:-1]
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(pair))
    most = np.maximum.reduceat(times, lo) if len(lo) else lo
    planes: list[list[bytes | None]] = []
    links = []
    for a, b, m in zip(lo.tolist(), hi.tolist(), most.tolist()):
        d = doc[a:b]
        if m == 1:
            planes.append([pack(d)])
            links.append(b - a)
            continue
        per = [d[times[a:b] >> k & 1 == 1] for k in range(m.bit_length())]
        planes.append([pack(p) if len(p) else None for p in per])
        links.append(sum(len(p) << k for k, p in enumerate(per)))
    return pa.RecordBatch.from_arrays([
        pa.array(pair[lo] // size_b << 32 | pair[lo] % size_b, pa.int64()), pa.array(planes, pa.list_(pa.binary())),
        pa.array(hi - lo, pa.int64()), pa.array(links, pa.int64())], names=["pair", "planes", "n_docs", "n_links"])


def worker_aligner(spec) -> Aligner:
    """The worker's aligner for the broadcast files; built once in a process."""
    return worker_state("align", hash(spec.value), make=lambda: Aligner(*spec.value))


def inverted(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents and postings of one pass over the texts, in one stored table.

    Rows with a null ``pair`` are documents: block, place in it, id, counts
    and digest. The others are a pair's container in a block: planes, n_docs
    and n_links. A block is made in one task and holds up to ``BLOCK_DOCS``
    documents, so containers of different blocks have no document in common:
    a pair's bitmap over the corpus is the list of its containers.
    """
    with open(path_a, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast((f.read(), model_bytes(path_b)))  # two vocabulary files
    src = ready(df).select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    id_type = src.dtypes[0][1]
    doc_cols = ["n_a", "n_b", "n_groups", "n_doc_links"]

    def run(batches):
        al = worker_aligner(spec)
        block = TaskContext.get().partitionId() << 24
        held: list[tuple] = []
        n = size = 0
        empty_id = None

        def flush():
            cols = bitmaps(*summed(*zip(*held)), al.size_b)
            m = len(cols)
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(m, block), pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, empty_id),
                *[pa.nulls(m, pa.int64()) for _ in doc_cols], pa.nulls(m, pa.string()), *cols.columns], names=NAMES)

        for b in batches:
            empty_id, lo = b.column("_id").type, 0
            for part in chunks(b.column("_text").to_pylist()):
                for k in range(0, len(part), BLOCK_DOCS // 4):
                    texts = part[k:k + BLOCK_DOCS // 4]
                    if held and (n + len(texts) > BLOCK_DOCS or size > BLOCK_POSTINGS):
                        yield flush()
                        block, held, n, size = block + 1, [], 0, 0
                    rows, key, times = al.documents(texts)
                    held.append((key + n, times))
                    m = len(texts)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(m, block), pa.int64()), pa.array(np.arange(n, n + m), pa.int32()),
                        b.column("_id").slice(lo, m),
                        *[pa.array(c, pa.string() if i == 4 else pa.int64()) for i, c in enumerate(zip(*rows))],
                        pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.binary())),
                        pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names=NAMES)
                    n, size, lo = n + m, size + len(key), lo + m
        if held:
            yield flush()

    return stored(src.mapInArrow(run, f"block bigint, at int, doc_id {id_type}, n_a bigint, n_b bigint, "
                                      "n_groups bigint, n_doc_links bigint, groups_sha256 string, pair bigint, "
                                      "planes array<binary>, n_docs bigint, n_links bigint"), "inverted")


NAMES = ["block", "at", "doc_id", "n_a", "n_b", "n_groups", "n_doc_links", "groups_sha256",
         "pair", "planes", "n_docs", "n_links"]


def pair_counts(table: DataFrame) -> DataFrame:
    """a_id, b_id, n_docs, n_links and best (no pair of this b_id has more links) of every
    linked id pair: the populations of its containers added up."""
    per = table.where("pair is not null").groupBy("pair").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    # the pairs of a b_id: at most the first vocabulary
    top = F.max("n_links").over(Window.partitionBy("b_id"))
    return per.select("pair", F.shiftright("pair", 32).cast("int").alias("a_id"), b.cast("int").alias("b_id"),
                      "n_docs", "n_links").withColumn("best", F.col("n_links") == top)


def returned(batches) -> Iterator[pa.RecordBatch]:
    """n_best and count_sum of every document of a block, from its pairs' containers and counts."""
    block, best, total = None, None, None

    def out():
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(at), block), pa.int64()), pa.array(at, pa.int32()),
            pa.array(best[at], pa.int64()), pa.array(total[at], pa.int64())],
            names=["block", "at", "n_best", "count_sum"])

    for b in batches:
        for name, planes, links, top in zip(*[b.column(c).to_pylist() for c in ("block", "planes", "n_links", "best")]):
            if name != block:
                if block is not None:
                    yield out()
                block, best, total = name, np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
            for k, plane in enumerate(planes):
                if plane is not None:
                    at = unpack(plane)
                    total[at] += links << k
                    if top:
                        best[at] += 1 << k
    if block is not None:
        yield out()


def align_documents(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level BPE file, applied to a space and the text, B a
    SentencePiece BPE model, applied to the text; special strings are plain
    text. Places where tokens of both end cut the tokens into groups; tokens
    of A and B are linked where their bytes overlap. An id pair's count is its
    number of links in all documents; n_best counts the links whose pair has
    the most links of its B id (ties included), count_sum adds the counts
    over the links. groups_sha256 is the digest of ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and texts that either tokenizer does not give back
    byte by byte, have zeros and the digest ''. Every row is a document of
    its own: null and repeated ids and equal texts are counted like others.
    Empty table: no rows. Further columns are not read.

    Scale: one pass over the texts writes the inverted containers; they are
    shuffled by pair (a pair has one row a block) to meet its counts, then by
    block, where a task adds up one block's documents at a time. Counts are
    partial sums. Nothing per pair or document reaches the driver.
    """
    table = inverted(df, path_a, path_b, id_col, text_col)
    counts = stored(pair_counts(table), "pairs").select("pair", F.col("n_links").alias("_links"), "best")
    # a merge join at every size: both sides grow with the corpus
    held = table.where("pair is not null").select("pair", "block", "planes").join(counts.hint("merge"), "pair")
    held = held.select("block", "planes", F.col("_links").alias("n_links"), "best")
    scores = held.repartition("block").sortWithinPartitions("block").mapInArrow(
        returned, "block bigint, at int, n_best bigint, count_sum bigint")
    docs = table.where("pair is null")
    out = docs.join(scores.hint("merge"), ["block", "at"], "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_doc_links").alias("n_links"),
                      F.coalesce("n_best", F.lit(0)).cast("bigint").alias("n_best"),
                      F.coalesce("count_sum", F.lit(0)).cast("bigint").alias("count_sum"), "groups_sha256")
