"""Byte-level BPE by segment trees over the ranks of adjacent pairs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, text_of, worker_state
from .pretokens import ByteLevel

ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
NONE = np.int32(2 ** 31 - 1)
#: Pre-tokens up to so many bytes are merged side by side, longer ones one by one.
SIDE_BY_SIDE = 64
#: Pre-tokens that a worker remembers.
CACHE = 200_000
#: New pre-tokens that are merged at once.
AT_ONCE = 16_384


class SegmentBpe:
    """Merges pre-tokens; the tree's root is the lowest rank of a mergeable pair.

    Leaf i holds the rank of the pair that starts at symbol i. Going down from
    the root, left first, finds the leftmost lowest pair; a merge changes three
    leaves and the nodes above them; it ends when the root holds no rank.
    """

    def __init__(self, vocab: ByteLevel):
        self.vocab = vocab
        merges = np.array(vocab.merges, np.int64).reshape(-1, 3)
        self.merged = merges[:, 2]
        self._hash_pairs(merges[:, 0] << 32 | merges[:, 1])
        self.rank_of = {(a, b): r for r, (a, b, _) in enumerate(vocab.merges)}
        self.byte_id = np.array(vocab.byte_id, np.int64)
        b = np.arange(256)
        self.byte_ranks = self.pair_ranks(self.byte_id[b].repeat(256), np.tile(self.byte_id[b], 256)).reshape(256, 256)
        self.known: dict[str, tuple[int, ...]] = {}
        self.id_text = [str(i) for i in range(vocab.size)]

    def _hash_pairs(self, keys: np.ndarray) -> None:
        """Open-addressed table of the pairs, an eighth full at most."""
        self.shift = np.uint64(64 - max(4, (8 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.slot_key, self.slot_rank = np.full(size + 64, -1, np.int64), np.full(size + 64, NONE, np.int32)
        left, self.probes = np.arange(len(keys)), 0
        slot = self._slot(keys)
        while len(left):  # of the pairs that want a free slot, one takes it; the others go on
            at = slot[left] + self.probes
            free = self.slot_key[at] == -1
            self.slot_key[at[free]] = keys[left[free]]
            won = self.slot_key[at] == keys[left]
            self.slot_rank[at[won]] = left[won]
            left, self.probes = left[~won], self.probes + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``NONE`` where there is no merge or no right symbol (-1)."""
        keys = a << 32 | np.maximum(b, 0)
        at = self._slot(keys)
        found = self.slot_key[at]
        rank = np.where(found == keys, self.slot_rank[at], NONE)
        left = np.flatnonzero((found != keys) & (found != -1))
        for i in range(1, self.probes):
            if not len(left):
                break
            found = self.slot_key[at[left] + i]
            hit = left[found == keys[left]]
            rank[hit] = self.slot_rank[at[hit] + i]
            left = left[(found != keys[left]) & (found != -1)]
        rank[b < 0] = NONE
        return rank

    def _side_by_side(self, data: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Words of at most ``width`` (a power of two) bytes, each with its own tree."""
        n = len(data)
        length = np.fromiter(map(len, data), np.int64, n)
        raw = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in data), np.uint8).reshape(n, width)
        place = np.arange(width)
        inside = place < length[:, None]
        # one row per word; all reads and writes go through flat places
        sym = np.where(inside, self.byte_id[raw], -1).ravel()
        tree = np.full((n, 2 * width), NONE, np.int32)
        tree[:, width:-1] = np.where(inside[:, 1:], self.byte_ranks[raw[:, :-1], raw[:, 1:]], NONE)
        for i in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1], out=tree[:, i])
        tree = tree.ravel()
        nxt = np.where(place + 1 < length[:, None], place + 1, -1).ravel()
        prv = np.tile(place - 1, n)
        w = np.flatnonzero(tree[1::2 * width] != NONE)
        while len(w):
            row, base = w * width, w * (2 * width)
            low = tree[base + 1]
            node = np.ones(len(w), np.int64)
            for _ in range(width.bit_length() - 1):
                node <<= 1
                node += tree[base + node] != low
            i = node - width
            j = nxt[row + i]
            k = nxt[row + j]
            p = prv[row + i]
            merged = self.merged[low]
            sym[row + i], sym[row + j] = merged, -1
            nxt[row + i] = k
            right, left = k >= 0, p >= 0
            prv[(row + k)[right]] = i[right]
            new = self.pair_ranks(merged, np.where(right, sym[row + k], -1))
            was = self.pair_ranks(np.where(left, sym[row + p], 0), np.where(left, merged, -1))
            # the three leaves, then the nodes above them, a level at a time
            tree[base + width + j], tree[base + width + i] = NONE, new
            tree[(base + width + p)[left]] = was[left]
            up = np.stack([j, i, np.where(left, p, i)]) + width
            for _ in range(width.bit_length() - 1):
                up >>= 1
                at = base + (up << 1)
                tree[base + up] = np.minimum(tree[at], tree[at + 1])
            w = w[tree[base + 1] != NONE]
        there = sym >= 0
        ids = sym[there].tolist()
        ends = np.cumsum(there.reshape(n, width).sum(1)).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends], ends)]

    def _one(self, data: bytes) -> tuple[int, ...]:
        """One long pre-token with one tree in plain lists."""
        n, none = len(data), int(NONE)
        width = 1 << max(0, n - 1).bit_length()
        sym = [self.vocab.byte_id[b] for b in data]
        rank = self.rank_of
        tree = [none] * (2 * width)
        for i in range(n - 1):
            tree[width + i] = rank.get((sym[i], sym[i + 1]), none)
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        nxt, prv = [*range(1, n), -1], [*range(-1, n - 1)]

        def put(i: int, value: int) -> None:
            i += width
            tree[i] = value
            while i > 1:
                i >>= 1
                low = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == low:
                    return
                tree[i] = low

        while (low := tree[1]) != none:
            i = 1
            while i < width:
                i = 2 * i if tree[2 * i] == low else 2 * i + 1
            i -= width
            j = nxt[i]
            k = nxt[j]
            sym[i], sym[j], nxt[i] = self.vocab.merges[low][2], -1, k
            put(j, none)
            if k >= 0:
                prv[k] = i
            put(i, rank.get((sym[i], sym[k]), none) if k >= 0 else none)
            if prv[i] >= 0:
                put(prv[i], rank.get((sym[prv[i]], sym[i]), none))
        return tuple(s for s in sym if s >= 0)

    def learn(self, new: list[str]) -> None:
        """Encode pre-tokens that are not known yet and remember them."""
        by_width: dict[int, list[str]] = {}
        data = {t: t.encode("utf-8", "surrogatepass") for t in new}
        for t, b in data.items():
            width = 1 << max(1, len(b) - 1).bit_length() if len(b) <= SIDE_BY_SIDE else 0
            by_width.setdefault(width, []).append(t)
        for width, ts in by_width.items():
            for lo in range(0, len(ts), AT_ONCE):
                part = ts[lo:lo + AT_ONCE]
                self.known.update(zip(part, self._side_by_side([data[t] for t in part], width) if width
                                      else [self._one(data[t]) for t in part]))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Token ids of each text."""
        split = [list(self.vocab.parts(t)) for t in texts]
        if len(self.known) > CACHE:
            self.known.clear()
        seen = set(chain.from_iterable(toks for parts in split for _, toks in parts))
        self.learn([t for t in seen if t not in self.known])
        known = self.known.__getitem__
        for parts in split:
            ids: list[int] = []
            for special, toks in parts:
                if special is not None:
                    ids.append(special)
                ids.extend(chain.from_iterable(map(known, toks)))
            yield ids

    def decode(self, ids: list[int]) -> str:
        """Text of token ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.vocab.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def chunks(texts: list[str], chars: int = 1_000_000) -> Iterator[list[str]]:
    """Runs of texts of about so many characters, so that a batch of long texts stays small."""
    part, n = [], 0
    for t in texts:
        part.append(t)
        n += len(t) + 1
        if n >= chars:
            yield part
            part, n = [], 0
    if part:
        yield part


def worker_bpe(spec) -> SegmentBpe:
    """The worker's encoder for a broadcast vocabulary file; built once in a process."""
    return worker_state("bpe", hash(spec.value), make=lambda: SegmentBpe(ByteLevel(spec.value)))


def _mapped(df: DataFrame, path: str, text_col: str, keep: list[str], schema: str, row) -> DataFrame:
    """One Arrow-batched pass: ``row(bpe, text, ids)`` makes the new columns of every text."""
    with open(path, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file: some MB

    def run(batches):
        bpe = worker_bpe(spec)
        for b in batches:  # Arrow, not pandas: null ids stay integers
            lo = 0
            for part in chunks(b.column("_text").to_pylist()):  # what goes back at once is a part's
                made = [row(bpe, t, ids) for t, ids in zip(part, bpe.encode(part))]
                cols = [pa.array([m[i] for m in made], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(lo, len(part)) for c in keep] + cols, names=[*keep, *names])
                lo += len(part)

    names, types = zip(*[(x.split()[0], ARROW[x.split()[1]]) for x in schema.split(", ")])
    src = ready(df).select(*[F.col(c) for c in keep], text_of(text_col).alias("_text"))
    out = ", ".join([*[f"`{c}` {t}" for c, t in src.dtypes if c != "_text"], schema])
    return src.mapInArrow(run, out)


def encode_documents(df: DataFrame, path: str, text_col: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``ids`` (array of token ids) of every whole text.

    The ids are those of the tokenizers library without added special tokens;
    special strings inside a text become their own id, as by its default.
    Null text: the empty text, no ids. Rows are handled one by one, so ties
    and repeated rows change nothing; columns not in ``keep`` are not read.
    No shuffle; a worker remembers ``CACHE`` pre-tokens.
    """
    return _mapped(df, path, text_col, list(keep), "ids array<int>", lambda bpe, t, ids: (ids,))


def decode_documents(df: DataFrame, path: str, ids_col: str = "ids", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``text``: the token ids turned back into text (null: empty)."""
    with open(path, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        bpe = worker_bpe(spec)
        for b in batches:
            text = pa.array([bpe.decode(x.as_py()) for x in b.column("_ids")], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [text], names=[*keep, "text"])

    src = ready(df).select(*[F.col(c) for c in keep], F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("_ids"))
    out = ", ".join([*[f"`{c}` {t}" for c, t in src.dtypes if c != "_ids"], "text string"])
    return src.mapInArrow(run, out)


def _round_trip(bpe: SegmentBpe, text: str, ids: list[int]) -> tuple[int, str, str, list[int]]:
    back = bpe.decode(ids)
    return (len(ids), hashlib.sha256(",".join(map(bpe.id_text.__getitem__, ids)).encode()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest(), ids)


def digests(df: DataFrame, path: str, text_col: str = "text", keep: list[str] = ("doc_id",),
            with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text in one pass: n_tokens, ids_sha256 (decimal
    ids joined by commas), decoded_sha256 (UTF-8) and, if asked for, the ids.

    Nulls, ties, repeated rows, empty tables and further columns as in
    :func:`encode_documents`: a null text is the empty one, with no ids.
    """
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _mapped(df, path, text_col, list(keep), schema, _round_trip)
