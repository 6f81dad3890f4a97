"""SentencePiece BPE by vectorised merge rounds over flat symbol arrays."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import chunks
from .common import ready, text_of, worker_state

#: What the library writes for a space.
SPACE = "▁"
#: Characters after which a word may end before a mark, if no piece has that mark behind one of them.
LETTER, MARKS = "A-Za-z0-9À-ÖØ-öø-ÿ", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\n\t"


def word_rule(pieces: list[str]) -> re.Pattern:
    """Words: a run of spaces with what follows it, cut once more between a letter and a mark.

    No merge crosses a place where no piece has the two characters next to
    each other; that no piece has a space behind another character is asked for.
    """
    behind = re.compile(f"(?<=[{LETTER}])[^{LETTER}]")
    met = {m for p in pieces for m in behind.findall(p)}
    marks = "".join(re.escape(m) for m in MARKS if m not in met)
    s = SPACE
    if not marks:
        return re.compile(f"{s}*[^{s}]+|{s}+")
    return re.compile(f"{s}*[{LETTER}]+(?=[{marks}{s}]|\\Z)|"
                      f"{s}*[^{s}]+?(?:(?<=[{LETTER}])(?=[{marks}])|(?={s})|\\Z)|{s}+")


NONE = np.int32(2 ** 31 - 1)
#: Hashed places of the pair table, as a power of two.
SLOT_BITS = 20
#: Words that a worker remembers.
CACHE = 200_000
#: Symbols of new words that are merged at once.
AT_ONCE = 400_000
#: After so many rounds what is left of a word is merged with a heap: a word of equal
#: symbols has one merge a round, and a round reads the whole word.
ROUNDS = 2_000


class PieceBpe:
    """Encoder and decoder of a SentencePiece BPE model with byte fallback.

    Symbols are piece ids; a character without a piece is ``size`` + its code
    point until it is written as byte pieces. The rank of a pair is the place
    of its joined piece's score: a better score first, equal scores equal.
    """

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        n = self.size = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        odd = "ﬁ Ａ́ \t  x "
        if (not all(map(sp.is_byte, self.byte_id)) or any(map(sp.is_unused, plain))
                or sp.normalize(odd) != SPACE + odd.replace(" ", SPACE)
                or any(re.search(f"[^{SPACE}]{SPACE}", self.pieces[i]) for i in plain)):
            raise ValueError("not a BPE model with byte fallback, a space before the text and no other normalisation")
        self.end_id = sp.eos_id()
        self.words = word_rule([self.pieces[i] for i in plain]).findall
        at = {self.pieces[i]: i for i in plain}
        self.char_id = np.arange(0x110000, dtype=np.int64) + n
        for p, i in at.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        score = np.array([sp.get_score(i) for i in plain])
        place = dict(zip(plain, np.searchsorted(np.unique(-score), -score).tolist()))
        self.rank_of: dict[tuple[int, int], tuple[int, int]] = {}
        for p, i in at.items():
            for k in range(1, len(p)):
                a, b = (at.get(x, int(self.char_id[ord(x)]) if len(x) == 1 else -1) for x in (p[:k], p[k:]))
                if a >= 0 and b >= 0:
                    self.rank_of[a, b] = place[i], i
        key = np.array([a << 32 | b for a, b in self.rank_of], np.int64)
        order = np.argsort(key)
        self.key = np.append(key[order], 2 ** 63 - 1)
        # most pairs are found by one look at a hashed place; where two share it, by search
        slot = self._slot(self.key[:-1])
        self.slot = np.full(1 << SLOT_BITS, len(order), np.int32)
        self.slot[slot] = np.arange(len(order))
        self.slot[np.flatnonzero(np.bincount(slot, minlength=1 << SLOT_BITS) > 1)] = -1
        got = np.array(list(self.rank_of.values()), np.int64).reshape(-1, 2)[order]
        self.rank = np.append(got[:, 0], NONE).astype(np.int32)
        self.joined = np.append(got[:, 1], 0)
        # decoding: bytes of every id, and what the unknown id looks like
        self.id_bytes = [b"" if sp.is_control(i) else self.pieces[i].replace(SPACE, " ").encode() for i in range(n)]
        for b, i in enumerate(self.byte_id):
            self.id_bytes[i] = bytes([b])
        self.unknown = sp.unk_id()
        self.id_bytes[self.unknown] = sp.decode([self.unknown]).encode()
        self.is_byte = [sp.is_byte(i) for i in range(n)]
        self.controls = frozenset(i for i in range(n) if sp.is_control(i))
        self.leads = [not (sp.is_byte(i) or sp.is_control(i)) and self.pieces[i].startswith(SPACE) for i in range(n)]
        self.id_text = [str(i) for i in range(n)]
        self.known: dict[str, tuple[int, ...]] = {}

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the pairs in the table; its last place (rank ``NONE``) for no merge."""
        key = a << 32 | b
        at = self.slot[self._slot(key)]
        shared = np.flatnonzero(at < 0)
        at[shared] = np.searchsorted(self.key, key[shared])
        return np.where(self.key[at] == key, at, len(self.key) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def merge(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of distinct, non-empty words.

        A round takes in every word the pairs of its lowest rank, from left to
        right and without overlaps, as far as the one-by-one order would take
        them: up to the first merge that makes a pair of that rank or lower.
        Words without a pair leave the arrays, which are compacted each round.
        """
        out: list[tuple[int, ...]] = [()] * len(words)
        sym = self.char_id[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        size = np.fromiter(map(len, words), np.int64, len(words))
        name = np.arange(len(words))
        last = np.zeros(len(sym), bool)
        last[np.cumsum(size) - 1] = True
        pair = np.full(len(sym), len(self.key) - 1)
        at = np.flatnonzero(~last)
        pair[at] = self.look_up(sym[at], sym[at + 1])
        for turn in range(ROUNDS + 1):
            start = np.cumsum(size) - size
            rank = self.rank[pair]
            low = np.minimum.reduceat(rank, start)
            done = low == NONE
            if done.any() or turn == ROUNDS:
                gone = done if turn < ROUNDS else np.ones(len(done), bool)
                stay = np.repeat(~gone, size)
                ids, lo = sym[~stay].tolist(), 0
                ends = np.cumsum(size[gone]).tolist()
                bytewise = np.maximum.reduceat(sym, start)[gone] >= self.size
                for w, hi, end, spell in zip(name[gone].tolist(), ends, done[gone].tolist(), bytewise.tolist()):
                    part = ids[lo:hi] if end else self.one_by_one(ids[lo:hi])
                    out[w] = self.spelled(part) if spell else tuple(part)
                    lo = hi
                if gone.all():
                    return out
                sym, pair, last, rank = sym[stay], pair[stay], last[stay], rank[stay]
                size, name, low = size[~gone], name[~gone], low[~gone]
            word = np.repeat(np.arange(len(size)), size)
            i = np.flatnonzero(rank == low[word])
            # of overlapping places in a row every second one, from the left
            k = np.arange(len(i))
            run = np.maximum.accumulate(np.where(np.diff(i, prepend=-2) == 1, 0, k))
            i = i[(k - run) % 2 == 0]
            new = self.joined[pair[i]]
            w = word[i]
            # the pairs that each merge makes: with what stands left of it by then, and right of it until then
            end = len(sym) - 1
            right = ~last[i + 1]
            after = np.where(right, self.look_up(new, sym[np.minimum(i + 2, end)]), len(self.key) - 1)
            left = (i > 0) & ~last[i - 1]
            done_before = np.zeros(len(i), bool)
            done_before[1:] = i[1:] - i[:-1] == 2
            prev = np.where(done_before, np.roll(new, 1), sym[i - 1])
            before = np.where(left, self.look_up(prev, new), len(self.key) - 1)
            bad = (self.rank[after] <= low[w]) | (self.rank[before] <= low[w])
            if bad.any():  # per word: up to its first such merge
                so_far = np.cumsum(bad) - bad
                first = np.searchsorted(w, w)  # w is sorted
                ok = so_far == so_far[first]
                i, new, w = i[ok], new[ok], w[ok]
            sym[i] = new
            last[i] |= last[i + 1]
            stay = np.ones(len(sym), bool)
            stay[i + 1] = False
            changed = np.zeros(len(sym), bool)
            changed[i] = True
            changed[i[i > 0] - 1] = True
            changed[np.maximum(i - 2, 0)[(i > 1) & ~stay[i - 1]]] = True
            size -= np.bincount(w, minlength=len(size))
            sym, pair, last, changed = sym[stay], pair[stay], last[stay], changed[stay]
            at = np.flatnonzero(changed)
            nxt = sym[np.minimum(at + 1, len(sym) - 1)]
            pair[at] = np.where(last[at], len(self.key) - 1, self.look_up(sym[at], nxt))
        return out

    def one_by_one(self, sym: list[int]) -> list[int]:
        """The same merges with a heap of (rank, place)."""
        n, get = len(sym), self.rank_of.get
        nxt, prv = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r[0], i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := get((sym[i], sym[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i] if sym[i] == a else -1
            if j < 0 or sym[j] != b:
                continue
            sym[i], sym[j] = get((a, b))[1], -1
            k = nxt[i] = nxt[j]
            if k >= 0:
                prv[k] = i
            for x, y in ((prv[i], i), (i, k)):
                if x >= 0 and y >= 0 and (r := get((sym[x], sym[y]))):
                    heapq.heappush(heap, (r[0], x, sym[x], sym[y]))
        return [s for s in sym if s >= 0]

    def spelled(self, sym: list[int]) -> tuple[int, ...]:
        """Symbols as ids: characters without a piece as the pieces of their bytes."""
        out: list[int] = []
        for s in sym:
            out += [s] if s < self.size else [self.byte_id[b] for b in chr(s - self.size).encode()]
        return tuple(out)

    def learn(self, new: list[str]) -> None:
        """Encode words that are not known yet and remember them."""
        part, n = [], 0
        for x in new:
            part.append(x)
            n += len(x)
            if n >= AT_ONCE:
                self.known.update(zip(part, self.merge(part)))
                part, n = [], 0
        if part:
            self.known.update(zip(part, self.merge(part)))

    def segments(self, text: str) -> list[str]:
        """Words of a text, with the space that the library puts before it."""
        return self.words(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text, without begin and end ids."""
        split = [self.segments(t) for t in texts]
        if len(self.known) > CACHE:
            self.known.clear()
        self.learn([w for w in set(chain.from_iterable(split)) if w not in self.known])
        known = self.known.__getitem__
        for words in split:
            yield list(chain.from_iterable(map(known, words)))

    def decode(self, ids: list[int]) -> str:
        """Text of ids, as the library writes it: control ids are nothing, the space before
        the text goes, and a byte that is no UTF-8 becomes U+FFFD."""
        first = next((i for i in ids if i not in self.controls), None)
        cut = first is not None and self.leads[first]
        if self.controls.isdisjoint(ids[:-1]):  # a control id would part two runs of bytes
            try:
                return b"".join(map(self.id_bytes.__getitem__, ids)).decode()[cut:]
            except UnicodeDecodeError:
                pass
        return "".join(self._runs(ids))[cut:]

    def _runs(self, ids: list[int]) -> Iterator[str]:
        run = b""
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.id_bytes[i]
                continue
            while run:
                try:
                    yield run.decode()
                    run = b""
                except UnicodeDecodeError as e:
                    yield run[:e.start].decode() + "�"
                    run = run[e.start + 1:]
            if i is not None:
                yield self.id_bytes[i].decode()


def worker_pieces(model) -> PieceBpe:
    """The worker's encoder for a broadcast model file; built once in a process."""
    return worker_state("pieces", hash(model.value), make=lambda: PieceBpe(model.value))


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _mapped(df: DataFrame, path: str, text_col: str, keep: list[str], schema: str, types: list, row) -> DataFrame:
    spec = df.sparkSession.sparkContext.broadcast(model_bytes(path))  # one model file: half a MB

    def run(batches):
        bpe = worker_pieces(spec)
        for b in batches:
            lo = 0
            for part in chunks(b.column("_text").to_pylist()):  # what goes back at once is a part's
                made = [row(bpe, ids) for ids in bpe.encode(part)]
                cols = [pa.array([m[i] for m in made], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(f"_k{i}").slice(lo, len(part)) for i in range(len(keep))] + cols, names=[*keep, *names])
                lo += len(part)

    names = [x.split()[0] for x in schema.split(", ")]
    src = ready(df).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], text_of(text_col).alias("_text"))
    out = ", ".join([*[f"`{c}` {t}" for c, (_, t) in zip(keep, src.dtypes)], schema])
    return src.mapInArrow(run, out)


def encode_documents(df: DataFrame, path: str, text_col: str = "text", keep: list[str] = ("doc_id",),
                     end_id: bool = True) -> DataFrame:
    """The columns ``keep`` and ``ids`` (array of int) of every whole text.

    The ids are those of the sentencepiece library without sampling and begin
    id, with its end id behind them if ``end_id``. Null text: the empty text.
    Strings of control pieces inside a text are ordinary text. Rows are
    handled one by one: ties and repeated rows change nothing, an empty table
    gives none, and columns not in ``keep`` are not read. No shuffle; a batch
    is encoded in parts of about a million characters, and a worker remembers
    ``CACHE`` words.
    """
    return _mapped(df, path, text_col, list(keep), "ids array<int>", [pa.list_(pa.int32())],
                   lambda bpe, ids: (ids + [bpe.end_id] * end_id,))


def decode_documents(df: DataFrame, path: str, ids_col: str = "ids", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``text``: ids turned back into text, as the library's
    decode does (null: the empty text; an id outside the model raises)."""
    spec = df.sparkSession.sparkContext.broadcast(model_bytes(path))

    def run(batches):
        bpe = worker_pieces(spec)
        for b in batches:
            text = pa.array([bpe.decode(x.as_py()) for x in b.column("_ids")], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(f"_k{i}") for i in range(len(keep))] + [text],
                                             names=[*keep, "text"])

    src = ready(df).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
                           F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("_ids"))
    out = ", ".join([*[f"`{c}` {t}" for c, (_, t) in zip(keep, src.dtypes)], "text string"])
    return src.mapInArrow(run, out)


def _round_trip(bpe: PieceBpe, ids: list[int]) -> tuple[int, str, str]:
    ids = [*ids, bpe.end_id]
    return (len(ids), hashlib.sha256(" ".join(map(bpe.id_text.__getitem__, ids)).encode()).hexdigest(),
            hashlib.sha256(bpe.decode(ids).encode()).hexdigest())


def digests(df: DataFrame, path: str, text_col: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """Encode with an end id and decode every whole text in one pass: ``keep``, n_tokens,
    ids_sha256 (decimal ids joined by a space) and decoded_sha256 (UTF-8).

    Nulls, odd rows and further columns as in :func:`encode_documents`.
    """
    return _mapped(df, path, text_col, list(keep), "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                   [pa.int64(), pa.string(), pa.string()], _round_trip)
