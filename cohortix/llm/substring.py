"""Substring de-duplication with a compressed FM-index per shard."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import integer_ids, ready, text_of, worker_state
from .fm_index import FmIndex

#: Words in a window that is reported if it repeats.
WINDOW = 13
#: Words in an anchor; a window's anchor is its least hashed run of so many words.
ANCHOR = 4
#: Bits of an anchor's name; two anchors with one name only share work.
NAME_BITS = 40
#: Windows in a segment, words in an index.
SEGMENT, SHARD_WORDS = 64, 60_000
#: Documents with one anchor from which its windows are dealt to several shards.
HOT = 2000
#: Bytes of text that are hashed at once.
CHUNK = 1_000_000
#: End of a span that reaches over a whole text.
WHOLE = 2 ** 31 - 1
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below n."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of some documents, as places in one buffer of bytes.

    ``bytes.split`` without an argument cuts at exactly the six characters
    that separate words, so the words come joined by one space.
    """

    def __init__(self, texts: list[str]):
        norm = [b" ".join(t.encode("utf-8", "surrogatepass").split()) for t in texts]
        self.buffer = b" ".join(norm) + b" "
        raw = np.frombuffer(self.buffer, np.uint8)
        self.n = np.array([x.count(b" ") + 1 if x else 0 for x in norm], np.int64)
        size = np.array([len(x) + 1 for x in norm], np.int64)
        #: first word of each document, and the document of each word
        self.first = np.cumsum(self.n) - self.n
        self.doc = np.repeat(np.arange(len(texts)), self.n)
        space = np.flatnonzero(raw == 32)
        # an empty document leaves a space that ends no word
        if (self.n == 0).any():
            space = np.setdiff1d(space, (np.cumsum(size) - 1)[self.n == 0], assume_unique=True)
        self.end = space
        start = np.append(0, space[:-1] + 1)
        if (self.n == 0).any():
            start = np.maximum(start, (np.cumsum(size) - size)[self.doc])
        self.start = start[:len(space)]
        # polynomial hash of every word from running sums, all modulo 2 ** 64
        up = powers(_BASE, len(raw) + 1)
        down = powers(pow(_BASE, -1, 2 ** 64), len(raw) + 1)
        total = np.append(_U(0), np.cumsum((raw.astype(np.uint64) + _U(1)) * up[:-1], dtype=np.uint64))
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start] + _U(0))

    def runs(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on."""
        n = max(0, len(self.hash) - k + 1)
        s = np.zeros(n, np.uint64)
        for i in range(k):
            s = s * _U(_BASE) + self.hash[i:i + n]
        return mix(s)

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word of every window that lies in one document, name of its anchor).

        The anchor depends on the window's words alone, so equal windows of any
        two documents have one name; windows in a row mostly share theirs.
        """
        k = min(ANCHOR, window)
        n = len(self.hash) - window + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key = self.runs(k)
        low = key[:n]
        for i in range(1, window - k + 1):
            low = np.minimum(low, key[i:i + n])
        at = np.flatnonzero(self.doc[:n] == self.doc[window - 1:])
        return at, (mix(low[at]) >> _U(64 - NAME_BITS)).astype(np.int64)


def in_chunks(texts: list[str]):
    """(first, last + 1) of runs of texts of about ``CHUNK`` characters."""
    lo, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= CHUNK:
            yield lo, i + 1
            lo, n = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def anchor_names(batches, window: int):
    """(rid, names): the anchors of each document, each once."""
    worker_state("substring", make=lambda: None)  # nothing is kept here, nor left of others
    for b in batches:
        texts = b.column("text").to_pylist()
        names, ends = [], [np.zeros(1, np.int64)]
        for lo, hi in in_chunks(texts):
            w = Words(texts[lo:hi])
            at, name = w.anchors(window)
            doc = w.doc[at]
            order = np.lexsort((name, doc))
            doc, name = doc[order], name[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (name[1:] != name[:-1])
            names.append(name[new])
            ends.append(ends[-1][-1] + np.cumsum(np.bincount(doc[new], minlength=hi - lo)))
        flat = np.concatenate(names) if names else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [b.column("rid"), pa.ListArray.from_arrays(np.concatenate(ends).astype(np.int32), flat)],
            names=["rid", "names"])


def _segments(b: pa.RecordBatch, window: int):
    """(row, name, salt, segment, first word) of the runs of windows whose anchor another document has.

    The windows of a hot anchor go one by one, dealt by their own hash.
    """
    texts, found = b.column("text").to_pylist(), b.column("found")
    for lo, hi in in_chunks(texts):
        w = Words(texts[lo:hi])
        at, name = w.anchors(window)
        if not len(at):
            continue
        lists = found.slice(lo, hi - lo)
        known = lists.flatten()
        owner = np.repeat(np.arange(hi - lo), lists.value_lengths().fill_null(0).to_numpy())
        # names are below 2 ** NAME_BITS, so (document, name) fits one number
        pair = owner << NAME_BITS | known.field("name").to_numpy(zero_copy_only=False)
        order = np.argsort(pair)
        pair, salts = pair[order], known.field("salts").to_numpy(zero_copy_only=False)[order]
        mine = w.doc[at] << NAME_BITS | name
        place = np.minimum(np.searchsorted(pair, mine), max(len(pair) - 1, 0))
        wanted = (pair[place] == mine) if len(pair) else np.zeros(len(mine), bool)
        at, name, mine = at[wanted], name[wanted], mine[wanted]
        salt = salts[place[wanted]] if len(pair) else np.zeros(0, np.int64)
        if not len(at):
            continue
        # a run ends where the anchor or the document changes, a window is left out, or it gets long
        new = np.ones(len(at), bool)
        new[1:] = (mine[1:] != mine[:-1]) | (at[1:] != at[:-1] + 1) | (salt[1:] > 1)
        run = np.cumsum(new) - 1
        new |= (np.arange(len(at)) - np.flatnonzero(new)[run]) % SEGMENT == 0
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at)) - 1
        dealt = np.zeros(len(head), np.int64)
        if (salt > 1).any():
            every = w.runs(window)
            dealt = (every[at[head]] % salt[head].astype(np.uint64)).astype(np.int64)
        begin, end = w.start[at[head]].tolist(), w.end[at[tail] + window - 1].tolist()
        segment = [w.buffer[x:y] for x, y in zip(begin, end)]
        doc = w.doc[at[head]]
        yield doc + lo, name[head], dealt.astype(np.int32), segment, (at[head] - w.first[doc]).astype(np.int32)


def index_segments(batches, window: int):
    """(name, salt, segment, first, last): each segment of a batch once, with its least and greatest document."""
    worker_state("substring", make=lambda: None)  # nothing is kept here, nor left of others
    for b in batches:
        ids = b.column("at").to_numpy()
        held: dict[tuple, list] = {}
        for row, name, salt, segment, _ in _segments(b, window):
            for i, n, s, x in zip(ids[row].tolist(), name.tolist(), salt.tolist(), segment):
                r = held.get((n, s, x))
                if r is None:
                    held[n, s, x] = [i, i]
                elif i < r[0]:
                    r[0] = i
                elif i > r[1]:
                    r[1] = i
        cols = [*(list(zip(*held)) or [()] * 3), *(list(zip(*held.values())) or [()] * 2)]
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=["name", "salt", "segment", "first", "last"])


def document_segments(batches, window: int):
    """(rid, th, at, name, salt, key, start): where each document holds which segment (by its digest)."""
    worker_state("substring", make=lambda: None)  # nothing is kept here, nor left of others
    for b in batches:
        for row, name, salt, segment, start in _segments(b, window):
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column(c).take(take) for c in ("rid", "th", "at")]
                + [pa.array(name), pa.array(salt), pa.array([digest(x) for x in segment], pa.binary()), pa.array(start)],
                names=["rid", "th", "at", "name", "salt", "key", "start"])


def digest(segment: bytes) -> bytes:
    return hashlib.blake2b(segment, digest_size=16).digest()


def shard_spans(rows: list[tuple], window: int):
    """(name, salt, key, [(from, to, least owner)]) of the segments of one shard.

    The index is built over all segments; every window of every segment is
    searched backward in it (matching statistics up to the threshold), and its
    interval gives the least document that holds it.
    """
    alphabet: dict[bytes, int] = {}
    seqs = [np.array([alphabet.setdefault(w, len(alphabet) + 1) for w in r[2].split(b" ")], np.int64) for r in rows]
    owner = np.array([r[3] for r in rows], np.int64)
    index = FmIndex(seqs, owner, len(alphabet) + 1, window)
    size = np.array([len(s) for s in seqs])
    begin = np.cumsum(size + 1) - (size + 1)
    n = size - window + 1
    of = np.repeat(np.arange(len(rows)), n)
    place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    # a window that only its own segment holds starts in no other document
    least = owner[of]
    for lo in range(0, len(of), 50_000):
        part = np.arange(lo, min(lo + 50_000, len(of)))
        left, low, high = index.matches(begin[of[part]] + place[part] + window, window)
        least[part[left]] = index.least_owner(low, high)
    # only where some holder of the segment comes after the least holder of the window
    use = least < np.array([r[4] for r in rows], np.int64)[of]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (least[1:] != least[:-1]) | ~use[:-1]
    heads = np.flatnonzero(use & new)
    edge = np.append(np.flatnonzero(new | ~use), len(of))
    tails = edge[np.searchsorted(edge, heads, "right")]
    for a, z in zip(heads.tolist(), tails.tolist()):
        r = rows[of[a]]
        yield r[0], r[1], digest(r[2]), int(place[a]), int(place[a]) + z - a, int(least[a])


def search_shards(batches, window: int):
    """Sorted segments are cut into shards between anchors; one index is held at a time."""
    rows: list[tuple] = []
    words = 0

    def finish():
        cols = list(zip(*shard_spans(rows, window))) or [()] * 6
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["name", "salt", "key", "lo", "hi", "least"])

    worker_state("substring", make=lambda: None)  # nothing is kept here, nor left of others
    for b in batches:
        for r in zip(*(b.column(c).to_pylist() for c in ("name", "salt", "segment", "first", "last"))):
            if rows and r[:3] == rows[-1][:3]:  # the same segment from another batch
                rows[-1] = (*r[:3], min(r[3], rows[-1][3]), max(r[4], rows[-1][4]))
                continue
            if words >= SHARD_WORDS and r[:2] != rows[-1][:2]:
                yield finish()
                rows, words = [], 0
            rows.append(r)
            words += r[2].count(b" ") + 1
    if rows:
        yield finish()


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rid, spans): word places [lo, hi) of windows that start in an earlier document, with the text's hash.

    ``docs`` has rid (the id, or the text's hash for a null id), th (that
    hash), at (the id's place in the order) and text. See :func:`remove_repeats`.
    """
    held = docs.select("rid", "text").mapInArrow(
        lambda b: anchor_names(b, window), "rid bigint, names array<bigint>").select("rid", F.explode("names").alias("name"))
    shared = held.groupBy("name").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        "name", F.ceil(F.col("_n") / HOT).cast("int").alias("salts"))
    found = held.join(shared, "name").groupBy("rid").agg(F.collect_set(F.struct("name", "salts")).alias("found"))
    # equal texts are indexed once, for the first of them: all windows of the others start there
    named = docs.select("rid", "th", "at", F.unhex(F.md5("text")).alias("md5"))
    first = named.groupBy("md5").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first < last")
    copies = named.join(first, "md5").where("at > first").select("rid", "th")
    found = found.join(copies.groupBy("rid").agg(F.collect_set("th").alias("copied")), "rid", "left")
    # all columns of the documents go along, so that this exchange of the texts is the one of the last join
    texts = docs.join(found, "rid").where(~F.array_contains(F.coalesce("copied", F.array().cast("array<bigint>")), F.col("th")))
    index = texts.mapInArrow(lambda b: index_segments(b, window),
                             "name bigint, salt int, segment binary, first bigint, last bigint")
    index = index.repartition("name", "salt").sortWithinPartitions("name", "salt", "segment")
    hits = index.mapInArrow(lambda b: search_shards(b, window),
                            "name bigint, salt int, key binary, lo int, hi int, least bigint")
    keyed = texts.mapInArrow(lambda b: document_segments(b, window),
                             "rid bigint, th bigint, at bigint, name bigint, salt int, key binary, start int")
    spans = keyed.join(hits, ["name", "salt", "key"]).where("least < at").select(
        "rid", F.struct("th", (F.col("start") + F.col("lo")).alias("lo"),
                        (F.col("start") + F.col("hi") + window - 1).alias("hi")).alias("span"))
    whole = copies.select("rid", F.struct("th", F.lit(0).alias("lo"), F.lit(WHOLE).alias("hi")).alias("span"))
    return spans.unionByName(whole).groupBy("rid").agg(F.collect_set("span").alias("spans"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, th, text, n_words, n_removed, kept (the words that stay, joined by one space),
    kept_sha256, and ``rest``, a struct of the columns named in ``keep`` (if any).

    A word goes if a window of ``window`` words over it, unchanged, also starts
    in a document with a smaller id. Windows are judged on the input. Texts
    are read whole; a null text has no words. Null ids come after all others
    and after none of each other; rows with equal ids do not remove each
    other's words. Empty table: no rows. Further columns are not read. Ids
    must be integers (TypeError).

    1. Every window names its anchor, a run of words inside it; only windows
       whose anchor at least two documents have can repeat (a false name
       costs work, never a word).
    2. Equal texts count once, as the first of them. Runs of such windows go to the shard of their anchor, equal ones once
       with their least document; windows of a hot anchor are dealt singly.
    3. Each shard builds a compressed FM-index (bounded words, one at a time)
       and searches its segments' windows backward; the least document in a
       window's interval decides.
    4. The spans return to their documents.

    Scale: the texts are shuffled once by id (null ids by their text's hash)
    and that exchange serves both joins. Equal segments meet once per batch of
    documents; anchors are counted with partial sums; the joins back are on
    keys that Spark can split; a document's spans are bounded by its length.
    """
    integer_ids(df, id_col)
    docs = ready(df).select(
        F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"),
        *([F.struct(*keep).alias("rest")] if keep else [])).withColumn("th", F.xxhash64("text"))
    own = docs.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    # ids in order; a null id comes after all others
    docs = docs.withColumns({"rid": F.coalesce(F.col("doc_id").cast("bigint"), F.col("th")),
                             "at": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2 ** 63 - 1))})

    def cut(batches):
        for b in batches:
            out = []
            for t, th, s in zip(b.column("text"), b.column("th").to_pylist(), b.column("spans")):
                ws = t.as_py().encode("utf-8", "surrogatepass").split()
                spans = [x for x in s.as_py() or () if x["th"] == th] if len(ws) >= window else ()
                kept = ws
                if spans:
                    gone = np.zeros(len(ws) + 1, np.int64)
                    for x in spans:
                        gone[x["lo"]] += 1
                        gone[min(x["hi"], len(ws))] -= 1
                    kept = [w for w, g in zip(ws, np.cumsum(gone).tolist()) if not g]
                joined = b" ".join(kept)
                out.append((len(ws), len(ws) - len(kept), joined.decode("utf-8", "surrogatepass"),
                            hashlib.sha256(joined).hexdigest()))
            cols = list(zip(*out)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in own] + [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=[*own, "n_words", "n_removed", "kept", "kept_sha256"])

    return docs.join(repeated_spans(docs, window), "rid", "left").mapInArrow(
        cut, f"{schema}, n_words bigint, n_removed bigint, kept string, kept_sha256 string")
