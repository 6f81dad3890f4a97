"""Language identification by cross-parsing against suffix automata."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ready, stored, unit_hash, worker_state

#: Characters of labelled text that a language's automaton is built from, at most.
TRAIN_CHARS = 40_000
#: Labelled documents of a language that may be fetched for it (the first in a seeded order).
TRAIN_DOCS = 200
#: A text is parsed in pieces of so many characters; a phrase ends with its piece.
PIECE = 256
#: Entries (states x letters) up to which the automata are one plain table (128 MB).
DENSE = 1 << 25
UNKNOWN = "und"
NOT_LETTERS = regex.compile(r"[^\p{L}]+")
SOME_LETTER = regex.compile(r"\p{L}")


def normal(text: str) -> str:
    """Lower-case letters; every run of other characters is one space."""
    return NOT_LETTERS.sub(" ", text.lower())


def suffix_automaton(codes: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """The suffix automaton of a code sequence: number of states, and (state, code, next state)
    of its transitions, at most three times as many as codes.

    State 1 is the start; the automaton takes exactly the substrings, so a
    walk from the start finds the longest match at a place of another text.
    """
    nxt: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], 1
    for c in codes.tolist():
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    size = np.fromiter(map(len, nxt), np.int64, len(nxt))
    code = np.fromiter((c for t in nxt for c in t), np.int64, size.sum())
    to = np.fromiter((x for t in nxt for x in t.values()), np.int64, size.sum())
    return len(nxt), np.repeat(np.arange(len(nxt)), size), code, to


class Dense:
    """Transitions of all automata as one table: a state is its row's place, 0 no transition."""

    def __init__(self, n: int, letters: int, state: np.ndarray, code: np.ndarray, to: np.ndarray):
        self.letters = letters
        self.table = np.zeros(n * letters, np.int32)
        self.table[state * letters + code] = to * letters

    def place(self, state: np.ndarray) -> np.ndarray:
        return (state * self.letters).astype(np.int32)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        return self.table[state + code]


class Hashed:
    """The same for large alphabets: an open-addressed table, a quarter to half full.

    It grows with the transitions, not with states x letters.
    """

    def __init__(self, n: int, letters: int, state: np.ndarray, code: np.ndarray, to: np.ndarray):
        bits = max(4, (2 * len(state)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.state, self.code, self.to = (np.zeros((1 << bits) + 64, np.int32) for _ in range(3))
        left, probe = np.arange(len(state)), 0
        slot = self._slot(state, code)
        while len(left):  # of the edges that want a free slot, one takes it; the others go on
            at = slot[left] + probe
            if int(at.max()) >= len(self.state) - 1:  # a long run at the end: more room there
                self.state, self.code, self.to = (np.append(x, np.zeros(len(x), np.int32))
                                                  for x in (self.state, self.code, self.to))
            free = self.state[at] == 0
            self.state[at[free]], self.code[at[free]] = state[left[free]], code[left[free]]
            won = (self.state[at] == state[left]) & (self.code[at] == code[left])
            self.to[at[won]] = to[left[won]]
            left, probe = left[~won], probe + 1

    def place(self, state: np.ndarray) -> np.ndarray:
        return state.astype(np.int32)

    def _slot(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        key = state.astype(np.uint64) << np.uint64(21) | code.astype(np.uint64)
        return (key * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        code = np.broadcast_to(code, state.shape)
        s, c = state.ravel(), code.ravel()
        at = self._slot(s, c)
        held = self.state[at]
        hit = (held == s) & (self.code[at] == c)
        out = np.where(hit, self.to[at], 0)
        left = np.flatnonzero(~hit & (held != 0))
        while len(left):  # linear probes until a free slot
            at[left] += 1
            held = self.state[at[left]]
            hit = (held == s[left]) & (self.code[at[left]] == c[left])
            out[left[hit]] = self.to[at[left[hit]]]
            left = left[~hit & (held != 0)]
        return out.reshape(state.shape)


class Parser:
    """Automata of all languages over one alphabet; made from (language, text) pairs."""

    def __init__(self, training: list[tuple[str, str]], train_chars: int = TRAIN_CHARS):
        by_lang: dict[str, list[str]] = {}
        for lang, text in sorted(training):
            by_lang.setdefault(lang, []).append(normal(text))
        self.langs = sorted(by_lang)
        joined = [" ".join(by_lang[x])[:train_chars] for x in self.langs]
        seen = sorted(set("".join(joined)) - {" "})
        #: 0: the space, 1..: letters seen in training; the last code: any other
        self.letters = len(seen) + 2
        self.points = np.array([ord(c) for c in seen], np.int64)
        n, edges, first = 1, [], []  # state 0 of all automata together: no match
        for x in joined:
            size, state, code, to = suffix_automaton(self.encode(x))
            edges.append((state + n - 1, code, to + n - 1))
            first.append(n)
            n += size - 1
        state, code, to = map(np.concatenate, zip(*edges)) if edges else (np.zeros(0, np.int64),) * 3
        self.moves = (Dense if n * self.letters <= DENSE else Hashed)(n, self.letters, state, code, to)
        self.start = self.moves.place(np.array(first, np.int64))

    def encode(self, text: str) -> np.ndarray:
        p = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        at = np.searchsorted(self.points, p)
        hit = self.points[np.minimum(at, len(self.points) - 1)] == p if len(self.points) else np.zeros(len(p), bool)
        return np.where(p == 32, 0, np.where(hit, at + 1, self.letters - 1))

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Number of phrases of each normalised text in each language: [text, language].

        All pieces of all texts step together: a character that extends no
        match ends the phrase, and a new one starts with it.
        """
        n = len(self.langs)
        counts = np.zeros((len(texts), n), np.int64)
        if not n or not texts:
            return counts
        length = np.array([len(t) for t in texts])
        pieces = -(-length // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        ends = np.cumsum(length)
        codes = self.encode("".join(texts))
        number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = (ends - length)[owner] + number * PIECE
        size = np.minimum(length[owner] - number * PIECE, PIECE)
        order = np.argsort(-size, kind="stable")
        begin, size, owner = begin[order], size[order], owner[order]
        state = np.repeat(self.start[:, None], len(owner), 1)
        found = np.zeros((n, len(owner)), np.int32)
        start = self.start[:, None]
        self.first = self.moves.step(np.repeat(start, self.letters, 1), np.arange(self.letters)[None, :])
        for step in range(int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -step, "left"))  # pieces longer than step
            c = codes[begin[:live] + step]
            was = state[:, :live]
            to = self.moves.step(was, c)
            broken = to == 0
            again = self.first[:, c]
            unseen = broken & (again == 0)
            # an open phrase ends; a character that the language never showed is one of its own
            found[:, :live] += broken & (was != start)
            found[:, :live] += unseen
            state[:, :live] = np.where(unseen, start, np.where(broken, again, to))
        found += state != start  # the phrase that the piece's end closes
        for i in range(n):
            counts[:, i] = np.bincount(owner, found[i], len(texts)).astype(np.int64)
        return counts

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each whole text; ties go to the first language.

        The score compares the phrase rates of the two best languages: the
        share by which the best parse is shorter, on a scale where half the
        phrases of the next give 1.
        """
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        some = [i for i, t in enumerate(texts) if t and SOME_LETTER.search(t)]
        if not self.langs:
            return out
        counts = self.phrases([normal(texts[i]).strip() + " " for i in some])
        for i, c in zip(some, counts):
            best = int(c.argmin())
            rest = np.delete(c, best)
            gap = 1.0 if not len(rest) else 1 - c[best] / rest.min()
            out[i] = (self.langs[best], float(min(1.0, max(0.0, 2 * gap))))
        return out


def training_texts(df: DataFrame, learn: Column, lang_col: str = "lang", text_col: str = "text",
                   docs: int = TRAIN_DOCS, seed: int = 42) -> DataFrame:
    """At most about ``docs`` labelled texts of each language, first in a seeded order.

    Returns lang, rank (the digest the order comes from) and the whole text.
    The order is a digest of the text itself, so copies are one text; the
    digest threshold of a language follows from its number of different texts,
    however many copies they have, and no key is sorted whole.
    """
    x = df.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    x = x.withColumn("_h", F.conv(F.substring(unit_hash(F.lit(seed), F.col("text")), 1, 12), 16, 10).cast("double")
                     / F.lit(float(2 ** 48)))
    # a stored row per language: Spark ships the table if its size on disk is small, and no text is shuffled
    per = stored(x.select("lang", "_h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("_n")), "languages")
    few = x.join(per, "lang").where(F.col("_h") * F.col("_n") < docs)
    return few.select("lang", F.col("_h").alias("rank"), "text").distinct()


def shares(texts: list[str], chars: int = TRAIN_CHARS) -> list[str]:
    """The first part of each normalised text: an equal share of ``chars`` (with a space after each).

    What a short text leaves over goes to the longer ones, so a language has
    all of ``chars`` if its texts have.
    """
    out, left = {}, chars + 1
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    for n, i in enumerate(order):
        part = texts[i][:max(0, left // (len(texts) - n) - 1)]
        out[i] = part
        left -= len(part) + 1
    return [out[i] for i in range(len(texts))]


def cut_to_shares(picked: DataFrame, chars: int = TRAIN_CHARS) -> DataFrame:
    """Each text cut to what :func:`shares` may take of it, so that a language's texts have
    little over ``chars`` letters together.

    The shortest texts that fit are whole; the share of the others is the rest
    by their number. The window has a language's picked texts, some hundreds.
    """
    order = Window.partitionBy("lang").orderBy("_len", "rank", "text")
    x = picked.withColumn("_len", F.char_length("text"))
    x = x.withColumn("_before", F.coalesce(F.sum(F.col("_len") + 1).over(
        order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    many = F.count(F.lit(1)).over(Window.partitionBy("lang")) - F.row_number().over(order) + 1
    x = x.withColumn("_share", F.floor((chars + 1 - F.col("_before")) / many).cast("int"))
    level = F.first(F.when(F.col("_len") >= F.col("_share"), F.col("_share")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, 0))
    return x.withColumn("_level", level).select("lang", "rank", F.when(
        F.col("_level").isNull(), F.col("text")).otherwise(
            F.substring(F.col("text"), F.lit(1), F.greatest(F.col("_level"), F.lit(0)) + 1)).alias("text"))


def predict_languages(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang", chunk_chars: int = 1_500_000) -> DataFrame:
    """doc_id, lang_pred, score of every whole text; learns from the rows with ``learn`` only.

    The automata are built from a bounded sample of labelled rows
    (:func:`training_texts`, :func:`shares`); every text is parsed whole.
    Null text, or one without a letter: ``und`` with score 0, as without any
    labelled row. Ties go to the first language by code point. Null or
    repeated ids and further columns change nothing. Empty table: no rows.

    Scale: texts are cut to their shares before the driver gets them, so it
    gets and broadcasts about ``TRAIN_CHARS`` letters for each language; each
    worker builds its automata once (a table that grows with them, not with
    the alphabet), and the texts are parsed in one pass without a shuffle.
    """
    # runs of other characters than letters are one space before the bound
    letters = F.trim(F.regexp_replace("text", "[^\\p{L}]+", " "))
    picked = cut_to_shares(training_texts(df, learn, lang_col, text_col).select(
        "lang", "rank", F.substring(letters, 1, TRAIN_CHARS).alias("text"))).collect()
    held: dict[str, list[str]] = {}
    for r in sorted(picked, key=lambda r: (r["rank"], r["text"])):
        held.setdefault(r["lang"], []).append(normal(r["text"]).strip())
    training = [(lang, t) for lang, ts in held.items() for t in shares(ts)]
    shared = df.sparkSession.sparkContext.broadcast(training)

    def run(batches):
        parser = worker_parser(shared.value)
        for b in batches:
            texts = b.column("_text").to_pylist()
            made, part, chars = [], [], 0
            for t in texts:
                part.append(t)
                chars += len(t or "")
                if chars > chunk_chars:
                    made += parser.predict(part)
                    part, chars = [], 0
            made += parser.predict(part)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([m[0] for m in made], pa.string()),
                 pa.array([m[1] for m in made], pa.float64())], names=["doc_id", "lang_pred", "score"])

    src = ready(df).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def worker_parser(training: list[tuple[str, str]]) -> Parser:
    return worker_state("languages", hash(tuple(training)), make=lambda: Parser(training))
