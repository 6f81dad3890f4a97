"""Token counts by a two-tier lookup on the map side."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, text_of
from .pretokens import ByteLevel

#: Pre-tokens that a worker remembers besides the broadcast table.
CACHE = 1_000_000


def frequent_lengths(vocab: ByteLevel) -> dict[str, int]:
    """Token counts of the pre-tokens that are frequent: those with a token of their own.

    The vocabulary was made of the most frequent strings, so its entries that
    are whole pre-tokens are the frequent ones; the table needs no pass over
    the data and is bounded by the vocabulary (50,000 entries, about 1 MB).
    """
    out = {}
    for b in vocab.token_bytes:
        try:
            t = b.decode()
        except UnicodeDecodeError:
            continue
        if t and t not in vocab.specials and vocab.plain(t) == [t]:
            out[t] = 1
    return out


class Lengths(dict):
    """Second tier: a miss is encoded once and remembered in the worker."""

    def __init__(self, table: dict[str, int], text: str):
        import tiktoken

        super().__init__(table)
        self.table, self.vocab = table, ByteLevel(text)
        v = self.vocab
        ids = [m[2] for m in v.merges]
        if ids == sorted(ids):  # ranks follow the ids: the fast encoder applies
            ranks = {b: i for i, b in enumerate(v.token_bytes) if b and b.decode("utf-8", "replace") not in v.specials}
            one = tiktoken.Encoding("counts", pat_str=v.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = one._encode_single_piece
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_str(text)
            self.encode = lambda t: whole.encode([t], is_pretokenized=True, add_special_tokens=False).ids

    def __missing__(self, token: str) -> int:
        n = len(self.encode(token))
        self[token] = n
        return n

    def count(self, text: str) -> int:
        if len(self) > CACHE + len(self.table):
            self.clear()
            self.update(self.table)
        n = 0
        for special, toks in self.vocab.parts(text):
            n += (special is not None) + sum(map(self.__getitem__, toks))
        return n


_workers: dict[int, Lengths] = {}


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every whole text.

    Counts equal the tokenizers library's, without added special tokens;
    special strings inside a text count as one, as by its default. Null text:
    0 and 0. Every row is handled alone: ties, repeated rows and further
    columns change nothing; an empty table gives no rows.

    Scale: one map-side pass and no shuffle. The broadcast first tier is
    bounded by the vocabulary, the second tier by ``CACHE`` entries a worker.
    """
    sc = df.sparkSession.sparkContext
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = sc.broadcast((text, frequent_lengths(ByteLevel(text))))

    def run(batches):
        key = hash(spec.value[0])
        if key not in _workers:
            _workers.clear()
            _workers[key] = Lengths(spec.value[1], spec.value[0])
        lengths = _workers[key]
        for b in batches:
            n = pa.array([lengths.count(t.as_py()) for t in b.column("_text")], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], names=["doc_id", "n_bytes", "n_tokens"])

    src = ready(df).select(F.col(id_col).alias("doc_id"), F.octet_length(text_of(text_col)).cast("bigint").alias("n_bytes"),
                    text_of(text_col).alias("_text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint")
