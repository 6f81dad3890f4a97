"""Vector codes by product quantisation, the nearest entries found by GNATs over the codebooks."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Split points of a tree's node; a node of up to so many entries is a leaf.
FANOUT = 6
#: Components from here on (before scaling) are refused: squared distances would leave 64 bits.
LIMIT = 2.0 ** 16
FAR = np.int64(2 ** 62)


@dataclass
class Node:
    """Split points, the distance ranges from each to each child's entries, and the children."""

    points: np.ndarray                 # entry numbers
    low: np.ndarray | None = None      # [point, child], rounded down
    high: np.ndarray | None = None     # [point, child], rounded up
    children: list[Node | None] | None = None


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of two integer matrices."""
    out = np.zeros((len(x), len(y)), np.int64)
    for c in range(x.shape[1]):
        d = x[:, c, None] - y[None, :, c]
        out += d * d
    return out


def below(squared: np.ndarray) -> np.ndarray:
    """A number that is surely at most the distance."""
    return np.maximum(0.0, np.sqrt(squared.astype(float)) * (1 - 1e-12) - 1e-12)


def above(squared: np.ndarray) -> np.ndarray:
    """A number that is surely at least the distance."""
    return np.sqrt(squared.astype(float)) * (1 + 1e-12) + 1e-12


class Gnat:
    """Nearest entry of a codebook: geometric near-neighbour access tree over its entries.

    A node has up to ``FANOUT`` split points, each far from those before it;
    every other entry goes to its nearest split point's child. Of each pair
    (split point, child) the least and greatest distance from the point to
    the child's entries are kept. A child is left out for a query if for one
    split point the ball of the best distance so far lies strictly outside
    that range. Ranges are rounded outwards, distances too, and results are
    compared as integers, equal ones by the lower entry number.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = self._node(np.arange(len(entries)))

    def _node(self, members: np.ndarray) -> Node:
        if len(members) <= FANOUT:
            return Node(members)
        e = self.entries
        chosen = [0]
        nearest = squares(e[members], e[members[:1]])[:, 0]
        while len(chosen) < FANOUT:
            far = int(nearest.argmax())
            if nearest[far] == 0:
                break  # only copies of the chosen points are left
            chosen.append(far)
            nearest = np.minimum(nearest, squares(e[members], e[members[far:far + 1]])[:, 0])
        points = members[chosen]
        rest = np.delete(members, chosen)
        if len(chosen) < 2:  # equal entries: the least number stands for all
            return Node(points)
        d = squares(e[rest], e[points])
        child = d.argmin(1)
        node = Node(points, np.full((len(points), len(points)), np.inf), np.full((len(points), len(points)), -np.inf), [])
        for j in range(len(points)):
            inside = child == j
            node.children.append(self._node(rest[inside]) if inside.any() else None)
            if inside.any():
                node.low[:, j] = below(d[inside].min(0))
                node.high[:, j] = above(d[inside].max(0))
        return node

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry number, squared distance) of each row's nearest entry."""
        best = np.full(len(x), FAR)
        name = np.full(len(x), len(self.entries), np.int64)
        if len(self.entries):
            self._search(self.root, x, np.arange(len(x)), best, name)
        return name, best

    def _search(self, node: Node, x: np.ndarray, rows: np.ndarray, best: np.ndarray, name: np.ndarray) -> None:
        d = squares(x[rows], self.entries[node.points])
        low = d.min(1)
        entry = np.where(d == low[:, None], node.points, len(self.entries)).min(1)
        better = (low < best[rows]) | ((low == best[rows]) & (entry < name[rows]))
        best[rows[better]], name[rows[better]] = low[better], entry[better]
        if node.children is None:
            return
        down, up = below(d), above(d)
        # the children of near split points first: the balls shrink early
        for j in np.argsort(d.sum(0), kind="stable"):
            if node.children[j] is None:
                continue
            ball = above(best[rows])[:, None]
            out = ((down - ball > node.high[:, j]) | (up + ball < node.low[:, j])).any(1)
            if not out.all():
                self._search(node.children[j], x, rows[~out], best, name)


def usable(df: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector is there and has only finite components."""
    v = F.col(vec_col)
    return df.where(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def as_matrix(column: pa.Array, width: int) -> np.ndarray:
    """Integer components floor(SCALE x) of an Arrow list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    if (size != width).any():
        raise ValueError(f"vectors must all have {width} components")
    x = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    if len(x) and np.abs(x).max() >= LIMIT:
        raise ValueError(f"components must be below {LIMIT}: squared distances would leave 64 bits")
    return np.floor(x * SCALE).astype(np.int64).reshape(len(size), width)


def cut(x: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(x, parts, axis=1)


def train(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = PARTS,
          entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks of usable vectors: for each part an integer matrix of up to ``entries`` rows.

    They start as the parts of the vectors with the least ids (equal ids by
    vector, null ids last). A round assigns every part of every vector to its
    nearest entry and replaces each entry by its parts' floor(sum / count);
    entries without parts stay. Tasks add up counts and sums per entry, so a
    round shuffles ``parts`` x ``entries`` rows a task, and the driver sees
    that many in all.
    """
    spark = df.sparkSession
    vectors = ready(usable(df, vec_col)).select(F.col(vec_col).cast("array<double>").alias("v"))
    first = usable(df, vec_col).select(F.col(id_col).alias("i"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = first.orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).collect()
    width = len(rows[0]["v"]) if rows else 0
    if width % parts:
        raise ValueError(f"vectors of {width} components do not cut into {parts} equal parts")
    start = as_matrix(pa.array([r["v"] for r in rows], pa.list_(pa.float64())), width) if rows else np.zeros((0, 0), np.int64)
    books = cut(start, parts)
    if not width:
        return books
    each = width // parts

    for _ in range(rounds):
        now = spark.sparkContext.broadcast(books)  # parts x entries small integers

        def partial(batches, now=now):
            trees = [Gnat(b) for b in now.value]
            count = np.zeros((parts, len(now.value[0])), np.int64)
            total = np.zeros((parts, len(now.value[0]), each), np.int64)
            for b in batches:
                for p, x in enumerate(cut(as_matrix(b.column("v"), width), parts)):
                    code, _ = trees[p].nearest(x)
                    count[p] += np.bincount(code, minlength=count.shape[1])
                    np.add.at(total[p], code, x)
            p, e = np.nonzero(count)
            yield pa.RecordBatch.from_arrays([
                pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e], pa.int64()),
                *[pa.array(total[p, e, i], pa.int64()) for i in range(each)]],
                names=["part", "entry", "n", *[f"s{i}" for i in range(each)]])

        sums = vectors.mapInArrow(partial, "part int, entry int, n bigint, " + ", ".join(
            f"s{i} bigint" for i in range(each)))
        got = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[
            F.sum(F.col(f"s{i}").cast("decimal(38,0)")).alias(f"s{i}") for i in range(each)]).collect()
        books = [b.copy() for b in books]
        for r in got:
            books[r["part"]][r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(each)]
    return books


def encode(df: DataFrame, books: list[np.ndarray], vec_col: str = "embedding", keep: list[str] = ("vec_id",)) -> DataFrame:
    """The columns ``keep``, ``code`` (two hex digits a part) and ``error`` (squared
    distances summed over the parts) of the usable vectors: one pass, no shuffle."""
    spec = df.sparkSession.sparkContext.broadcast(books)
    width, parts = sum(b.shape[1] for b in books), len(books)

    def run(batches):
        trees = [Gnat(b) for b in spec.value]
        for b in batches:
            x = as_matrix(b.column("_v"), width)
            code, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p, y in enumerate(cut(x, parts) if len(x) else []):
                if not y.shape[1]:
                    continue  # vectors without components: all parts are the first entry
                code[:, p], d = trees[p].nearest(y)
                error += d
            digits = code.tobytes().hex()
            yield pa.RecordBatch.from_arrays([
                *[b.column(f"_k{i}") for i in range(len(keep))],
                pa.array([digits[i:i + 2 * parts] for i in range(0, len(digits), 2 * parts)], pa.string()),
                pa.array(error, pa.int64())], names=[*keep, "code", "error"])

    src = ready(usable(df, vec_col)).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
                                           F.col(vec_col).cast("array<double>").alias("_v"))
    out = ", ".join([*[f"`{c}` {t}" for c, (_, t) in zip(keep, src.dtypes)], "code string", "error bigint"])
    return src.mapInArrow(run, out)


def decode(code: str, books: list[np.ndarray]) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([b[int(code[2 * p:2 * p + 2], 16)] for p, b in enumerate(books)])


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable vector.

    Vectors that are null or hold a null or non-finite component are dropped.
    All others must have one length, a multiple of ``parts``, and components
    below ``LIMIT``; else an error says so. Components are floor(256 x).
    Equal distances: the lower entry. Repeated rows each count and come out
    each; null ids are kept. label_error sums the errors of equal labels,
    nulls being one. No usable vector: no rows. Further columns are not read.
    ``entries`` is 256 at most (two hex digits).

    Scale: ``rounds`` + 1 passes that read the vectors where they are; shuffled
    are partial sums, and for label_error the coded rows against the table of
    label sums, which Spark broadcasts if it is small by its size on disk;
    else the rows of a hot label are split as a skewed join.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    books = train(df, id_col, vec_col, parts, entries, rounds)
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    coded = encode(df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v")),
                   books, "v", ["vec_id", "label"])
    coded = stored(coded, "codes")
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").select(
        F.col("label").alias("_label"), "label_error")
    out = coded.join(sums, coded["label"].eqNullSafe(sums["_label"]))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
