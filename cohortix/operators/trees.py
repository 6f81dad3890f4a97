"""Tree ensembles over histograms of binned features: second-order boosting and Gini forests.

* A feature has up to ``BINS`` bins, cut between its values if there are no
  more of them, else at quantiles. A split sends values up to a cut left;
  missing values are in the last bin.
* A level of a tree is found from the cells (node, feature, bin) of the rows'
  statistics, one after the other in each feature. Statistics are 64-bit
  fixed-point numbers, so their sums, and with them every split and score, do
  not depend on the order or the partitions of the rows.
* In memory, nodes that try the same columns have dense cells; of two children
  those with the lesser hessian are counted and the others' are the difference,
  which whole numbers give exactly. Work on rows is done in blocks that stay in
  cache. The trees are those of the general way (``grow``).
* Rows and columns are drawn by seeded hashes of the row and of the place in
  the ensemble. Rows that are equal in all columns are drawn together.
* ``fit_many`` fits on all labelled rows. Where a worker has the memory for
  them, the matrix is broadcast, and each task makes one boosted model or a group
  of a forest's trees: the fits of a search or of all folds run side by side, one
  task each. Where it has not, ``steps`` makes the same trees from any number of
  rows, which stay where they are.
* Scores are one pass over any number of rows; the trees are broadcast in groups.
  A tree of up to 64 leaves has a word per feature and bin, whose bits are the
  leaves that a row in that bin can reach; the words of a row's bins, taken
  together, leave its leaf as the first bit. Greater trees are walked.
"""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.session import share_package

#: Bytes of rows and of a fit's arrays up to which a worker fits in memory; more are fitted by ``steps``.
MEMORY_BYTES = 256 << 20
BINS = 256
#: One in fixed-point statistics.
ONE = 1 << 24
#: A forest's trees that one task grows, and that are broadcast together.
GROUP = 10
#: Rows that in-memory steps take at a time: their arrays stay in cache.
BLOCK = 8192
#: Rows that a scoring step gathers from Arrow batches.
BUNDLE = 1 << 16
SCORE = "score"


# --- hashes, bins, cells -----------------------------------------------------------------------


def scramble(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit numbers of 64-bit numbers (the public splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(rid: np.ndarray, *place: int) -> np.ndarray:
    """A number in [0, 1) for each row and place of the ensemble."""
    key = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in place:
            key = scramble(np.array([key ^ np.uint64(p)]) + np.uint64(0x9E3779B97F4A7C15))[0]
    return (scramble(rid.astype(np.uint64) ^ key) >> np.uint64(11)).astype(float) / 2.0 ** 53


def bin_cuts(x: np.ndarray) -> list[np.ndarray]:
    """For each column the values up to which rows fall in its bins, but for the last bin."""
    out = []
    for c in range(x.shape[1]):
        v = np.sort(x[~np.isnan(x[:, c]), c])
        u = np.unique(v)
        if len(u) <= BINS:
            out.append(u[:-1] + (u[1:] - u[:-1]) / 2)
        else:
            out.append(np.unique(v[(np.arange(1, BINS) * len(v)) // BINS]))
    return out


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of every value, a row per column; missing ones in the last bin."""
    return np.stack([np.searchsorted(cut, x[:, c], "left") for c, cut in enumerate(cuts)]).astype(np.uint8) if cuts \
        else np.zeros((0, len(x)), np.uint8)


def cells(bins: np.ndarray, node: np.ndarray, columns: np.ndarray, stats: np.ndarray,
          n_nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (slot, node, bin) and summed statistics of the rows' cells.

    ``columns`` has the features of each node's slots. The first statistic is
    positive in every row; all are whole numbers, whose sums doubles hold
    exactly. Many rows a cell: counted in place; few: sorted.
    """
    m = columns.shape[1]
    keys, sums = [], []
    same = n_nodes == 1 or columns.strides[0] == 0
    dense = n_nodes * BINS <= 16 * max(len(node), 1)
    at_node = node * BINS
    for s in range(m):
        key = at_node + (bins[columns[0, s]] if same else bins.ravel().take(columns[:, s][node] * bins.shape[1] + np.arange(len(node))))
        if dense:
            first = np.bincount(key, weights=stats[0], minlength=n_nodes * BINS)
            at = np.flatnonzero(first)
            sums.append(np.stack([first[at], *[np.bincount(key, weights=t, minlength=n_nodes * BINS)[at]
                                               for t in stats[1:]]]))
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            at = key[first]
            sums.append(np.add.reduceat(stats[:, order], first, axis=1) if len(first) else np.zeros((len(stats), 0)))
        keys.append(at + s * n_nodes * BINS)
    return np.concatenate(keys), np.concatenate(sums, axis=1).astype(np.int64)


# --- rules --------------------------------------------------------------------------------------


@dataclass
class Boost:
    """Second-order boosting: statistics (hessian, gradient)."""

    STATS = ("h", "g")

    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0

    def shrunk(self, g):
        return np.sign(g) * np.maximum(np.abs(g) - self.reg_alpha, 0.0)

    def power(self, s):
        g = s[1] / ONE
        if self.reg_alpha:
            g = np.maximum(np.abs(g) - self.reg_alpha, 0.0)
        return g ** 2 / (s[0] / ONE + self.reg_lambda)

    def gain(self, left, right, total):
        """Gain of each split, -inf where it is not allowed."""
        ok = np.minimum(left[0], right[0]) / ONE >= self.min_child_weight
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = self.power(left) + self.power(right) - self.power(total)
        return np.where(ok & (gain > 1e-6) & (gain >= self.gamma), gain, -np.inf)

    def may_split(self, s):
        return s[0] / ONE >= 2 * self.min_child_weight

    def value(self, s):
        with np.errstate(divide="ignore", invalid="ignore"):
            v = -self.shrunk(s[1] / ONE) / (s[0] / ONE + self.reg_lambda)
        return np.where(s[0] > 0, v, 0.0)

    def cover(self, s):
        return s[0] / ONE


@dataclass
class Gini:
    """Classification trees: statistics (rows, weight of class 0, weight of class 1)."""

    STATS = ("n", "w0", "w1")

    min_samples_split: int = 2
    min_samples_leaf: int = 1

    def may_split(self, s):
        return (s[0] >= self.min_samples_split) & (np.minimum(s[1], s[2]) > 0)

    @staticmethod
    def impurity(s):
        w = s[1] + s[2]
        return 2.0 * s[1] * (s[2] / np.maximum(w, 1)) / ONE

    def gain(self, left, right, total):
        ok = (np.minimum(left[0], right[0]) >= self.min_samples_leaf) & self.may_split(total)
        return np.where(ok, np.maximum(self.impurity(total) - self.impurity(left) - self.impurity(right), 0.0), -np.inf)

    def value(self, s):
        return s[2] / np.maximum(s[1] + s[2], 1)

    def cover(self, s):
        return (s[1] + s[2]) / ONE


def best_splits(rule, key: np.ndarray, stats: np.ndarray, n_nodes: int):
    """(node, slot, bin, gain, left statistics, total statistics) of each node's best
    split; ties: the lower slot, then the lower bin. Gain -inf: no split."""
    seg = key // BINS
    last = np.append(seg[1:] != seg[:-1], True)[:len(seg)]
    ends = np.flatnonzero(last)
    which = np.cumsum(last) - last
    run = np.cumsum(stats, axis=1)
    base = np.concatenate([np.zeros((len(stats), 1), np.int64), run[:, ends[:-1]]], axis=1)
    whole = run[:, ends] - base
    total, left = whole[:, which], run - base[:, which]
    gain = rule.gain(left, total - left, total)
    gain[last] = -np.inf
    start = np.append(0, ends[:-1] + 1)
    top = np.maximum.reduceat(gain, start)
    hit = np.flatnonzero(gain == top[which])
    at = hit[np.searchsorted(which[hit], np.arange(len(ends)))]
    # of a node's columns the best one, the first of equals
    slot, node = seg[ends] // n_nodes, seg[ends] % n_nodes
    order = np.lexsort((slot, -top, node))
    best = order[np.flatnonzero(np.append(True, np.diff(node[order]) != 0))]
    return node[best], slot[best], key[at[best]] % BINS, top[best], left[:, at[best]], whole[:, best]


def without_split(rule, found) -> np.ndarray:
    """Nodes that found no split among the columns tried, though the rule allows one."""
    return found[0][(found[3] == -np.inf) & rule.may_split(found[5])]


# --- trees --------------------------------------------------------------------------------------


@dataclass
class Trees:
    """Structure of arrays of many trees: a split has ``feature`` >= 0, goes left for bins up to
    ``cut``, and its children are ``left`` and ``left`` + 1 (counted within the tree)."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    start: np.ndarray  # first node of every tree, and the number of nodes
    depth: int = 0
    _walk: tuple | None = field(default=None, repr=False, compare=False)   # made when first used
    _masks: tuple | None = field(default=None, repr=False, compare=False)

    ARRAYS = ("feature", "cut", "left", "value", "cover", "gain", "start")

    @staticmethod
    def join(parts: list[Trees]) -> Trees:
        off = np.cumsum([0, *[p.start[-1] for p in parts]])
        cat = {k: np.concatenate([getattr(p, k) for p in parts]) for k in Trees.ARRAYS[:-1]}
        start = np.concatenate([*[p.start[:-1] + o for p, o in zip(parts, off)], off[-1:]])
        return Trees(**cat, start=start, depth=max(p.depth for p in parts))

    def groups(self, n: int) -> list[Trees]:
        out = []
        for lo in range(0, len(self.start) - 1, n):
            s = self.start[lo:lo + n + 1]
            out.append(Trees(**{k: getattr(self, k)[s[0]:s[-1]] for k in self.ARRAYS[:-1]}, start=s - s[0],
                             depth=self.depth))
        return out

    def walk(self) -> tuple[np.ndarray, ...]:
        """(feature, cut, left child) of every node, where a leaf leads to itself."""
        if self._walk is None:
            inner = self.feature >= 0
            nodes = np.arange(len(inner))
            tree = np.repeat(self.start[:-1], np.diff(self.start))
            self._walk = (np.maximum(self.feature, 0).astype(np.int64), np.where(inner, self.cut, BINS),
                          np.where(inner, tree + self.left, nodes))
        return self._walk

    def leaves(self, bins: np.ndarray, t: int) -> np.ndarray:
        """The leaf of every row in tree ``t``."""
        feature, cut, left = self.walk()
        n, flat = bins.shape[1], np.ascontiguousarray(bins).ravel()
        out = np.full(n, self.start[t])
        if self.feature[self.start[t]] < 0:
            return out
        for lo in range(0, n, BLOCK):
            at = out[lo:lo + BLOCK]
            rows = np.arange(lo, lo + len(at))
            for _ in range(self.depth):
                at = left.take(at) + (flat.take(feature.take(at) * n + rows) > cut.take(at))
            out[lo:lo + BLOCK] = at
        return out

    def masks(self, p: int) -> tuple[np.ndarray, list, np.ndarray, np.ndarray]:
        """For trees of up to 64 leaves: words (tree, feature, bin) of the leaves that a row can
        reach, each tree's features, values (tree, leaf from left to right), and which trees these are."""
        if self._masks is None:
            n_trees, inner = len(self.start) - 1, self.feature >= 0
            tree = np.repeat(np.arange(n_trees), np.diff(self.start))
            left = self.walk()[2]
            level, here = [], self.start[:-1]
            while len(here):
                level.append(here)
                split = here[inner[here]]
                here = np.concatenate([left[split], left[split] + 1])
            leaves, first = np.ones(len(inner), np.int64), np.zeros(len(inner), np.int64)
            for nodes in level[::-1]:
                split = nodes[inner[nodes]]
                leaves[split] = leaves[left[split]] + leaves[left[split] + 1]
            for nodes in level:
                split = nodes[inner[nodes]]
                first[left[split]] = first[split]
                first[left[split] + 1] = first[split] + leaves[left[split]]
            small = leaves[self.start[:-1]] <= 64
            words = np.full((n_trees if small.any() else 0, p, BINS), ~np.uint64(0))
            split = np.flatnonzero(inner & small[tree])
            used = np.zeros((n_trees, p), bool)
            used[tree[split], self.feature[split]] = True
            split = split[self.cut[split] < BINS - 1]
            one = np.uint64(1)  # the left side has at most 63 leaves
            gone = ((one << leaves[left[split]].astype(np.uint64)) - one) << first[left[split]].astype(np.uint64)
            np.bitwise_and.at(words, (tree[split], self.feature[split], self.cut[split] + 1), ~gone)
            np.bitwise_and.accumulate(words, axis=2, out=words)
            values = np.zeros((n_trees, 64))
            leaf = np.flatnonzero(~inner & small[tree])
            values[tree[leaf], first[leaf]] = self.value[leaf]
            self._masks = words, [np.flatnonzero(u).tolist() for u in used], values, small
        return self._masks

    def total(self, bins: np.ndarray) -> np.ndarray:
        """Sum of the leaves' values of every row, tree after tree."""
        n, out = bins.shape[1], np.zeros(bins.shape[1])
        words, used, values, small = self.masks(len(bins))
        word, more = np.empty(BLOCK, np.uint64), np.empty(BLOCK, np.uint64)
        for lo in range(0, n, BLOCK):
            part = bins[:, lo:lo + BLOCK].astype(np.int64)
            sums, k = out[lo:lo + BLOCK], part.shape[1]
            v, m = word[:k], more[:k]
            for t in range(len(small)):
                if not small[t]:
                    sums += self.value.take(self.leaves(bins[:, lo:lo + BLOCK], t))
                    continue
                if not used[t]:
                    sums += values[t, 0]
                    continue
                for i, f in enumerate(used[t]):
                    words[t, f].take(part[f], out=m if i else v, mode="clip")
                    if i:
                        np.bitwise_and(v, m, out=v)
                # bits below the first one that is set: as many as its place
                np.subtract(v, np.uint64(1), out=m)
                np.bitwise_and(m, np.invert(v, out=v), out=m)
                sums += values[t].take(np.bitwise_count(m))
        return out

    def pack(self) -> bytes:
        buf = io.BytesIO()
        np.savez(buf, depth=self.depth, **{k: getattr(self, k) for k in self.ARRAYS})
        return buf.getvalue()

    @staticmethod
    def unpack(data: bytes) -> Trees:
        with np.load(io.BytesIO(data)) as z:
            return Trees(**{k: z[k] for k in Trees.ARRAYS}, depth=int(z["depth"]))


class Plan:
    """A tree under construction: a level's splits make the next level's nodes."""

    def __init__(self, rule, max_depth: int, columns: Callable[[Plan], tuple[np.ndarray, ...]], level: int = 0,
                 path: np.ndarray | None = None):
        self.rule, self.max_depth, self.columns = rule, max_depth, columns
        self.level = level
        self.path = np.ones(1, np.uint64) if path is None else path   # hashes of the ways to this level's nodes
        self.stats = None                                             # their statistics; None: the root's
        self.parts = {k: [] for k in ("feature", "cut", "left", "value", "cover", "gain")}
        self.first, self.n = 0, 1   # this level's nodes
        self.size = 1
        self._node_rows(None)

    def _node_rows(self, stats) -> None:
        n = self.n
        fill = {"feature": np.full(n, -1, np.int16), "cut": np.zeros(n, np.int16), "left": np.zeros(n, np.int32),
                "gain": np.zeros(n, np.float32),
                "value": np.zeros(n, np.float32) if stats is None else self.rule.value(stats).astype(np.float32),
                "cover": np.zeros(n, np.float32) if stats is None else self.rule.cover(stats).astype(np.float32)}
        for k, v in fill.items():
            self.parts[k].append(v)

    def tries(self) -> tuple[np.ndarray, ...]:
        """The columns to try: a matrix (node, slot) a time, later ones for nodes that found no split."""
        return self.columns(self)

    def split(self, found: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Take the best splits of this level's nodes, by tries; go on to their children.

        Returns feature (-1: a leaf), bin and left child of each node of the level.
        """
        feature, cut, left = np.full(self.n, -1), np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        gain, total = np.zeros(self.n), None
        lefts = None
        for cols, (node, slot, b, g, ls, ts) in found:
            if total is None:
                total = np.zeros((len(ts), self.n), np.int64)
                lefts = np.zeros((len(ts), self.n), np.int64)
            new = (feature[node] < 0) & (g > -np.inf)
            total[:, node] = ts
            n = node[new]
            feature[n], cut[n], gain[n] = cols[n, slot[new]], b[new], g[new]
            lefts[:, n] = ls[:, new]
        if len(self.parts["value"]) == 1 and total is not None:
            self.parts["value"][0] = self.rule.value(total).astype(np.float32)
            self.parts["cover"][0] = self.rule.cover(total).astype(np.float32)
        has = np.flatnonzero(feature >= 0)
        left[has] = self.size + 2 * np.arange(len(has))
        for k, v in (("feature", feature), ("cut", cut), ("left", left), ("gain", gain)):
            self.parts[k][-1] = v.astype(self.parts[k][-1].dtype)
        self.first, self.n = self.size, 2 * len(has)
        self.level += 1
        self.path = scramble(np.repeat(self.path[has], 2) * np.uint64(2) + np.arange(self.n, dtype=np.uint64) % np.uint64(2))
        if len(has):
            child = np.empty((len(total), self.n), np.int64)
            child[:, 0::2], child[:, 1::2] = lefts[:, has], total[:, has] - lefts[:, has]
            self.stats = child
            self.size += self.n
            self._node_rows(child)
        return feature, cut, left

    @property
    def open(self) -> bool:
        return self.n > 0 and self.level < self.max_depth

    def tree(self) -> Trees:
        return Trees(**{k: np.concatenate(v) for k, v in self.parts.items()}, start=np.array([0, self.size]),
                     depth=max(self.level, 1))


def grow(bins: np.ndarray, stats: np.ndarray, plan: Plan, node: np.ndarray | None = None) -> tuple[Trees, np.ndarray]:
    """A tree over rows in memory, all with a positive first statistic, and the leaf of every row.

    ``node``: the rows' nodes in the plan's level, if that is not the root's.
    """
    n = bins.shape[1]
    leaf = np.zeros(n, np.int64)
    rows, b, s = np.arange(n), bins, stats.astype(float)
    node = np.zeros(n, np.int64) if node is None else node
    while plan.open and len(rows):
        found, left_over = [], None
        for cols in plan.tries():
            if left_over is None:
                key, total = cells(b, node, cols, s, plan.n)
            else:
                mine = np.flatnonzero(np.isin(node, left_over))
                key, total = cells(b[:, mine], node[mine], cols, s[:, mine], plan.n)
            got = best_splits(plan.rule, key, total, plan.n)
            found.append((cols, got))
            left_over = without_split(plan.rule, got)
            if not len(left_over):
                break
        feature, cut, left = plan.split(found)
        go = (feature >= 0)[node]
        if not go.all():
            rows, node, b, s = rows[go], node[go], b[:, go], s[:, go]
        f = feature[node]
        right = b.ravel().take(f * b.shape[1] + np.arange(len(node))) > cut[node]
        child = left[node] + right
        leaf[rows] = child
        node = child - plan.first
    return plan.tree(), leaf


def dense_splits(rule: Boost, cells: np.ndarray, starts: np.ndarray):
    """:func:`best_splits` of dense cells (statistic, node, bin), the tried columns' bins side by side."""
    n, width = cells.shape[1:]
    ends, step = np.append(starts[1:], width), max(1, 4 * BLOCK // width)
    best, top, lefts, totals = np.empty(n, np.int64), np.empty(n), np.empty((2, n)), np.empty((2, n))
    for lo in range(0, n, step):
        here = slice(lo, lo + step)
        left = np.empty_like(cells[:, here])
        for a, b in zip(starts, ends):
            np.cumsum(cells[:, here, a:b], axis=2, out=left[:, :, a:b])
        total = left[:, :, ends[0] - 1:ends[0]].copy()
        gain = rule.gain(left, total - left, total)
        at, nodes = gain.argmax(axis=1), np.arange(len(gain))
        best[here], top[here], lefts[:, here], totals[:, here] = at, gain[nodes, at], left[:, nodes, at], total[:, :, 0]
    slot = np.searchsorted(starts, best, "right") - 1
    return np.arange(n), slot, best - starts[slot], top, lefts.astype(np.int64), totals.astype(np.int64)


class Grower:
    """Trees over the same rows and bins, whose nodes try the same columns at every place."""

    def __init__(self, bins: np.ndarray):
        p, n = bins.shape
        self.bins = bins
        self.flat = np.ascontiguousarray(bins.T).ravel()          # a row's bins side by side
        self.widths = bins.max(axis=1, initial=0).astype(np.int64) + 1
        self.places = np.arange(min(BLOCK, n)) * p
        self.at = np.empty(n, np.int64)
        self.index, self.key = np.empty(min(BLOCK, n), np.int64), np.empty(n, np.int64)
        self.stats, self.slot = np.empty((2, n)), np.empty(n, np.int64)
        self.bin = np.empty(n, np.uint8)

    def step(self, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> None:
        """All rows go on to their next node; leaves lead to themselves."""
        n, p = len(self.at), len(self.bins)
        for lo in range(0, n, BLOCK):
            at = self.at[lo:lo + BLOCK]
            k = len(at)
            index, b = self.index[:k], self.bin[:k]
            feature.take(at, out=index, mode="clip")
            index += self.places[:k]
            self.flat[lo * p:(lo + k) * p].take(index, out=b, mode="clip")
            right = b > cut.take(at)
            left.take(at, out=index, mode="clip")
            np.add(index, right, out=at)

    def count(self, stats: np.ndarray, cols: np.ndarray, slot_of: np.ndarray | None, drawn: np.ndarray,
              n_nodes: int) -> np.ndarray:
        """Cells (statistic, slot, bin) of the drawn rows in nodes that have a slot; None: of all rows."""
        widths = self.widths[cols]
        starts = np.cumsum(widths) - widths
        out = np.empty((2, n_nodes, int(widths.sum())))
        if slot_of is None:
            k, (h, g) = len(self.at), stats
        else:
            rows = np.flatnonzero((slot_of >= 0).take(self.at) & drawn)
            k = len(rows)
            h, g = self.stats[0, :k], self.stats[1, :k]
            stats[0].take(rows, out=h, mode="clip")
            stats[1].take(rows, out=g, mode="clip")
            slot = self.slot[:k]
            slot_of.take(self.at.take(rows, out=self.key[:k], mode="clip"), out=slot, mode="clip")
        key, b = self.key[:k], self.bin[:k]
        for f, w, a in zip(cols, widths, starts):
            if slot_of is None:
                key[:] = self.bins[f]
            else:
                np.multiply(slot, w, out=key)
                self.bins[f].take(rows, out=b, mode="clip")
                key += b
            for i, s in enumerate((h, g)):
                out[i, :, a:a + w] = np.bincount(key, weights=s, minlength=n_nodes * w).reshape(n_nodes, w)
        return out

    def grow(self, stats: np.ndarray, plan: Plan) -> tuple[Trees, np.ndarray]:
        """The tree of :func:`grow` over the rows with a positive first statistic, and all rows' leaves.
        Other rows have statistics of zero."""
        n, drawn = len(self.at), stats[0] > 0
        self.at[:] = 0
        if not drawn.any():
            return plan.tree(), self.at
        (tried,) = plan.tries()
        cols = tried[0]
        widths = self.widths[cols]
        starts = np.cumsum(widths) - widths
        cells = None
        while plan.open:
            if plan.n * widths.sum() > 32 * max(n, 1024):  # few rows a cell: sorted
                mine = np.flatnonzero(drawn & (self.at >= plan.first))
                tree, _ = grow(self.bins[:, mine], stats[:, mine], plan, self.at[mine] - plan.first)
                return tree, tree.leaves(self.bins, 0)
            if cells is None:
                cells = self.count(stats, cols, None, drawn, 1)
            first, level = plan.first, plan.n
            found = dense_splits(plan.rule, cells, starts)
            feature, cut, left = plan.split([(np.broadcast_to(cols, (level, len(cols))), found)])
            has = np.flatnonzero(feature >= 0)
            if not len(has):
                break
            nodes = np.arange(plan.size)
            table = np.zeros(plan.size, np.int64), np.full(plan.size, BINS - 1, np.uint8), nodes
            table[0][first + has], table[1][first + has], table[2][first + has] = feature[has], cut[has], left[has]
            self.step(*table)
            if not plan.open:
                break
            # of two children the lesser is counted, the other is what is left
            least = (2 * found[4][0, has] > found[5][0, has]).astype(np.int64)
            slot_of = np.full(plan.size, -1)
            slot_of[left[has] + least] = np.arange(len(has))
            some = self.count(stats, cols, slot_of, drawn, len(has))
            parents, cells = cells[:, has], np.empty((2, plan.n, cells.shape[2]))
            mine = 2 * np.arange(len(has)) + least
            cells[:, mine] = some
            cells[:, mine ^ 1] = np.subtract(parents, some, out=parents)
        return plan.tree(), self.at


def boost_plan(params: Mapping, p: int, seed: int, turn: int) -> Plan:
    """The tree of a round: its columns are drawn once."""
    rule = Boost(float(params.get("reg_lambda", 1.0)), float(params.get("reg_alpha", 0.0)),
                 float(params.get("gamma", 0.0)), float(params.get("min_child_weight", 1.0)))
    m = max(1, int(p * float(params.get("colsample_bytree", 1.0))))
    cols = np.sort(np.argsort(uniform(np.arange(p), seed, turn, 1), kind="stable")[:m])[None, :]
    return Plan(rule, int(params.get("max_depth", 6)), lambda plan: (np.broadcast_to(cols, (plan.n, m)),))


def forest_plan(params: Mapping, p: int, seed: int, tree: int, level: int = 0, path: np.ndarray | None = None) -> Plan:
    """A tree of a forest, or what is below one of its nodes: sqrt(p) columns for every node, drawn by
    its path from the root; all, if they have no split."""
    rule = Gini(int(params.get("min_samples_split", 2)), int(params.get("min_samples_leaf", 1)))
    m = max(1, int(p ** 0.5))

    def columns(plan: Plan):
        n, at = plan.n, scramble(plan.path)[:, None] + np.arange(p, dtype=np.uint64)
        u = uniform(at.ravel(), seed, tree, 2).reshape(n, p)
        some = np.sort(np.argsort(u, axis=1, kind="stable")[:, :m], axis=1)
        return (some, np.broadcast_to(np.arange(p), (n, p))) if m < p else (some,)

    return Plan(rule, int(params.get("max_depth", 2 ** 20)), columns, level, path)


def boost_stats(params: Mapping, seed: int, turn: int, rid, y, weight, margin) -> np.ndarray:
    """(hessian, gradient) of every row in a round; zeros for rows that are not drawn."""
    part = float(params.get("subsample", 1.0))
    out = np.empty((2, len(y)))
    for lo in range(0, len(y), BLOCK):
        at = slice(lo, lo + BLOCK)
        w, prob = weight[at], 1.0 / (1.0 + np.exp(-margin[at]))
        out[0, at] = np.maximum(np.rint(w * prob * (1 - prob) * ONE), 1)
        out[1, at] = np.rint(w * (prob - y[at]) * ONE)
        if part < 1:
            out[:, at] *= uniform(rid[at], seed, turn, 0) < part
    return out


#: Chances of 0, 1, 2, ... copies of a row in a bag (Poisson, mean 1), added up.
BAG = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1, dtype=float)) for k in range(12)])


def forest_stats(seed: int, tree: int, rid, y, weight) -> np.ndarray:
    """(rows, weight of class 0, weight of class 1) with the row's copies in a tree's bag."""
    copies = np.searchsorted(BAG, uniform(rid, seed, tree, 3), "right")
    w = np.rint(weight * copies * ONE).astype(np.int64)
    return np.stack([(copies > 0).astype(np.int64), np.where(y > 0, 0, w), np.where(y > 0, w, 0)])


def class_weights(kind: str, neg: int, pos: int) -> tuple[float, float]:
    """Weights of class 0 and 1: boosting weighs positives by neg / pos, a forest balances."""
    if kind == "boosted":
        return 1.0, neg / max(pos, 1)
    return (neg + pos) / (2 * max(neg, 1)), (neg + pos) / (2 * max(pos, 1))


# --- models ---------------------------------------------------------------------------------------


@dataclass
class TreeModel:
    kind: str
    features: list[str]
    cuts: list[np.ndarray]
    trees: Trees
    rate: float = 1.0
    rows: int = 0          # fitted rows
    params: dict = field(default_factory=dict)

    def probability(self, total: np.ndarray) -> np.ndarray:
        if self.kind == "boosted":
            return 1.0 / (1.0 + np.exp(-total))
        return total / max(len(self.trees.start) - 1, 1)

    def importances(self) -> np.ndarray:
        """A feature's share of the gain: boosting, the mean gain of its splits; a forest, the
        mean over its trees of the share of the impurity decrease."""
        t, p = self.trees, len(self.features)
        inner = t.feature >= 0
        if self.kind == "boosted":
            n = np.bincount(t.feature[inner], minlength=p)
            out = np.bincount(t.feature[inner], weights=t.gain[inner], minlength=p) / np.maximum(n, 1)
        else:
            tree = np.repeat(np.arange(len(t.start) - 1), np.diff(t.start))[inner]
            per = np.zeros((len(t.start) - 1, p))
            np.add.at(per, (tree, t.feature[inner]), t.gain[inner])
            out = (per / np.maximum(per.sum(1, keepdims=True), 1e-300)).mean(0)
        return out / max(out.sum(), 1e-300)


def matrix(table, names: Sequence[str]) -> np.ndarray:
    """Feature columns of an Arrow table or batch as doubles, nulls as NaN."""
    cols = [np.asarray(table.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False), float)
            if isinstance(table, pa.RecordBatch) else np.asarray(table.column(c).cast(pa.float64()).to_numpy(), float)
            for c in names]
    return np.stack(cols, axis=1) if cols else np.zeros((table.num_rows, 0))


def labelled(df: DataFrame, features: Sequence[str], label: str, fold: str | None) -> DataFrame:
    """(f0, f1, ..., y, rid, fold) of the rows that have a label."""
    rid = F.xxhash64(*[F.col(f"`{c}`").cast("double") for c in features], F.col(label).cast("int"))
    return df.where(F.col(label).isNotNull()).select(
        *[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)],
        F.col(label).cast("int").alias("y"), rid.alias("rid"),
        (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"))


def fit_rows_of(df: DataFrame, features: Sequence[str], label: str, fold: str | None, fit_rows: int | None, seed: int):
    """(features, labels, row hashes, folds) of all labelled rows in memory, in the order of the
    hashes and values; of about ``fit_rows`` of them by a seeded hash, if a caller asks for that."""
    x = labelled(df, features, label, fold)
    if fit_rows is not None and (n := x.count()) > fit_rows:
        x = x.where(F.pmod(F.xxhash64("rid", F.lit(seed)), F.lit(1 << 30)) < int(fit_rows / n * (1 << 30)))
    t = x.toArrow()
    names = [f"f{i}" for i in range(len(features))]
    data, y, rid, fold = matrix(t, names), t["y"].to_numpy(), t["rid"].to_numpy(), t["fold"].to_numpy()
    order = np.lexsort((fold, y, *data.T[::-1], rid))
    return data[order], y[order].astype(np.int64), rid[order], fold[order]


@dataclass(frozen=True)
class Fit:
    """One model to fit: of kind ``boosted`` or ``forest``, without the rows of fold ``leave_out``."""

    kind: str
    params: Mapping
    leave_out: int | None = None
    seed: int = 42


def _boosted(fit: Fit, bins, y, rid) -> Trees:
    """All rounds of one model; ``value`` holds the shrunken leaf weights."""
    w0, w1 = class_weights("boosted", int((y == 0).sum()), int((y == 1).sum()))
    weight = np.where(y > 0, w1, w0)
    margin, out = np.zeros(len(y)), []
    rate = np.float32(fit.params.get("learning_rate", 0.3))
    grower = Grower(bins)
    for turn in range(int(fit.params.get("n_estimators", 100))):
        stats = boost_stats(fit.params, fit.seed, turn, rid, y, weight, margin)
        tree, at = grower.grow(stats, boost_plan(fit.params, len(bins), fit.seed, turn))
        tree.value = tree.value * rate
        margin += tree.value.take(at)
        out.append(tree)
    return Trees.join(out)


def _forest(fit: Fit, bins, y, rid, trees: range) -> Trees:
    w0, w1 = class_weights("forest", int((y == 0).sum()), int((y == 1).sum()))
    weight = np.where(y > 0, w1, w0)
    out = []
    for t in trees:
        stats = forest_stats(fit.seed, t, rid, y, weight)
        bag = stats[0] > 0
        out.append(grow(bins[:, bag], stats[:, bag], forest_plan(fit.params, len(bins), fit.seed, t))[0])
    return Trees.join(out)


def auc_and_precision(y: np.ndarray, s: np.ndarray) -> tuple[float | None, float | None]:
    """ROC-AUC (ties half) and step-rule average precision; None without both classes."""
    pos = int((y > 0).sum())
    if pos == 0 or pos == len(y):
        return None, None
    order = np.argsort(-s, kind="stable")
    end = np.flatnonzero(np.append(np.diff(s[order]) != 0, True))
    tp = np.cumsum(y[order] > 0)[end].astype(float)
    fp = (end + 1) - tp
    neg = len(y) - pos
    dt, df = np.diff(tp, prepend=0), np.diff(fp, prepend=0)
    return float((df * (tp - dt / 2)).sum() / (pos * neg)), float((dt * tp / (end + 1)).sum() / pos)


def fit_many(df: DataFrame, features: Sequence[str], label: str, fits: Sequence[Fit], fold: str | None = None,
             fit_rows: int | None = None, seed: int = 42, models: bool = True):
    """Fit many models on all labelled rows; ``fit_rows``: on about so many of them.

    Rows that a worker has the memory for (``MEMORY_BYTES``) are broadcast, and
    a boosted model or ``GROUP`` trees are a task; of others ``steps.fit_all``
    makes the same trees, where the rows are.

    Returns a :class:`TreeModel` for each fit; or, with ``models=False``, for
    each (ROC-AUC, average precision) on the rows of the fold that it leaves
    out. A label that is null leaves a row out. Bins are cut from a fit's own
    rows. Lost tasks are made again, with the same trees.
    """
    spark = df.sparkSession
    share_package(spark)
    if fit_rows is None:
        counts = classes_of(df, label, fold)
        if sum(a + b for a, b in counts.values()) * (9 * len(features) + 110) > MEMORY_BYTES:
            return _fit_where_rows_are(df, features, label, fits, fold, counts, models)
    x, y, rid, folds = fit_rows_of(df, features, label, fold, fit_rows, seed)
    data = spark.sparkContext.broadcast((x, y, rid, folds))
    work = []
    for i, f in enumerate(fits):
        n = int(f.params.get("num_trees", 100))
        if f.kind == "boosted" or not models:
            work.append((i, range(n)))
        else:
            work += [(i, range(a, min(a + GROUP, n))) for a in range(0, n, GROUP)]
    # the longest fits first, so that no core is left with one at the end
    work.sort(key=lambda w: -float(fits[w[0]].params.get("n_estimators", 100)) * float(fits[w[0]].params.get("max_depth", 6)))

    def run(batches):
        x, y, rid, folds = data.value
        for b in batches:
            for k in b.column(0).to_pylist():
                i, trees = work[k]
                f = fits[i]
                mine = folds != f.leave_out if f.leave_out is not None else np.ones(len(y), bool)
                cuts = bin_cuts(x[mine])
                bins = binned(x[mine], cuts)
                made = _boosted(f, bins, y[mine], rid[mine]) if f.kind == "boosted" else _forest(
                    f, bins, y[mine], rid[mine], trees)
                auc = ap = None
                if not models:
                    total = made.total(binned(x[~mine], cuts))
                    auc, ap = auc_and_precision(y[~mine], total)
                yield pa.RecordBatch.from_arrays([
                    pa.array([k], pa.int64()), pa.array([made.pack() if models else None], pa.binary()),
                    pa.array([auc], pa.float64()), pa.array([ap], pa.float64())], names=["k", "trees", "auc", "ap"])

    rows = spark.range(0, len(work), 1, max(len(work), 1)).mapInArrow(
        run, "k bigint, trees binary, auc double, ap double").collect()
    got = {r["k"]: r for r in rows}
    out = []
    for i, f in enumerate(fits):
        mine = [k for k, (j, _) in enumerate(work) if j == i]
        if not models:
            out.append((got[mine[0]]["auc"], got[mine[0]]["ap"]))
            continue
        keep = folds != f.leave_out if f.leave_out is not None else np.ones(len(y), bool)
        out.append(TreeModel(f.kind, list(features), bin_cuts(x[keep]), Trees.join(
            [Trees.unpack(bytes(got[k]["trees"])) for k in mine]), rows=int(keep.sum()), params=dict(f.params)))
    data.unpersist()
    return out


# --- any number of rows ----------------------------------------------------------------------------


def classes_of(df: DataFrame, label: str, fold: str | None) -> dict[int, tuple[int, int]]:
    """Rows of class 0 and 1 of each fold."""
    y = F.col(label).cast("int")
    rows = df.where(F.col(label).isNotNull()).groupBy((F.col(fold).cast("int") if fold else F.lit(0)).alias("fold")).agg(
        F.count_if(y <= 0).alias("neg"), F.count_if(y > 0).alias("pos")).collect()
    return {r["fold"]: (r["neg"], r["pos"]) for r in rows}


def _fit_where_rows_are(df, features, label, fits, fold, counts, models):
    from cohortix.operators import steps

    made = steps.fit_all(labelled(df, features, label, fold), features, fits, counts)
    if models:
        return made
    from cohortix.operators import metrics

    # fits that leave out different folds, and so score different rows, go together
    groups: list[dict] = []
    for i, f in enumerate(fits):
        group = next((g for g in groups if f.leave_out not in g), None)
        if group is None:
            groups.append(group := {})
        group[f.leave_out] = i
    out = [(None, None)] * len(fits)
    rows = df.where(F.col(label).isNotNull())
    for g in groups:
        scored = score({k: made[i] for k, i in g.items()}, rows, [label, fold], by=fold, raw=True).where(
            F.col(fold).isin(list(g)))
        for r in metrics.evaluate(scored, label, SCORE, 0.0, by=[fold]).collect():
            out[g[r[fold]]] = r["roc_auc"], r["average_precision"]
    return out


def fit_distributed(df: DataFrame, features: Sequence[str], label: str, fit: Fit, checkpoint_every: int = 10) -> TreeModel:
    """The model of ``fit`` from all labelled rows, however few, the way of ``steps``.

    ``checkpoint_every`` is not needed: rows' state is made again from the trees where it is lost.
    """
    return _fit_where_rows_are(df, features, label, [fit], None, classes_of(df, label, None), True)[0]


# --- scores, importances, files -------------------------------------------------------------------


def bundles(batches, size: int = BUNDLE):
    """Arrow batches joined to ``size`` rows or more, but for the last."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def score(models: TreeModel | Mapping[int, TreeModel], df: DataFrame, keep: Sequence[str] = (),
          by: str | None = None, raw: bool = False) -> DataFrame:
    """``keep`` and ``score`` = P(y = 1) of every row, in one pass; ``raw``: the sum of the trees' values.

    With ``by``, each row goes to the model of its value in that column (a
    fold's own model); rows without a model have a null score. The trees are
    broadcast in groups of ``10 * GROUP``: their number of nodes is bounded by
    the fitted rows and the number of trees, not by ``df``.
    """
    spark = df.sparkSession
    share_package(spark)
    named = models if by else {None: models}
    first = next(iter(named.values()))
    sc = spark.sparkContext
    sent = {k: (m.cuts, [sc.broadcast(g) for g in m.trees.groups(10 * GROUP)], m.kind, len(m.trees.start) - 1)
            for k, m in named.items()}
    names = [f"_f{i}" for i in range(len(first.features))]

    def run(batches):
        for b in bundles(batches):
            x = matrix(b, names)
            out = np.full(b.num_rows, np.nan)
            which = b.column("_by").to_numpy(zero_copy_only=False) if by else None
            for k, (cuts, groups, kind, n) in sent.items():
                mine = np.flatnonzero(which == k) if by else np.arange(b.num_rows)
                if len(mine):
                    bins = binned(x[mine], cuts)
                    total = np.zeros(len(mine))
                    for g in groups:
                        total += g.value.total(bins)
                    out[mine] = total if raw else 1.0 / (1.0 + np.exp(-total)) if kind == "boosted" else total / max(n, 1)
            yield pa.RecordBatch.from_arrays([*[b.column(f"_k{i}") for i in range(len(keep))],
                                              pa.array(out, pa.float64(), from_pandas=True)], names=[*keep, SCORE])

    src = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
                    *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(first.features, names)],
                    *([F.col(by).cast("int").alias("_by")] if by else []))
    schema = ", ".join([*[f"`{c}` {t}" for c, (_, t) in zip(keep, src.dtypes)], f"{SCORE} double"])
    return src.mapInArrow(run, schema)


def importance(model: TreeModel, spark: SparkSession, top: int | None = None) -> DataFrame:
    """Gain importances, largest first, optionally the ``top`` first."""
    rows = [(f, float(v)) for f, v in zip(model.features, model.importances())]
    df = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return df.limit(top) if top else df


def save(model: TreeModel, spark: SparkSession, path: str) -> None:
    """Write a model as a Parquet table: its settings and a row per group of trees."""
    head = json.dumps({"kind": model.kind, "features": model.features, "rows": model.rows, "params": model.params,
                       "cuts": [c.tolist() for c in model.cuts]})
    rows = [(-1, bytearray(head.encode()))] + [
        (i, bytearray(g.pack())) for i, g in enumerate(model.trees.groups(10 * GROUP))]
    spark.createDataFrame(rows, "part int, data binary").write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> TreeModel:
    rows = spark.read.parquet(path).orderBy("part").collect()
    head = json.loads(bytes(rows[0]["data"]))
    return TreeModel(head["kind"], head["features"], [np.array(c, float) for c in head["cuts"]],
                     Trees.join([Trees.unpack(bytes(r["data"])) for r in rows[1:]]), rows=head["rows"],
                     params=head["params"])
