"""Tree ensembles from all rows of tables that are too large for one worker.

The trees are those of ``trees.fit_many`` in memory; rows stay in partitions.

* Cuts are exact quantiles of all rows, for every left-out fold. Each rank has a
  bracket of values (as ordered 64-bit keys); a pass counts the brackets' buckets
  and keeps those with a rank, until few values are left, which are read.
* The rows' state is their bins: one byte a feature, in blocks of ``BLOCK_ROWS`` rows.
* Boosted fits of a wave go on together. A job is one level of a tree of each of
  them: tasks count the cells of their rows, cells are added up by node, and the
  driver gets a row per node, its best split.
* What a task needs again (a fit's margins, statistics, nodes) is in a scratch file
  of the machine, which is only a cache: a task that does not find it, or finds
  another turn, says so, and the job is run again with all trees so far, from which
  it is made anew. ``STATE_BYTES`` bounds what a wave keeps.
* A forest's trees grow by levels, cells being keyed by node and column, until a
  node has ``LOCAL_ROWS`` rows of the bag at most; then its rows go to one task,
  which grows what is below. ``STATE_BYTES`` bounds the rows that travel at once.
"""

from __future__ import annotations

import contextlib
import fcntl
import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession

from cohortix.operators import trees as T
from cohortix.operators.trees import BINS, Fit, TreeModel, Trees
from cohortix.session import share_package, sweep

#: Bytes of state, over all machines, that the fits of a wave keep on disk.
STATE_BYTES = 8 << 30
#: Rows of a partition and of a block of the state, about.
PART_ROWS, BLOCK_ROWS = 1 << 20, 1 << 14
#: Rows of a forest's node that one task takes to the end.
LOCAL_ROWS = 1 << 20
#: Buckets of a pass over the whole range and over a bracket; values of a feature that are read.
COARSE, FINE, FEW = 4096, 64, 1 << 16
#: Bytes of a level's cells, over all partitions, that the driver adds up itself.
DRIVER_BYTES = 32 << 20
#: Bytes of a fit's scratch a row: margin, two statistics, node.
ROW_BYTES = 28

#: Bytes of shuffled cells and rows after which the files of those no longer needed are dropped.
SWEEP_BYTES = 1 << 30

_FREE = threading.Condition()
_TAKEN = [0, 0]  # bytes of the states in use; bytes shuffled since the last sweep


@contextlib.contextmanager
def room(n: int):
    """Wait until the state of ``n`` bytes fits beside those of other threads, or until it is alone."""
    with _FREE:
        _FREE.wait_for(lambda: not _TAKEN[0] or _TAKEN[0] + n <= STATE_BYTES)
        _TAKEN[0] += n
    try:
        yield
    finally:
        with _FREE:
            _TAKEN[0] -= n
            _FREE.notify_all()


def _shuffled(spark: SparkSession, n: int) -> None:
    """``n`` more bytes went through a shuffle that is done with."""
    with _FREE:
        _TAKEN[1] += n
        full = _TAKEN[1] >= SWEEP_BYTES
        if full:
            _TAKEN[1] = 0
    if full:
        sweep(spark)


# --- cuts -----------------------------------------------------------------------------------------


def order_keys(v: np.ndarray) -> np.ndarray:
    """64-bit keys in the order of the values; both zeros are one."""
    u = (v + 0.0).view(np.uint64)
    return np.where(u >> np.uint64(63), ~u, u | np.uint64(1 << 63))


def key_values(k: np.ndarray) -> np.ndarray:
    return np.where(k >> np.uint64(63), k & np.uint64((1 << 63) - 1), ~k).view(float)


def _batch(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def _blobs(arrays) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def _added(parts: DataFrame, *keys: str) -> DataFrame:
    """The int64 arrays ``a`` of equal keys, added up."""
    schema = ", ".join([*[f"{k} int" for k in keys], "a binary"])

    def run(batches):
        total = {}
        for b in batches:
            named = zip(*[b.column(k).to_pylist() for k in keys])
            for k, a in zip(named, b.column("a").to_pylist()):
                a = np.frombuffer(a, np.int64)
                if k in total:
                    total[k] += a
                else:
                    total[k] = a.copy()
        for k, a in total.items():
            yield _batch(**{n: pa.array([v], pa.int32()) for n, v in zip(keys, k)}, a=_blobs([a]))

    return parts.repartition(*keys).mapInArrow(run, schema)


class _Ranks:
    """The search for a feature's ranks: disjoint brackets [lo, hi] of keys, and per fold the values
    below each and in it."""

    def __init__(self, lo, hi, total: np.ndarray, targets: list[tuple[np.ndarray, np.ndarray]]):
        self.lo, self.hi = np.array([lo], np.uint64), np.array([hi], np.uint64)
        self.below, self.total = np.zeros((len(total), 1), np.int64), total[:, None]
        self.targets = targets  # of each set: which folds, ranks

    def open(self) -> np.ndarray:
        return np.flatnonzero(self.hi > self.lo)

    def places(self, below, total):
        """Of each set the bracket of every rank."""
        return [np.searchsorted(below[folds].sum(0), ranks, "right") - 1 for folds, ranks in self.targets]

    def keep(self, lo, hi, below, total) -> None:
        used = np.unique(np.concatenate([np.zeros(0, np.int64), *self.places(below, total)]))
        self.lo, self.hi, self.below, self.total = lo[used], hi[used], below[:, used], total[:, used]

    def steps(self, s: int) -> np.ndarray:
        return (self.hi - self.lo) // np.uint64(s) + np.uint64(1)

    def refine(self, counts: np.ndarray, s: int) -> None:
        """``counts``: (fold, open bracket, bucket)."""
        o, step = self.open(), self.steps(s)
        lo, hi, below, total = [], [], [], []
        for b in range(len(self.lo)):
            at = np.searchsorted(o, b)
            if at == len(o) or o[at] != b:
                parts = self.lo[b:b + 1], self.hi[b:b + 1], self.below[:, b:b + 1], self.total[:, b:b + 1]
            else:
                n = counts[:, at]
                some = np.flatnonzero(n.sum(0))
                first = self.lo[b] + some.astype(np.uint64) * step[b]
                run = np.cumsum(n, axis=1) - n + self.below[:, b:b + 1]
                parts = first, np.minimum(first + (step[b] - np.uint64(1)), self.hi[b]), run[:, some], n[:, some]
            for out, part in zip((lo, hi, below, total), parts):
                out.append(part)
        self.keep(np.concatenate(lo), np.concatenate(hi), np.concatenate(below, 1), np.concatenate(total, 1))

    def settle(self, keys: np.ndarray, n: np.ndarray) -> None:
        """``keys``: the sorted values of the open brackets; ``n``: their counts (fold, key)."""
        o = self.open()
        lo, hi = np.searchsorted(keys, self.lo[o]), np.searchsorted(keys, self.hi[o], "right")
        rest = np.setdiff1d(np.arange(len(self.lo)), o)
        parts = [(self.lo[rest], self.below[:, rest], self.total[:, rest])]
        for b, i, j in zip(o, lo, hi):
            run = np.cumsum(n[:, i:j], axis=1) - n[:, i:j] + self.below[:, b:b + 1]
            parts.append((keys[i:j], run, n[:, i:j]))
        k, below, total = np.concatenate([p[0] for p in parts]), *(
            np.concatenate([p[i] for p in parts], axis=1) for i in (1, 2))
        order = np.argsort(k, kind="stable")
        self.keep(k[order], k[order], below[:, order], total[:, order])

    def values(self) -> list[np.ndarray]:
        return [key_values(self.lo[at]) for at in self.places(self.below, self.total)]


def cuts_of(x: DataFrame, p: int, sets: Sequence[int | None]) -> dict[int | None, list[np.ndarray]]:
    """``trees.bin_cuts`` of all rows but those of each fold in ``sets`` (None: of all)."""
    names = [f"f{i}" for i in range(p)]
    seen = _distinct(x, names)
    folds = sorted({f for _, f in seen})
    out = {s: [None] * p for s in sets}
    search: dict[int, _Ranks] = {}
    asked: dict[int, list] = {}
    for c in range(p):
        parts = [seen.get((c, f)) for f in folds]
        n = np.array([m[0] if m else 0 for m in parts])
        for s in sets:
            mine = [i for i, f in enumerate(folds) if f != s and parts[i]]
            u = np.unique(np.concatenate([np.zeros(0, np.uint64), *[parts[i][1] for i in mine]]))
            if len(u) <= BINS:
                v = key_values(u)
                out[s][c] = v[:-1] + (v[1:] - v[:-1]) / 2
            else:
                folded = np.array([i in mine for i in range(len(folds))])
                asked.setdefault(c, []).append((s, (folded, (np.arange(1, BINS) * int(n[mine].sum())) // BINS)))
        if c in asked:
            some = [m for m in parts if m]
            search[c] = _Ranks(min(m[2] for m in some), max(m[3] for m in some), n, [t for _, t in asked[c]])
    s = COARSE
    while wide := {c: r for c, r in search.items() if len(r.open())}:
        few = {c: r for c, r in wide.items() if r.total[:, r.open()].sum() <= FEW}
        if len(few) == len(wide):
            for c, (keys, n) in _read(x, names, wide, folds).items():
                wide[c].settle(keys, n)
        else:
            for c, n in _counted(x, names, wide, folds, s).items():
                wide[c].refine(n, s)
        s = FINE
    for c, r in search.items():
        for (s, _), v in zip(asked[c], r.values()):
            out[s][c] = np.unique(v)
    return out


def _columns(batches, names, some):
    """(column, fold, keys of its values) of gathered batches."""
    for b in T.bundles(batches):
        fold = b.column("fold").to_numpy(zero_copy_only=False)
        for c in some:
            v = T.matrix(b, [names[c]])[:, 0]
            has = ~np.isnan(v)
            yield c, fold[has], order_keys(v[has])


def _distinct(x: DataFrame, names) -> dict[tuple[int, int], tuple]:
    """(feature, fold) -> rows, at most BINS + 1 of their keys, least and greatest key."""
    def run(batches):
        got = {}
        for c, fold, key in _columns(batches, names, range(len(names))):
            for f in np.unique(fold).tolist():
                k = key[fold == f]
                least, most = k.min(), k.max()
                n, few, lo, hi = got.get((c, f), (0, np.zeros(0, np.uint64), least, most))
                if len(few) <= BINS:
                    few = np.union1d(few, np.unique(k))[:BINS + 1]
                got[c, f] = n + len(k), few, min(lo, least), max(hi, most)
        for (c, f), (n, few, lo, hi) in got.items():
            yield _batch(c=pa.array([c], pa.int32()), fold=pa.array([f], pa.int32()), n=pa.array([n], pa.int64()),
                         few=_blobs([few]), ends=_blobs([np.array([lo, hi], np.uint64)]))

    out = {}
    for r in x.mapInArrow(run, "c int, fold int, n long, few binary, ends binary").collect():
        few, (lo, hi) = np.frombuffer(r["few"], np.uint64), np.frombuffer(r["ends"], np.uint64)
        n, old, lo0, hi0 = out.get((r["c"], r["fold"]), (0, few, lo, hi))
        out[r["c"], r["fold"]] = (n + r["n"], np.union1d(old, few)[:BINS + 1], min(lo, lo0), max(hi, hi0))
    return out


def _open_of(wide: Mapping[int, _Ranks], s: int) -> dict[int, tuple]:
    return {c: (r.lo[r.open()], r.hi[r.open()], r.steps(s)[r.open()]) for c, r in wide.items()}


def _inside(key, lo, hi):
    """Which keys are in a bracket, and in which."""
    at = np.searchsorted(lo, key, "right") - 1
    mine = np.flatnonzero((at >= 0) & (key <= hi[np.maximum(at, 0)]))
    return mine, at[mine]


def _counted(x: DataFrame, names, wide, folds, s: int) -> dict[int, np.ndarray]:
    ask, fold_no = _open_of(wide, s), np.array(folds)

    def run(batches):
        total = {c: np.zeros(len(fold_no) * len(lo) * s, np.int64) for c, (lo, _, _) in ask.items()}
        for c, fold, key in _columns(batches, names, ask):
            lo, hi, step = ask[c]
            mine, at = _inside(key, lo, hi)
            bucket = ((key[mine] - lo[at]) // step[at]).astype(np.int64)
            place = (np.searchsorted(fold_no, fold[mine]) * len(lo) + at) * s + bucket
            total[c] += np.bincount(place, minlength=len(total[c]))
        for c, a in total.items():
            if a.any():
                yield _batch(c=pa.array([c], pa.int32()), a=_blobs([a]))

    got = _added(x.mapInArrow(run, "c int, a binary"), "c").collect()
    return {r["c"]: np.frombuffer(r["a"], np.int64).reshape(len(folds), -1, s) for r in got}


def _read(x: DataFrame, names, wide, folds) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    ask = _open_of(wide, FINE)

    def run(batches):
        kept = {c: [] for c in ask}
        for c, fold, key in _columns(batches, names, ask):
            mine, _ = _inside(key, *ask[c][:2])
            kept[c].append((key[mine], fold[mine]))
        for c, parts in kept.items():
            if parts:
                key, fold = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
                yield _batch(c=pa.array([c], pa.int32()), k=_blobs([key]), fold=_blobs([fold.astype(np.int32)]))

    parts: dict[int, list] = {c: [] for c in ask}
    for r in x.mapInArrow(run, "c int, k binary, fold binary").collect():
        parts[r["c"]].append((np.frombuffer(r["k"], np.uint64), np.frombuffer(r["fold"], np.int32)))
    out = {}
    for c, got in parts.items():
        key, fold = (np.concatenate([g[i] for g in got]) for i in (0, 1))
        u, at = np.unique(key, return_inverse=True)
        place = np.searchsorted(folds, fold) * len(u) + at
        out[c] = u, np.bincount(place, minlength=len(folds) * len(u)).reshape(len(folds), len(u))
    return out


# --- rows' state ------------------------------------------------------------------------------------


def state_of(x: DataFrame, p: int, cuts: Mapping[int | None, list[np.ndarray]], n: int) -> tuple[DataFrame, dict]:
    """Blocks of rows (y, rid, fold, bins of each set), persisted, and each set's column."""
    names, sets = [f"f{i}" for i in range(p)], list(cuts)

    def run(batches):
        for b in T.bundles(batches, BLOCK_ROWS):
            x = T.matrix(b, names)
            cols = {"n": pa.array([b.num_rows], pa.int32())}
            for c, t in (("y", np.int8), ("rid", np.int64), ("fold", np.int32)):
                cols[c] = _blobs([b.column(c).to_numpy(zero_copy_only=False).astype(t)])
            yield _batch(**cols, **{f"b{j}": _blobs([T.binned(x, cuts[s])]) for j, s in enumerate(sets)})

    schema = "n int, y binary, rid binary, fold binary, " + ", ".join(f"b{j} binary" for j in range(len(sets)))
    parts = max(x.sparkSession.sparkContext.defaultParallelism, -(-n // PART_ROWS))
    state = x.mapInArrow(run, schema).repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
    return state, {s: j for j, s in enumerate(sets)}


class Rows:
    """A partition's rows of the state; the bins of one set at a time."""

    def __init__(self, batches, p: int):
        self.parts = [b for b in batches if b.num_rows]
        self.n = np.concatenate([np.zeros(0, int), *[b.column("n").to_numpy() for b in self.parts]]).astype(int)
        self.y, self.rid, self.fold = (self._all(c, t) for c, t in (
            ("y", np.int8), ("rid", np.int64), ("fold", np.int32)))
        self.p = p

    def _blobs(self, name):
        return [v for b in self.parts for v in b.column(name).to_pylist()]

    def _all(self, name, t):
        return np.frombuffer(b"".join(self._blobs(name)), t)

    def bins(self, j: int) -> np.ndarray:
        out, lo = np.empty((self.p, len(self.y)), np.uint8), 0
        for n, raw in zip(self.n, self._blobs(f"b{j}")):
            out[:, lo:lo + n] = np.frombuffer(raw, np.uint8).reshape(self.p, n)
            lo += n
        return out


# --- boosting ---------------------------------------------------------------------------------------


def scratch_folder(run: str) -> str:
    return os.path.join(tempfile.gettempdir(), run)


class Scratch:
    """A fit's arrays over a partition's rows between jobs: a file that one task holds at a time.

    ``turn`` and ``level`` say what they are; -1 while they are written. If another
    task has the file, there is nothing to read, and nothing is written.
    """

    def __init__(self, run: str, name: str, n: int):
        size, folder = 16 + ROW_BYTES * n, scratch_folder(run)
        os.makedirs(folder, exist_ok=True)
        self.file, self.n = open(os.open(os.path.join(folder, name), os.O_RDWR | os.O_CREAT), "r+b", buffering=0), n
        self.head, self.mine = np.full(2, -1, np.int64), True
        self.stats = np.empty((2, n))
        try:
            fcntl.flock(self.file, fcntl.LOCK_EX | fcntl.LOCK_NB)
            if os.fstat(self.file.fileno()).st_size == size:
                self._read(self.head, 0)
            else:
                self.file.truncate(size)
        except BlockingIOError:
            self.mine = False

    def _read(self, out: np.ndarray, at: int) -> np.ndarray:
        view, done = memoryview(out.reshape(-1)).cast("B"), 0
        while done < len(view):
            done += os.preadv(self.file.fileno(), [view[done:]], at + done)
        return out

    def _write(self, a: np.ndarray, at: int) -> None:
        view, done = memoryview(a.reshape(-1)).cast("B"), 0
        while self.mine and done < len(view):
            done += os.pwrite(self.file.fileno(), view[done:], at + done)

    def _nodes(self) -> np.ndarray:
        return self._read(np.empty(self.n, np.int32), 16 + 24 * self.n)

    def close(self) -> None:
        self.file.close()

    def bring(self, ask: Ask, rows: Rows, bins: np.ndarray, grower: T.Grower, weights, history: Trees | None) -> bool:
        """The statistics of the asked turn, and the nodes of its level in ``grower.at``, if they can be made."""
        turn, level = self.head.tolist()
        self._write(np.full(2, -1, np.int64), 0)
        if turn == ask.turn and level >= 0:
            grower.at[:] = self._nodes()
            self._read(self.stats, 16 + 8 * self.n)
            _down(grower, ask.tree, ask.level - level)
        else:
            margin = np.zeros(self.n)
            if turn == ask.turn - 1 and turn >= 0 and level >= 0 and not ask.level:
                grower.at[:] = self._nodes()
                _down(grower, ask.last, ask.last.depth - level)
                self._read(margin, 16)
                margin += ask.last.value.take(grower.at)
            elif ask.turn and history is not None:
                margin = history.total(bins)
            elif ask.turn:
                return False
            self.stats = T.boost_stats(ask.fit.params, ask.fit.seed, ask.turn, rows.rid, rows.y,
                                       np.where(rows.y > 0, weights[1], weights[0]), margin)
            if ask.fit.leave_out is not None:
                self.stats[:, rows.fold == ask.fit.leave_out] = 0
            self._write(margin, 16)
            self._write(self.stats, 16 + 8 * self.n)
            grower.at[:] = 0
            _down(grower, ask.tree, ask.level)
        self._write(grower.at.astype(np.int32), 16 + 24 * self.n)
        self._write(np.array([ask.turn, ask.level]), 0)
        return True


def _down(grower: T.Grower, tree: Trees | None, levels: int) -> None:
    if tree is not None and levels > 0:
        feature, cut, left = tree.walk()
        for _ in range(levels):
            grower.step(feature, np.minimum(cut, BINS - 1).astype(np.uint8), left)


class Ask:
    """What a job is to find for one fit: the splits of a level of its tree."""

    def __init__(self, i: int, fit: Fit, turn: int, plan: T.Plan, last: Trees | None, widths: np.ndarray):
        self.i, self.fit, self.turn, self.level, self.last, self.rule = i, fit, turn, plan.level, last, plan.rule
        self.tree = plan.tree() if plan.level else None
        self.first, self.n = plan.first, plan.n
        (tried,) = plan.tries()
        self.cols = tried[0]
        self.starts = np.cumsum(widths[self.cols]) - widths[self.cols]


class Boosting:
    """A boosted fit that goes on level by level."""

    def __init__(self, i: int, fit: Fit, cuts: list[np.ndarray]):
        self.i, self.fit, self.p = i, fit, len(cuts)
        self.widths = np.array([len(c) + 1 for c in cuts], np.int64)
        self.rate = np.float32(fit.params.get("learning_rate", 0.3))
        self.rounds = int(fit.params.get("n_estimators", 100))
        self.made: list[Trees] = []
        self.plan = T.boost_plan(fit.params, self.p, fit.seed, 0)
        self._skip()

    def _skip(self) -> None:
        while self.open and not self.plan.open:
            self._finish()

    @property
    def open(self) -> bool:
        return len(self.made) < self.rounds

    def ask(self) -> Ask:
        return Ask(self.i, self.fit, len(self.made), self.plan, self.made[-1] if self.made else None, self.widths)

    def _finish(self) -> None:
        tree = self.plan.tree()
        tree.value = tree.value * self.rate
        self.made.append(tree)
        self.plan = T.boost_plan(self.fit.params, self.p, self.fit.seed, len(self.made))

    def take(self, cols: np.ndarray, found: tuple | None) -> None:
        """Go on with the found splits; None: no row was drawn."""
        if found is None:
            self._finish()
        else:
            self.plan.split([(np.broadcast_to(cols, (self.plan.n, len(cols))), found)])
        self._skip()


FOUND = "fit int, node int, slot int, bin int, gain double, l0 long, l1 long, t0 long, t1 long"


def _level(state: DataFrame, parts: int, column: Mapping, p: int, asks: list[Ask], widths: Mapping, weights: Mapping, name: str,
           history) -> dict[int, tuple]:
    """Best splits (or None) of each asked fit's nodes; fits that some task has lost: -1."""
    by_set: dict = {}
    for a in asks:
        by_set.setdefault(a.fit.leave_out, []).append(a)
    size = {a.i: 16 * a.n * int(widths[a.fit.leave_out][a.cols].sum()) for a in asks}
    direct = parts * sum(size.values()) <= DRIVER_BYTES

    def run(batches):
        rows = Rows(batches, p)
        if not len(rows.y):
            return
        part = TaskContext.get().partitionId()
        for s, mine in by_set.items():
            bins = rows.bins(column[s])
            grower = T.Grower(bins)
            grower.widths = widths[s]
            for a in mine:
                got = Scratch(name, f"{part}-{a.i}", len(rows.y))
                trees = Trees.unpack(history.value[a.i]) if history is not None and a.i in history.value else None
                if not got.bring(a, rows, bins, grower, weights[s], trees):
                    got.close()
                    yield _batch(fit=pa.array([a.i], pa.int32()), node=pa.array([-1], pa.int32()),
                                 a=_blobs([np.zeros(1, np.int64)]))
                    continue
                slots = None
                if a.level:
                    slots = np.full(a.first + a.n, -1)
                    slots[a.first:] = np.arange(a.n)
                found = grower.count(got.stats, a.cols, slots, got.stats[0] > 0, a.n)
                got.close()
                if direct:
                    yield _batch(fit=pa.array([a.i], pa.int32()), node=pa.array([0], pa.int32()),
                                 a=_blobs([found.astype(np.int64)]))
                    continue
                nodes = np.flatnonzero(found[0].any(axis=1))
                yield _batch(fit=pa.array(np.full(len(nodes), a.i), pa.int32()), node=pa.array(nodes, pa.int32()),
                             a=_blobs(found[:, k].astype(np.int64) for k in nodes))

    rules = {a.i: (a.rule, a.starts) for a in asks}

    def best(batches):
        total: dict[int, dict] = {}
        for b in batches:
            for i, node, a in zip(b.column("fit").to_pylist(), b.column("node").to_pylist(), b.column("a").to_pylist()):
                mine, a = total.setdefault(i, {}), np.frombuffer(a, np.int64)
                if node not in mine:
                    mine[node] = a.copy()
                elif node >= 0:
                    mine[node] += a
        for i, mine in total.items():
            lost = mine.pop(-1, None) is not None
            nodes = np.array(sorted(mine), np.int64)
            cols = [[] for _ in range(8)]
            if len(nodes):
                cells = np.stack([mine[k] for k in nodes.tolist()]).reshape(len(nodes), 2, -1).transpose(1, 0, 2)
                _, slot, b, gain, left, whole = T.dense_splits(rules[i][0], cells.astype(float), rules[i][1])
                cols = [nodes, slot, b, gain, *left, *whole]
            if lost:
                cols = [np.append(c, [-1 if k == 0 else 0]) for k, c in enumerate(cols)]
            kinds = [pa.int32()] * 3 + [pa.float64()] + [pa.int64()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cols[0]), i), pa.int32()), *[
                pa.array(c).cast(t, safe=False) for c, t in zip(cols, kinds)]], names=[c.split()[0] for c in FOUND.split(", ")])

    cells = state.select("n", "y", "rid", "fold", *[f"b{column[s]}" for s in by_set]).mapInArrow(
        run, "fit int, node int, a binary")
    if direct:
        return _split_here(cells, asks)
    _shuffled(state.sparkSession, parts * sum(size.values()))
    got = cells.repartition("fit", "node").mapInArrow(best, FOUND).toArrow().sort_by([("fit", "ascending"), ("node", "ascending")])
    c = {f: got[f].to_numpy() for f in got.column_names}
    out: dict = {}
    for a in asks:
        mine = slice(*np.searchsorted(c["fit"], [a.i, a.i + 1]))
        node = c["node"][mine].astype(np.int64)
        out[a.i] = None if not len(node) else -1 if node[0] < 0 else (
            node, *[c[f][mine].astype(np.int64) for f in ("slot", "bin")], c["gain"][mine],
            np.stack([c["l0"][mine], c["l1"][mine]]), np.stack([c["t0"][mine], c["t1"][mine]]))
    return out


def _split_here(cells: DataFrame, asks: list[Ask]) -> dict[int, tuple]:
    """:func:`_level` with the cells of all nodes of a fit in one array a task."""
    got, total, lost = cells.toArrow(), {}, set()
    for i, node, a in zip(got["fit"].to_pylist(), got["node"].to_pylist(), got["a"].to_pylist()):
        if node < 0:
            lost.add(i)
        elif i in total:
            total[i] += np.frombuffer(a, np.int64)
        else:
            total[i] = np.frombuffer(a, np.int64).copy()
    out: dict = {}
    for a in asks:
        if a.i in lost or a.i not in total or not total[a.i].any():
            out[a.i] = -1 if a.i in lost else None
            continue
        c = total[a.i].reshape(2, a.n, -1)
        nodes = np.flatnonzero(c[0].any(axis=1))
        _, *rest = T.dense_splits(a.rule, c[:, nodes].astype(float), a.starts)
        out[a.i] = (nodes, *rest)
    return out


def boost(state: DataFrame, column: Mapping, fits: Mapping[int, Fit], cuts: Mapping, weights: Mapping) -> dict[int, Trees]:
    """The trees of all ``fits``, which go on together."""
    sc = state.sparkSession.sparkContext
    p, parts = len(next(iter(cuts.values()))), state.rdd.getNumPartitions()
    widths = {s: np.array([len(c) + 1 for c in cuts[s]], np.int64) for s in cuts}
    name = f"cohortix-{uuid.uuid4().hex}"
    active = {i: Boosting(i, f, cuts[f.leave_out]) for i, f in fits.items()}
    made = dict(active)

    try:
        while active := {i: b for i, b in active.items() if b.open}:
            asks = [b.ask() for b in active.values()]
            got = _level(state, parts, column, p, asks, widths, weights, name, None)
            lost = [a for a in asks if isinstance(got[a.i], int)]
            if lost:
                trees = sc.broadcast({a.i: Trees.join(active[a.i].made).pack() for a in lost if active[a.i].made})
                got |= _level(state, parts, column, p, lost, widths, weights, name, trees)
                trees.unpersist()
            for a in asks:
                active[a.i].take(a.cols, got[a.i])
    finally:
        def drop(batches):
            for _ in batches:
                pass
            shutil.rmtree(scratch_folder(name), ignore_errors=True)
            yield from ()

        state.select("n").mapInArrow(drop, "n int").collect()
    return {i: Trees.join(b.made) for i, b in made.items()}


# --- forests ----------------------------------------------------------------------------------------


def _bag(rows: Rows, fit: Fit, tree: int, weights) -> np.ndarray:
    stats = T.forest_stats(fit.seed, tree, rows.rid, rows.y, np.where(rows.y > 0, weights[1], weights[0]))
    if fit.leave_out is not None:
        stats[:, rows.fold == fit.leave_out] = 0
    return stats


def _gini_splits(state: DataFrame, column: int, p: int, fit: Fit, weights, asked: Mapping[int, tuple]) -> dict[int, tuple]:
    """``trees.best_splits`` of the asked nodes of each tree: (tree so far, nodes, their columns)."""
    rule = T.forest_plan(fit.params, p, fit.seed, 0).rule

    def run(batches):
        rows = Rows(batches, p)
        if not len(rows.y):
            return
        bins = rows.bins(column)
        for t, (tree, nodes, cols) in asked.items():
            stats, n, m = _bag(rows, fit, t, weights), len(nodes), cols.shape[1]
            slot = np.full(tree.start[-1], -1)
            slot[nodes] = np.arange(n)
            node = slot[tree.leaves(bins, 0)]
            mine = np.flatnonzero((node >= 0) & (stats[0] > 0))
            key, sums = T.cells(bins[:, mine], node[mine], cols, stats[:, mine], n)
            order = np.argsort(key // BINS % n, kind="stable")
            key, sums = key[order], sums[:, order]
            ends = np.searchsorted(key // BINS % n, np.arange(n + 1))
            for k in range(n):
                if ends[k] < ends[k + 1]:
                    here = slice(ends[k], ends[k + 1])
                    dense = np.zeros((len(sums), m * BINS), np.int64)
                    dense[:, key[here] // (n * BINS) * BINS + key[here] % BINS] = sums[:, here]
                    yield _batch(tree=pa.array([t], pa.int32()), node=pa.array([k], pa.int32()), a=_blobs([dense]))

    def best(batches):
        total: dict[tuple, np.ndarray] = {}
        for b in batches:
            for k, a in zip(zip(b.column("tree").to_pylist(), b.column("node").to_pylist()), b.column("a").to_pylist()):
                a = np.frombuffer(a, np.int64)
                if k in total:
                    total[k] += a
                else:
                    total[k] = a.copy()
        for (t, k), a in total.items():
            a = a.reshape(3, -1)
            key = np.flatnonzero(a[0])
            _, slot, cut, gain, left, whole = T.best_splits(rule, key, a[:, key], 1)
            yield _batch(tree=pa.array([t], pa.int32()), node=pa.array([k], pa.int32()),
                         slot=pa.array(slot.astype(np.int32)), bin=pa.array(cut.astype(np.int32)), gain=pa.array(gain),
                         **{f"l{i}": pa.array(left[i]) for i in range(3)}, **{f"t{i}": pa.array(whole[i]) for i in range(3)})

    schema = "tree int, node int, slot int, bin int, gain double, " + ", ".join(
        f"{c}{i} long" for c in "lt" for i in range(3))
    cells = state.select("n", "y", "rid", "fold", f"b{column}").mapInArrow(run, "tree int, node int, a binary")
    parts = max(state.sparkSession.sparkContext.defaultParallelism, 1)
    _shuffled(state.sparkSession, parts * sum(len(nodes) * cols.shape[1] for _, nodes, cols in asked.values()) * 24 * BINS)
    got = cells.repartition("tree", "node").mapInArrow(best, schema).toArrow().sort_by(
        [("tree", "ascending"), ("node", "ascending")])
    c = {f: got[f].to_numpy() for f in got.column_names}
    out = {}
    for t in asked:
        mine = slice(*np.searchsorted(c["tree"], [t, t + 1]))
        if mine.start < mine.stop:
            out[t] = (*[c[f][mine].astype(np.int64) for f in ("node", "slot", "bin")], c["gain"][mine],
                      *[np.stack([c[f"{k}{i}"][mine] for i in range(3)]) for k in "lt"])
    return out


def _below(state: DataFrame, column: int, p: int, fit: Fit, weights, asked: Mapping[int, tuple]) -> dict[tuple, Trees]:
    """What grows below the asked nodes of each tree: (tree so far, nodes, their levels and paths), the
    rows of a node in one task."""
    def run(batches):
        rows = Rows(batches, p)
        if not len(rows.y):
            return
        bins = rows.bins(column)
        for t, (tree, nodes, _, _) in asked.items():
            copies = np.searchsorted(T.BAG, T.uniform(rows.rid, fit.seed, t, 3), "right").astype(np.uint8)
            if fit.leave_out is not None:
                copies[rows.fold == fit.leave_out] = 0
            slot = np.full(tree.start[-1], -1)
            slot[nodes] = np.arange(len(nodes))
            node = slot[tree.leaves(bins, 0)]
            mine = np.flatnonzero((node >= 0) & (copies > 0))
            mine = mine[np.argsort(node[mine], kind="stable")]
            ends = np.searchsorted(node[mine], np.arange(len(nodes) + 1))
            for k in range(len(nodes)):
                at = mine[ends[k]:ends[k + 1]]
                if len(at):
                    yield _batch(tree=pa.array([t], pa.int32()), node=pa.array([k], pa.int32()), a=_blobs(
                        [np.concatenate([rows.y[None, at].astype(np.uint8), copies[None, at], bins[:, at]])]))

    def grown(t, k, parts):
        a = np.concatenate([np.frombuffer(v, np.uint8).reshape(p + 2, -1) for v in parts], axis=1)
        w = np.rint(np.where(a[0] > 0, weights[1], weights[0]) * a[1] * T.ONE).astype(np.int64)
        stats = np.stack([np.ones(len(w), np.int64), np.where(a[0] > 0, 0, w), np.where(a[0] > 0, w, 0)])
        _, _, levels, paths = asked[t]
        plan = T.forest_plan(fit.params, p, fit.seed, t, int(levels[k]), paths[k:k + 1])
        tree, _ = T.grow(np.ascontiguousarray(a[2:]), stats, plan)
        return _batch(tree=pa.array([t], pa.int32()), node=pa.array([k], pa.int32()), a=pa.array([tree.pack()], pa.binary()))

    def grow(batches):
        at, parts = None, []
        for b in batches:
            for k, a in zip(zip(b.column("tree").to_pylist(), b.column("node").to_pylist()), b.column("a").to_pylist()):
                if k != at and parts:
                    yield grown(*at, parts)
                    parts = []
                at = k
                parts.append(a)
        if parts:
            yield grown(*at, parts)

    schema = "tree int, node int, a binary"
    rows = state.select("n", "y", "rid", "fold", f"b{column}").mapInArrow(run, schema)
    got = rows.repartition("tree", "node").sortWithinPartitions("tree", "node").mapInArrow(grow, schema)
    return {(r["tree"], r["node"]): Trees.unpack(bytes(r["a"])) for r in got.toLocalIterator()}


def _joined(top: Trees, nodes: np.ndarray, levels: np.ndarray, below: list[Trees | None]) -> Trees:
    """The tree whose nodes go on as ``below``, with its nodes in the order of levels."""
    names = Trees.ARRAYS[:-1]
    a = {k: [getattr(top, k).copy()] for k in names}
    size, depth = int(top.start[-1]), top.depth
    for node, level, sub in zip(nodes, levels, below):
        if sub is None or sub.feature[0] < 0:
            continue
        for k in ("feature", "cut", "gain"):
            a[k][0][node] = getattr(sub, k)[0]
        a["left"][0][node] = sub.left[0] + size
        for k in names:
            a[k].append(getattr(sub, k) + size if k == "left" else getattr(sub, k))
        size, depth = size + int(sub.start[-1]), max(depth, int(level) + sub.depth)
    a = {k: np.concatenate(v) for k, v in a.items()}
    here, order, first = np.zeros(1, np.int64), [], 0
    left = np.zeros(size, np.int64)
    while len(here):
        order.append(here)
        first += len(here)
        split = here[a["feature"][here] >= 0]
        left[split] = first + 2 * np.arange(len(split))
        kids = np.empty(2 * len(split), np.int64)
        kids[0::2], kids[1::2] = a["left"][split], a["left"][split] + 1
        here = kids
    order = np.concatenate(order)
    a["left"] = left.astype(a["left"].dtype)
    return Trees(**{k: v[order] for k, v in a.items()}, start=np.array([0, len(order)]), depth=depth)


def forest(state: DataFrame, column: int, p: int, fit: Fit, weights, n: int) -> Trees:
    """All trees of a forest, a group of them at a time."""
    n_trees, made = int(fit.params.get("num_trees", 100)), []
    group = int(min(T.GROUP, max(1, STATE_BYTES // (2 * max(n, 1) * (p + 2)))))
    for lo in range(0, n_trees, group):
        plans = {t: T.forest_plan(fit.params, p, fit.seed, t) for t in range(lo, min(lo + group, n_trees))}
        left = {t: ([], [], []) for t in plans}   # nodes, levels and paths that one task takes on
        tall = {t: np.array([n]) for t in plans}  # rows of the level's nodes, at most
        going = dict(plans)
        while going:
            asked, wide = {}, {}
            for t, plan in list(going.items()):
                large = np.flatnonzero(tall[t] > LOCAL_ROWS)
                if plan.open:
                    some = np.arange(plan.n) if plan.stats is None else np.flatnonzero(plan.rule.may_split(plan.stats))
                    some = np.setdiff1d(some, large)
                    for out, v in zip(left[t], (plan.first + some, np.full(len(some), plan.level), plan.path[some])):
                        out.append(v)
                if plan.open and len(large):
                    wide[t], asked[t] = large, plan.tries()
                else:
                    del going[t]
            found = {t: [] for t in asked}
            todo = dict(wide)
            for turn in range(max((len(c) for c in asked.values()), default=0)):
                ask = {t: (plans[t].tree(), plans[t].first + todo[t], np.ascontiguousarray(asked[t][turn][todo[t]]))
                       for t in todo if turn < len(asked[t]) and len(todo[t])}
                if not ask:
                    break
                got = _gini_splits(state, column, p, fit, weights, ask)
                for t in ask:
                    if t not in got:
                        todo[t] = todo[t][:0]
                        continue
                    node, *rest = got[t]
                    mine = todo[t][node]
                    found[t].append((asked[t][turn], (mine, *rest)))
                    todo[t] = T.without_split(plans[t].rule, (mine, *rest))
            for t in asked:
                plans[t].split(found[t])
                tall[t] = plans[t].stats[0] if plans[t].n else np.zeros(0, np.int64)
        ask = {}
        for t, parts in left.items():
            nodes, levels, paths = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in parts)
            if len(nodes):
                ask[t] = plans[t].tree(), nodes, levels, paths
        subs = _below(state, column, p, fit, weights, ask) if ask else {}
        _shuffled(state.sparkSession, len(ask) * n * (p + 2))
        for t, plan in plans.items():
            top, nodes, levels, _ = ask.get(t, (plan.tree(), [], [], []))
            tree = _joined(top, nodes, levels, [subs.get((t, k)) for k in range(len(nodes))])
            if 0 in nodes and (t, 0) in subs:  # a whole tree of one task: the root's own values
                tree.value[0], tree.cover[0] = subs[t, 0].value[0], subs[t, 0].cover[0]
            made.append(tree)
    return Trees.join(made)


# --- all fits ---------------------------------------------------------------------------------------


def state_bytes(fits: Sequence[Fit], n: int, p: int) -> int:
    """Bytes on disk, at most, of a wave: rows' state, persisted and in the shuffle that dealt it, and scratch."""
    boosted = sum(f.kind == "boosted" for f in fits)
    return n * (2 * (13 + p * len({f.leave_out for f in fits})) + ROW_BYTES * boosted)


def waves(fits: Sequence[Fit], n: int, p: int) -> list[list[int]]:
    """Boosted fits in groups whose state is within ``STATE_BYTES``; like ones together."""
    order = sorted((i for i, f in enumerate(fits) if f.kind == "boosted"), key=lambda i: (
        fits[i].leave_out is not None, fits[i].leave_out or 0, -int(fits[i].params.get("n_estimators", 100))))
    out: list[list[int]] = []
    for i in order:
        if out and state_bytes([fits[k] for k in (*out[-1], i)], n, p) <= STATE_BYTES:
            out[-1].append(i)
        else:
            out.append([i])
    return out


def fit_all(x: DataFrame, features: Sequence[str], fits: Sequence[Fit], counts: Mapping[int, tuple[int, int]]) -> list[TreeModel]:
    """The model of every fit from all rows of ``x`` (f0, f1, ..., y, rid, fold), which is read several
    times. ``counts``: rows of both classes of each fold."""
    share_package(x.sparkSession)
    p, n = len(features), sum(a + b for a, b in counts.values())

    def classes(s):
        mine = [v for f, v in counts.items() if f != s]
        return sum(v[0] for v in mine), sum(v[1] for v in mine)

    sets = list(dict.fromkeys(f.leave_out for f in fits))
    made: dict[int, Trees] = {}
    cuts = cuts_of(x, p, sets)
    for wave in [*waves(fits, n, p), *[[i] for i, f in enumerate(fits) if f.kind != "boosted"]]:
        used = {fits[i].leave_out: cuts[fits[i].leave_out] for i in wave}
        share = {s: T.class_weights(fits[wave[0]].kind, *classes(s)) for s in used}
        size = state_bytes([fits[i] for i in wave], n, p)
        with room(size):
            state, column = state_of(x, p, used, n)
            try:
                if fits[wave[0]].kind == "boosted":
                    made |= boost(state, column, {i: fits[i] for i in wave}, used, share)
                else:
                    (i,), (s,) = wave, used
                    made[i] = forest(state, column[s], p, fits[i], share[s], n)
            finally:
                state.unpersist()
                del state
                _shuffled(x.sparkSession, size)
    return [TreeModel(f.kind, list(features), cuts[f.leave_out], made[i], rows=sum(classes(f.leave_out)),
                      params=dict(f.params)) for i, f in enumerate(fits)]
