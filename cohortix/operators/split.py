"""Group-disjoint splits and folds, leakage checks, train-only scaling, weights.

Splits are a pure function of the group key (a seeded hash), so they need no
shuffle and give the same answer on every executor, every retry and every
engine that has MD5 (the oracle repeats it in SQL).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix.operators.cumulative import running_totals

HASH_BUCKETS = 1_000_000


def group_hash(group_cols: Sequence[str], seed: int = 42) -> Column:
    """Non-negative 60-bit hash of ``seed:key`` from MD5 (portable across engines)."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in group_cols])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def group_split(df: DataFrame, group_cols: Sequence[str], test_fraction: float = 0.2,
                seed: int = 42, out: str = "split") -> DataFrame:
    """Assign whole groups to ``train`` / ``test`` (about ``test_fraction`` of groups)."""
    b = F.pmod(group_hash(group_cols, seed), F.lit(HASH_BUCKETS))
    cut = int(round(test_fraction * HASH_BUCKETS))
    return df.withColumn(out, F.when(b < cut, F.lit("test")).otherwise(F.lit("train")))


def group_split_exact(df: DataFrame, group_cols: Sequence[str], test_fraction: float = 0.2,
                      seed: int = 42, out: str = "split") -> DataFrame:
    """Exactly ``ceil(test_fraction * n_groups)`` groups in test.

    Groups are ranked by hash with the distributed running count (no single
    task sees all groups). The last test group is one row: a row is in test
    if its (hash, key) is not above that one, so the table is not joined.
    """
    cols = list(group_cols)
    place = F.struct(F.col("_cx_h"), *[F.col(c) for c in cols])
    g = df.select(*cols).distinct().withColumn("_cx_h", group_hash(cols, seed))
    ranked = running_totals(g.withColumn("_cx_one", F.lit(1)), [F.col("_cx_h"), *[F.col(c) for c in cols]],
                            ["_cx_one"], prefix="_cx_rank", total_prefix="_cx_total")
    last = ranked.where(F.col("_cx_rank_cx_one") == F.ceil(F.lit(float(test_fraction)) * F.col("_cx_total_cx_one")))
    last = last.select(place.alias("_cx_last"))  # one row, none if no group is for test
    marked = df.withColumn("_cx_h", group_hash(cols, seed)).join(F.broadcast(last), F.lit(True), "left")
    test = F.coalesce(place <= F.col("_cx_last"), F.lit(False))
    return marked.withColumn(out, F.when(test, F.lit("test")).otherwise(F.lit("train"))).drop("_cx_h", "_cx_last")


def _join_back(df: DataFrame, assign: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Add ``out`` of ``assign`` (one row per key) to every row; null keys match null keys."""
    named = assign.select(*[F.col(c).alias(f"_cx_k{i}") for i, c in enumerate(keys)], F.col(out).alias("_cx_out"))
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & df[c].eqNullSafe(named[f"_cx_k{i}"])
    return df.join(named, same, "left").withColumn(out, F.col("_cx_out")).drop(
        "_cx_out", *[f"_cx_k{i}" for i in range(len(keys))])


def hash_kfold(df: DataFrame, group_cols: Sequence[str], k: int = 5, seed: int = 42,
               out: str = "fold") -> DataFrame:
    """Cheap group folds: ``hash mod k`` (no balancing, no shuffle)."""
    return df.withColumn(out, F.pmod(group_hash(group_cols, seed), F.lit(k)).cast("int"))


def _greedy_plan(size_hist: list[tuple[int, int]], k: int) -> list[tuple[int, int, int, list[int]]]:
    """Largest-group-first greedy allotment over a histogram of group sizes.

    Every group goes to the currently lightest fold (lowest index on ties).
    For groups of one size the folds within that size of the lightest one
    take turns in a fixed order until the next fold comes within reach, so
    whole rounds are one phase and a size has at most ``k`` + 1 phases,
    however unequal the folds are. Returns phases ``(size, first_rank,
    last_rank, cycle)``: the group of that size with 1-based rank r in the
    phase goes to ``cycle[(r - first_rank) % len(cycle)]``.
    """
    loads = [0] * k
    phases = []
    for size, count in sorted(size_hist, key=lambda t: -t[0]):
        r = 1
        while r <= count:
            low = min(loads)
            near = sorted((f for f in range(k) if loads[f] < low + size), key=lambda f: (loads[f], f))
            left = count - r + 1
            rounds = min([left // len(near), *((loads[f] - low) // size for f in range(k) if f not in near)])
            # a last round that is not full goes to the first folds of the cycle
            n = rounds * len(near) if rounds else min(left, len(near))
            phases.append((size, r, r + n - 1, near))
            for i, f in enumerate(near):
                loads[f] += size * (n // len(near) + (i < n % len(near)))
            r += n
    return phases


def group_kfold(df: DataFrame, group_cols: Sequence[str], k: int = 5, seed: int = 42,
                out: str = "fold") -> DataFrame:
    """Group-disjoint folds balanced by row count (largest group first).

    Plan: group sizes (one ``groupBy``), the rank of each group among groups
    of its size by the distributed running count (a hot size is spread over
    range partitions), the histogram of sizes to the driver for the greedy
    allotment (N rows have at most sqrt(2 N) distinct sizes), and a join of
    the phase table (at most ``k`` + 1 rows per distinct size) to turn ranks
    into folds. Null keys are a group like any other.
    """
    spark = df.sparkSession
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_cx_size"))
    ranked = running_totals(
        sizes.withColumn("_cx_h", group_hash(group_cols, seed)).withColumn("_cx_one", F.lit(1)),
        [F.col("_cx_h"), *[F.col(c) for c in group_cols]],
        ["_cx_one"],
        group_by=["_cx_size"],
        prefix="_cx_rank",
    )
    # from the ranks' checkpoint, so that the table is not grouped twice
    hist = [(int(r[0]), int(r[1])) for r in
            ranked.groupBy("_cx_size").agg(F.count(F.lit(1))).collect()]
    phases = _greedy_plan(hist, k)
    plan = spark.createDataFrame(
        [(s, a, b, c) for s, a, b, c in phases],
        "_cx_size long, _cx_a long, _cx_b long, _cx_cycle array<int>",
    )
    rank = F.col("_cx_rank_cx_one")
    # no hint: Spark broadcasts the phase table if it turns out small, and
    # splits a hot size of the ranked groups otherwise
    assign = ranked.join(plan, "_cx_size").where(
        (rank >= F.col("_cx_a")) & (rank <= F.col("_cx_b"))
    ).select(
        *group_cols,
        F.element_at(
            F.col("_cx_cycle"),
            (F.pmod(rank - F.col("_cx_a"), F.size("_cx_cycle")) + 1).cast("int"),
        ).alias(out),
    )
    return _join_back(df, assign, list(group_cols), out)


def stratified_kfold(df: DataFrame, label: str, k: int = 3, seed: int = 42,
                     key_cols: Sequence[str] | None = None, out: str = "fold") -> DataFrame:
    """Label-stratified folds, not grouped.

    Within each label, distinct ``key_cols`` values ranked by a seeded hash
    go round-robin to folds (distributed ranking, no single-task window).
    Rows sharing a key (identical rows when ``key_cols`` is every column)
    share a fold, so copies never straddle train and validation.
    """
    key_cols = list(key_cols or [c for c in df.columns if c != label])
    keyed = df.withColumn("_cx_h", group_hash(key_cols, seed))
    per = keyed.groupBy(label, "_cx_h", *key_cols).agg(F.lit(1).alias("_cx_one"))
    ranked = running_totals(per, [F.col("_cx_h"), *[F.col(c) for c in key_cols]], ["_cx_one"],
                            group_by=[label], prefix="_cx_rank")
    assign = ranked.select(
        label, "_cx_h", *key_cols,
        F.pmod(F.col("_cx_rank_cx_one") - 1, F.lit(k)).cast("int").alias(out),
    )
    return _join_back(keyed, assign, [label, "_cx_h", *key_cols], out).drop("_cx_h")


def split_overlap(df: DataFrame, split_col: str, group_cols: Sequence[str]) -> DataFrame:
    """Groups found in more than one split: ``(n_groups, n_overlap)`` (must be 0)."""
    per = df.groupBy(*group_cols).agg(F.count_distinct(split_col).alias("_cx_k"))
    return per.agg(
        F.count(F.lit(1)).alias("n_groups"), F.count_if(F.col("_cx_k") > 1).alias("n_overlap")
    )


def fit_standard_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row frame of ``{c}__mean`` and ``{c}__std`` (population std)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return df.agg(*aggs)


def apply_standard_scaler(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / std with zero variance -> 0 (x - mean); stats broadcast (1 row)."""
    j = df.crossJoin(F.broadcast(stats))
    exprs = {}
    for c in cols:
        m, s = F.col(f"{c}__mean"), F.col(f"{c}__std")
        exprs[c] = F.when(s == 0, F.col(c) - m).otherwise((F.col(c) - m) / s)
    return j.withColumns(exprs).drop(*stats.columns)


def standard_scale(df: DataFrame, cols: Sequence[str], fit_filter: Column | None = None) -> DataFrame:
    """Fit on rows matching ``fit_filter`` (e.g. the train split), apply to all."""
    fit_df = df.where(fit_filter) if fit_filter is not None else df
    return apply_standard_scaler(df, fit_standard_scaler(fit_df, cols), cols)


def scale_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """min/max over columns of the scaled means and sample stds."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__m"), F.stddev_samp(c).alias(f"{c}__s")]
    one = df.agg(*aggs)
    means = [F.col(f"{c}__m") for c in cols]
    stds = [F.col(f"{c}__s") for c in cols]
    if len(cols) == 1:
        return one.select(means[0].alias("mean_min"), means[0].alias("mean_max"),
                          stds[0].alias("std_min"), stds[0].alias("std_max"))
    return one.select(
        F.least(*means).alias("mean_min"),
        F.greatest(*means).alias("mean_max"),
        F.least(*stds).alias("std_min"),
        F.greatest(*stds).alias("std_max"),
    )


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weights ``n / (n_classes * n_c)`` as a column; a null label is a class too."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_cx_nc"))
    tot = counts.agg(F.sum("_cx_nc").alias("_cx_n"), F.count(F.lit(1)).alias("_cx_k"))
    w = counts.crossJoin(tot).select(
        label, (F.col("_cx_n") / (F.col("_cx_k") * F.col("_cx_nc"))).alias(out)
    )
    # one row per class; no hint, as a label may have any number of values
    return _join_back(df, w, [label], out)


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, weight, scale_pos_weight)``; spw = neg / max(pos, 1)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(
        F.sum("n").alias("n_all"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("neg"),
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("pos"),
    )
    return counts.crossJoin(tot).select(
        "label",
        "n",
        (F.col("n_all") / (F.col("k") * F.col("n"))).alias("weight"),
        (F.col("neg") / F.greatest(F.col("pos"), F.lit(1))).alias("scale_pos_weight"),
    )
