"""Distributed running totals and exact quantiles.

An un-partitioned ``Window`` (``ORDER BY score`` over the whole table) runs in
one task. Here the ordered keys are range-partitioned over all executors, the
partitioning is frozen with a reliable ``checkpoint()``, each partition's
totals are summed (one small row per partition and group), turned into
offsets by a window over that small table, and added to an in-partition
running sum. No step holds more than one range partition in a task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortix.session import ensure_checkpoint_dir

_PID = "_cx_pid"


def _null_safe_join_cond(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    conds = [left[c].eqNullSafe(right[c]) for c in cols]
    return reduce(lambda a, b: a & b, conds)


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column],
    sums: Sequence[str],
    group_by: Sequence[str] = (),
    num_partitions: int | None = None,
    prefix: str = "cum_",
    total_prefix: str | None = None,
) -> DataFrame:
    """Inclusive running sums of ``sums`` in ``order_by`` order within ``group_by``.

    ``(group_by, order_by)`` must identify a row (aggregate ties first); the
    result keeps every input column and adds ``{prefix}{name}`` per sum, and
    with ``total_prefix`` the group totals ``{total_prefix}{name}`` too (taken
    from the per-partition totals, so the input is not read again).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys = [F.col(g) for g in group_by] + list(order_by)
    # Without an explicit count, AQE may coalesce the range partitions; it only
    # merges adjacent ones, so partition ids stay in key order.
    parted = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = parted.withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True)
    part_tot = ranged.groupBy(_PID, *group_by).agg(
        *[F.sum(c).alias(f"_cx_tot_{c}") for c in sums]
    )
    w_prev = (
        Window.partitionBy(*group_by)
        .orderBy(_PID)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    w_all = Window.partitionBy(*group_by)
    offsets = part_tot.select(
        _PID,
        *group_by,
        *[
            F.coalesce(F.sum(f"_cx_tot_{c}").over(w_prev), F.lit(0)).alias(f"_cx_off_{c}")
            for c in sums
        ],
        *[F.sum(f"_cx_tot_{c}").over(w_all).alias(f"_cx_all_{c}") for c in sums],
    )
    joined = ranged.join(
        offsets, _null_safe_join_cond(ranged, offsets, [_PID, *group_by]), "inner"
    ).select(ranged["*"], *[offsets[f"_cx_off_{c}"] for c in sums],
             *[offsets[f"_cx_all_{c}"] for c in sums])
    w_in = (
        Window.partitionBy(_PID, *group_by)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = [F.col(f"_cx_all_{c}").alias(f"{total_prefix}{c}") for c in sums] if total_prefix else []
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.sum(c).over(w_in) + F.col(f"_cx_off_{c}")).alias(f"{prefix}{c}") for c in sums],
        *totals,
    )


def long_values(df: DataFrame, cols: Sequence[str], name: str = "col_name",
                value: str = "value") -> DataFrame:
    """Unpivot numeric ``cols`` to ``(col_name, value double)``, NULLs dropped."""
    wide = df.select(*[_finite(c).alias(c) for c in cols])
    return wide.unpivot([], list(cols), name, value).where(F.col(value).isNotNull())


def _quantiles_from_ranks(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``ranked`` has per distinct value: ``n`` (its count), ``cum_n`` (rank of
    its last copy + 1) and ``h`` (target 0-based fractional rank) per ``keys``.
    Linear interpolation between the values at ranks floor(h) and ceil(h)."""
    lo, hi = F.floor("h"), F.ceil("h")
    first = F.col("cum_n") - F.col("n")
    lo_hit = (first <= lo) & (lo < F.col("cum_n"))
    hi_hit = (first <= hi) & (hi < F.col("cum_n"))
    agg = ranked.where(lo_hit | hi_hit).groupBy(*keys, "h").agg(
        F.max(F.when(lo_hit, F.col("value"))).alias("v_lo"),
        F.max(F.when(hi_hit, F.col("value"))).alias("v_hi"),
    )
    frac = F.col("h") - F.floor("h")
    return agg.select(*keys, (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * frac).alias("value"))


def exact_quantiles_full(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles from the running count of every distinct value.

    Shuffles one row per distinct ``(column, value)``: one pass over the data,
    for columns known to have few values.
    """
    counts = long_values(df, cols).groupBy("col_name", "value").agg(F.count("*").alias("n"))
    cum = running_totals(counts, [F.col("value")], ["n"], group_by=["col_name"],
                         total_prefix="_cx_total_")
    # a literal table of len(probs) rows
    probs_df = df.sparkSession.createDataFrame([(float(p),) for p in probs], "p double")
    ranked = cum.crossJoin(F.broadcast(probs_df)).withColumn(
        "h", F.col("p") * (F.col("_cx_total_n") - 1))
    return _quantiles_from_ranks(ranked, ["col_name", "p"]).select("col_name", "p", "value")


#: Buckets that a pass cuts each bracket into.
BUCKETS = 512
_SHUFFLES = re.compile(r"^[\s:+\-*()0-9]*(Aggregate|Join|Window|Sort|Repartition|Distinct|Deduplicate)\b", re.M)


def has_shuffle(df: DataFrame) -> bool:
    """True when an operator of the optimized plan aggregates, joins, windows or
    sorts, i.e. re-reading the frame means recomputing a shuffle."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    except Exception:  # noqa: BLE001 - e.g. no JVM handle (Spark Connect)
        return False
    return _SHUFFLES.search(plan) is not None


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    buckets: int = BUCKETS) -> DataFrame:
    """Exact linear-interpolation quantiles per column (pandas/numpy default).

    Returns ``(col_name, p, value)``. Each target rank has a bracket of values,
    at first a column's whole range. A pass counts the values inside the
    brackets per bucket (partial counts in every task, at most ``buckets`` + 2
    rows per bracket) and keeps the bucket with the rank, with its least and
    greatest value as the next bracket, until both are one. Passes cut evenly
    by value and by logarithm in turn and always take a bracket's ends off,
    so outliers cost at most another pass. The data is never shuffled; no
    sketch and no list of values meets in one task.
    """
    cols, probs = list(cols), [float(p) for p in probs]
    cached = has_shuffle(df)
    if cached:
        # several passes below: keep only the needed columns, spill-aware
        df = df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _narrowed(df, cols, probs, buckets)
    finally:
        if cached:
            df.unpersist()


def _narrowed(df: DataFrame, cols: list[str], probs: list[float], buckets: int) -> DataFrame:
    spark = df.sparkSession
    first = df.agg(*[f(_finite(c)).alias(f"{k}{i}") for i, c in enumerate(cols)
                     for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    known: dict[tuple[str, int], float] = {}
    # (column, least, greatest): (values below, values inside, wanted ranks)
    brackets: dict[tuple[str, float, float], tuple[int, int, set[int]]] = {}

    def narrow(c: str, lo: float, hi: float, below: int, n: int, ranks: set[int]) -> None:
        left = set()
        for r in ranks:
            if lo == hi or r == below:
                known[c, r] = lo
            elif r == below + n - 1:
                known[c, r] = hi
            else:
                left.add(r)
        if left:
            brackets[c, lo, hi] = (below, n, left)

    for i, c in enumerate(cols):
        n = first[f"n{i}"]
        if n:
            ranks = {r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}
            narrow(c, first[f"lo{i}"], first[f"hi{i}"], 0, n, ranks)
    step = 0
    while brackets:
        open_ = list(brackets.items())
        brackets = {}
        # a row per open bracket: at most two per column and probability
        bounds = spark.createDataFrame([(i, c, lo, hi) for i, ((c, lo, hi), _) in enumerate(open_)],
                                       "i int, col_name string, lo double, hi double")
        x = long_values(df, sorted({c for (c, _, _), _ in open_})).join(F.broadcast(bounds), "col_name")
        x = x.where(F.col("value").between(F.col("lo"), F.col("hi")))
        rows = x.groupBy("i", _bucket(buckets, step % 2 == 1).alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
        parts: dict[int, list] = {}
        for r in rows:
            parts.setdefault(r["i"], []).append(r)
        for i, ((c, _, _), (below, _, ranks)) in enumerate(open_):
            for r in sorted(parts[i], key=lambda r: r["b"]):
                here = {k for k in ranks if below <= k < below + r["n"]}
                if here:
                    narrow(c, r["lo"], r["hi"], below, r["n"], here)
                below += r["n"]
        step += 1
    out = []
    for i, c in enumerate(cols):
        n = first[f"n{i}"]
        for p in probs if n else ():
            h = p * (n - 1)
            lo, hi = known[c, math.floor(h)], known[c, math.ceil(h)]
            out.append((c, p, lo if lo == hi else lo + (hi - lo) * (h - math.floor(h))))
    return spark.createDataFrame(out, "col_name string, p double, value double")


def _finite(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _bucket(buckets: int, by_log: bool) -> Column:
    """Bucket of ``value`` in [lo, hi], rising with it; the ends have buckets of their own."""
    def scale(x: Column) -> Column:
        return F.signum(x) * F.log1p(F.abs(x)) if by_log else x

    v, lo, hi = scale(F.col("value")), scale(F.col("lo")), scale(F.col("hi"))
    part = F.nanvl((v - lo) / (hi - lo), F.lit(0.0))
    inner = F.least(F.lit(buckets - 1), F.floor(F.least(part, F.lit(1.0)) * buckets)) + 1
    return (F.when(F.col("value") == F.col("lo"), 0).when(F.col("value") == F.col("hi"), buckets + 1)
            .when(hi > lo, inner).otherwise(1))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """``(col_name, p, value)``; ``exact=False`` uses one-pass ``percentile_approx``."""
    if exact:
        return exact_quantiles(df, cols, probs)
    arr = F.array(*[F.lit(float(p)) for p in probs])
    row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("col_name"),
                    F.percentile_approx(F.col(c).cast("double"), arr, accuracy).alias("v"),
                )
                for c in cols
            ]
        ).alias("a")
    )
    return (
        row.select(F.inline("a"))
        .select("col_name", F.posexplode("v").alias("i", "value"))
        .join(
            df.sparkSession.createDataFrame(
                [(i, float(p)) for i, p in enumerate(probs)], "i int, p double"
            ),
            "i",
        )
        .select("col_name", "p", "value")
    )


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   exact: bool = True) -> dict[str, list[float | None]]:
    """Quantiles collected to the driver: ``len(cols) * len(probs)`` scalars."""
    rows = quantiles(df, cols, probs, exact=exact).collect()
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cols}
    index = {float(p): i for i, p in enumerate(probs)}
    for r in rows:
        out[r["col_name"]][index[float(r["p"])]] = r["value"]
    return out
