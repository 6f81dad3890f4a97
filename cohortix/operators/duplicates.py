"""Duplicate profiles, duplicate marking and majority-vote de-duplication.

All of these are hash aggregations: partial aggregation on the map side means
a key that holds a third of the table still ships one buffer per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix.functions.exprs import pct
from cohortix.operators.profile import digest, hashable


def duplicate_profile(df: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    """Exact, feature and conflicting duplicates from digests of the rows.

    A row is a 128-bit digest of its non-label columns and one of its labels,
    both over typed values with null marks, so 32 bytes a row are shuffled,
    whatever its width. Groups by the feature digest and counts distinct
    label digests inside each group: ``(n_rows, n_distinct_rows, n_exact_dup,
    exact_dup_pct, n_distinct_features, n_feature_dup, feature_dup_pct,
    n_conflict_groups, n_conflict_rows)``. ``n_conflict_rows`` =
    distinct(all) - distinct(features). Two different rows among 10^12 have
    one digest with odds below 10^-14.
    """
    labels = list(labels)
    feats = [hashable(df, c) for c in df.columns if c not in set(labels)]
    labs = [hashable(df, c) for c in labels]
    rows = df.select(*[digest(feats, k).alias(f"f{k}") for k in (1, 2)],
                     *([digest(labs, k).alias(f"l{k}") for k in (1, 2)] if labels else []))
    if labels:
        inner = rows.groupBy("f1", "f2").agg(
            F.count(F.lit(1)).alias("_cx_n"),
            F.count_distinct("l1", "l2").alias("_cx_k"),
        )
    else:
        inner = rows.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("_cx_n"),
                                             F.lit(1).cast("long").alias("_cx_k"))
    s = inner.agg(
        F.sum("_cx_n").alias("n_rows"),
        F.sum("_cx_k").alias("n_distinct_rows"),
        F.count(F.lit(1)).alias("n_distinct_features"),
        F.count_if(F.col("_cx_k") > 1).alias("n_conflict_groups"),
    )
    return s.select(
        F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce("n_distinct_rows", F.lit(0)).cast("long").alias("n_distinct_rows"),
        (F.col("n_rows") - F.col("n_distinct_rows")).cast("long").alias("n_exact_dup"),
        F.round(pct(F.col("n_rows") - F.col("n_distinct_rows"), F.col("n_rows")), 1).alias("exact_dup_pct"),
        F.col("n_distinct_features").cast("long").alias("n_distinct_features"),
        (F.col("n_rows") - F.col("n_distinct_features")).cast("long").alias("n_feature_dup"),
        F.round(pct(F.col("n_rows") - F.col("n_distinct_features"), F.col("n_rows")), 1).alias("feature_dup_pct"),
        F.col("n_conflict_groups").cast("long").alias("n_conflict_groups"),
        (F.col("n_distinct_rows") - F.col("n_distinct_features")).cast("long").alias("n_conflict_rows"),
    )


def dup_exact(df: DataFrame) -> DataFrame:
    """``(n_rows, n_dup, dup_pct)``: rows beyond the first copy."""
    return duplicate_profile(df).select(
        "n_rows", F.col("n_exact_dup").alias("n_dup"), F.col("exact_dup_pct").alias("dup_pct")
    )


def dup_features(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Duplicates ignoring the label columns."""
    return duplicate_profile(df.drop(*labels)).select(
        "n_rows", F.col("n_exact_dup").alias("n_dup"), F.col("exact_dup_pct").alias("dup_pct")
    )


def dup_conflict(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Feature-duplicate groups whose copies disagree on a label."""
    return duplicate_profile(df, labels).select(
        "n_distinct_rows", "n_distinct_features", "n_conflict_groups", "n_conflict_rows"
    )


def _eq(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


ROW_ORDER = "_row_order"


def _order(df: DataFrame, order_by: Sequence[str] | None) -> list[str]:
    """The given order, else the scan's file/row position (``_row_order``)."""
    if order_by:
        return list(order_by)
    if ROW_ORDER in df.columns:
        return [ROW_ORDER]
    raise ValueError("no row order: pass order_by or scan with row_order=True")


def dup_mark(df: DataFrame, cols: Sequence[str], order_by: Sequence[str] | None = None,
             out: str = "is_dup") -> DataFrame:
    """Mark the 2nd..nth copy of each ``cols`` group (first in ``order_by`` kept).

    The first copy is found with ``min(struct(order_by))`` per group (partial
    aggregation, so a hot group costs one buffer per task) and joined back on
    the group key; a hot key on the big side is split by AQE's skew-join. The
    order must be total (e.g. the scan's file/row position).
    """
    cols, order_by = list(cols), _order(df, order_by)
    ordk = F.struct(*[F.col(c) for c in order_by])
    firsts = df.groupBy(*cols).agg(F.min(ordk).alias("_cx_first"))
    d = df.withColumn("_cx_ord", ordk)
    j = d.join(firsts, _eq(d, firsts, cols), "left").select(
        d["*"], firsts["_cx_first"]
    )
    return j.withColumn(out, ~F.col("_cx_ord").eqNullSafe(F.col("_cx_first"))).drop(
        "_cx_ord", "_cx_first"
    )


def dedup_majority(df: DataFrame, key: str, order_by: Sequence[str] | None = None,
                   first_cols: Sequence[str] | None = None,
                   vote_cols: Sequence[str] = ()) -> DataFrame:
    """One row per ``key``.

    Each ``first_cols`` column takes its first non-missing value in
    ``order_by`` order (so one output row may mix source rows); each
    ``vote_cols`` column takes its most frequent value, ties to the smallest;
    rows with a NULL key are dropped. Both aggregates are partial-able.
    """
    vote = list(vote_cols)
    order_by = _order(df, order_by)
    firsts = list(first_cols) if first_cols is not None else [
        c for c in df.columns if c != key and c not in set(vote) and c != ROW_ORDER
    ]
    # one order column needs no struct: each first value then carries that column only
    ordk = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*[F.col(c) for c in order_by])
    aggs = [
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), ordk)).alias(c) for c in firsts
    ] + [F.mode(F.col(c), True).alias(c) for c in vote]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
