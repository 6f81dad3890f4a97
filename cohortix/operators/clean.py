"""Cleaning operators: NULL-out, winsorize, impute, encode, transform, trim.

Fitted statistics (medians, bounds) are a handful of scalars per column; they
are computed once on the fitting frame and applied as literals (or as a
broadcast one-row frame), so applying them is a narrow projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.functions.exprs import pct, clip, encode_binary, outside, within_or_null
from cohortix.operators.cumulative import quantile_table


def null_out_impossible(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Values outside ``[lo, hi]`` become NULL (only listed columns change)."""
    return df.withColumns(
        {c: within_or_null(F.col(c), lo, hi) for c, (lo, hi) in bounds.items() if c in df.columns}
    )


def impossible_report(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """``(col_name, n_nulled)`` for columns where the rule fires."""
    cols = [c for c in bounds if c in df.columns]
    structs = [
        F.struct(F.lit(c).alias("col_name"), F.count_if(outside(c, *bounds[c])).alias("n_nulled"))
        for c in cols
    ]
    return (
        df.agg(F.array(*structs).alias("a")).select(F.inline("a")).where(F.col("n_nulled") > 0)
    )


def inf_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """+-infinity becomes NULL in ``cols``, by default every floating column."""
    floating = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    cols = floating if cols is None else [c for c in cols if c in floating]
    return df.withColumns({c: F.when(F.abs(F.col(c)) != float("inf"), F.col(c)) for c in cols})


def winsorize(df: DataFrame, caps: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Clip each listed column to its ``(lo, hi)``; missing stays missing."""
    out = {}
    for c, (lo, hi) in caps.items():
        if c not in df.columns:
            continue
        t = df.schema[c].dataType
        integral = t.typeName() in ("integer", "long", "short", "byte")
        if integral and float(lo).is_integer() and float(hi).is_integer():
            out[c] = clip(F.col(c), int(lo), int(hi)).cast(t)
        else:
            out[c] = clip(F.col(c), lo, hi)
    return df.withColumns(out)


def winsorize_report(df: DataFrame, caps: Mapping[str, tuple[float, float]]) -> DataFrame:
    """``(col_name, n_low, n_high)`` for columns where clipping changes values."""
    cols = [c for c in caps if c in df.columns]
    structs = [
        F.struct(
            F.lit(c).alias("col_name"),
            F.count_if(F.col(c) < caps[c][0]).alias("n_low"),
            F.count_if(F.col(c) > caps[c][1]).alias("n_high"),
        )
        for c in cols
    ]
    return (
        df.agg(F.array(*structs).alias("a"))
        .select(F.inline("a"))
        .where(F.col("n_low") + F.col("n_high") > 0)
    )


def fit_medians(df: DataFrame, cols: Sequence[str], exact: bool = True) -> dict[str, float | None]:
    """Column medians (pandas ``median``: NULLs skipped, linear interpolation)."""
    q = quantile_table(df, list(cols), [0.5], exact=exact)
    return {c: q[c][0] for c in cols}


def impute_median(df: DataFrame, cols: Sequence[str], fit_df: DataFrame | None = None,
                  exact: bool = True, medians: Mapping[str, float] | None = None) -> DataFrame:
    """NULL -> median fitted on ``fit_df`` (default: ``df`` itself).

    Pass the train frame as ``fit_df`` for leakage-free imputation.
    """
    med = dict(medians) if medians is not None else fit_medians(fit_df or df, cols, exact)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(med[c]).cast(df.schema[c].dataType))
         for c in cols if med.get(c) is not None}
    )


def impute_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Flag columns: NULL -> 0, as int."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in cols})


def encode(df: DataFrame, col: str, positive: str = "M", out: str | None = None) -> DataFrame:
    """``{col}_encoded`` = 1 for ``positive``, else 0 (missing included)."""
    return df.withColumn(out or f"{col}_encoded", encode_binary(F.col(col), positive))


def log1p_columns(df: DataFrame, cols: Sequence[str], suffix: str = "_log") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": F.log1p(F.col(c)) for c in cols if c in df.columns})


def quantile_trim(df: DataFrame, col: str, lo_q: float = 0.01, hi_q: float = 0.99,
                  exact: bool = True) -> DataFrame:
    """Keep non-null rows with ``q_lo <= x <= q_hi`` (inclusive)."""
    lo, hi = quantile_table(df, [col], [lo_q, hi_q], exact=exact)[col]
    if lo is None:
        return df.limit(0)
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))


def stats_apply(df: DataFrame, stats: DataFrame,
                fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a one-row statistics frame to every row.

    ``stats`` must be a one-row aggregate (fixed size), so it is broadcast and
    attached with a nested-loop join that does not move ``df``.
    """
    joined = df.crossJoin(F.broadcast(stats))
    return fn(joined).drop(*[c for c in stats.columns if c not in df.columns])


def before_after(original: DataFrame, cleaned: DataFrame, numeric: Sequence[str],
                 labels: Sequence[str]) -> DataFrame:
    """Rows, removed rows, missing values and feature duplicates, before vs after."""
    from cohortix.operators.duplicates import duplicate_profile

    def prof(d: DataFrame, stage: str) -> DataFrame:
        cols = [c for c in numeric if c in d.columns]
        miss = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0).cast("long"))
        m = d.agg(F.count(F.lit(1)).alias("n_rows"), miss.cast("long").alias("n_missing"))
        dups = duplicate_profile(d.drop(*[c for c in labels if c in d.columns])).select(
            F.col("n_exact_dup").alias("n_feature_dup")
        )
        return m.crossJoin(dups).select(F.lit(stage).alias("stage"), "*")

    a, b = prof(original, "original"), prof(cleaned, "cleaned")
    both = a.unionByName(b)
    n0 = a.select(F.col("n_rows").alias("n0"))
    return both.crossJoin(F.broadcast(n0)).select(
        "stage",
        "n_rows",
        (F.col("n0") - F.col("n_rows")).alias("n_removed"),
        F.round(pct(F.col("n0") - F.col("n_rows"), F.col("n0")), 1).alias("removed_pct"),
        "n_missing",
        "n_feature_dup",
    )


def label_filter(df: DataFrame, label: str, value) -> DataFrame:
    """Rows of one label value (pushed down to the scan as ``EqualTo``)."""
    return df.where(F.col(label) == F.lit(value))


def drop_missing(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is present (``dropna(subset=[col])``)."""
    return df.where(F.col(col).isNotNull())


def project_roles(df: DataFrame, roles) -> DataFrame:
    """Keep the feature columns of ``roles`` (drop ids, labels, excluded)."""
    return df.select(*roles.features(df))
