"""Table profiles: shape, types, missing values, ranges, outliers, moments,
distributions, correlation and class balance.

Every profile reads its input once with one wide ``agg`` (partial + final hash
aggregation, so each task ships one row) and turns the one-row result into a
long table with ``inline``. Only quantile-based profiles take a second pass.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortix.functions.exprs import pct, severity_band
from cohortix.operators.cumulative import quantile_table


class Fused:
    """Several profiles of one table from one scan.

    :meth:`tables` runs each maker of a profile twice: once to collect the
    aggregates that it declares, once, when one ``agg`` has computed those of
    all makers, to build its table on that row (schema width). A profile that
    nobody asks for costs nothing; makers must be deterministic.
    """

    _open: Fused | None = None

    def __init__(self, df: DataFrame):
        self.df, self.asked, self.row, self.next = df, [], None, 0

    def take(self, structs: list[Column]) -> DataFrame | None:
        """None while aggregates are collected; then the part of the row."""
        if self.row is None:
            self.asked.append(structs)
            return None
        self.next += 1
        return self.row.select(F.inline(f"_cx_{self.next - 1}"))

    @staticmethod
    def tables(df: DataFrame, makers: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        fused = Fused(df)
        Fused._open = fused
        try:
            for make in makers.values():
                make()
            if fused.asked:
                one = df.agg(*[F.array(*s).alias(f"_cx_{i}") for i, s in enumerate(fused.asked)])
                fused.row = df.sparkSession.createDataFrame([one.first()], one.schema)
            else:
                fused.row = df
            return {name: make() for name, make in makers.items()}
        finally:
            Fused._open = None


def _inline(df: DataFrame, structs: list[Column], empty_schema: str | None = None) -> DataFrame:
    """One aggregate over ``df`` returning one row per struct; with no structs
    the (typed) empty table ``empty_schema``. Inside :class:`Fused` the
    aggregate is shared with the other profiles of the same table."""
    if not structs:
        return df.sparkSession.createDataFrame([], empty_schema or "col_name string")
    if Fused._open is not None and Fused._open.df is df:
        shared = Fused._open.take(structs)
        if shared is not None:
            return shared
    return df.agg(F.array(*structs).alias("_cx_a")).select(F.inline("_cx_a"))


# --- shape and types ----------------------------------------------------------


def table_shape(df: DataFrame) -> DataFrame:
    """``(n_rows, n_cols)``."""
    return _inline(df, [F.struct(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_cols"))])


def hashable(df: DataFrame, col: str) -> Column:
    """A column in a form whose hash tells its values apart: nested ones as JSON."""
    t = df.schema[col].dataType
    c = F.col(f"`{col}`")
    if isinstance(t, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(F.struct(c), {"ignoreNullFields": "false"})
    return c


def digest(cols: Sequence[Column], seed: int) -> Column:
    """64-bit digest of typed values and their null marks (two seeds: 128 bits)."""
    return F.xxhash64(F.lit(seed), *[x for c in cols for x in (c.isNull(), c)])


def schema_profile(df: DataFrame, cols: Sequence[str] | None = None,
                   approx: bool = False) -> DataFrame:
    """Per column: type and number of distinct non-null values.

    Exact counts come from one shuffle of (column, 128-bit digest of the
    value), each task handing on a digest once; the values themselves are not
    shuffled. ``approx=True`` estimates them from :func:`distinct_sketches`,
    which is one pass at any scale.
    """
    cols = list(df.columns if cols is None else cols)
    schema = "col_name string, dtype string, n_unique long"
    if not cols:
        return df.sparkSession.createDataFrame([], schema)
    if approx:
        return merged_distinct(distinct_sketches(df, cols))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    each = [F.struct(F.lit(i).alias("i"), c.isNotNull().alias("there"), digest([c], 1).alias("a"),
                     digest([c], 2).alias("b")) for i, c in enumerate(hashable(df, c) for c in cols)]
    values = df.select(F.inline(F.array(*each))).where("there").select("i", "a", "b").distinct()
    n = values.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    names = df.sparkSession.createDataFrame([(i, c, types[c]) for i, c in enumerate(cols)],
                                            "i int, col_name string, dtype string")
    # a row per column of the schema on both sides
    return names.join(F.broadcast(n), "i", "left").select(
        "col_name", "dtype", F.coalesce("n", F.lit(0)).cast("long").alias("n_unique"))


def distinct_sketches(df: DataFrame, cols: Sequence[str] | None = None, lg_k: int = 12) -> DataFrame:
    """``(col_name, dtype, sketch)``: a mergeable sketch of each column's distinct values.

    A HyperLogLog sketch of the values' digests, which can be stored: the
    union of the tables of many runs or days goes to :func:`merged_distinct`.
    """
    cols = list(df.columns if cols is None else cols)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return _inline(df, [
        F.struct(F.lit(c).alias("col_name"), F.lit(types[c]).alias("dtype"),
                 F.hll_sketch_agg(F.when(h.isNotNull(), digest([h], 1)), lg_k).alias("sketch"))
        for c, h in ((c, hashable(df, c)) for c in cols)], "col_name string, dtype string, sketch binary")


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """``(col_name, dtype, n_unique)`` estimated from one or many tables of sketches."""
    return sketches.groupBy("col_name", "dtype").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("long").alias("n_unique"))


def unexpected_types(df: DataFrame, expected_strings: Sequence[str]) -> DataFrame:
    """String columns other than the expected ones: ``(col_name, dtype, n_values, n_numeric)``.

    One aggregate over the rows counts a column's values and those that read
    as numbers: a column of numbers with a few bad texts shows at once.
    """
    found = [f for f in df.schema.fields
             if isinstance(f.dataType, T.StringType) and f.name not in set(expected_strings)]
    if not found:
        return df.sparkSession.createDataFrame([], "col_name string, dtype string, n_values long, n_numeric long")
    return _inline(df, [
        F.struct(F.lit(f.name).alias("col_name"), F.lit(f.dataType.simpleString()).alias("dtype"),
                 F.count(f.name).alias("n_values"),
                 F.count(F.col(f.name).try_cast("double")).alias("n_numeric"))
        for f in found])


# --- missing values -------------------------------------------------------------


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None,
                    high_pct: float = 30.0) -> DataFrame:
    """``(col_name, n_missing, missing_pct, high)`` sorted by count desc."""
    cols = list(df.columns if cols is None else cols)
    n = F.count(F.lit(1))
    out = _inline(
        df,
        [
            F.struct(
                F.lit(c).alias("col_name"),
                F.count_if(F.col(c).isNull()).alias("n_missing"),
                F.round(pct(F.count_if(F.col(c).isNull()), n), 2).alias("missing_pct"),
            )
            for c in cols
        ],
        "col_name string, n_missing long, missing_pct double",
    )
    return out.withColumn("high", F.col("missing_pct") > high_pct).orderBy(
        F.desc("n_missing"), "col_name"
    )


def missing_total(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(n_missing)`` summed over all ``cols`` in one pass."""
    cols = list(df.columns if cols is None else cols)
    total = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0).cast("long"))
    return df.agg(total.cast("long").alias("n_missing"))


# --- ranges and outliers --------------------------------------------------------


def range_violations(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Values strictly outside ``[lo, hi]`` per column.

    ``(col_name, lo, hi, n_below, n_above, n_total, pct, actual_min,
    actual_max)``; only columns with at least one violation, by pct desc.
    pct is of non-null values; NULL never violates.
    """
    cols = [c for c in ranges if c in df.columns]
    structs = []
    for c in cols:
        lo, hi = ranges[c]
        x = F.col(c)
        below = F.count_if(x < F.lit(lo))
        above = F.count_if(x > F.lit(hi))
        structs.append(
            F.struct(
                F.lit(c).alias("col_name"),
                F.lit(float(lo)).alias("lo"),
                F.lit(float(hi)).alias("hi"),
                below.alias("n_below"),
                above.alias("n_above"),
                (below + above).alias("n_total"),
                F.round(pct(below + above, F.count(x)), 2).alias("pct"),
                F.round(F.min(x).cast("double"), 4).alias("actual_min"),
                F.round(F.max(x).cast("double"), 4).alias("actual_max"),
            )
        )
    return _inline(df, structs, "col_name string, lo double, hi double, n_below long, n_above long, "
                   "n_total long, pct double, actual_min double, actual_max double").where(
        F.col("n_total") > 0).orderBy(
        F.desc("pct"), "col_name"
    )


def critical_flag(violations: DataFrame, critical: Sequence[str]) -> DataFrame:
    """Violations of the named critical columns (e.g. pH)."""
    return violations.where(F.col("col_name").isin(list(critical)))


def scale_mix(df: DataFrame, col: str, unit_max: float = 1.0) -> DataFrame:
    """Mixed-unit test: some but not all non-null values are ``<= unit_max``."""
    x = F.col(col)
    return df.agg(
        F.count_if(x <= unit_max).alias("n_unit"), F.count(x).alias("n_nonnull")
    ).select(
        F.lit(col).alias("col_name"),
        "n_unit",
        "n_nonnull",
        ((F.col("n_unit") > 0) & (F.col("n_unit") < F.col("n_nonnull"))).alias("mixed"),
    )


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5,
                 exact: bool = True) -> DataFrame:
    """Tukey fences from linear-interpolated quartiles.

    ``(col_name, n_outliers, pct, q1, q3, iqr, lo_bound, hi_bound, min, max)``
    for columns with outliers. Quartiles are ``2 * len(cols)`` scalars; the
    counting pass is one wide ``agg`` with the fences as literals.
    """
    cols = list(cols)
    q = quantile_table(df, cols, [0.25, 0.75], exact=exact)
    structs = []
    for c in cols:
        q1, q3 = q[c]
        if q1 is None:
            continue
        iqr = q3 - q1
        lo, hi = q1 - k * iqr, q3 + k * iqr
        x = F.col(c)
        n_out = F.count_if((x < F.lit(lo)) | (x > F.lit(hi)))
        structs.append(
            F.struct(
                F.lit(c).alias("col_name"),
                n_out.alias("n_outliers"),
                F.round(pct(n_out, F.count(x)), 2).alias("pct"),
                F.round(F.lit(q1), 4).alias("q1"),
                F.round(F.lit(q3), 4).alias("q3"),
                F.round(F.lit(iqr), 4).alias("iqr"),
                F.round(F.lit(lo), 4).alias("lo_bound"),
                F.round(F.lit(hi), 4).alias("hi_bound"),
                F.round(F.min(x).cast("double"), 4).alias("min"),
                F.round(F.max(x).cast("double"), 4).alias("max"),
            )
        )
    if not structs:
        return df.sparkSession.createDataFrame(
            [], "col_name string, n_outliers long, pct double, q1 double, q3 double, "
            "iqr double, lo_bound double, hi_bound double, min double, max double"
        )
    return _inline(df, structs).where(F.col("n_outliers") > 0).orderBy(
        F.desc("pct"), "col_name"
    )


def box_stats(df: DataFrame, cols: Sequence[str], k: float = 1.5,
              exact: bool = True) -> DataFrame:
    """Data behind a box plot: quartiles, whisker ends and flier count."""
    cols = list(cols)
    q = quantile_table(df, cols, [0.25, 0.5, 0.75], exact=exact)
    structs = []
    for c in cols:
        q1, med, q3 = q[c]
        if q1 is None:
            continue
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        x = F.col(c).cast("double")
        inside = (x >= F.lit(lo)) & (x <= F.lit(hi))
        structs.append(
            F.struct(
                F.lit(c).alias("col_name"),
                F.lit(q1).alias("q1"),
                F.lit(med).alias("median"),
                F.lit(q3).alias("q3"),
                F.min(F.when(inside, x)).alias("whisker_lo"),
                F.max(F.when(inside, x)).alias("whisker_hi"),
                F.count_if(x.isNotNull() & ~inside).alias("n_fliers"),
            )
        )
    return _inline(df, structs, "col_name string, q1 double, median double, q3 double, "
                   "whisker_lo double, whisker_hi double, n_fliers long")


# --- moments ------------------------------------------------------------------


def _g1_adjusted(x: Column) -> Column:
    """Bias-adjusted sample skewness G1 (pandas ``skew``); NULL for n < 3 and
    0.0 for a constant column (Spark's ``skewness`` gives NULL there)."""
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    constant = F.max(x) == F.min(x)
    return F.when(n >= 3, F.when(constant, F.lit(0.0)).otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2)))


def skewness(df: DataFrame, cols: Sequence[str], flag_abs: float = 1.0) -> DataFrame:
    """``(col_name, skew, flagged)`` with G1 = g1 * sqrt(n(n-1)) / (n-2)."""
    out = _inline(
        df,
        [
            F.struct(F.lit(c).alias("col_name"), _g1_adjusted(F.col(c).cast("double")).alias("skew"))
            for c in cols
        ],
        "col_name string, skew double",
    )
    return out.withColumn("flagged", F.abs("skew") > flag_abs)


def summary_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(col_name, n, mean, std, min, max)``; std has ddof 1."""
    return _inline(
        df,
        [
            F.struct(
                F.lit(c).alias("col_name"),
                F.count(F.col(c)).alias("n"),
                F.avg(F.col(c)).cast("double").alias("mean"),
                F.stddev_samp(F.col(c)).cast("double").alias("std"),
                F.min(F.col(c)).cast("double").alias("min"),
                F.max(F.col(c)).cast("double").alias("max"),
            )
            for c in cols
        ],
        "col_name string, n long, mean double, std double, min double, max double",
    )


def group_moments(df: DataFrame, by: str, col: str) -> DataFrame:
    """Per value of ``by``: n, mean and sample std of ``col``."""
    return (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count(F.col(col)).alias("n"),
            F.avg(col).cast("double").alias("mean"),
            F.stddev_samp(col).cast("double").alias("std"),
        )
    )


# --- categories and classes -----------------------------------------------------


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, n)`` by count desc; NULL excluded."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def _balance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: number of classes, smallest and largest class, min/max ratio."""
    parts = []
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "col_name string, n_classes long, n_min long, n_max long, ratio double")
    for c in cols:
        counts = (
            df.where(F.col(c).isNotNull())
            .groupBy(F.col(c))
            .agg(F.count(F.lit(1)).alias("_cx_n"))
        )
        parts.append(
            counts.agg(
                F.count(F.lit(1)).alias("n_classes"),
                F.min("_cx_n").alias("n_min"),
                F.max("_cx_n").alias("n_max"),
            ).select(
                F.lit(c).alias("col_name"),
                "n_classes",
                "n_min",
                "n_max",
                (F.col("n_min") / F.col("n_max")).alias("ratio"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def class_balance(df: DataFrame, labels: Sequence[str], severe: float = 0.1,
                  moderate: float = 0.3) -> DataFrame:
    """Minority/majority ratio per label with SEVERE / MODERATE / OK."""
    return _balance(df, labels).withColumn(
        "severity", severity_band(F.col("ratio"), [(severe, "SEVERE"), (moderate, "MODERATE")], "OK")
    )


def category_balance(df: DataFrame, cols: Sequence[str], warn: float = 0.5) -> DataFrame:
    """Category min/max ratio; WARNING below ``warn``."""
    return _balance(df, cols).withColumn(
        "severity", F.when(F.col("ratio") < warn, "WARNING").otherwise("OK")
    )


def crosstab(df: DataFrame, row: str, col: str) -> DataFrame:
    """Long-form crosstab: ``(row_value, col_value, n, row_share, row_pct)``.

    row_share is n over the row total (``normalize='index'``), row_pct the
    same times 100; NULLs excluded.
    The row totals come from a window over the small count table.
    """
    counts = (
        df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
        .groupBy(F.col(row).alias("row_value"), F.col(col).alias("col_value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    w = Window.partitionBy("row_value")
    return counts.withColumns({
        "row_share": F.col("n") / F.sum("n").over(w),
        "row_pct": pct(F.col("n"), F.sum("n").over(w)),
    })


def crosstab_wide(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Pivoted counts with the column values given (no distinct pre-pass)."""
    return (
        df.where(F.col(row).isNotNull())
        .groupBy(row)
        .pivot(col, list(values))
        .agg(F.count(F.lit(1)))
        .fillna(0)
    )


# --- distributions ------------------------------------------------------------------


def bin_index(x: Column, lo: Column, width: Column, bins: int) -> Column:
    """Equal-width bin 1..bins; the maximum falls in the last bin."""
    raw = F.floor((x - lo) / width).cast("long") + 1
    return F.least(F.greatest(raw, F.lit(1)), F.lit(bins))


def histogram(df: DataFrame, col: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., bin, lo_edge, hi_edge, n, density)``; empty bins are not listed.

    The edges are those of the whole column, so groups can be compared; each
    group's density sums to one. A constant x spans x - 0.5 to x + 0.5.

    min/max are a one-row aggregate joined by broadcast (one row, fixed size);
    counting is one ``groupBy(bin)`` with map-side combine.
    """
    x = F.col(col).cast("double")
    by = list(by)
    data = df.select(*by, x.alias("_cx_x")).where(F.col("_cx_x").isNotNull())
    rng = data.agg(F.min("_cx_x").alias("_lo"), F.max("_cx_x").alias("_hi"))
    rng = rng.select(
        F.when(F.col("_hi") > F.col("_lo"), F.col("_lo")).otherwise(F.col("_lo") - 0.5).alias("mn"),
        F.when(F.col("_hi") > F.col("_lo"), (F.col("_hi") - F.col("_lo")) / bins).otherwise(1.0 / bins).alias("w"))
    j = data.crossJoin(F.broadcast(rng))
    counted = j.groupBy(
        *by, bin_index(F.col("_cx_x"), F.col("mn"), F.col("w"), bins).alias("bin"), "mn", "w"
    ).agg(F.count(F.lit(1)).alias("n"))
    # at most ``bins`` rows per group
    counted = counted.withColumn("n_all", F.sum("n").over(Window.partitionBy(*(by or [F.lit(0)]))))
    return counted.select(
        *by,
        "bin",
        (F.col("mn") + (F.col("bin") - 1) * F.col("w")).alias("lo_edge"),
        (F.col("mn") + F.col("bin") * F.col("w")).alias("hi_edge"),
        "n",
        (F.col("n") / (F.col("n_all") * F.col("w"))).alias("density"),
    )


# --- correlation --------------------------------------------------------------------


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson r for every pair i < j: ``(col_a, col_b, i, j, r)``.

    One scan for any number of columns: each task adds up the cross products
    of its rows as matrix products - rows, sums, squares and products over
    the rows where both columns of a pair have a value, centred by a value of
    each column - and hands on one row per pair; Spark sums those. Null for a
    pair without two rows or with a constant column, as ``corr``; NaN and
    infinite values make it NaN.
    """
    from cohortix.session import share_package

    cols, spark = list(cols), df.sparkSession
    names = spark.createDataFrame([(i, c) for i, c in enumerate(cols)], "i int, name string")
    if len(cols) < 2:
        return spark.createDataFrame([], "col_a string, col_b string, i int, j int, r double")
    share_package(spark)
    x = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    row = x.first()
    shift = [v if v is not None and v == v and abs(v) != float("inf") else 0.0 for v in row] if row else [0.0] * len(cols)
    stats = ["n", "sa", "sb", "qa", "qb", "ab"]

    def products(batches):
        p = len(shift)
        total = np.zeros((6, p, p))
        for b in batches:
            z = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1)
            there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns], axis=1).astype(float)
            z = np.where(there > 0, z - shift, 0.0)
            with np.errstate(invalid="ignore"):
                sums, squares = z.T @ there, (z * z).T @ there
                total += np.stack([there.T @ there, sums, sums.T, squares, squares.T, z.T @ z])
        i, j = np.triu_indices(p, 1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                          *[pa.array(t[i, j]) for t in total]], names=["i", "j", *stats])

    parts = x.mapInArrow(products, "i int, j int, " + ", ".join(f"{c} double" for c in stats))
    t = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in stats])
    n = F.col("n")
    # sums of squares about the mean; rounding leaves a constant column a little off zero
    va, vb = (F.col(q) - F.col(s) * F.col(s) / n for q, s in (("qa", "sa"), ("qb", "sb")))
    flat = (va <= F.col("qa") * 1e-14) | (vb <= F.col("qb") * 1e-14)
    r = F.when((n > 1) & ~flat, (F.col("ab") - F.col("sa") * F.col("sb") / n) / F.sqrt(va) / F.sqrt(vb))
    return t.join(F.broadcast(names), "i").join(  # a row per column
        F.broadcast(names.select(F.col("i").alias("j"), F.col("name").alias("col_b"))), "j").select(
            F.col("name").alias("col_a"), "col_b", "i", "j", r.alias("r"))


def corr_pairs(matrix: DataFrame, features: Sequence[str], high: float = 0.9,
               moderate: float = 0.7) -> DataFrame:
    """Feature pairs with |r| > high (HIGH) or moderate < |r| <= high (MODERATE)."""
    feats = list(features)
    a = F.abs("r")
    return (
        matrix.where(F.col("col_a").isin(feats) & F.col("col_b").isin(feats))
        .withColumn(
            "band",
            F.when(a > high, "HIGH").when((a > moderate) & (a <= high), "MODERATE"),
        )
        .where(F.col("band").isNotNull())
    )


def corr_label(matrix: DataFrame, features: Sequence[str], labels: Sequence[str],
               threshold: float = 0.8, min_abs: float | None = None) -> DataFrame:
    """Feature-label r, flagged above ``threshold`` (leakage risk), by |r|
    desc; ``min_abs`` keeps only pairs with |r| above it (the review list)."""
    feats, labs = list(features), list(labels)
    m = matrix.select("col_a", "col_b", "r")
    both = m.unionByName(m.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "r"))
    out = (
        both.where(F.col("col_a").isin(feats) & F.col("col_b").isin(labs))
        .select(F.col("col_b").alias("label"), F.col("col_a").alias("feature"), "r")
        .withColumn("flagged", F.abs("r") > threshold)
    )
    if min_abs is not None:
        out = out.where(F.abs("r") > min_abs)
    return out.orderBy(F.desc(F.abs("r")), "label", "feature")


def distinct_entities(df: DataFrame, split_col: str, group_col: str) -> DataFrame:
    """Rows and distinct groups per split value."""
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(group_col).alias("n_groups")
    )
