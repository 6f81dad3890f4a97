"""Statistical tests: chi-squared independence, two-sample t, fold CI.

The data work (contingency counts, group moments) is a Spark aggregate; the
only driver work is turning one statistic into a p-value.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- distribution tails: Spark's JVM has them ------------------------------------


#: Degrees of freedom from which Wallace's normal expansion of t is used.
LARGE_DOF = 1e6


def _special(name: str):
    spark = SparkSession.active()
    return getattr(spark.sparkContext._jvm.org.apache.commons.math3.special, name)


def t_two_sided_p(t: float, dof: float) -> float:
    """P(|T| >= |t|); nan without a statistic."""
    if t is None or dof is None or dof <= 0 or math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 0.0
    if dof > LARGE_DOF:
        # the beta function's logarithms lose digits here; this expansion is exact to 1 / dof^2
        z = (8 * dof + 1) / (8 * dof + 3) * math.sqrt(dof * math.log1p(t * t / dof))
        return math.erfc(z / math.sqrt(2))
    # I_x(a, b) of x = dof / (dof + t^2), by the side that keeps its digits
    y = t * t / (dof + t * t)
    beta = _special("Beta").regularizedBeta
    return beta(1.0 - y, dof / 2.0, 0.5) if y > 0.5 else 1.0 - beta(y, 0.5, dof / 2.0)


def chi2_sf(x: float, dof: int) -> float:
    """P(X >= x); nan without a degree of freedom."""
    if x is None or dof is None or dof <= 0:
        return float("nan")
    return _special("Gamma").regularizedGammaQ(dof / 2.0, max(x, 0.0) / 2.0)


# --- tests ---------------------------------------------------------------------------


def chi2_statistic(df: DataFrame, a: str, b: str, yates: bool = True) -> DataFrame:
    """``(chi2, dof, n_rows, n_cols)`` with the Yates correction at dof = 1.

    Works on the observed cells only: the empty cells of the r x c grid add
    their expected counts, which are N minus those of the observed cells. In
    a 2 x 2 table all four differences are equal, so one of them and the
    margins give the corrected sum. One ``groupBy(a, b)`` over the data, the
    margins by windows over the cells; a table without rows has no result.
    """
    cells = (
        df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(F.col(a).alias("av"), F.col(b).alias("bv"))
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    one = cells.agg(F.sum("n").alias("total"), F.count_distinct("av").alias("r"), F.count_distinct("bv").alias("c"))
    x = cells.withColumns({
        "rn": F.sum("n").over(Window.partitionBy("av")),
        "cn": F.sum("n").over(Window.partitionBy("bv")),
    }).crossJoin(F.broadcast(one))  # one row of totals
    e = F.col("rn") / F.col("total") * F.col("cn")
    diff = F.abs(F.col("n") - e)
    g = x.groupBy("total", "r", "c").agg(
        F.sum(diff * diff / e).alias("s"), F.sum(e).alias("e"), F.max(diff).alias("d"),
        F.sum(F.col("n") / F.col("rn") / F.col("rn")).alias("ri"),
        F.sum(F.col("n") / F.col("cn") / F.col("cn")).alias("ci"))
    dof = (F.col("r") - 1) * (F.col("c") - 1)
    d = F.col("d") - F.least(F.lit(0.5), F.col("d"))
    corrected = d * d * F.col("total") * F.col("ri") * F.col("ci")
    plain = F.col("s") + F.greatest(F.col("total") - F.col("e"), F.lit(0.0))
    return g.select(
        F.when((dof == 1) & F.lit(yates), corrected).otherwise(plain).alias("chi2"),
        dof.cast("long").alias("dof"), F.col("r").alias("n_rows"), F.col("c").alias("n_cols"))


def chi2_independence(df: DataFrame, a: str, b: str, alpha: float = 0.05,
                      yates: bool = True) -> DataFrame:
    """Chi-squared test of independence with p-value and WARNING/OK."""
    row = chi2_statistic(df, a, b, yates).first()
    spark = df.sparkSession
    if row is None:
        return spark.createDataFrame([], "a string, b string, chi2 double, dof long, p double, verdict string")
    p = chi2_sf(row["chi2"], int(row["dof"]))
    return spark.createDataFrame(
        [(a, b, float(row["chi2"]), int(row["dof"]), p, "WARNING" if p < alpha else "OK")],
        "a string, b string, chi2 double, dof long, p double, verdict string",
    )


def ttest_moments(df: DataFrame, group: str, col: str, g0=0, g1=1) -> DataFrame:
    """Pooled-variance Student t from one aggregate: ``(n0, n1, t, dof)``."""
    x = F.col(col)
    in0 = F.col(group) == F.lit(g0)
    in1 = F.col(group) == F.lit(g1)
    m = df.agg(
        F.count(F.when(in0, x)).alias("n0"),
        F.count(F.when(in1, x)).alias("n1"),
        F.avg(F.when(in0, x)).alias("m0"),
        F.avg(F.when(in1, x)).alias("m1"),
        F.var_samp(F.when(in0, x)).alias("v0"),
        F.var_samp(F.when(in1, x)).alias("v1"),
    )
    dof = F.col("n0") + F.col("n1") - 2
    sp2 = F.try_divide((F.col("n0") - 1) * F.col("v0") + (F.col("n1") - 1) * F.col("v1"), dof)
    se = F.sqrt(sp2 * (F.try_divide(F.lit(1.0), F.col("n0")) + F.try_divide(F.lit(1.0), F.col("n1"))))
    t = F.try_divide(F.col("m0") - F.col("m1"), se)
    return m.select("n0", "n1", "m0", "m1", t.alias("t"), dof.cast("long").alias("dof"))


def ttest_two_sample(df: DataFrame, group: str, col: str, g0=0, g1=1,
                     alpha: float = 0.05) -> DataFrame:
    """Two-sample t-test (equal variances) with p-value and WARNING/OK."""
    r = ttest_moments(df, group, col, g0, g1).first()
    t = r["t"]
    p = t_two_sided_p(float(t), float(r["dof"])) if t is not None else float("nan")
    return df.sparkSession.createDataFrame(
        [(group, col, int(r["n0"]), int(r["n1"]), None if t is None else float(t), p,
          "WARNING" if p < alpha else "OK")],
        T.StructType(
            [
                T.StructField("group", T.StringType()),
                T.StructField("col_name", T.StringType()),
                T.StructField("n0", T.LongType()),
                T.StructField("n1", T.LongType()),
                T.StructField("t", T.DoubleType()),
                T.StructField("p", T.DoubleType()),
                T.StructField("verdict", T.StringType()),
            ]
        ),
    )


def confidence_interval(metrics: DataFrame, value: str, by: list[str] | None = None,
                        z: float = 1.96) -> DataFrame:
    """mean +- z * std_pop / sqrt(n) over a fold-metric table."""
    by = by or []
    n = F.count(F.col(value))
    g = metrics.groupBy(*by) if by else metrics
    return g.agg(
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        n.alias("n"),
    ).select(
        *by,
        "mean",
        "std",
        "n",
        (F.col("mean") - z * F.col("std") / F.sqrt("n")).alias("ci_lo"),
        (F.col("mean") + z * F.col("std") / F.sqrt("n")).alias("ci_hi"),
    )
