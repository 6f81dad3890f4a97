"""Binary-classification metrics on a scored frame (label 0/1, score = P(y=1)).

Every metric takes ``by`` (e.g. model, fold) so many evaluations run as one
job. Curves and rank metrics first collapse rows to distinct scores
(``groupBy(by, score)``, map-side combined), then use the distributed running
totals, so no task ever holds every score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix.operators.cumulative import running_totals


def predict(df: DataFrame, score: str, threshold: float, out: str = "pred") -> DataFrame:
    """``score >= threshold`` as int."""
    return df.withColumn(out, (F.col(score) >= F.lit(threshold)).cast("int"))


def _div0(a: Column, b: Column) -> Column:
    """a / b with 0 when b is 0 (zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), F.nullif(b, F.lit(0)).cast("double")), F.lit(0.0))


def confusion_matrix(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """2x2 counts ``(by..., actual, predicted, n)`` including empty cells."""
    by = list(by)
    cells = df.groupBy(*by, F.col(label).cast("int").alias("actual"),
                       F.col(pred).cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, p) for a in (0, 1) for p in (0, 1)], "actual int, predicted int")
    if by:
        grid = df.select(*by).distinct().crossJoin(grid)
    return grid.join(cells, [*by, "actual", "predicted"], "left").fillna(0, ["n"])


def point_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, F1 (zero division -> 0) in one aggregate."""
    y, p = F.col(label), F.col(pred)
    g = df.groupBy(*by) if by else df
    c = g.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )
    prec = _div0(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div0(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select(
        *by, "n", "tp", "fp", "tn", "fn",
        _div0(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        _div0(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision/recall/F1/support, then accuracy, macro and weighted avg."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    c = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )

    def cls(name: str, tp: str, fp: str, fn: str) -> Column:
        pr = _div0(F.col(tp), F.col(tp) + F.col(fp))
        rc = _div0(F.col(tp), F.col(tp) + F.col(fn))
        return F.struct(
            F.lit(name).alias("row"),
            pr.alias("precision"),
            rc.alias("recall"),
            _div0(2 * F.col(tp), 2 * F.col(tp) + F.col(fp) + F.col(fn)).alias("f1"),
            (F.col(tp) + F.col(fn)).alias("support"),
        )

    per = c.select(F.inline(F.array(cls("0", "tn", "fn", "fp"), cls("1", "tp", "fp", "fn"))))
    avg = per.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").alias("n"),
    )
    acc = c.select(_div0(F.col("tp") + F.col("tn"), F.col("n")).alias("acc"))
    tail = avg.crossJoin(acc).select(
        F.inline(
            F.array(
                F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                         F.lit(None).cast("double").alias("recall"), F.col("acc").alias("f1"),
                         F.col("n").alias("support")),
                F.struct(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"),
                         F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support")),
                F.struct(F.lit("weighted avg").alias("row"), F.col("wp").alias("precision"),
                         F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support")),
            )
        )
    )
    return per.unionByName(tail)


def score_cumulative(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, descending: ``(by..., score, pos, neg, cum_pos, cum_neg,
    total_pos, total_neg)``; cumulative counts include the score itself.
    Rows without a score or label are left out."""
    by = list(by)
    taken = {"score", "pos", "neg"} & set(by)
    if taken:
        raise ValueError(f"grouping columns {sorted(taken)} clash with the output columns")
    y = F.col(label).cast("int")
    scored = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    per = scored.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    return running_totals(per, [F.col("score").desc()], ["pos", "neg"], group_by=by,
                          total_prefix="total_")


def roc_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., threshold, fpr, tpr)`` at every distinct score plus the origin
    (threshold NULL); no intermediate point is dropped."""
    by = list(by)
    c = score_cumulative(df, label, score, by)
    pts = c.select(
        *by,
        F.col("score").alias("threshold"),
        _div0(F.col("cum_neg"), F.col("total_neg")).alias("fpr"),
        _div0(F.col("cum_pos"), F.col("total_pos")).alias("tpr"),
    )
    origin = c.select(*by).distinct() if by else df.sparkSession.range(1).select()
    origin = origin.select(*by, F.lit(None).cast("double").alias("threshold"),
                           F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC with ties counted half: ``(by..., roc_auc)``.

    AUC = sum_s pos(s) * (negatives below s + neg(s) / 2) / (P * N).
    """
    return auc_from_cumulative(score_cumulative(df, label, score, by), by)


def auc_from_cumulative(c: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    by = list(by)
    below = F.col("total_neg") - F.col("cum_neg")
    contrib = F.col("pos").cast("double") * (below + F.col("neg") / 2.0)
    g = c.groupBy(*by, "total_pos", "total_neg").agg(F.sum(contrib).alias("s"))
    return g.select(
        *by,
        F.when((F.col("total_pos") > 0) & (F.col("total_neg") > 0),
               F.col("s") / F.col("total_pos") / F.col("total_neg")).alias("roc_auc"),
    )


def pr_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., threshold, precision, recall)`` per distinct score plus the end
    point (recall 0, precision 1, threshold NULL)."""
    by = list(by)
    c = score_cumulative(df, label, score, by)
    pts = c.select(
        *by,
        F.col("score").alias("threshold"),
        _div0(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.when(F.col("total_pos") == 0, F.lit(1.0))
        .otherwise(F.col("cum_pos") / F.col("total_pos")).alias("recall"),
    )
    end = c.select(*by).distinct() if by else df.sparkSession.range(1).select()
    end = end.select(*by, F.lit(None).cast("double").alias("threshold"),
                     F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Step-rule AP = sum_i (R_i - R_{i-1}) * P_i (not the trapezoid)."""
    return ap_from_cumulative(score_cumulative(df, label, score, by), by)


def ap_from_cumulative(c: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    by = list(by)
    contrib = F.col("pos").cast("double") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    g = c.groupBy(*by, "total_pos").agg(F.sum(contrib).alias("s"))
    return g.select(*by, F.when(F.col("total_pos") > 0, F.col("s") / F.col("total_pos")).alias("average_precision"))


def brier(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    g = df.groupBy(*by) if by else df
    return g.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def calibration_edges(n_bins: int) -> list[float]:
    """Interior edges of ``n_bins`` uniform bins on [0, 1] (i / n_bins)."""
    return [i * (1.0 / n_bins) for i in range(1, n_bins)]


def calibration_bin(score: Column, n_bins: int = 10) -> Column:
    """0-based bin; a score equal to an edge belongs to the lower bin."""
    out = F.lit(0)
    for e in calibration_edges(n_bins):
        out = out + (score > F.lit(e)).cast("int")
    return out


def calibration_bins(df: DataFrame, label: str, score: str, n_bins: int = 10,
                     by: Sequence[str] = ()) -> DataFrame:
    """Non-empty bins: ``(by..., bin, n, mean_predicted, fraction_positive)``."""
    return df.groupBy(*by, calibration_bin(F.col(score), n_bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("fraction_positive"),
    )


def evaluate(df: DataFrame, label: str, score: str, threshold: float,
             by: Sequence[str] = ()) -> DataFrame:
    """All scalar metrics per ``by``: point metrics, ROC-AUC, AP, Brier.

    Everything follows from the counts of each distinct score, so the scored
    rows (and the model behind them) are read once. Rows without a score or
    a label are left out. No row: one row of zeros without ``by``.
    """
    by = list(by)
    c = score_cumulative(df, label, score, by)
    s, pos, neg = F.col("score"), F.col("pos").cast("double"), F.col("neg").cast("double")
    hit = s >= F.lit(threshold)
    count = lambda x, n: F.coalesce(F.sum(F.when(x, F.col(n)).otherwise(0)), F.lit(0))
    below = F.col("total_neg") - F.col("cum_neg")
    g = c.groupBy(*by).agg(
        F.coalesce(F.sum(F.col("pos") + F.col("neg")), F.lit(0)).alias("n"),
        count(hit, "pos").alias("tp"), count(hit, "neg").alias("fp"),
        count(~hit, "neg").alias("tn"), count(~hit, "pos").alias("fn"),
        F.sum(pos * (below + neg / 2.0)).alias("_auc"),
        F.sum(pos * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("_ap"),
        F.sum(pos * F.pow(s - 1, 2) + neg * s * s).alias("_brier"))
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    p, n = tp + fn, fp + tn
    return g.select(
        *by, "n", "tp", "fp", "tn", "fn",
        _div0(tp + tn, F.col("n")).alias("accuracy"),
        _div0(tp, tp + fp).alias("precision"),
        _div0(tp, tp + fn).alias("recall"),
        _div0(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.when((p > 0) & (n > 0), F.col("_auc") / p / n).alias("roc_auc"),
        F.when(p > 0, F.col("_ap") / p).alias("average_precision"),
        F.try_divide(F.col("_brier"), F.col("n")).alias("brier"))


def cv_stability(fold_metrics: DataFrame, value: str = "roc_auc", by: Sequence[str] = (),
                 stable: float = 0.02, moderate: float = 0.04) -> DataFrame:
    """Mean and population std over folds, with STABLE / MODERATE / UNSTABLE."""
    g = fold_metrics.groupBy(*by) if by else fold_metrics
    s = g.agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count(F.lit(1)).alias("n_folds"))
    return s.withColumn(
        "stability",
        F.when(F.col("std") < stable, "STABLE").when(F.col("std") < moderate, "MODERATE").otherwise("UNSTABLE"),
    )
