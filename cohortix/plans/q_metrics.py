"""Registered queries: evaluation metrics on given scores (events: score =
value / 500, label = purchase)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortix.operators import metrics
from cohortix.operators.split import hash_kfold
from cohortix.plans.catalog import EV_SQL, query, r6, scored_events
from cohortix.plans.q_stats import EV_FOLD_SQL, events_folds

T = 0.1  # decision threshold for the point metrics
PRED_SQL = f"(SELECT *, CAST(score >= {T} AS INTEGER) AS pred FROM {EV_SQL})"


def predicted(spark, sf):
    return metrics.predict(scored_events(spark, sf), "score", T)


@query("predict_threshold", f"SELECT event_id, pred FROM {PRED_SQL}")
def q_predict_threshold(spark, sf):
    return predicted(spark, sf).select("event_id", "pred")


@query("confusion_matrix", f"""
WITH g AS (SELECT a.actual, p.predicted FROM (VALUES (0), (1)) a(actual), (VALUES (0), (1)) p(predicted))
SELECT CAST(g.actual AS INTEGER) AS actual, CAST(g.predicted AS INTEGER) AS predicted,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM g LEFT JOIN (SELECT label AS actual, pred AS predicted, count(*) AS n FROM {PRED_SQL} GROUP BY 1, 2) c
  ON g.actual = c.actual AND g.predicted = c.predicted
""")
def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(predicted(spark, sf), "label", "pred")


_COUNTS = """CAST(count(*) AS BIGINT) AS n, CAST(count_if(label = 1 AND pred = 1) AS BIGINT) AS tp,
  CAST(count_if(label = 0 AND pred = 1) AS BIGINT) AS fp, CAST(count_if(label = 0 AND pred = 0) AS BIGINT) AS tn,
  CAST(count_if(label = 1 AND pred = 0) AS BIGINT) AS fn"""


def _point_sql(src, by=""):
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""
WITH c AS (SELECT {sel}{_COUNTS} FROM {src} {grp})
SELECT {sel}n, tp, fp, tn, fn,
  round(CASE WHEN n = 0 THEN 0 ELSE (tp + tn) * 1.0 / n END, 6) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp * 1.0 / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp * 1.0 / (tp + fn) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1
FROM c"""


@query("point_metrics", _point_sql(PRED_SQL))
def q_point_metrics(spark, sf):
    return r6(metrics.point_metrics(predicted(spark, sf), "label", "pred"))


@query("class_report", f"""
WITH c AS (SELECT {_COUNTS} FROM {PRED_SQL}),
per AS (
  SELECT '0' AS "row", CASE WHEN tn + fn = 0 THEN 0 ELSE tn * 1.0 / (tn + fn) END AS precision,
         CASE WHEN tn + fp = 0 THEN 0 ELSE tn * 1.0 / (tn + fp) END AS recall,
         CASE WHEN 2 * tn + fn + fp = 0 THEN 0 ELSE 2.0 * tn / (2 * tn + fn + fp) END AS f1, tn + fp AS support FROM c
  UNION ALL
  SELECT '1', CASE WHEN tp + fp = 0 THEN 0 ELSE tp * 1.0 / (tp + fp) END,
         CASE WHEN tp + fn = 0 THEN 0 ELSE tp * 1.0 / (tp + fn) END,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, tp + fn FROM c),
tail AS (
  SELECT 'accuracy' AS "row", CAST(NULL AS DOUBLE) AS precision, CAST(NULL AS DOUBLE) AS recall,
         (SELECT (tp + tn) * 1.0 / n FROM c) AS f1, sum(support) AS support FROM per
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1 * support) / sum(support), sum(support) FROM per)
SELECT "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM (SELECT * FROM per UNION ALL SELECT * FROM tail)
""")
def q_class_report(spark, sf):
    return r6(metrics.class_report(predicted(spark, sf), "label", "pred"))


CUM_SQL = f"""
WITH s AS (SELECT score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM {EV_SQL} GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cum_pos, sum(neg) OVER (ORDER BY score DESC) AS cum_neg,
             sum(pos) OVER () AS tp, sum(neg) OVER () AS tn FROM s)
"""


@query("roc_curve", CUM_SQL + """
SELECT round(score, 6) AS threshold, round(cum_neg * 1.0 / tn, 6) AS fpr, round(cum_pos * 1.0 / tp, 6) AS tpr FROM c
UNION ALL SELECT NULL, 0.0, 0.0
""")
def q_roc_curve(spark, sf):
    return r6(metrics.roc_curve(scored_events(spark, sf), "label", "score"))


@query("roc_auc", CUM_SQL + """
SELECT round(sum(pos * (tn - cum_neg + neg / 2.0)) / (any_value(tp) * any_value(tn)), 6) AS roc_auc FROM c
""")
def q_roc_auc(spark, sf):
    return r6(metrics.roc_auc(scored_events(spark, sf), "label", "score"))


@query("pr_curve", CUM_SQL + """
SELECT round(score, 6) AS threshold, round(cum_pos * 1.0 / (cum_pos + cum_neg), 6) AS precision,
       round(cum_pos * 1.0 / tp, 6) AS recall FROM c
UNION ALL SELECT NULL, 1.0, 0.0
""")
def q_pr_curve(spark, sf):
    return r6(metrics.pr_curve(scored_events(spark, sf), "label", "score"))


@query("average_precision", CUM_SQL + """
SELECT round(sum(pos * cum_pos * 1.0 / (cum_pos + cum_neg)) / any_value(tp), 6) AS average_precision FROM c
""")
def q_average_precision(spark, sf):
    return r6(metrics.average_precision(scored_events(spark, sf), "label", "score"))


@query("brier", f"SELECT round(avg(power(score - label, 2)), 6) AS brier FROM {EV_SQL}")
def q_brier(spark, sf):
    return r6(metrics.brier(scored_events(spark, sf), "label", "score"))


def _calib_bin_sql(score="score", n=10):
    return " + ".join(f"CAST({score} > CAST({e!r} AS DOUBLE) AS INTEGER)" for e in metrics.calibration_edges(n))


@query("calibration_bins", f"""
SELECT CAST({_calib_bin_sql()} AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n,
       round(avg(score), 6) AS mean_predicted, round(avg(CAST(label AS DOUBLE)), 6) AS fraction_positive
FROM {EV_SQL} GROUP BY 1
""")
def q_calibration_bins(spark, sf):
    return r6(metrics.calibration_bins(scored_events(spark, sf), "label", "score", 10))


FOLD_AUC_SQL = f"""
WITH s AS (SELECT fold, score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM {EV_FOLD_SQL} GROUP BY 1, 2),
c AS (SELECT *, sum(neg) OVER (PARTITION BY fold ORDER BY score DESC) AS cum_neg,
             sum(pos) OVER (PARTITION BY fold) AS tp, sum(neg) OVER (PARTITION BY fold) AS tn FROM s),
f AS (SELECT fold, sum(pos * (tn - cum_neg + neg / 2.0)) / (any_value(tp) * any_value(tn)) AS roc_auc FROM c GROUP BY fold)
"""


@query("cv_fold_metrics", FOLD_AUC_SQL + "SELECT fold, round(roc_auc, 6) AS roc_auc FROM f")
def q_cv_fold_metrics(spark, sf):
    """Per-fold ROC-AUC of given scores in one job (``by=fold``)."""
    return r6(metrics.roc_auc(events_folds(spark, sf), "label", "score", by=["fold"]))


@query("cv_stability", FOLD_AUC_SQL + """
SELECT round(avg(roc_auc), 6) AS mean, round(stddev_pop(roc_auc), 6) AS std, CAST(count(*) AS BIGINT) AS n_folds,
  CASE WHEN stddev_pop(roc_auc) < 0.02 THEN 'STABLE' WHEN stddev_pop(roc_auc) < 0.04 THEN 'MODERATE'
       ELSE 'UNSTABLE' END AS stability FROM f
""")
def q_cv_stability(spark, sf):
    per = metrics.roc_auc(events_folds(spark, sf), "label", "score", by=["fold"])
    return r6(metrics.cv_stability(per, "roc_auc"))


@query("run_compare", f"""
WITH src AS (SELECT event_type AS target, score, CAST(event_type = 'purchase' AS INTEGER) AS label FROM {EV_SQL}),
b AS (SELECT 'purchase' AS target, count_if((score >= 0.1) = (label = 1)) * 1.0 / count(*) AS baseline,
             count_if((score >= 0.2) = (label = 1)) * 1.0 / count(*) AS new FROM src)
SELECT target, 'value_score' AS model, round(baseline, 6) AS baseline, round(new, 6) AS new,
       round(new - baseline, 6) AS gain FROM b
""")
def q_run_compare(spark, sf):
    from cohortix.operators.models import run_compare

    ev = scored_events(spark, sf)
    base = metrics.point_metrics(metrics.predict(ev, "score", 0.1), "label", "pred").select(
        F.lit("purchase").alias("target"), F.lit("value_score").alias("model"), F.col("accuracy").alias("metric"))
    new = metrics.point_metrics(metrics.predict(ev, "score", 0.2), "label", "pred").select(
        F.lit("purchase").alias("target"), F.lit("value_score").alias("model"), F.col("accuracy").alias("metric"))
    return r6(run_compare(base, new, ["target", "model"], "metric"))


@query("evaluate_by_fold", _point_sql(f"(SELECT *, CAST(score >= {T} AS INTEGER) AS pred FROM {EV_FOLD_SQL})", "fold"))
def q_evaluate_by_fold(spark, sf):
    p = metrics.predict(hash_kfold(scored_events(spark, sf), ["user_id"], 5), "score", T)
    return r6(metrics.point_metrics(p, "label", "pred", by=["fold"]))
