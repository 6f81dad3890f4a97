"""End-to-end modelling and review plan over a cleaned table.

Per label: engineered features (NULL-safe), medians for the engineered
columns, a group split, the three models on the train split, test metrics
keyed by model, class report, importances, SHAP of the boosted model,
calibration and Brier, group-fold CV with a confidence interval,
scaling-leakage check, the benchmark status, the best model against an
earlier run's, and the saved models. With a search grid the boosted model is
tuned first and joins the comparison. The driver only loops over labels and
models; all data work is Spark jobs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.functions.features import ENGINEERED, add_features
from cohortix.operators import clean, metrics, models, ranking, shap, split, stats, verdict
from cohortix.plans.catalog import shared_dir
from cohortix.session import stored


@dataclass
class TrainReport:
    test_metrics: DataFrame      # (target, model, n, tp, ..., roc_auc, average_precision, brier)
    importances: DataFrame       # (target, model, feature, importance)
    calibration: DataFrame       # (target, model, bin, n, mean_predicted, fraction_positive)
    cv: DataFrame                # (target, mean, std, n, ci_lo, ci_hi)
    leakage: DataFrame           # (target, auc_correct, auc_leaky, diff, verdict)
    benchmark: DataFrame         # (target, roc_auc, threshold, status)
    class_report: DataFrame      # (target, model, row, precision, recall, f1, support) of the best model
    shap: DataFrame              # (target, feature, mean_abs_phi) of the boosted model
    comparison: DataFrame        # (target, model, roc_auc, earlier, gain): the best model and the earlier run's best
    saved: dict[tuple[str, str], str]  # (target, model) -> folder


def _earlier_best(earlier: Mapping[str, Mapping[str, float]]) -> list[tuple[str, float]]:
    return [(t, float(max(m.values()))) for t, m in earlier.items() if m]


def prepare(df: DataFrame, exclude: Sequence[str], group_cols: Sequence[str],
            test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, list[str]]:
    """Engineered features, their medians (fitted on train), split column."""
    feat = split.group_split(add_features(df), group_cols, test_fraction, seed)
    eng = [c for c in ENGINEERED if c in feat.columns]
    feat = clean.impute_median(feat, eng, fit_df=feat.where(F.col("split") == "train"))
    skip = set(exclude) | {"split"}
    features = [f.name for f in feat.schema.fields
                if f.name not in skip and f.dataType.typeName() in ("double", "integer", "long", "float")]
    return feat, features


def train_review(df: DataFrame, labels: Sequence[str], features: Sequence[str],
                 specs: Sequence[models.ModelSpec], thresholds: Mapping[str, float],
                 group_cols: Sequence[str], benchmark_rules: Mapping[str, tuple[float, str, str]],
                 cv_folds: int = 5, id_cols: Sequence[str] = (), grid: Mapping[str, Sequence] | None = None,
                 n_iter: int = 50, search_folds: int = 3, earlier: Mapping[str, Mapping[str, float]] | None = None,
                 shap_rows: int = 500, shap_top: int = 25, model_dir: str | None = None) -> TrainReport:
    """Fit, score and review every (label, model); ``df`` carries ``split``.

    ``grid``: the boosted model is tuned by ``n_iter`` draws on group folds of
    the train split and reviewed as one more model, "<name>_tuned". ``earlier``
    maps a target to the ROC-AUC of an earlier run's models. ``model_dir``:
    each target's models are saved below it.
    """
    shap_parts, saved = [], {}
    scored_parts, imp_parts, cv_parts, leak_parts = [], [], [], []
    folds = split.group_kfold(df.where(F.col("split") == "train"), list(group_cols), cv_folds)
    train = df.where(F.col("split") == "train")
    for label in labels:
        boosted = next((s for s in specs if s.kind == "boosted"), None)
        tried = list(specs)
        if grid and boosted:
            board = models.random_search(split.group_kfold(train, list(group_cols), search_folds), features, label,
                                         "fold", "boosted", grid, n_iter)
            tried.append(models.ModelSpec(f"{boosted.name}_tuned", "boosted", models.best_params(board)))
        # the folds and the leakage check take the boosted model, or the last one where there is none
        review = boosted or specs[-1]
        # they need nothing of the compared models: all are fitted side by side
        with ThreadPoolExecutor(max_workers=3) as pool:
            cv = pool.submit(models.cv_metrics, folds, features, label, "fold", review, thresholds.get(label, 0.5))
            leak = pool.submit(models.scaling_leakage, df, features, label, "split", review)
            made = models.fit_all(train, features, label, tried)
        cv_parts.append(stats.confidence_interval(cv.result(), "roc_auc").withColumn("target", F.lit(label)))
        leak_parts.append(leak.result().withColumn("target", F.lit(label)))
        scored = models.score_all(made, df.where(F.col("split") == "test"), [*id_cols, label])
        scored_parts.append(scored.withColumn("target", F.lit(label)).withColumnRenamed(label, "label"))
        for spec in tried:
            if model_dir:
                saved[label, spec.name] = f"{model_dir.rstrip('/')}/{label}/{spec.name}"
                models.save(made[spec.name], df.sparkSession, saved[label, spec.name])
            if models.is_trees(spec):
                imp_parts.append(models.feature_importance(made[spec.name], df.sparkSession)
                                 .withColumn("target", F.lit(label)).withColumn("model", F.lit(spec.name)))
        if boosted:
            rows = ranking.sample_first_n(df.where(F.col("split") == "test"), [*group_cols, *features], shap_rows)
            rows = rows.repartition(8, *[F.col(f"`{c}`") for c in features])
            shap_parts.append(shap.shap_mean_abs(shap.shap_values(rows, made[boosted.name], []), shap_top)
                              .withColumn("target", F.lit(label)))
    scored_all = scored_parts[0]
    for p in scored_parts[1:]:
        scored_all = scored_all.unionByName(p)
    scored_all, _ = stored(scored_all, shared_dir(df.sparkSession, "scored"))
    # thresholds differ per label: predict with the label's own threshold
    thr = F.lit(0.5)
    for lab, t in thresholds.items():
        thr = F.when(F.col("target") == lab, F.lit(t)).otherwise(thr)
    pred = scored_all.withColumn("_cx_pred", (F.col(models.SCORE) >= thr).cast("int"))
    pm = metrics.point_metrics(pred, "label", "_cx_pred", by=["target", "model"])
    cum = metrics.score_cumulative(scored_all, "label", models.SCORE, by=["target", "model"])
    test_metrics = (pm.join(metrics.auc_from_cumulative(cum, ["target", "model"]), ["target", "model"])
                    .join(metrics.ap_from_cumulative(cum, ["target", "model"]), ["target", "model"])
                    .join(metrics.brier(scored_all, "label", models.SCORE, ["target", "model"]), ["target", "model"]))
    calib = metrics.calibration_bins(scored_all, "label", models.SCORE, 10, by=["target", "model"])
    best = ranking.arg_max(test_metrics, "roc_auc", "model", by=["target"])
    best_auc = best.select("target", "roc_auc")
    spark = df.sparkSession
    before = spark.createDataFrame(_earlier_best(earlier or {}), "target string, earlier double")
    comparison = best.join(F.broadcast(before), "target", "left").withColumn(  # a row per target on both sides
        "gain", F.col("roc_auc") - F.col("earlier"))
    chosen = {r["target"]: r["model"] for r in best.collect()}
    reports = [metrics.class_report(pred.where((F.col("target") == t) & (F.col("model") == m)), "label", "_cx_pred")
               .withColumn("target", F.lit(t)).withColumn("model", F.lit(m)) for t, m in sorted(chosen.items())]

    def union(parts):
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    return TrainReport(
        test_metrics=test_metrics,
        importances=union(imp_parts) if imp_parts else df.sparkSession.createDataFrame(
            [], "feature string, importance double, target string, model string"),
        calibration=calib,
        cv=union(cv_parts),
        leakage=union(leak_parts),
        benchmark=verdict.benchmark_status(best_auc, benchmark_rules),
        class_report=union(reports),
        shap=union(shap_parts) if shap_parts else spark.createDataFrame(
            [], "feature string, mean_abs_phi double, target string"),
        comparison=comparison,
        saved=saved,
    )
