"""The ICU configuration end to end on a small synthetic cohort with the
hand rows of FIXTURES.md: CSV scan -> audit -> fix -> train/review."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortix.config import icu
from cohortix.operators import models, verdict
from cohortix.plans import audit as plans
from cohortix.plans.train import prepare, train_review
from cohortix.sources.scan import scan_csv

DOUBLES = ["heart_rate", "resp_rate", "spo2", "sys_bp", "dia_bp", "fio2", "peep", "tidal_volume",
           "pao2", "paco2", "ph", "lactate", "creatinine", "icu_los_days", "hosp_los_days"]


def _cohort(tmp_path):
    rng = np.random.default_rng(42)
    rows = []
    for stay in range(1, 161):
        subject = (stay + 1) // 2
        base = {
            "subject_id": subject, "hadm_id": 1000 + stay, "stay_id": stay, "age": int(rng.integers(18, 95)),
            "gender": "M" if rng.random() < 0.55 else "F",
            "heart_rate": rng.normal(85, 15), "resp_rate": rng.normal(20, 5), "spo2": rng.normal(96, 2),
            "sys_bp": rng.normal(120, 20), "dia_bp": rng.normal(70, 10), "fio2": rng.uniform(21, 80),
            "peep": rng.uniform(0, 15), "tidal_volume": rng.normal(450, 80), "pao2": rng.normal(100, 30),
            "paco2": rng.normal(40, 8), "ph": rng.normal(7.4, 0.05), "lactate": rng.exponential(2),
            "creatinine": rng.exponential(1.2), "icu_los_days": rng.exponential(4),
            "hosp_los_days": rng.exponential(9) + 1, "charlson_comorbidity_index": int(rng.integers(0, 10)),
            "sofa_score": int(rng.integers(0, 15)), "hypertension": int(rng.integers(0, 2)),
            "diabetes": int(rng.integers(0, 2)), "copd": int(rng.integers(0, 2)), "heart_failure": int(rng.integers(0, 2)),
        }
        wean = int(base["pao2"] + rng.normal(0, 20) > 95)
        readm = int(base["sofa_score"] + rng.normal(0, 3) > 10)
        for copy in range(int(rng.integers(1, 4))):
            r = dict(base, weaning_success=wean if copy < 2 else 1 - wean, readmission=readm)
            rows.append(r)
    pdf = pd.DataFrame(rows)
    # hand rows
    pdf.loc[0, "heart_rate"] = np.nan            # first row missing one value only
    pdf.loc[1, "spo2"] = 101.0
    pdf.loc[2, "spo2"] = 81914.67
    pdf.loc[3, "pao2"] = 0.0
    pdf.loc[4, "icu_los_days"] = 0.0
    pdf.loc[5, "fio2"] = 0.0
    pdf.loc[6, "gender"] = None
    pdf.loc[7, "hypertension"] = None
    tie = pdf.iloc[[10]].copy()
    tie["stay_id"], tie["subject_id"], tie["weaning_success"] = 999, 500, 1
    tie2 = tie.copy()
    tie2["weaning_success"] = 0                  # a 1-1 label tie -> 0
    nokey = pdf.iloc[[11]].copy()
    nokey["stay_id"] = None
    pdf = pd.concat([pdf, tie, tie2, nokey], ignore_index=True)
    pdf["_ord"] = np.arange(len(pdf))
    path = str(tmp_path / "cohort.csv")
    pdf.to_csv(path, index=False, na_rep="NaN")
    return path, len(pdf)


@pytest.fixture(scope="module")
def cohort(spark, tmp_path_factory):
    from pyspark.sql import types as T

    path, n = _cohort(tmp_path_factory.mktemp("icu"))
    schema = T.StructType(icu.V2_SCHEMA.fields + [T.StructField("_ord", T.LongType())])
    return scan_csv(spark, path, schema), n


def test_scan_reads_nan_text_as_missing(cohort):
    df, n = cohort
    assert df.count() == n
    assert df.where(F.col("heart_rate").isNull()).count() == 1
    assert df.where(F.col("gender").isNull()).count() == 1
    assert df.where(F.col("stay_id").isNull()).count() == 1


def test_audit_with_icu_rules(cohort):
    df, _ = cohort
    res = plans.audit(df.drop("_ord"), icu.ROLES, icu.AUDIT_RANGES, unit_col="fio2", critical=["ph", "spo2"],
                      bias_numeric="age")
    f = res.findings.collect()
    steps = {r["step"] for r in f}
    assert {"1_structure", "2_missing", "3_ranges", "7_correlation", "8_bias", "9_verdict"} <= steps
    assert any(r["step"] == "3_ranges" and r["severity"] == "CRITICAL" and r["subject"] == "spo2" for r in f)
    assert {r["test"] for r in res.bias.collect()} == {"chi2", "ttest"}
    issues = {(r["severity"], r["category"], r["subject"]) for r in res.issues.collect()}
    assert ("CRITICAL", "duplicates", "feature rows") in issues
    assert ("MODERATE", "range", "spo2") in issues
    v = {r["col_name"]: r for r in res.violations.collect()}
    assert v["spo2"]["actual_max"] == 81914.67
    assert res.readiness.first()["status"] == "NOT READY"


def test_fix_then_train(cohort, spark, tmp_path):
    df, _ = cohort
    fixed = plans.fix(df, "stay_id", ["_ord"], icu.ROLES, icu.IMPOSSIBLE_BOUNDS, icu.CLINICAL_CAPS,
                      ["subject_id"], log_cols=list(icu.LOG_COLS), encode_col="gender").drop("_ord").cache()
    n_stays = df.where(F.col("stay_id").isNotNull()).select("stay_id").distinct().count()
    assert fixed.count() == n_stays
    tie = fixed.where("stay_id = 999").first()
    assert tie["weaning_success"] == 0
    first = fixed.where("stay_id = 1").first()
    assert first["heart_rate"] is not None            # first non-missing copy
    assert fixed.agg(F.max("spo2")).first()[0] <= 100
    numeric = [c for c in icu.ROLES.numeric(fixed) if c not in ("split",)]
    checks = {r["check"]: r for r in verdict.post_clean_checks(
        fixed, numeric, list(icu.LABEL_COLS), icu.CLINICAL_CAPS, "split", ["subject_id"]).collect()}
    assert checks["missing_values"]["passed"] and checks["out_of_range"]["passed"]
    assert checks["split_overlap"]["passed"]
    assert set(fixed.columns) >= {"gender_encoded", "lactate_log", "hosp_los_days_log"}

    feat, features = prepare(fixed, list(icu.ID_COLS) + list(icu.LABEL_COLS) + ["gender"], ["subject_id"])
    assert {"pf_ratio", "sofa_per_day", "charlson_high"} <= set(features)
    assert feat.where(F.col("pf_ratio").isNull() | F.col("sofa_per_day").isNull()).count() == 0
    specs = [models.ModelSpec("LR", "logistic", {"max_iter": 100}),
             models.ModelSpec("GBT", "boosted", {"n_estimators": 5, "max_depth": 3})]
    rep = train_review(feat, list(icu.LABEL_COLS), features, specs, icu.PREDICT_THRESHOLDS,
                       ["subject_id"], icu.BENCHMARK_STATUS, cv_folds=3, grid={"n_estimators": [3, 6], "max_depth": [2]},
                       n_iter=2, earlier=icu.PUBLISHED_V1_ROC_AUC, shap_rows=40, model_dir=str(tmp_path / "models"))
    tm = rep.test_metrics.collect()
    assert {(r["target"], r["model"]) for r in tm} == {
        (t, m) for t in icu.LABEL_COLS for m in ("LR", "GBT", "GBT_tuned")}
    assert all(0.0 <= r["roc_auc"] <= 1.0 for r in tm)
    assert rep.cv.count() == 2 and rep.leakage.count() == 2
    assert {r["target"] for r in rep.benchmark.collect()} == set(icu.LABEL_COLS)
    best = {r["target"]: r for r in rep.comparison.collect()}
    for t in icu.LABEL_COLS:
        top = max((r for r in tm if r["target"] == t), key=lambda r: r["roc_auc"])
        assert best[t]["roc_auc"] == top["roc_auc"]
        assert best[t]["earlier"] == icu.PUBLISHED_V1_ROC_AUC[t]["XGB_Tuned"]
        assert best[t]["gain"] == pytest.approx(top["roc_auc"] - best[t]["earlier"])
        rows = rep.class_report.where(F.col("target") == t).collect()
        assert {r["row"] for r in rows} == {"0", "1", "accuracy", "macro avg", "weighted avg"}
        assert {r["model"] for r in rows} == {best[t]["model"]}
    assert {r["target"] for r in rep.shap.collect()} == set(icu.LABEL_COLS)
    assert rep.shap.where("mean_abs_phi > 0").count() > 0
    assert set(rep.saved) == {(t, m) for t in icu.LABEL_COLS for m in ("LR", "GBT", "GBT_tuned")}
    from cohortix.operators import newton, trees

    for (t, m), path in rep.saved.items():
        again = newton.load(spark, path) if m == "LR" else trees.load(spark, path)
        assert models.score(again, feat, ["stay_id"]).count() == feat.count()
