"""The ICU cohort configuration: roles, schema and rule tables.

FIXED VALUES: the bounds, column names and thresholds below must equal the
original study's values for the results to agree. They are stated as plain
data in natural order; the operators take them as parameters.
"""

from __future__ import annotations

from pyspark.sql import types as T

from cohortix.roles import Roles

# --- fixed values: column roles ---------------------------------------------
ID_COLS = ("subject_id", "hadm_id", "stay_id")
LABEL_COLS = ("weaning_success", "readmission")
CATEGORY_COLS = ("gender",)
FLAG_COLS = ("hypertension", "diabetes", "copd", "heart_failure")
EXPECTED_STRING_COLS = ("gender",)
LOG_COLS = ("lactate", "creatinine", "icu_los_days", "hosp_los_days")

ROLES = Roles(ids=ID_COLS, labels=LABEL_COLS, category=CATEGORY_COLS, flags=FLAG_COLS)
MODEL_ROLES = Roles(ids=ID_COLS, labels=LABEL_COLS, exclude=CATEGORY_COLS)

# --- fixed values: audit ranges (reported, never changed) --------------------
AUDIT_RANGES = {
    "heart_rate": (40, 180),
    "resp_rate": (10, 40),
    "spo2": (80, 100),
    "sys_bp": (80, 200),
    "dia_bp": (20, 120),
    "fio2": (21, 100),
    "peep": (0, 20),
    "tidal_volume": (200, 800),
    "ph": (7.2, 7.6),
    "pao2": (50, 300),
    "paco2": (30, 70),
    "lactate": (0.5, 10),
    "creatinine": (0.3, 15),
    "age": (18, 100),
}

# --- fixed values: impossible bounds (outside -> missing) --------------------
IMPOSSIBLE_BOUNDS = {
    "heart_rate": (0, 300),
    "resp_rate": (0, 80),
    "spo2": (0, 100),
    "sys_bp": (0, 350),
    "dia_bp": (0, 250),
    "fio2": (0, 100),
    "peep": (0, 40),
    "tidal_volume": (0, 2000),
    "ph": (6.0, 8.0),
    "pao2": (0, 700),
    "paco2": (0, 250),
    "lactate": (0, 30),
    "creatinine": (0, 30),
    "icu_los_days": (0, 365),
    "hosp_los_days": (0, 730),
    "charlson_comorbidity_index": (0, 37),
    "sofa_score": (0, 24),
}

# --- fixed values: clinical caps (clipped) -----------------------------------
CLINICAL_CAPS = {
    "heart_rate": (30, 220),
    "resp_rate": (4, 60),
    "spo2": (50, 100),
    "sys_bp": (40, 250),
    "dia_bp": (10, 150),
    "fio2": (21, 100),
    "peep": (0, 30),
    "tidal_volume": (50, 1500),
    "ph": (6.5, 7.8),
    "pao2": (20, 600),
    "paco2": (10, 150),
    "lactate": (0.1, 25),
    "creatinine": (0.1, 25),
    "icu_los_days": (0, 200),
    "hosp_los_days": (0, 365),
    "charlson_comorbidity_index": (0, 20),
    "sofa_score": (0, 24),
}

# --- fixed values: thresholds ------------------------------------------------
PREDICT_THRESHOLDS = {"weaning_success": 0.5, "readmission": 0.3}
HIGH_MISSING_PCT = 30.0
OUTLIER_SEVERE_PCT = 5.0
IMBALANCE_SEVERE = 0.1
IMBALANCE_MODERATE = 0.3
CATEGORY_BALANCE_WARN = 0.5
SKEW_FLAG = 1.0
CORR_HIGH = 0.9
CORR_MODERATE = 0.7
LEAKAGE_CORR_AUDIT = 0.8
LEAKAGE_CORR_REVIEW = 0.5
CV_STABLE_STD = 0.02
CV_MODERATE_STD = 0.04
SCALING_LEAK_TOLERANCE = 0.005
BENCHMARK_STATUS = {
    "weaning_success": (0.80, "COMPETITIVE", "BELOW BENCHMARK"),
    "readmission": (0.70, "ABOVE AVERAGE", "BELOW AVERAGE"),
}
# Reported model quality the review compares against (ROC-AUC, PR-AUC).
PUBLISHED_V2 = {"weaning_success": (0.8759, 0.9787), "readmission": (0.7766, 0.2878)}
PUBLISHED_V1_ROC_AUC = {
    "weaning_success": {"LR": 0.7656, "RF": 0.8008, "XGB": 0.8050, "XGB_Tuned": 0.8149},
    "readmission": {"LR": 0.6336, "RF": 0.6394, "XGB": 0.6263, "XGB_Tuned": 0.6557},
}

# --- fixed values: model settings --------------------------------------------
LOGISTIC = {"max_iter": 1000, "C": 1.0}
FOREST = {"num_trees": 300, "max_depth": 15, "min_samples_split": 5, "min_samples_leaf": 2}
BOOSTED = {
    "n_estimators": 400,
    "max_depth": 6,
    "learning_rate": 0.08,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "reg_alpha": 0.1,
    "reg_lambda": 1.0,
    "min_child_weight": 3,
    "gamma": 0.1,
}
SEARCH_GRID = {
    "n_estimators": [300, 500, 700],
    "max_depth": [4, 6, 8, 10],
    "learning_rate": [0.03, 0.05, 0.08, 0.1],
    "subsample": [0.7, 0.8, 0.9],
    "colsample_bytree": [0.7, 0.8, 0.9],
    "reg_alpha": [0, 0.1, 0.5, 1.0],
    "reg_lambda": [0.5, 1.0, 2.0],
    "min_child_weight": [1, 3, 5],
    "gamma": [0, 0.1, 0.3],
}
SEARCH_ITERATIONS = 50
SEARCH_FOLDS = 3
CV_FOLDS = 5
TEST_FRACTION = 0.2
SEED = 42
TOP_IMPORTANCE = (15, 20)
SHAP_ROWS = 500
SHAP_TOP = 25

# --- schemas -----------------------------------------------------------------
_V1_DOUBLES = (
    "heart_rate", "resp_rate", "spo2", "sys_bp", "dia_bp", "fio2", "peep",
    "tidal_volume", "pao2", "paco2", "ph", "lactate", "creatinine",
)
V1_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in ID_COLS]
    + [T.StructField("age", T.LongType()), T.StructField("gender", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in _V1_DOUBLES]
    + [T.StructField(c, T.IntegerType()) for c in LABEL_COLS]
)
V2_SCHEMA = T.StructType(
    V1_SCHEMA.fields
    + [
        T.StructField("icu_los_days", T.DoubleType()),
        T.StructField("hosp_los_days", T.DoubleType()),
        T.StructField("charlson_comorbidity_index", T.IntegerType()),
        T.StructField("sofa_score", T.IntegerType()),
    ]
    + [T.StructField(c, T.IntegerType()) for c in FLAG_COLS]
)
