"""Derived clinical features (all column expressions, no UDF).

Divisions by zero give NULL (numpy gives +-inf, which the original then
turned into missing), so ANSI mode never raises.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix.functions.exprs import case_flag, safe_div


def pf_ratio(pao2: Column, fio2: Column) -> Column:
    return safe_div(pao2, fio2 / 100.0)


def rsbi(resp_rate: Column, tidal_volume: Column) -> Column:
    return safe_div(resp_rate, tidal_volume / 1000.0)


def mean_arterial_pressure(sys_bp: Column, dia_bp: Column) -> Column:
    return (sys_bp + 2 * dia_bp) / 3.0


def pulse_pressure(sys_bp: Column, dia_bp: Column) -> Column:
    return sys_bp - dia_bp


def oxygenation_index(fio2: Column, map_: Column, pao2: Column) -> Column:
    return safe_div(fio2 * map_, pao2)


def aa_gradient(fio2: Column, paco2: Column, pao2: Column) -> Column:
    return (fio2 / 100.0 * 713) - (paco2 / 0.8) - pao2


def comorbidity_count(*flags: Column) -> Column:
    out = flags[0]
    for f in flags[1:]:
        out = out + f
    return out


def feature_exprs(c: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """The twelve engineered features over the cleaned ICU columns."""
    col = (lambda n: c[n]) if c is not None else F.col
    mp = mean_arterial_pressure(col("sys_bp"), col("dia_bp"))
    return {
        "pf_ratio": pf_ratio(col("pao2"), col("fio2")),
        "rsbi": rsbi(col("resp_rate"), col("tidal_volume")),
        "map": mp,
        "pulse_pressure": pulse_pressure(col("sys_bp"), col("dia_bp")),
        "oxi_index": oxygenation_index(col("fio2"), mp, col("pao2")),
        "aa_gradient": aa_gradient(col("fio2"), col("paco2"), col("pao2")),
        "pao2_log": F.log1p(col("pao2")),
        "comorbidity_count": comorbidity_count(
            col("hypertension"), col("diabetes"), col("copd"), col("heart_failure")
        ),
        "sofa_per_day": safe_div(col("sofa_score"), col("icu_los_days")),
        "los_ratio": safe_div(col("icu_los_days"), col("hosp_los_days")),
        "charlson_high": case_flag(col("charlson_comorbidity_index"), 5),
        "sofa_high": case_flag(col("sofa_score"), 8),
    }


ENGINEERED = (
    "pf_ratio", "rsbi", "map", "pulse_pressure", "oxi_index", "aa_gradient", "pao2_log",
    "comorbidity_count", "sofa_per_day", "los_ratio", "charlson_high", "sofa_high",
)


def add_features(df: DataFrame) -> DataFrame:
    """Append the engineered columns in one projection."""
    return df.withColumns(feature_exprs())
