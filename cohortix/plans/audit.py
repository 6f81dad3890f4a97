"""End-to-end plans: the audit (profiles -> issues -> readiness) and the fix
(dedup -> NULL-out -> winsorize -> impute -> encode -> log -> split).

Both are compositions of the operators; every step is a lazy DataFrame, and
the one-row statistics they need are the only values that reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortix.operators import clean, duplicates, profile, split, stats, verdict
from cohortix.operators.cumulative import has_shuffle
from cohortix.roles import Roles


@dataclass
class AuditResult:
    shape: DataFrame
    schema: DataFrame
    duplicates: DataFrame
    missing: DataFrame
    violations: DataFrame
    outliers: DataFrame
    balance: DataFrame
    skew: DataFrame
    issues: DataFrame
    readiness: DataFrame
    scale_mix: DataFrame | None = None
    critical: DataFrame | None = None
    correlation: DataFrame | None = None
    corr_pairs: DataFrame | None = None
    corr_label: DataFrame | None = None
    category_balance: DataFrame | None = None
    bias: DataFrame | None = None
    findings: DataFrame | None = None
    source: DataFrame | None = None

    def release(self) -> None:
        """Drop the persisted input once the results have been written."""
        if self.source is not None:
            self.source.unpersist()


def audit(df: DataFrame, roles: Roles, ranges: Mapping[str, tuple[float, float]],
          exact: bool = True, persist: bool | None = None, unit_col: str | None = None,
          critical: Sequence[str] = (), bias_numeric: str | None = None,
          exact_distinct: bool = False) -> AuditResult:
    """All table profiles and the verdict for one table.

    Shape, missing values, ranges, skewness and distinct counts are one scan
    (:class:`cohortix.operators.profile.Fused`); each other table is one
    aggregate over the input, computed when it is read. A plain scan is read
    again for each, with the columns it needs; an input that joins or
    aggregates is persisted (``persist`` overrides; call ``release()`` after).
    ``unit_col`` gets the mixed-scale test (e.g. FiO2
    as fraction vs percent), ``critical`` columns get an extra finding when
    they violate their range, and for each category column the bias tests
    run against every label (chi-squared) and ``bias_numeric`` is compared
    between label groups (t-test).
    """
    if duplicates.ROW_ORDER in df.columns:  # file position is not data
        df = df.drop(duplicates.ROW_ORDER)
    if persist is None:
        persist = has_shuffle(df)
    src = df.persist(StorageLevel.MEMORY_AND_DISK) if persist else df
    numeric = roles.numeric(src, include_flags=True)
    dups = duplicates.duplicate_profile(src, roles.labels)
    left_out = {*roles.ids, *roles.exclude}
    # profiles that are plain aggregates share one scan
    t = profile.Fused.tables(src, {
        "shape": lambda: profile.table_shape(src),
        "missing": lambda: profile.missing_profile(src, [c for c in src.columns if c not in left_out]),
        "violations": lambda: profile.range_violations(src, ranges),
        "skew": lambda: profile.skewness(src, numeric),
        **({} if exact_distinct else {"sketches": lambda: profile.distinct_sketches(src)}),
    })
    miss, viol = t["missing"], t["violations"]
    outl = profile.iqr_outliers(src, numeric, exact=exact)
    bal = profile.class_balance(src, roles.labels)
    issues = verdict.issue_list(dups, miss, viol, outl, bal)
    corr_cols = numeric + [c for c in roles.labels if c in src.columns]
    corr = profile.correlation_matrix(src, corr_cols) if len(corr_cols) > 1 else None
    res = AuditResult(
        shape=t["shape"],
        schema=profile.schema_profile(src) if exact_distinct else profile.merged_distinct(t["sketches"]),
        duplicates=dups,
        missing=miss,
        violations=viol,
        outliers=outl,
        balance=bal,
        skew=t["skew"],
        issues=issues,
        readiness=verdict.readiness(issues),
        scale_mix=profile.scale_mix(src, unit_col) if unit_col else None,
        critical=profile.critical_flag(viol, critical) if critical else None,
        correlation=corr,
        corr_pairs=profile.corr_pairs(corr, numeric) if corr is not None else None,
        corr_label=profile.corr_label(corr, numeric, roles.labels) if corr is not None and roles.labels else None,
        category_balance=profile.category_balance(src, roles.category) if roles.category else None,
        bias=_bias(src, roles, bias_numeric) if roles.category and roles.labels else None,
    )
    res.findings = findings(res)
    res.source = src if persist else None
    return res


def _bias(src: DataFrame, roles: Roles, numeric: str | None) -> DataFrame:
    """Per (category, label): chi-squared (Yates at dof 1) and, for
    ``numeric``, the two-sample t statistic between label groups."""
    spark = src.sparkSession
    rows = []
    for cat in roles.category:
        for lab in roles.labels:
            r = stats.chi2_independence(src, cat, lab).first()
            if r is not None:
                rows.append(("chi2", cat, lab, float(r["chi2"]), float(r["p"]), r["verdict"]))
    if numeric:
        for lab in roles.labels:
            r = stats.ttest_two_sample(src, lab, numeric).first()
            rows.append(("ttest", numeric, lab, r["t"], r["p"], r["verdict"]))
    return spark.createDataFrame(rows, "test string, subject string, label string, statistic double, "
                                       "p double, verdict string")


def findings(res: AuditResult) -> DataFrame:
    """One ordered findings table ``(step, seq, severity, subject, message,
    value)`` from the profile tables (each of schema-width size)."""
    w = Window.partitionBy("step").orderBy(F.desc(F.abs(F.col("value"))), "subject")

    def part(df: DataFrame, step: str, severity, subject, message: str, value) -> DataFrame:
        sev = F.lit(severity) if isinstance(severity, str) else severity
        return df.select(F.lit(step).alias("step"), sev.alias("severity"), subject.alias("subject"),
                         F.lit(message).alias("message"), value.cast("double").alias("value"))

    parts = [
        part(res.shape, "1_structure", "INFO", F.lit("rows"), "row count", F.col("n_rows")),
        part(res.duplicates, "1_structure", "INFO", F.lit("exact duplicates"), "duplicate rows", F.col("n_exact_dup")),
        part(res.duplicates, "1_structure", "INFO", F.lit("feature duplicates"), "duplicates ignoring labels",
             F.col("n_feature_dup")),
        part(res.missing.where(F.col("n_missing") > 0), "2_missing",
             F.when(F.col("high"), "MODERATE").otherwise("MINOR"), F.col("col_name"), "missing %",
             F.col("missing_pct")),
        part(res.violations, "3_ranges", "MODERATE", F.col("col_name"), "out-of-range %", F.col("pct")),
        part(res.outliers, "4_outliers", F.when(F.col("pct") > 5, "MODERATE").otherwise("INFO"),
             F.col("col_name"), "IQR outlier %", F.col("pct")),
        part(res.balance, "5_imbalance", F.col("severity"), F.col("col_name"), "minority / majority",
             F.col("ratio")),
        part(res.skew, "6_skew", F.when(F.col("flagged"), "SUGGEST").otherwise("INFO"), F.col("col_name"),
             "skewness", F.col("skew")),
        part(res.issues, "9_verdict", F.col("severity"), F.col("subject"), "issue", F.col("value")),
        part(res.readiness, "9_verdict", F.when(F.col("n_critical") > 0, "CRITICAL").otherwise("OK"),
             F.col("status"), "readiness", F.col("n_critical")),
    ]
    if res.scale_mix is not None:
        parts.append(part(res.scale_mix, "3_ranges", F.when(F.col("mixed"), "WARNING").otherwise("OK"),
                          F.col("col_name"), "values <= 1 (mixed scale)", F.col("n_unit")))
    if res.critical is not None:
        parts.append(part(res.critical, "3_ranges", "CRITICAL", F.col("col_name"), "critical range", F.col("pct")))
    if res.corr_pairs is not None:
        parts.append(part(res.corr_pairs, "7_correlation", F.col("band"),
                          F.concat_ws(" <-> ", "col_a", "col_b"), "feature pair r", F.col("r")))
    if res.corr_label is not None:
        parts.append(part(res.corr_label, "7_correlation", F.when(F.col("flagged"), "LEAKAGE RISK").otherwise("INFO"),
                          F.concat_ws(" ~ ", "feature", "label"), "feature-label r", F.col("r")))
    if res.category_balance is not None:
        parts.append(part(res.category_balance, "8_bias", F.col("severity"), F.col("col_name"),
                          "category min / max", F.col("ratio")))
    if res.bias is not None:
        parts.append(part(res.bias, "8_bias", F.col("verdict"), F.concat_ws(" x ", "test", "subject", "label"),
                          "p-value", F.col("p")))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out.withColumn("seq", F.row_number().over(w)).select(
        "step", "seq", "severity", "subject", "message", "value")


def fix(df: DataFrame, key: str, order_by: Sequence[str] | None, roles: Roles,
        impossible: Mapping[str, tuple[float, float]], caps: Mapping[str, tuple[float, float]],
        group_cols: Sequence[str], log_cols: Sequence[str] = (), encode_col: str | None = None,
        fit_on: str = "train", test_fraction: float = 0.2, seed: int = 42,
        drop_order: bool = False) -> DataFrame:
    """Clean a raw table to one row per ``key`` with a ``split`` column.

    ``fit_on="train"`` fits the medians on the train split only (no leakage);
    ``"all"`` fits them on every row as the original study did.
    ``drop_order`` removes the ``order_by`` columns after de-duplication, for
    a column that only gives the order and must not become a feature.
    """
    firsts = [c for c in df.columns
              if c != key and c not in set(roles.labels) and c != duplicates.ROW_ORDER]
    one = duplicates.dedup_majority(df, key, order_by, first_cols=firsts, vote_cols=roles.labels)
    if drop_order:
        one = one.drop(*[c for c in order_by or () if c != key])
    one = clean.null_out_impossible(one, impossible)
    one = clean.winsorize(one, caps)
    one = split.group_split(one, group_cols, test_fraction, seed)
    one = one.persist(StorageLevel.MEMORY_AND_DISK)
    numeric = [c for c in roles.numeric(one) if c != "split"]
    fit_df = one.where(F.col("split") == "train") if fit_on == "train" else one
    one = clean.impute_median(one, numeric, fit_df=fit_df)
    one = clean.impute_zero(one, list(roles.flags))
    if encode_col:
        one = clean.encode(one, encode_col)
    return clean.log1p_columns(one, log_cols)
