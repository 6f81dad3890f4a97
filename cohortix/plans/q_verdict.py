"""Registered queries: verdict rules and the end-to-end audit / fix plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortix.operators import clean, metrics, split, verdict
from cohortix.plans import audit as plans
from cohortix.plans.catalog import EV_SQL, LI_ORDER, lineitem, query, r6, scored_events, split_hash_sql
from cohortix.plans.q_profile import DEDUP_SQL, LI_RANGES, dedup_lineitem
from cohortix.roles import Roles

AUDIT_NUM = ["l_quantity", "l_discount", "l_tax"]
AUDIT_LABELS = ["is_r", "is_big"]


def audit_frame(spark, sf):
    li = lineitem(spark, sf)
    return li.select(
        "l_quantity",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_r"),
        (F.col("l_quantity") > 45).cast("int").alias("is_big"),
    )


AUDIT_SRC = """(SELECT l_quantity, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax,
  CAST(l_returnflag = 'R' AS INTEGER) AS is_r, CAST(l_quantity > 45 AS INTEGER) AS is_big FROM lineitem)"""
AUDIT_RANGES = {k: v for k, v in LI_RANGES.items() if k in AUDIT_NUM}


def _issue_sql():
    miss = " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, round(count_if({c} IS NULL) * 100.0 / count(*), 2) AS pct FROM a"
        for c in ["l_quantity", "l_discount", "l_tax", "is_r", "is_big"])
    viol = " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, count_if({c} < {lo} OR {c} > {hi}) AS n, "
        f"round(count_if({c} < {lo} OR {c} > {hi}) * 100.0 / count({c}), 2) AS pct FROM a"
        for c, (lo, hi) in AUDIT_RANGES.items())
    outl = " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, round(count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100.0 "
        f"/ count({c}), 2) AS pct FROM a, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM a)"
        for c in AUDIT_NUM)
    bal = " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, min(n) * 1.0 / max(n) AS ratio FROM (SELECT {c}, count(*) AS n FROM a "
        f"WHERE {c} IS NOT NULL GROUP BY {c})" for c in AUDIT_LABELS)
    return f"""
WITH a AS {AUDIT_SRC},
d AS (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_discount, l_tax FROM a)) AS n FROM a),
m AS ({miss}), v AS ({viol}), o AS ({outl}), b AS ({bal}),
issues AS (
  SELECT 'CRITICAL' AS severity, 'duplicates' AS category, 'feature rows' AS subject, CAST(n AS DOUBLE) AS value FROM d WHERE n > 0
  UNION ALL SELECT 'MODERATE', 'missing', col_name, pct FROM m WHERE pct > 30
  UNION ALL SELECT 'MINOR', 'missing', col_name, pct FROM m WHERE pct > 0
  UNION ALL SELECT 'MODERATE', 'range', col_name, pct FROM v WHERE n > 0
  UNION ALL SELECT 'MODERATE', 'outliers', col_name, pct FROM o WHERE pct > 5
  UNION ALL SELECT CASE WHEN ratio < 0.1 THEN 'SEVERE' ELSE 'MODERATE' END, 'imbalance', col_name, round(ratio, 6)
            FROM b WHERE ratio < 0.3)
"""


def issues_of(spark, sf):
    a = audit_frame(spark, sf)
    roles = Roles(labels=tuple(AUDIT_LABELS))
    res = plans.audit(a, roles, AUDIT_RANGES, persist=False)
    return res


@query("issue_list", _issue_sql() + "SELECT * FROM issues")
def q_issue_list(spark, sf):
    return r6(issues_of(spark, sf).issues)


@query("readiness", _issue_sql() + """
SELECT CAST(count_if(severity = 'CRITICAL') AS BIGINT) AS n_critical, CAST(count(*) AS BIGINT) AS n_issues,
       CASE WHEN count_if(severity = 'CRITICAL') > 0 THEN 'NOT READY' ELSE 'CONDITIONALLY READY' END AS status
FROM issues
""")
def q_readiness(spark, sf):
    return issues_of(spark, sf).readiness


@query("audit_skew", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, round(skewness({c}), 6) AS skew, abs(skewness({c})) > 1 AS flagged FROM {AUDIT_SRC}"
    for c in AUDIT_NUM))
def q_audit_skew(spark, sf):
    """The audit plan's skewness table (G1 per numeric column)."""
    return r6(issues_of(spark, sf).skew)


CAPS = {"l_quantity": (5, 45)}


def cleaned_lineitem(spark, sf):
    d = dedup_lineitem(spark, sf)
    d = clean.winsorize(d, CAPS)
    d = clean.impute_median(d, ["tax_n"])
    return split.group_split(d, ["l_orderkey"])


@query("post_clean_checks", DEDUP_SQL + f""",
w AS (SELECT l_orderkey, GREATEST(5, LEAST(45, l_quantity)) AS l_quantity,
             COALESCE(tax_n, (SELECT median(tax_n) FROM dedup)) AS tax_n, is_r, is_o FROM dedup),
c AS (SELECT * FROM w)
SELECT chk AS "check", value,
       CASE WHEN chk IN ('classes_is_r', 'classes_is_o') THEN value >= 2
            WHEN chk = 'n_rows' THEN value > 0
            WHEN chk IN ('feature_duplicates', 'missing_values', 'out_of_range', 'split_overlap') THEN value = 0
            ELSE true END AS passed FROM (
  SELECT 'feature_duplicates' AS chk,
         CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (is_r, is_o) FROM c)) AS DOUBLE) AS value FROM c
  UNION ALL SELECT 'missing_values', CAST(count_if(l_quantity IS NULL) + count_if(tax_n IS NULL) AS DOUBLE) FROM c
  UNION ALL SELECT 'out_of_range', CAST(count_if(l_quantity < 5 OR l_quantity > 45) AS DOUBLE) FROM c
  UNION ALL SELECT 'n_rows', CAST(count(*) AS DOUBLE) FROM c
  UNION ALL SELECT 'classes_is_r', CAST(count(DISTINCT is_r) AS DOUBLE) FROM c
  UNION ALL SELECT 'classes_is_o', CAST(count(DISTINCT is_o) AS DOUBLE) FROM c
  UNION ALL SELECT 'n_columns', (SELECT count(*) FROM (DESCRIBE SELECT * FROM c))
  UNION ALL SELECT 'count_is_r_0', count_if(is_r = 0) FROM c UNION ALL SELECT 'count_is_r_1', count_if(is_r = 1) FROM c
  UNION ALL SELECT 'count_is_o_0', count_if(is_o = 0) FROM c UNION ALL SELECT 'count_is_o_1', count_if(is_o = 1) FROM c
  UNION ALL SELECT 'mean_tax_n', round(avg(tax_n), 6) FROM c UNION ALL SELECT 'min_tax_n', min(tax_n) FROM c
  UNION ALL SELECT 'max_tax_n', max(tax_n) FROM c
  UNION ALL SELECT 'split_overlap', CAST(count_if(k > 1) AS DOUBLE) FROM (
    SELECT l_orderkey, count(DISTINCT CASE WHEN ({split_hash_sql("CAST(l_orderkey AS VARCHAR)")} % 1000000) < 200000
                                      THEN 'test' ELSE 'train' END) AS k FROM c GROUP BY 1)
) t(chk, value)
""")
def q_post_clean_checks(spark, sf):
    d = cleaned_lineitem(spark, sf)
    return r6(verdict.post_clean_checks(d, ["l_quantity", "tax_n"], ["is_r", "is_o"], CAPS, "split", ["l_orderkey"],
                                        summary=["tax_n"]))


TARGETS_SQL = f"""(SELECT 'weaning_success' AS target, score, CAST(event_type = 'purchase' AS INTEGER) AS label FROM {EV_SQL}
  UNION ALL SELECT 'readmission', score, CAST(event_type = 'error' AS INTEGER) FROM {EV_SQL})"""


@query("benchmark_status", f"""
WITH s AS (SELECT target, score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM {TARGETS_SQL} GROUP BY 1, 2),
c AS (SELECT *, sum(neg) OVER (PARTITION BY target ORDER BY score DESC) AS cum_neg,
             sum(pos) OVER (PARTITION BY target) AS tp, sum(neg) OVER (PARTITION BY target) AS tn FROM s),
auc AS (SELECT target, sum(pos * (tn - cum_neg + neg / 2.0)) / (any_value(tp) * any_value(tn)) AS roc_auc FROM c GROUP BY 1),
r AS (SELECT * FROM (VALUES ('weaning_success', 0.80, 'COMPETITIVE', 'BELOW BENCHMARK'),
                            ('readmission', 0.70, 'ABOVE AVERAGE', 'BELOW AVERAGE')) t(target, threshold, ok, below))
SELECT target, round(roc_auc, 6) AS roc_auc, CAST(threshold AS DOUBLE) AS threshold,
       CASE WHEN roc_auc >= threshold THEN ok ELSE below END AS status FROM auc JOIN r USING (target)
""")
def q_benchmark_status(spark, sf):
    from cohortix.config.icu import BENCHMARK_STATUS

    ev = scored_events(spark, sf)
    t = ev.select(F.lit("weaning_success").alias("target"), "score", "label").unionByName(
        ev.select(F.lit("readmission").alias("target"), "score",
                  (F.col("event_type") == "error").cast("int").alias("label")))
    auc = metrics.roc_auc(t, "label", "score", by=["target"])
    return r6(verdict.benchmark_status(auc, BENCHMARK_STATUS))


@query("fix_plan_summary", f"""
SELECT split, count(*) AS n_rows, round(avg(ln(1 + price)), 6) AS mean_log_price FROM (
  SELECT l_orderkey, first(l_extendedprice ORDER BY {", ".join(LI_ORDER)}) AS price,
    CASE WHEN {split_hash_sql("CAST(l_orderkey AS VARCHAR)")} % 1000000 < 200000 THEN 'test' ELSE 'train' END AS split
  FROM lineitem GROUP BY l_orderkey) GROUP BY split
""")
def q_fix_plan_summary(spark, sf):
    """The whole fix plan on lineitem (one row per order): rows per split."""
    li = lineitem(spark, sf).select(
        *LI_ORDER, (F.col("l_returnflag") == "R").cast("int").alias("is_r"))
    roles = Roles(ids=("l_orderkey",), labels=("is_r",), category=("l_returnflag", "l_linestatus"),
                  exclude=("l_shipdate",))
    out = plans.fix(li, "l_orderkey", LI_ORDER, roles, {"l_quantity": (0, 50)}, {"l_quantity": (5, 45)},
                    ["l_orderkey"], log_cols=["l_extendedprice"])
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.round(F.avg("l_extendedprice_log"), 6).alias("mean_log_price"))


@query("audit_report")
def q_audit_report(spark, sf):
    """The whole audit on lineitem (category l_linestatus, labels is_r and
    is_big, bias numeric l_quantity): the ordered findings table."""
    li = lineitem(spark, sf).select(
        "l_quantity", "l_extendedprice",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"), "l_linestatus",
        (F.col("l_returnflag") == "R").cast("int").alias("is_r"),
        (F.col("l_quantity") > 45).cast("int").alias("is_big"),
    )
    roles = Roles(labels=("is_r", "is_big"), category=("l_linestatus",))
    res = plans.audit(li, roles, LI_RANGES, unit_col="l_quantity", critical=["l_tax"], bias_numeric="l_quantity")
    return res.findings
