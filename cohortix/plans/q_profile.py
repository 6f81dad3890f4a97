"""Registered queries: scans, projections, filters and table profiles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortix.functions.exprs import case_flag, outside, severity_band
from cohortix.operators import duplicates, profile
from cohortix.plans.catalog import (
    EV_SQL, LI_NULLS_SQL, LI_NUM, LI_ORDER, lineitem, lineitem_nulls, query, r6,
    scored_events, shared_dir, split_hash_sql,
)
from cohortix.roles import Roles
from cohortix.sources import scan, sinks
from cohortix.sources.scan import table

SPLIT_H = split_hash_sql("CAST(o_custkey AS VARCHAR)")

# --- 2.1 scans, sources, sinks -------------------------------------------------------


@query("scan_csv", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem
""")
def q_scan_csv(spark, sf):
    """lineitem written as header CSV (derived data), read back with a schema."""
    src = lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity",
                                     "l_extendedprice", "l_returnflag")
    path = shared_dir(spark, "scan_csv")
    src.write.mode("overwrite").option("header", True).csv(path)
    return scan.scan_csv(spark, path, src.schema)


@query("scan_if_exists", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(5 AS BIGINT) AS n_cols, false AS skipped FROM customer
""")
def q_scan_if_exists(spark, sf):
    df = scan.scan_if_exists(spark, f"{sf}/customer.parquet")
    missing = scan.scan_if_exists(spark, f"{sf}/no_such_cohort.parquet")
    return profile.table_shape(df).withColumn("skipped", F.lit(missing is not None))


@query("require_columns", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(3 AS BIGINT) AS n_cols FROM orders
""")
def q_require_columns(spark, sf):
    need = ["o_orderkey", "o_custkey", "o_totalprice"]
    df = scan.require_columns(table(spark, sf, "orders"), need).select(*need)
    return profile.table_shape(df)


@query("column_diff", """
SELECT column_name AS col_name, (SELECT count(s_suppkey) FROM supplier) AS n_values FROM information_schema.columns
WHERE table_name = 'supplier' AND column_name NOT IN
  (SELECT replace(column_name, 'c_', 's_') FROM information_schema.columns WHERE table_name = 'customer')
""")
def q_column_diff(spark, sf):
    """Columns of supplier with no customer twin, and how many values each holds."""
    cust = table(spark, sf, "customer")
    renamed = cust.toDF(*[c.replace("c_", "s_") for c in cust.columns])
    sup = table(spark, sf, "supplier")
    miss = scan.missing_columns(renamed, sup.columns)
    counts = profile.missing_profile(sup, miss).select("col_name", "n_missing")
    return counts.crossJoin(F.broadcast(sup.agg(F.count(F.lit(1)).alias("n")))).select(
        "col_name", (F.col("n") - F.col("n_missing")).alias("n_values"))


@query("sink_table", f"""
SELECT CASE WHEN ({SPLIT_H} % 1000000) < 200000 THEN 'test' ELSE 'train' END AS split,
       CAST(count(*) AS BIGINT) AS n_rows
FROM orders GROUP BY 1
""")
def q_sink_table(spark, sf):
    from cohortix.operators.split import group_split

    df = group_split(table(spark, sf, "orders"), ["o_custkey"])
    path = shared_dir(spark, "sink_table")
    sinks.sink_table(df, path, partition_by=["split"])
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


@query("sink_report", """
SELECT 'ranges' AS step, col_name AS subject, n_total AS value FROM (
  SELECT 'l_quantity' AS col_name, CAST(count_if(l_quantity < 5 OR l_quantity > 45) AS DOUBLE) AS n_total FROM lineitem
  UNION ALL
  SELECT 'l_discount', CAST(count_if(l_discount < 0.01 OR l_discount > 0.09) AS DOUBLE) FROM lineitem
) WHERE n_total > 0
""")
def q_sink_report(spark, sf):
    viol = profile.range_violations(lineitem(spark, sf), {"l_quantity": (5, 45), "l_discount": (0.01, 0.09)})
    findings = viol.select(
        F.lit("ranges").alias("step"),
        F.row_number().over(Window.orderBy(F.desc("pct"), "col_name")).alias("seq"),
        F.lit("MODERATE").alias("severity"),
        F.col("col_name").alias("subject"),
        F.lit("out-of-range values").alias("message"),
        F.col("n_total").cast("double").alias("value"),
    )
    path = shared_dir(spark, "sink_report")
    sinks.sink_report(findings, path)
    return spark.read.parquet(path).select("step", "subject", "value")


@query("schema_profile", """
SELECT * FROM (VALUES
  ('l_quantity', 'double', (SELECT CAST(count(DISTINCT l_quantity) AS BIGINT) FROM lineitem)),
  ('l_extendedprice', 'double', (SELECT CAST(count(DISTINCT l_extendedprice) AS BIGINT) FROM lineitem)),
  ('l_returnflag', 'string', (SELECT CAST(count(DISTINCT l_returnflag) AS BIGINT) FROM lineitem)),
  ('l_orderkey', 'bigint', (SELECT CAST(count(DISTINCT l_orderkey) AS BIGINT) FROM lineitem)),
  ('l_linenumber', 'int', (SELECT CAST(count(DISTINCT l_linenumber) AS BIGINT) FROM lineitem))
) t(col_name, dtype, n_unique)
""")
def q_schema_profile(spark, sf):
    return profile.schema_profile(
        lineitem(spark, sf),
        ["l_quantity", "l_extendedprice", "l_returnflag", "l_orderkey", "l_linenumber"],
    )


@query("unexpected_types", """
SELECT 'o_orderstatus' AS col_name, 'string' AS dtype, count(o_orderstatus) AS n_values,
       count(TRY_CAST(o_orderstatus AS DOUBLE)) AS n_numeric FROM orders
UNION ALL SELECT 'key_text', 'string', count(*), count(TRY_CAST(k AS DOUBLE))
FROM (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR) END AS k FROM orders)
""")
def q_unexpected_types(spark, sf):
    """A key that came as text, with some bad values, next to a real category."""
    key = F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_orderkey").cast("string"))
    o = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", key.alias("key_text"))
    return profile.unexpected_types(o, ["o_orderpriority"])


@query("table_shape", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem
""")
def q_table_shape(spark, sf):
    return profile.table_shape(lineitem(spark, sf))


# --- 2.2 projections, filters ---------------------------------------------------------------


@query("project_roles", """
SELECT l_partkey, l_suppkey, l_quantity, round(l_extendedprice, 6) AS l_extendedprice,
       round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax, l_linestatus FROM lineitem
""")
def q_project_roles(spark, sf):
    from cohortix.operators.clean import project_roles

    roles = Roles(ids=("l_orderkey", "l_linenumber"), labels=("l_returnflag",), exclude=("l_shipdate",))
    return r6(project_roles(lineitem(spark, sf), roles))


@query("range_filter", """
SELECT c_custkey, round(c_acctbal, 6) AS c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000
""")
def q_range_filter(spark, sf):
    # the plain comparison reaches the scan; the second one sees NaN as missing
    c = table(spark, sf, "customer", where=(F.col("c_acctbal") < 0) | (F.col("c_acctbal") > 9000))
    return r6(c.where(outside("c_acctbal", 0, 9000)).select("c_custkey", "c_acctbal"))


@query("label_filter", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R'
""")
def q_label_filter(spark, sf):
    from cohortix.operators.clean import label_filter

    return label_filter(lineitem(spark, sf), "l_returnflag", "R").select("l_orderkey", "l_linenumber", "l_quantity")


@query("drop_missing", f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows, round(avg(l_discount), 6) AS mean_discount
FROM {LI_NULLS_SQL} WHERE l_discount IS NOT NULL
""")
def q_drop_missing(spark, sf):
    from cohortix.operators.clean import drop_missing

    d = drop_missing(lineitem_nulls(spark, sf), "l_discount")
    return r6(d.agg(F.count(F.lit(1)).alias("n_rows"), F.avg("l_discount").alias("mean_discount")))


@query("quantile_trim", """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem)
SELECT CAST(count(*) AS BIGINT) AS n_rows, round(min(l_extendedprice), 6) AS min_kept,
       round(max(l_extendedprice), 6) AS max_kept
FROM lineitem, q WHERE l_extendedprice BETWEEN lo AND hi
""")
def q_quantile_trim(spark, sf):
    from cohortix.operators.clean import quantile_trim

    t = quantile_trim(lineitem(spark, sf), "l_extendedprice", 0.01, 0.99)
    return r6(t.agg(F.count(F.lit(1)).alias("n_rows"), F.min("l_extendedprice").alias("min_kept"),
                    F.max("l_extendedprice").alias("max_kept")))


@query("case_flag", """
SELECT l_orderkey, l_linenumber, COALESCE(CAST(nullif(l_quantity, 30) >= 25 AS INTEGER), 0) AS big_qty FROM lineitem
""")
def q_case_flag(spark, sf):
    li = lineitem(spark, sf)
    return li.select("l_orderkey", "l_linenumber",
                     case_flag(F.nullif(F.col("l_quantity"), F.lit(30.0)), 25).alias("big_qty"))


@query("severity_band", """
SELECT CASE WHEN value < 5 THEN 'LOW' WHEN value < 30 THEN 'MID' ELSE 'HIGH' END AS band,
       CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1
""")
def q_severity_band(spark, sf):
    ev = table(spark, sf, "events")
    band = severity_band(F.col("value"), [(5, "LOW"), (30, "MID")], "HIGH")
    return ev.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


# --- 2.4 aggregations ------------------------------------------------------------------


_DEDUP_ORDER_SQL = ", ".join(LI_ORDER)
DEDUP_SQL = f"""
WITH src AS (
  SELECT *, nullif(l_tax, 0) AS tax_n, CAST(l_returnflag = 'R' AS INTEGER) AS is_r,
         CAST(l_linestatus = 'O' AS INTEGER) AS is_o
  FROM lineitem),
ft AS (SELECT l_orderkey, tax_n, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_DEDUP_ORDER_SQL}) AS rn
       FROM src WHERE tax_n IS NOT NULL),
fq AS (SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_DEDUP_ORDER_SQL}) AS rn
       FROM src),
vr AS (SELECT l_orderkey, is_r, row_number() OVER (PARTITION BY l_orderkey ORDER BY count(*) DESC, is_r) AS rn
       FROM src GROUP BY l_orderkey, is_r),
vo AS (SELECT l_orderkey, is_o, row_number() OVER (PARTITION BY l_orderkey ORDER BY count(*) DESC, is_o) AS rn
       FROM src GROUP BY l_orderkey, is_o),
keys AS (SELECT DISTINCT l_orderkey FROM src),
dedup AS (
SELECT k.l_orderkey, fq.l_quantity, round(ft.tax_n, 6) AS tax_n, vr.is_r, vo.is_o
FROM keys k
LEFT JOIN (SELECT * FROM fq WHERE rn = 1) fq USING (l_orderkey)
LEFT JOIN (SELECT * FROM ft WHERE rn = 1) ft USING (l_orderkey)
LEFT JOIN (SELECT * FROM vr WHERE rn = 1) vr USING (l_orderkey)
LEFT JOIN (SELECT * FROM vo WHERE rn = 1) vo USING (l_orderkey))
"""


def dedup_input(spark, sf):
    li = lineitem(spark, sf)
    return li.withColumns(
        {"tax_n": F.nullif(F.col("l_tax"), F.lit(0.0)),
         "is_r": (F.col("l_returnflag") == "R").cast("int"),
         "is_o": (F.col("l_linestatus") == "O").cast("int")}
    )


def dedup_lineitem(spark, sf):
    return duplicates.dedup_majority(
        dedup_input(spark, sf), "l_orderkey", LI_ORDER,
        first_cols=["l_quantity", "tax_n"], vote_cols=["is_r", "is_o"],
    )


@query("dedup_majority", DEDUP_SQL + "SELECT * FROM dedup")
def q_dedup_majority(spark, sf):
    return r6(dedup_lineitem(spark, sf))


DOC_SQL = "(SELECT text, source, lang FROM documents)"


def docs(spark, sf):
    return table(spark, sf, "documents").select("text", "source", "lang")


@query("dup_exact", f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {DOC_SQL})) AS BIGINT) AS n_dup,
       round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {DOC_SQL}))) * 100.0 / count(*), 1) AS dup_pct
FROM {DOC_SQL}
""")
def q_dup_exact(spark, sf):
    return duplicates.dup_exact(docs(spark, sf))


@query("dup_features", f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, source FROM {DOC_SQL})) AS BIGINT) AS n_dup,
       round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, source FROM {DOC_SQL}))) * 100.0 / count(*), 1) AS dup_pct
FROM {DOC_SQL}
""")
def q_dup_features(spark, sf):
    return duplicates.dup_features(docs(spark, sf), ["lang"])


@query("dup_conflict", f"""
WITH g AS (SELECT text, source, count(DISTINCT lang) AS k FROM {DOC_SQL} GROUP BY text, source)
SELECT CAST(sum(k) AS BIGINT) AS n_distinct_rows, CAST(count(*) AS BIGINT) AS n_distinct_features,
       CAST(count_if(k > 1) AS BIGINT) AS n_conflict_groups, CAST(sum(k) - count(*) AS BIGINT) AS n_conflict_rows
FROM g
""")
def q_dup_conflict(spark, sf):
    return duplicates.dup_conflict(docs(spark, sf), ["lang"])


@query("dup_mark", """
SELECT doc_id, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) > 1 AS is_dup FROM documents
""")
def q_dup_mark(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return duplicates.dup_mark(d, ["text", "lang"], ["doc_id"]).select("doc_id", "is_dup")


def _missing_sql(cols, src):
    parts = [
        f"SELECT '{c}' AS col_name, CAST(count_if({c} IS NULL) AS BIGINT) AS n_missing, "
        f"round(count_if({c} IS NULL) * 100.0 / count(*), 2) AS missing_pct FROM {src}"
        for c in cols
    ]
    return " UNION ALL ".join(parts)


@query("missing_profile", f"""
SELECT *, missing_pct > 30 AS high FROM ({_missing_sql(LI_NUM, LI_NULLS_SQL)})
""")
def q_missing_profile(spark, sf):
    return profile.missing_profile(lineitem_nulls(spark, sf), LI_NUM)


@query("missing_total", f"""
SELECT CAST(sum(n_missing) AS BIGINT) AS n_missing FROM ({_missing_sql(LI_NUM, LI_NULLS_SQL)})
""")
def q_missing_total(spark, sf):
    return profile.missing_total(lineitem_nulls(spark, sf), LI_NUM)


LI_RANGES = {"l_quantity": (5, 45), "l_discount": (0.01, 0.09), "l_tax": (0.0, 0.07),
             "l_extendedprice": (1000.0, 100000.0)}


def _range_sql(ranges, src):
    parts = []
    for c, (lo, hi) in ranges.items():
        parts.append(
            f"SELECT '{c}' AS col_name, CAST({float(lo)} AS DOUBLE) AS lo, CAST({float(hi)} AS DOUBLE) AS hi, "
            f"CAST(count_if({c} < {lo}) AS BIGINT) AS n_below, CAST(count_if({c} > {hi}) AS BIGINT) AS n_above, "
            f"CAST(count_if({c} < {lo} OR {c} > {hi}) AS BIGINT) AS n_total, "
            f"round(count_if({c} < {lo} OR {c} > {hi}) * 100.0 / count({c}), 2) AS pct, "
            f"round(CAST(min({c}) AS DOUBLE), 4) AS actual_min, round(CAST(max({c}) AS DOUBLE), 4) AS actual_max FROM {src}"
        )
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE n_total > 0"


@query("range_violations", _range_sql(LI_RANGES, "lineitem"))
def q_range_violations(spark, sf):
    return profile.range_violations(lineitem(spark, sf), LI_RANGES)


@query("range_violations_customer", _range_sql({"c_acctbal": (0, 9000)}, "customer"))
def q_range_violations_customer(spark, sf):
    return profile.range_violations(table(spark, sf, "customer"), {"c_acctbal": (0, 9000)})


@query("critical_flag", "SELECT * FROM (" + _range_sql(LI_RANGES, "lineitem") + ") WHERE col_name IN ('l_tax', 'l_quantity')")
def q_critical_flag(spark, sf):
    return profile.critical_flag(profile.range_violations(lineitem(spark, sf), LI_RANGES), ["l_tax", "l_quantity"])


@query("scale_mix", """
SELECT 'l_quantity' AS col_name, CAST(count_if(l_quantity <= 1) AS BIGINT) AS n_unit,
       CAST(count(l_quantity) AS BIGINT) AS n_nonnull,
       count_if(l_quantity <= 1) > 0 AND count_if(l_quantity <= 1) < count(l_quantity) AS mixed
FROM lineitem
""")
def q_scale_mix(spark, sf):
    return profile.scale_mix(lineitem(spark, sf), "l_quantity")


EV_NUM = ["value", "user_id", "event_id"]


def _iqr_sql(cols, src):
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS col_name, CAST(count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers,
  round(count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100.0 / count({c}), 2) AS pct,
  round(any_value(q1), 4) AS q1, round(any_value(q3), 4) AS q3, round(any_value(q3 - q1), 4) AS iqr,
  round(any_value(q1 - 1.5 * (q3 - q1)), 4) AS lo_bound, round(any_value(q3 + 1.5 * (q3 - q1)), 4) AS hi_bound,
  round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max
FROM {src}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {src})""")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE n_outliers > 0"


@query("iqr_outliers", _iqr_sql(EV_NUM, "events"))
def q_iqr_outliers(spark, sf):
    return profile.iqr_outliers(table(spark, sf, "events"), EV_NUM)


@query("box_stats", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
                  quantile_cont(value, 0.75) AS q3 FROM events)
SELECT 'value' AS col_name, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median,
       round(any_value(q3), 6) AS q3,
       round(min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
       round(max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
       CAST(count_if(NOT (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS BIGINT) AS n_fliers
FROM events, q
""")
def q_box_stats(spark, sf):
    return r6(profile.box_stats(table(spark, sf, "events"), ["value"]))


@query("skewness", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, round(skewness({c}), 6) AS skew, abs(skewness({c})) > 1 AS flagged FROM events"
    for c in EV_NUM))
def q_skewness(spark, sf):
    return r6(profile.skewness(table(spark, sf, "events"), EV_NUM))


@query("summary_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, CAST(count({c}) AS BIGINT) AS n, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, "
    f"round(CAST(max({c}) AS DOUBLE), 6) AS max FROM lineitem" for c in LI_NUM))
def q_summary_stats(spark, sf):
    return r6(profile.summary_stats(lineitem(spark, sf), LI_NUM))


@query("group_moments", """
SELECT l_linestatus, CAST(count(l_quantity) AS BIGINT) AS n, round(avg(l_quantity), 6) AS mean,
       round(stddev_samp(l_quantity), 6) AS std FROM lineitem GROUP BY l_linestatus
""")
def q_group_moments(spark, sf):
    return r6(profile.group_moments(lineitem(spark, sf), "l_linestatus", "l_quantity"))


@query("value_counts", """
SELECT l_returnflag AS value, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1
""")
def q_value_counts(spark, sf):
    return profile.value_counts(lineitem(spark, sf), "l_returnflag")


def _balance_sql(cols, src, sev):
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS col_name, CAST(count(*) AS BIGINT) AS n_classes, CAST(min(n) AS BIGINT) AS n_min, "
            f"CAST(max(n) AS BIGINT) AS n_max, round(min(n) * 1.0 / max(n), 6) AS ratio FROM "
            f"(SELECT {c}, count(*) AS n FROM {src} WHERE {c} IS NOT NULL GROUP BY {c})"
        )
    return f"SELECT *, {sev} AS severity FROM (" + " UNION ALL ".join(parts) + ")"


@query("class_balance", _balance_sql(
    ["quality", "toxic"], "labels",
    "CASE WHEN ratio < 0.1 THEN 'SEVERE' WHEN ratio < 0.3 THEN 'MODERATE' ELSE 'OK' END"))
def q_class_balance(spark, sf):
    return r6(profile.class_balance(table(spark, sf, "labels"), ["quality", "toxic"]))


@query("category_balance", _balance_sql(
    ["c_mktsegment"], "customer", "CASE WHEN ratio < 0.5 THEN 'WARNING' ELSE 'OK' END"))
def q_category_balance(spark, sf):
    return r6(profile.category_balance(table(spark, sf, "customer"), ["c_mktsegment"]))


@query("crosstab", """
SELECT l_returnflag AS row_value, l_linestatus AS col_value, CAST(count(*) AS BIGINT) AS n,
       round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY l_returnflag), 6) AS row_share,
       round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY l_returnflag), 6) AS row_pct
FROM lineitem GROUP BY 1, 2
""")
def q_crosstab(spark, sf):
    return r6(profile.crosstab(lineitem(spark, sf), "l_returnflag", "l_linestatus"))


@query("crosstab_wide", """
SELECT quality, CAST(count_if(toxic = 0) AS BIGINT) AS "0", CAST(count_if(toxic = 1) AS BIGINT) AS "1"
FROM labels GROUP BY quality
""")
def q_crosstab_wide(spark, sf):
    return profile.crosstab_wide(table(spark, sf, "labels"), "quality", "toxic", [0, 1])


@query("histogram", """
WITH r AS (SELECT min(value) AS mn, max(value) AS mx, count(*) AS n_all FROM events),
b AS (SELECT LEAST(GREATEST(CAST(floor((value - mn) / ((mx - mn) / 50)) AS BIGINT) + 1, 1), 50) AS bin,
             mn, (mx - mn) / 50 AS w, n_all FROM events, r)
SELECT bin, round(mn + (bin - 1) * w, 6) AS lo_edge, round(mn + bin * w, 6) AS hi_edge,
       CAST(count(*) AS BIGINT) AS n, round(count(*) / (n_all * w), 6) AS density
FROM b GROUP BY bin, mn, w, n_all
""")
def q_histogram(spark, sf):
    return r6(profile.histogram(table(spark, sf, "events"), "value", 50))


CORR_COLS = LI_NUM + ["is_o"]


def corr_input(spark, sf):
    return lineitem(spark, sf).withColumn("is_o", (F.col("l_linestatus") == "O").cast("int"))


CORR_SRC = "(SELECT *, CAST(l_linestatus = 'O' AS INTEGER) AS is_o FROM lineitem)"
CORR_MATRIX_SQL = " UNION ALL ".join(
    f"SELECT '{CORR_COLS[i]}' AS col_a, '{CORR_COLS[j]}' AS col_b, {i} AS i, {j} AS j, "
    f"round(corr({CORR_COLS[i]}, {CORR_COLS[j]}), 6) AS r FROM {CORR_SRC}"
    for i in range(len(CORR_COLS)) for j in range(i + 1, len(CORR_COLS))
)


@query("correlation_matrix", CORR_MATRIX_SQL)
def q_correlation_matrix(spark, sf):
    return r6(profile.correlation_matrix(corr_input(spark, sf), CORR_COLS))


PAIR_EXPRS = {
    "l_quantity": "l_quantity",
    "l_extendedprice": "l_extendedprice",
    "l_discount": "l_discount",
    "revenue": "l_extendedprice * (1 - l_discount)",
    "qty_adj": "l_quantity + 5 * l_linenumber",
    "unit_price": "l_extendedprice / l_quantity",
}
PAIR_COLS = list(PAIR_EXPRS)
PAIR_SRC = "(SELECT " + ", ".join(f"{e} AS {k}" for k, e in PAIR_EXPRS.items()) + " FROM lineitem)"
PAIR_MATRIX_SQL = " UNION ALL ".join(
    f"SELECT '{PAIR_COLS[i]}' AS col_a, '{PAIR_COLS[j]}' AS col_b, {i} AS i, {j} AS j, "
    f"corr({PAIR_COLS[i]}, {PAIR_COLS[j]}) AS r FROM {PAIR_SRC}"
    for i in range(len(PAIR_COLS)) for j in range(i + 1, len(PAIR_COLS))
)


@query("corr_pairs", f"""
SELECT * REPLACE (round(r, 6) AS r), CASE WHEN abs(r) > 0.9 THEN 'HIGH' ELSE 'MODERATE' END AS band
FROM ({PAIR_MATRIX_SQL})
WHERE abs(r) > 0.7
""")
def q_corr_pairs(spark, sf):
    """lineitem with derived revenue / adjusted quantity / unit price, bands
    |r| > 0.9 HIGH and 0.7 < |r| <= 0.9 MODERATE."""
    li = lineitem(spark, sf).select(*[F.expr(e).alias(k) for k, e in PAIR_EXPRS.items()])
    m = profile.correlation_matrix(li, PAIR_COLS)
    return r6(profile.corr_pairs(m, PAIR_COLS, high=0.9, moderate=0.7))


LABEL_EXPRS = dict(PAIR_EXPRS, high_qty="CAST(l_quantity >= 40 AS INTEGER)",
                   big_order="CAST(l_extendedprice * (1 - l_discount) > 60000 AS INTEGER)")
LABEL_FEATS = PAIR_COLS
LABEL_COLS = ["high_qty", "big_order"]
LABEL_ALL = LABEL_FEATS + LABEL_COLS
LABEL_SRC = "(SELECT " + ", ".join(f"{e} AS {k}" for k, e in LABEL_EXPRS.items()) + " FROM lineitem)"
LABEL_SQL = " UNION ALL ".join(
    f"SELECT '{lab}' AS label, '{f}' AS feature, corr({f}, {lab}) AS r FROM {LABEL_SRC}"
    for lab in LABEL_COLS for f in LABEL_FEATS
)


def _label_matrix(spark, sf):
    li = lineitem(spark, sf).select(*[F.expr(e).alias(k) for k, e in LABEL_EXPRS.items()])
    return profile.correlation_matrix(li, LABEL_ALL)


@query("corr_label", f"SELECT * REPLACE (round(r, 6) AS r), abs(r) > 0.8 AS flagged FROM ({LABEL_SQL})")
def q_corr_label(spark, sf):
    """Feature-label correlations, leakage flag above 0.8 (audit rule)."""
    return r6(profile.corr_label(_label_matrix(spark, sf), LABEL_FEATS, LABEL_COLS, threshold=0.8))


@query("corr_label_review", f"SELECT * REPLACE (round(r, 6) AS r), abs(r) > 0.8 AS flagged FROM ({LABEL_SQL}) WHERE abs(r) > 0.5")
def q_corr_label_review(spark, sf):
    """The review's list: only pairs with |r| > 0.5, by |r| desc."""
    return r6(profile.corr_label(_label_matrix(spark, sf), LABEL_FEATS, LABEL_COLS, threshold=0.8, min_abs=0.5))


@query("importance_rank", f"""
SELECT feature, CAST(row_number() OVER (ORDER BY abs(r) DESC, feature) AS INTEGER) AS rank
FROM (SELECT col_a AS feature, r FROM ({CORR_MATRIX_SQL.replace("round(", "(").replace("), 6)", "))")}) WHERE col_b = 'is_o')
QUALIFY rank <= 3
""")
def q_importance_rank(spark, sf):
    from cohortix.operators.ranking import rank_top

    m = profile.correlation_matrix(corr_input(spark, sf), CORR_COLS)
    lab = profile.corr_label(m, LI_NUM, ["is_o"]).select("feature", "r")
    return rank_top(lab, [F.desc(F.abs("r")), F.col("feature")], 3).select("feature", "rank")


@query("distinct_entities", f"""
SELECT CASE WHEN ({SPLIT_H} % 1000000) < 200000 THEN 'test' ELSE 'train' END AS split,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_groups
FROM orders GROUP BY 1
""")
def q_distinct_entities(spark, sf):
    from cohortix.operators.split import group_split

    return profile.distinct_entities(group_split(table(spark, sf, "orders"), ["o_custkey"]), "split", "o_custkey")


@query("score_cumulative", f"""
WITH s AS (SELECT score, CAST(count_if(label = 1) AS BIGINT) AS pos, CAST(count_if(label = 0) AS BIGINT) AS neg
           FROM {EV_SQL} GROUP BY score)
SELECT round(score, 6) AS score, pos, neg,
       CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS cum_pos,
       CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS cum_neg,
       CAST(sum(pos) OVER () AS BIGINT) AS total_pos, CAST(sum(neg) OVER () AS BIGINT) AS total_neg
FROM s
""")
def q_score_cumulative(spark, sf):
    from cohortix.operators.metrics import score_cumulative

    return r6(score_cumulative(scored_events(spark, sf), "label", "score"))
