"""Registered queries: cleaning operators, scalar features and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortix.functions import features as feat
from cohortix.functions.exprs import safe_div, zero_to_null
from cohortix.functions.text import REPLACEMENTS, normalize_text
from cohortix.operators import clean
from cohortix.plans.catalog import LI_NULLS_SQL, lineitem, lineitem_nulls, query, r6
from cohortix.plans.q_profile import DEDUP_SQL, dedup_lineitem
from cohortix.sources.scan import table

CUST_BOUNDS = {"c_acctbal": (0, 9000)}
LI_CAPS = {"l_quantity": (5, 45), "l_extendedprice": (1000.0, 90000.0)}


@query("null_out_impossible", """
SELECT c_custkey, round(CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN c_acctbal END, 6) AS c_acctbal FROM customer
""")
def q_null_out_impossible(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return r6(clean.null_out_impossible(c, CUST_BOUNDS))


@query("impossible_report", """
SELECT 'c_acctbal' AS col_name, CAST(count_if(c_acctbal < 0 OR c_acctbal > 9000) AS BIGINT) AS n_nulled FROM customer
""")
def q_impossible_report(spark, sf):
    return clean.impossible_report(table(spark, sf, "customer"), CUST_BOUNDS)


@query("winsorize", """
SELECT l_orderkey, l_linenumber, round(GREATEST(5, LEAST(45, l_quantity)), 6) AS l_quantity,
       round(GREATEST(1000.0, LEAST(90000.0, l_extendedprice)), 6) AS l_extendedprice FROM lineitem
""")
def q_winsorize(spark, sf):
    li = lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return r6(clean.winsorize(li, LI_CAPS))


@query("winsorize_report", """
SELECT * FROM (
  SELECT 'l_quantity' AS col_name, CAST(count_if(l_quantity < 5) AS BIGINT) AS n_low,
         CAST(count_if(l_quantity > 45) AS BIGINT) AS n_high FROM lineitem
  UNION ALL
  SELECT 'l_extendedprice', CAST(count_if(l_extendedprice < 1000) AS BIGINT),
         CAST(count_if(l_extendedprice > 90000) AS BIGINT) FROM lineitem
) WHERE n_low + n_high > 0
""")
def q_winsorize_report(spark, sf):
    return clean.winsorize_report(lineitem(spark, sf), LI_CAPS)


@query("impute_median", f"""
WITH s AS {LI_NULLS_SQL}, m AS (SELECT median(l_tax) AS mt, median(l_discount) AS md FROM s)
SELECT l_orderkey, l_linenumber, round(COALESCE(l_tax, mt), 6) AS l_tax,
       round(COALESCE(l_discount, md), 6) AS l_discount FROM s, m
""")
def q_impute_median(spark, sf):
    li = lineitem_nulls(spark, sf).select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    return r6(clean.impute_median(li, ["l_tax", "l_discount"]))


@query("impute_zero", """
SELECT l_orderkey, l_linenumber,
       CAST(COALESCE(nullif(CAST(l_returnflag = 'R' AS INTEGER), 0), 0) AS INTEGER) AS flag_r FROM lineitem
""")
def q_impute_zero(spark, sf):
    li = lineitem(spark, sf).select(
        "l_orderkey", "l_linenumber",
        F.nullif((F.col("l_returnflag") == "R").cast("int"), F.lit(0)).alias("flag_r"))
    return clean.impute_zero(li, ["flag_r"])


@query("encode_binary", """
SELECT CAST(COALESCE(nullif(l_linestatus, 'F') = 'O', false) AS INTEGER) AS status_encoded,
       CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1
""")
def q_encode_binary(spark, sf):
    li = lineitem(spark, sf).select(F.nullif(F.col("l_linestatus"), F.lit("F")).alias("status"))
    enc = clean.encode(li, "status", positive="O")
    return enc.groupBy("status_encoded").agg(F.count(F.lit(1)).alias("n"))


@query("log1p", """
SELECT l_orderkey, l_linenumber, round(ln(1 + l_extendedprice), 6) AS l_extendedprice_log,
       round(ln(1 + l_tax), 6) AS l_tax_log FROM lineitem
""")
def q_log1p(spark, sf):
    li = lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax")
    return r6(clean.log1p_columns(li, ["l_extendedprice", "l_tax"]).drop("l_extendedprice", "l_tax"))


@query("zero_to_null", """
SELECT CAST(count_if(nullif(l_discount, 0) IS NULL) AS BIGINT) AS n_null,
       CAST(count(nullif(l_discount, 0)) AS BIGINT) AS n_kept FROM lineitem
""")
def q_zero_to_null(spark, sf):
    z = lineitem(spark, sf).select(zero_to_null("l_discount").alias("d"))
    return z.agg(F.count_if(F.col("d").isNull()).alias("n_null"), F.count("d").alias("n_kept"))


@query("inf_to_null", """
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / l_discount END, 6) AS qty_per_discount,
       round(CASE WHEN l_tax = 0 THEN NULL ELSE -l_extendedprice / l_tax END, 6) AS price_per_tax FROM lineitem
""")
def q_inf_to_null(spark, sf):
    li = lineitem(spark, sf)
    inf = F.lit(float("inf"))
    x = li.select("l_orderkey", "l_linenumber",
                  F.coalesce(safe_div(F.col("l_quantity"), F.col("l_discount")), inf).alias("qty_per_discount"),
                  F.coalesce(safe_div(-F.col("l_extendedprice"), F.col("l_tax")), -inf).alias("price_per_tax"))
    return r6(clean.inf_to_null(x))


# --- engineered features on lineitem columns mapped to clinical roles ----------------------

_ROLE_MAP = {
    "sys_bp": "l_extendedprice / 500.0",
    "dia_bp": "l_quantity",
    "pao2": "(l_extendedprice / 100.0 - 100.0)",
    "fio2": "(l_discount * 1000.0)",
    "resp_rate": "CAST(l_linenumber AS DOUBLE)",
    "tidal_volume": "(l_tax * 10000.0)",
    "paco2": "(l_tax * 1000.0)",
    "hypertension": "CAST(l_returnflag = 'R' AS INTEGER)",
    "diabetes": "CAST(l_linestatus = 'O' AS INTEGER)",
    "copd": "CAST(l_returnflag = 'A' AS INTEGER)",
    "heart_failure": "CAST(l_linenumber > 4 AS INTEGER)",
    "sofa_score": "l_linenumber",
    "icu_los_days": "(l_discount * 100.0)",
    "hosp_los_days": "(l_tax * 100.0)",
    "charlson_comorbidity_index": "(l_linenumber - 1)",
}

_FEATURE_SQL = {
    "pf_ratio": "CASE WHEN ({fio2} / 100.0) = 0 THEN NULL ELSE {pao2} / ({fio2} / 100.0) END",
    "rsbi": "CASE WHEN ({tidal_volume} / 1000.0) = 0 THEN NULL ELSE {resp_rate} / ({tidal_volume} / 1000.0) END",
    "map": "({sys_bp} + 2 * {dia_bp}) / 3.0",
    "pulse_pressure": "{sys_bp} - {dia_bp}",
    "oxi_index": "CASE WHEN {pao2} = 0 THEN NULL ELSE ({fio2} * (({sys_bp} + 2 * {dia_bp}) / 3.0)) / {pao2} END",
    "aa_gradient": "({fio2} / 100.0 * 713) - ({paco2} / 0.8) - {pao2}",
    "pao2_log": "CASE WHEN {pao2} > -1 THEN ln(1 + {pao2}) END",
    "comorbidity_count": "{hypertension} + {diabetes} + {copd} + {heart_failure}",
    "sofa_per_day": "CASE WHEN {icu_los_days} = 0 THEN NULL ELSE {sofa_score} / {icu_los_days} END",
    "los_ratio": "CASE WHEN {hosp_los_days} = 0 THEN NULL ELSE {icu_los_days} / {hosp_los_days} END",
    "charlson_high": "COALESCE(CAST({charlson_comorbidity_index} >= 5 AS INTEGER), 0)",
    "sofa_high": "COALESCE(CAST({sofa_score} >= 8 AS INTEGER), 0)",
}


def mapped_roles(spark, sf):
    li = lineitem(spark, sf)
    return li.select("l_orderkey", "l_linenumber", *[F.expr(e).alias(k) for k, e in _ROLE_MAP.items()])


def _feature_query(name):
    body = _FEATURE_SQL[name].format(**_ROLE_MAP)
    wrap = f"round({body}, 6)" if name not in ("comorbidity_count", "charlson_high", "sofa_high") else body
    sql = f"SELECT l_orderkey, l_linenumber, {wrap} AS {name} FROM lineitem"

    def fn(spark, sf):
        df = mapped_roles(spark, sf)
        return r6(df.select("l_orderkey", "l_linenumber", feat.feature_exprs()[name].alias(name)))

    fn.__name__ = f"q_feat_{name}"
    query(f"feat_{name}", sql)(fn)


for _n in _FEATURE_SQL:
    _feature_query(_n)


@query("round_n", """
SELECT o_orderkey, round(o_totalprice / 7.0, 2) AS price_7 FROM orders
""")
def q_round_n(spark, sf):
    o = table(spark, sf, "orders")
    from cohortix.functions.exprs import round_n

    return o.select("o_orderkey", round_n(F.col("o_totalprice") / 7.0, 2).alias("price_7"))


# --- text --------------------------------------------------------------------------------------


def _inject(col):
    """Put typographic characters into the prose (the tables hold none)."""
    c = F.replace(col, F.lit(","), F.lit("—"))
    c = F.replace(c, F.lit(" - "), F.lit(" – "))
    c = F.replace(c, F.lit("."), F.lit("…"))
    c = F.replace(c, F.lit(" the "), F.lit(" “the” "))
    c = F.replace(c, F.lit(" a "), F.lit(" ‘a’ "))
    return c


_INJECT_SQL = ("replace(replace(replace(replace(replace(text, ',', '—'), ' - ', ' – '), '.', '…'), "
               "' the ', ' “the” '), ' a ', ' ‘a’ ')")


def _normalize_sql(expr: str) -> str:
    out = expr
    for k, v in REPLACEMENTS.items():
        v_sql = v.replace("'", "''")
        out = f"replace({out}, '{k}', '{v_sql}')"
    return out


@query("normalize_text", f"""
WITH s AS (SELECT doc_id, {_INJECT_SQL} AS text FROM documents)
SELECT doc_id, {_normalize_sql('text')} AS text, {_normalize_sql('text')} <> text AS changed FROM s
""")
def q_normalize_text(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", _inject(F.col("text")).alias("text"))
    return normalize_text(d, "text")


@query("normalize_text_summary", f"""
WITH s AS (SELECT {_INJECT_SQL} AS text FROM documents)
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count_if({_normalize_sql('text')} <> text) AS BIGINT) AS n_changed FROM s
""")
def q_normalize_text_summary(spark, sf):
    d = table(spark, sf, "documents").select(_inject(F.col("text")).alias("text"))
    n = normalize_text(d, "text")
    return n.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("changed").alias("n_changed"))


# --- fitted statistics applied to rows ------------------------------------------------------


@query("stats_apply", """
SELECT l_orderkey, l_linenumber, round(l_quantity - m, 6) AS qty_dev FROM lineitem, (SELECT avg(l_quantity) AS m FROM lineitem)
""")
def q_stats_apply(spark, sf):
    li = lineitem(spark, sf)
    stats = li.agg(F.avg("l_quantity").alias("_m"))
    out = clean.stats_apply(li, stats, lambda d: d.withColumn("qty_dev", F.col("l_quantity") - F.col("_m")))
    return r6(out.select("l_orderkey", "l_linenumber", "qty_dev"))


@query("before_after", DEDUP_SQL + """,
orig AS (SELECT l_quantity, nullif(l_tax, 0) AS tax_n FROM lineitem),
p AS (
  SELECT 'original' AS stage, CAST(count(*) AS BIGINT) AS n_rows,
         CAST(count_if(l_quantity IS NULL) + count_if(tax_n IS NULL) AS BIGINT) AS n_missing,
         CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, tax_n FROM orig)) AS BIGINT) AS n_feature_dup
  FROM orig
  UNION ALL
  SELECT 'cleaned', CAST(count(*) AS BIGINT),
         CAST(count_if(l_quantity IS NULL) + count_if(tax_n IS NULL) AS BIGINT),
         CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, tax_n FROM dedup)) AS BIGINT)
  FROM dedup)
SELECT stage, n_rows, (SELECT n_rows FROM p WHERE stage = 'original') - n_rows AS n_removed,
       round(((SELECT n_rows FROM p WHERE stage = 'original') - n_rows) * 100.0 /
             (SELECT n_rows FROM p WHERE stage = 'original'), 1) AS removed_pct,
       n_missing, n_feature_dup FROM p
""")
def q_before_after(spark, sf):
    orig = lineitem(spark, sf).select("l_quantity", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax_n"))
    cleaned = dedup_lineitem(spark, sf).select("l_quantity", "tax_n")
    return clean.before_after(orig, cleaned, ["l_quantity", "tax_n"], [])


# --- the same row operators on a stream --------------------------------------------------------


@query("stream_clean", """
SELECT l_orderkey, l_linenumber, round(GREATEST(5, LEAST(45, l_quantity)), 6) AS l_quantity,
       round(GREATEST(1000.0, LEAST(90000.0, l_extendedprice)), 6) AS l_extendedprice,
       round(CASE WHEN l_tax BETWEEN 0.01 AND 0.08 THEN l_tax END, 6) AS l_tax FROM lineitem
""")
def q_stream_clean(spark, sf):
    """lineitem read as a file stream, NULL-out + winsorize per micro-batch,
    drained to a file sink (exactly-once, checkpointed) and read back."""
    from cohortix.plans.catalog import shared_dir
    from cohortix.streaming import stateless as st

    schema = lineitem(spark, sf).schema
    src = st.read_stream(spark, f"{sf}/lineitem.parquet", schema)
    steps = [
        lambda d: d.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax"),
        lambda d: clean.null_out_impossible(d, {"l_tax": (0.01, 0.08)}),
        lambda d: clean.winsorize(d, LI_CAPS),
    ]
    base = shared_dir(spark, "stream_clean")
    st.write_stream(st.apply_steps(src, steps), f"{base}/out", f"{base}/checkpoint")
    return r6(spark.read.schema(
        "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double"
    ).parquet(f"{base}/out"))
