"""Registered queries: statistical tests, splits, folds, scaling, ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortix.operators import ranking, split, stats
from cohortix.operators.metrics import roc_auc
from cohortix.plans.catalog import EV_SQL, LI_NUM, lineitem, query, r6, scored_events, split_hash_sql
from cohortix.sources.scan import table

CUST_H = split_hash_sql("CAST(o_custkey AS VARCHAR)")
ORDER_SPLIT_SQL = f"""(SELECT *, CASE WHEN ({CUST_H} % 1000000) < 200000 THEN 'test' ELSE 'train' END AS split
  FROM orders)"""


def orders_split(spark, sf):
    return split.group_split(table(spark, sf, "orders"), ["o_custkey"])


# --- 2.9 statistical tests ---------------------------------------------------------------------


def _chi2_sql(a, b, src, yates):
    corr = "LEAST(0.5, abs(n - e))" if yates else "0"
    return f"""
WITH cells AS (SELECT {a} AS av, {b} AS bv, count(*) AS n FROM {src} GROUP BY 1, 2),
r AS (SELECT av, sum(n) AS rn FROM cells GROUP BY av),
c AS (SELECT bv, sum(n) AS cn FROM cells GROUP BY bv),
g AS (SELECT r.av, c.bv, rn, cn FROM r, c),
full_ AS (SELECT g.av, g.bv, COALESCE(cells.n, 0) AS n, rn * cn * 1.0 / (SELECT sum(n) FROM cells) AS e
          FROM g LEFT JOIN cells ON g.av = cells.av AND g.bv = cells.bv),
shape AS (SELECT (SELECT count(*) FROM r) AS nr, (SELECT count(*) FROM c) AS nc)
SELECT round(sum(power(abs(n - e) - CASE WHEN (nr - 1) * (nc - 1) = 1 THEN {corr} ELSE 0 END, 2) / e), 6) AS chi2,
       CAST(any_value((nr - 1) * (nc - 1)) AS BIGINT) AS dof, CAST(any_value(nr) AS BIGINT) AS n_rows,
       CAST(any_value(nc) AS BIGINT) AS n_cols
FROM full_, shape
"""


@query("chi2_independence", _chi2_sql("l_returnflag", "l_linestatus", "lineitem", True))
def q_chi2_independence(spark, sf):
    return r6(stats.chi2_statistic(lineitem(spark, sf), "l_returnflag", "l_linestatus"))


@query("chi2_yates", _chi2_sql("quality", "toxic", "labels", True))
def q_chi2_yates(spark, sf):
    """2 x 2 table: the Yates continuity correction applies."""
    return r6(stats.chi2_statistic(table(spark, sf, "labels"), "quality", "toxic"))


# P(|Z| < z) by Simpson's rule over 4,000 steps
_NORMAL_SQL = """(SELECT sum((CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
  * exp(-power(sqrt(chi2) * i / 4000.0, 2) / 2)) * sqrt(chi2) / 12000.0 * 2 / sqrt(2 * pi()) FROM range(4001) t(i))"""


@query("chi2_pvalue", f"""
WITH s AS (WITH q AS ({_chi2_sql("quality", "toxic", "labels", True).replace("round(sum", "(sum").replace("e), 6)", "e))")})
           SELECT chi2, dof FROM q)
SELECT 'quality' AS a, 'toxic' AS b, round(chi2, 6) AS chi2, dof, round(1 - {_NORMAL_SQL}, 6) AS p,
       CASE WHEN 1 - {_NORMAL_SQL} < 0.05 THEN 'WARNING' ELSE 'OK' END AS verdict FROM s
""")
def q_chi2_pvalue(spark, sf):
    """The 2 x 2 test with its p-value and verdict."""
    return r6(stats.chi2_independence(table(spark, sf, "labels"), "quality", "toxic"))


_TTEST_SQL = """
WITH m AS (SELECT count(l_quantity) FILTER (WHERE l_linestatus = 'O') AS n0,
                  count(l_quantity) FILTER (WHERE l_linestatus = 'F') AS n1,
                  avg(l_quantity) FILTER (WHERE l_linestatus = 'O') AS m0,
                  avg(l_quantity) FILTER (WHERE l_linestatus = 'F') AS m1,
                  var_samp(l_quantity) FILTER (WHERE l_linestatus = 'O') AS v0,
                  var_samp(l_quantity) FILTER (WHERE l_linestatus = 'F') AS v1 FROM lineitem)
SELECT CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1, round(m0, 6) AS m0, round(m1, 6) AS m1,
       round((m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1)), 6) AS t,
       CAST(n0 + n1 - 2 AS BIGINT) AS dof FROM m
"""


@query("ttest_two_sample", _TTEST_SQL)
def q_ttest_two_sample(spark, sf):
    return r6(stats.ttest_moments(lineitem(spark, sf), "l_linestatus", "l_quantity", "O", "F"))


@query("ttest_pvalue", f"""
WITH s AS ({_TTEST_SQL.replace("round((m0 - m1)", "((m0 - m1)").replace("1.0 / n1)), 6)", "1.0 / n1)))")}),
p AS (SELECT n0, n1, t, 1 - (SELECT sum((CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
    * power(1 + power(t * i / 4000.0, 2) / dof, -(dof + 1) / 2.0)) * abs(t) / 12000.0 * 2
    * exp(lgamma((dof + 1) / 2.0) - lgamma(dof / 2.0)) / sqrt(dof * pi()) FROM range(4001) r(i)) AS p FROM s)
SELECT 'l_linestatus' AS "group", 'l_quantity' AS col_name, n0, n1, round(t, 6) AS t, round(p, 6) AS p,
       CASE WHEN p < 0.05 THEN 'WARNING' ELSE 'OK' END AS verdict FROM p
""")
def q_ttest_pvalue(spark, sf):
    return r6(stats.ttest_two_sample(lineitem(spark, sf), "l_linestatus", "l_quantity", "O", "F"))


EV_FOLD_SQL = f"""(SELECT *, CAST(({split_hash_sql("CAST(user_id AS VARCHAR)")}) % 5 AS INTEGER) AS fold FROM {EV_SQL})"""


def events_folds(spark, sf):
    return split.hash_kfold(scored_events(spark, sf), ["user_id"], 5)


@query("confidence_interval", f"""
WITH f AS (SELECT fold, avg(score) AS metric FROM {EV_FOLD_SQL} GROUP BY fold)
SELECT round(avg(metric), 6) AS mean, round(stddev_pop(metric), 6) AS std, CAST(count(*) AS BIGINT) AS n,
       round(avg(metric) - 1.96 * stddev_pop(metric) / sqrt(count(*)), 6) AS ci_lo,
       round(avg(metric) + 1.96 * stddev_pop(metric) / sqrt(count(*)), 6) AS ci_hi FROM f
""")
def q_confidence_interval(spark, sf):
    per_fold = events_folds(spark, sf).groupBy("fold").agg(F.avg("score").alias("metric"))
    return r6(stats.confidence_interval(per_fold, "metric"))


# --- 2.10 splits and scaling ----------------------------------------------------------------------


@query("group_split", f"""
SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_groups
FROM {ORDER_SPLIT_SQL} GROUP BY split
""")
def q_group_split(spark, sf):
    return orders_split(spark, sf).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_custkey").alias("n_groups"))


@query("group_split_exact", f"""
WITH g AS (SELECT DISTINCT o_custkey FROM orders),
rk AS (SELECT o_custkey, row_number() OVER (ORDER BY {CUST_H}, o_custkey) AS rn FROM g),
a AS (SELECT o_custkey, CASE WHEN rn <= CAST(ceil(0.2 * (SELECT count(*) FROM g)) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM rk)
SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_groups
FROM orders JOIN a USING (o_custkey) GROUP BY split
""")
def q_group_split_exact(spark, sf):
    s = split.group_split_exact(table(spark, sf, "orders"), ["o_custkey"])
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_custkey").alias("n_groups"))


@query("split_apply", f"""
SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM {ORDER_SPLIT_SQL} WHERE split = 'test'
""")
def q_split_apply(spark, sf):
    return r6(orders_split(spark, sf).where(F.col("split") == "test").select("o_orderkey", "o_totalprice"))


@query("hash_kfold", f"""
SELECT fold, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS n_groups
FROM {EV_FOLD_SQL} GROUP BY fold
""")
def q_hash_kfold(spark, sf):
    return events_folds(spark, sf).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user_id").alias("n_groups"))


@query("group_kfold", """
WITH RECURSIVE g AS (SELECT row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS i, count(*) AS n FROM orders GROUP BY o_custkey),
t(i, l, c) AS (
  SELECT 0::BIGINT, [0, 0, 0, 0, 0]::BIGINT[], [0, 0, 0, 0, 0]::BIGINT[]
  UNION ALL
  SELECT t.i + 1, list_transform(l, lambda x, j: x + CASE WHEN j = list_position(l, list_min(l)) THEN g.n ELSE 0 END),
         list_transform(c, lambda x, j: x + CASE WHEN j = list_position(l, list_min(l)) THEN 1 ELSE 0 END)
  FROM t JOIN g ON g.i = t.i + 1)
SELECT CAST(f AS INTEGER) AS fold, l[f + 1] AS n_rows, c[f + 1] AS n_groups
FROM (SELECT l, c FROM t ORDER BY i DESC LIMIT 1), range(5) r(f)
""")
def q_group_kfold(spark, sf):
    """Row-balanced group folds: the greedy, group after group, in the twin."""
    f = split.group_kfold(table(spark, sf, "orders"), ["o_custkey"], 5)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_custkey").alias("n_groups"))


@query("stratified_kfold", f"""
WITH k AS (SELECT DISTINCT quality, doc_id, toxic,
                  {split_hash_sql("CAST(doc_id AS VARCHAR), CAST(toxic AS VARCHAR)")} AS h FROM labels),
r AS (SELECT quality, doc_id, toxic,
             CAST((row_number() OVER (PARTITION BY quality ORDER BY h, doc_id, toxic) - 1) % 3 AS INTEGER) AS fold FROM k)
SELECT quality, fold, CAST(count(*) AS BIGINT) AS n FROM labels JOIN r USING (quality, doc_id, toxic) GROUP BY 1, 2
""")
def q_stratified_kfold(spark, sf):
    f = split.stratified_kfold(table(spark, sf, "labels"), "quality", 3)
    return f.groupBy("quality", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("split_overlap", f"""
SELECT CAST(count(*) AS BIGINT) AS n_groups, CAST(count_if(k > 1) AS BIGINT) AS n_overlap
FROM (SELECT o_custkey, count(DISTINCT split) AS k FROM {ORDER_SPLIT_SQL} GROUP BY o_custkey)
""")
def q_split_overlap(spark, sf):
    return split.split_overlap(orders_split(spark, sf), "split", ["o_custkey"])


@query("union_rows", f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows, round(sum(o_totalprice) / 1000.0, 2) AS total_k FROM orders
""")
def q_union_rows(spark, sf):
    s = orders_split(spark, sf)
    both = s.where(F.col("split") == "train").unionByName(s.where(F.col("split") == "test"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice") / 1000.0, 2).alias("total_k"))


LI_SPLIT_SQL = f"""(SELECT *, CASE WHEN ({split_hash_sql("CAST(l_orderkey AS VARCHAR)")} % 1000000) < 200000
  THEN 'test' ELSE 'train' END AS split FROM lineitem)"""


def lineitem_split(spark, sf):
    return split.group_split(lineitem(spark, sf), ["l_orderkey"])


def _scaled_sql():
    cols = ", ".join(
        f"round(CASE WHEN s_{c} = 0 THEN {c} - m_{c} ELSE ({c} - m_{c}) / s_{c} END, 6) AS {c}" for c in LI_NUM)
    stats_ = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in LI_NUM)
    return (f"SELECT l_orderkey, l_linenumber, split, {cols} FROM {LI_SPLIT_SQL} t, "
            f"(SELECT {stats_} FROM {LI_SPLIT_SQL} WHERE split = 'train') st")


@query("standard_scale", _scaled_sql())
def q_standard_scale(spark, sf):
    s = lineitem_split(spark, sf).select("l_orderkey", "l_linenumber", "split", *LI_NUM)
    return r6(split.standard_scale(s, LI_NUM, F.col("split") == "train"))


@query("scale_check", f"""
WITH s AS ({_scaled_sql()}), t AS (SELECT * FROM s WHERE split = 'train'),
m AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in LI_NUM)} FROM t)
SELECT round(LEAST({", ".join(f"m_{c}" for c in LI_NUM)}), 4) AS mean_min,
       round(GREATEST({", ".join(f"m_{c}" for c in LI_NUM)}), 4) AS mean_max,
       round(LEAST({", ".join(f"s_{c}" for c in LI_NUM)}), 4) AS std_min,
       round(GREATEST({", ".join(f"s_{c}" for c in LI_NUM)}), 4) AS std_max FROM m
""")
def q_scale_check(spark, sf):
    s = lineitem_split(spark, sf).select("split", *LI_NUM)
    scaled = split.standard_scale(s, LI_NUM, F.col("split") == "train").where(F.col("split") == "train")
    return r6(split.scale_check(scaled, LI_NUM), 4)


@query("class_weights", """
WITH c AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY 1),
t AS (SELECT sum(n) AS n_all, count(*) AS k, sum(CASE WHEN label = 0 THEN n ELSE 0 END) AS neg,
             sum(CASE WHEN label = 1 THEN n ELSE 0 END) AS pos FROM c)
SELECT label, CAST(n AS BIGINT) AS n, round(n_all * 1.0 / (k * n), 6) AS weight,
       round(neg * 1.0 / GREATEST(pos, 1), 6) AS scale_pos_weight FROM c, t
""")
def q_class_weights(spark, sf):
    return r6(split.class_weight_table(table(spark, sf, "labels"), "quality"))


# --- 2.6 sorts, limits ------------------------------------------------------------------------


@query("sort_desc", """
SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey
""")
def q_sort_desc(spark, sf):
    return r6(ranking.sort_desc(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                                "o_totalprice", ["o_orderkey"]))


@query("top_k", """
SELECT c_custkey, round(c_acctbal, 6) AS c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 15
""")
def q_top_k(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return r6(ranking.top_k(c, [F.desc("c_acctbal"), F.col("c_custkey")], 15))


@query("sample_first_n", f"""
SELECT o_orderkey, o_custkey FROM {ORDER_SPLIT_SQL} WHERE split = 'test'
ORDER BY {split_hash_sql("CAST(o_orderkey AS VARCHAR)")}, o_orderkey LIMIT 500
""")
def q_sample_first_n(spark, sf):
    test = orders_split(spark, sf).where(F.col("split") == "test").select("o_orderkey", "o_custkey")
    return ranking.sample_first_n(test, ["o_orderkey"], 500)


MODEL_SCORES_SQL = f"""(SELECT 'value' AS model, score, label FROM {EV_SQL}
  UNION ALL SELECT 'user', user_id / 100.0, label FROM {EV_SQL}
  UNION ALL SELECT 'neg_value', 1 - score, label FROM {EV_SQL})"""


def model_scores(spark, sf):
    ev = scored_events(spark, sf)
    return (ev.select(F.lit("value").alias("model"), "score", "label")
            .unionByName(ev.select(F.lit("user").alias("model"), (F.col("user_id") / 100.0).alias("score"), "label"))
            .unionByName(ev.select(F.lit("neg_value").alias("model"), (1 - F.col("score")).alias("score"), "label")))


AUC_BY_MODEL_SQL = f"""
WITH s AS (SELECT model, score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM {MODEL_SCORES_SQL} GROUP BY 1, 2),
c AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS cum_neg,
             sum(pos) OVER (PARTITION BY model) AS tp, sum(neg) OVER (PARTITION BY model) AS tn FROM s),
auc AS (SELECT model, sum(pos * (tn - cum_neg + neg / 2.0)) / (any_value(tp) * any_value(tn)) AS roc_auc FROM c GROUP BY model)
"""


@query("arg_max_model", AUC_BY_MODEL_SQL + """
SELECT arg_max(model, roc_auc) AS model, round(max(roc_auc), 6) AS roc_auc FROM auc
""")
def q_arg_max_model(spark, sf):
    auc = roc_auc(model_scores(spark, sf), "label", "score", by=["model"])
    return r6(ranking.arg_max(auc, "roc_auc", "model"))


@query("roc_auc_by_model", AUC_BY_MODEL_SQL + "SELECT model, round(roc_auc, 6) AS roc_auc FROM auc")
def q_roc_auc_by_model(spark, sf):
    return r6(roc_auc(model_scores(spark, sf), "label", "score", by=["model"]))
