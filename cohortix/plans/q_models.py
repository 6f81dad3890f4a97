"""Registered queries: model fits, tuning, comparison, interpretation.

Inputs: lineitem numerics as features, label ``l_returnflag = 'R'``, groups
``l_orderkey`` (md5 split / folds). Fits are not SQL-expressible, so these are
rows-only checks; their metric code is the SQL-checked one in ``q_metrics``.

The models and the search have the settings of the ICU configuration
(``config.icu``: 300 trees, 400 boosting rounds, 50 draws x 3 folds). All models
fit on all labelled rows of the train split, and all test rows are scored.
README has measured times.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortix.config import icu
from cohortix.operators import models as mdl
from cohortix.operators import newton
from cohortix.operators.metrics import evaluate
from cohortix.operators.split import group_kfold, group_split
from cohortix.plans.catalog import LI_NUM, lineitem, query, shared_dir, split_hash_sql
from cohortix.sources import scan
from cohortix.sources.sinks import sink_model, sink_table

LABEL = "is_r"
QUERY_SPECS = {
    "LR": mdl.ModelSpec("LR", "logistic", icu.LOGISTIC),
    "RF": mdl.ModelSpec("RF", "forest", icu.FOREST),
    "GBT": mdl.ModelSpec("GBT", "boosted", icu.BOOSTED),
}
#: The original's leakage check names only these settings and leaves the others at their defaults.
LEAKAGE_SPEC = mdl.ModelSpec("GBT", "boosted", {k: icu.BOOSTED[k] for k in (
    "n_estimators", "max_depth", "learning_rate")})


def model_frame(spark, sf):
    li = lineitem(spark, sf).select(
        "l_orderkey", "l_linenumber", *LI_NUM, (F.col("l_returnflag") == "R").cast("int").alias(LABEL))
    return group_split(li, ["l_orderkey"])


def _fit_query(name):
    def fn(spark, sf):
        df = model_frame(spark, sf)
        scored = mdl.train_and_score(df, LI_NUM, LABEL, "split", [QUERY_SPECS[name]], ["l_orderkey", "l_linenumber"])
        return evaluate(scored, LABEL, mdl.SCORE, 0.5, by=["model"])

    fn.__name__ = f"q_fit_{name}"
    return fn


query("fit_logistic")(_fit_query("LR"))
query("fit_forest")(_fit_query("RF"))
query("fit_boosted")(_fit_query("GBT"))


@query("model_compare")
def q_model_compare(spark, sf):
    """Three models scored on the test split, one metric job keyed by model,
    with the gain of each over the logistic baseline."""
    df = model_frame(spark, sf)
    scored = mdl.train_and_score(df, LI_NUM, LABEL, "split", list(QUERY_SPECS.values()),
                                 ["l_orderkey", "l_linenumber"])
    m = evaluate(scored, LABEL, mdl.SCORE, 0.5, by=["model"])
    base = m.where(F.col("model") == "LR").select(F.col("roc_auc").alias("_base"))
    return m.crossJoin(F.broadcast(base)).withColumn("gain_vs_lr", F.col("roc_auc") - F.col("_base")).drop("_base")


@query("cv_metrics")
def q_cv_metrics(spark, sf):
    df = group_kfold(model_frame(spark, sf), ["l_orderkey"], icu.CV_FOLDS)
    return mdl.cv_metrics(df, LI_NUM, LABEL, "fold", QUERY_SPECS["GBT"])


@query("random_search")
def q_random_search(spark, sf):
    df = group_kfold(model_frame(spark, sf).where(F.col("split") == "train"), ["l_orderkey"],
                     icu.SEARCH_FOLDS)
    return mdl.random_search(df, LI_NUM, LABEL, "fold", "boosted", icu.SEARCH_GRID, n_iter=icu.SEARCH_ITERATIONS)


@query("tune_boosted")
def q_tune_boosted(spark, sf):
    """Search, refit, test metrics at 0.3, gain over LR, tuned-model CV with PR-AUC, saved pipeline."""
    df = group_kfold(model_frame(spark, sf), ["l_orderkey"], icu.SEARCH_FOLDS)
    return mdl.tune(df, LI_NUM, LABEL, "split", "fold", "boosted", icu.SEARCH_GRID, icu.SEARCH_ITERATIONS, 0.3,
                    QUERY_SPECS["LR"], shared_dir(spark, "tuned_model"))


@query("feature_importance")
def q_feature_importance(spark, sf):
    train = model_frame(spark, sf).where(F.col("split") == "train")
    made = mdl.fit_all(train, LI_NUM, LABEL, [QUERY_SPECS["RF"], QUERY_SPECS["GBT"]])
    rf, gbt = (mdl.feature_importance(made[m], spark, top).withColumn("model", F.lit(m))
               for m, top in zip(("RF", "GBT"), icu.TOP_IMPORTANCE))
    return rf.unionByName(gbt)


@query("scaling_leakage")
def q_scaling_leakage(spark, sf):
    return mdl.scaling_leakage(model_frame(spark, sf), LI_NUM, LABEL, "split", LEAKAGE_SPEC)


@query("sink_model", f"""
SELECT count(*) AS n_test, count_if(l_returnflag = 'R') AS n_positive, 0::BIGINT AS n_mismatch FROM lineitem
WHERE {split_hash_sql("CAST(l_orderkey AS VARCHAR)")} % 1000000 < 200000
""")
def q_sink_model(spark, sf):
    """Fit, save and load: the reloaded pipeline scores every test row as the fitted one."""
    from pyspark.ml import PipelineModel

    df = model_frame(spark, sf)
    train = mdl.with_balanced_weight(df.where(F.col("split") == "train"), LABEL)
    model = mdl.fit(train, LI_NUM, LABEL, QUERY_SPECS["LR"])
    path = shared_dir(spark, "sink_model")
    sink_model(model, path)
    test = df.where(F.col("split") == "test")
    one = mdl.score(model, test, [LABEL, *LI_NUM]).withColumnRenamed(mdl.SCORE, "_first")
    two = mdl.score(PipelineModel.load(path), one, [LABEL, "_first"])
    return two.agg(F.count(F.lit(1)).alias("n_test"), F.count_if(F.col(LABEL) == 1).alias("n_positive"),
                   F.count_if(F.col("_first") != F.col(mdl.SCORE)).alias("n_mismatch"))


@query("logistic_certificate", f"""
SELECT count(*) AS n_rows, count_if(l_returnflag = 'R') AS n_positive, 4::BIGINT AS n_features, true AS certified
FROM lineitem WHERE {split_hash_sql("CAST(l_orderkey AS VARCHAR)")} % 1000000 >= 200000
""")
def q_logistic_certificate(spark, sf):
    """Newton's fit on the train split: rows, positives, and whether the largest entry of the
    objective's gradient, from a pass of its own over the rows, is below 1e-8 a row."""
    train = model_frame(spark, sf).where(F.col("split") == "train")
    (m,) = newton.fit(train, LI_NUM, LABEL)
    s = newton.score(m, train, [LABEL, *LI_NUM])
    n, pos = (F.count(F.lit(1)), F.count_if(F.col(LABEL) == 1))
    counts = s.agg(n.alias("n"), pos.alias("p"))
    w = F.when(F.col(LABEL) == 1, F.col("n") / (2 * F.col("p"))).otherwise(F.col("n") / (2 * (F.col("n") - F.col("p"))))
    r = w * (F.col(mdl.SCORE) - F.col(LABEL))
    parts = [F.abs(F.sum(r))] + [
        F.abs(F.sum(r * (F.col(c) - F.lit(float(mu))) / F.lit(float(sd))) + F.lit(float(b)))
        for c, mu, sd, b in zip(LI_NUM, m.mean, m.std, m.coef)]
    return s.crossJoin(F.broadcast(counts)).agg(  # one row
        n.alias("n_rows"), pos.alias("n_positive"), F.lit(len(m.features)).cast("bigint").alias("n_features"),
        (F.greatest(*parts) / n < 1e-8).alias("certified"))


@query("external_score")
def q_external_score(spark, sf):
    """A model fitted on lineitem's train rows, applied to a second cohort that is read from its own
    folder if that is there (here the other split, written with further columns); else no rows."""
    df = model_frame(spark, sf)
    model = mdl.fit(df.where(F.col("split") == "train"), LI_NUM, LABEL, QUERY_SPECS["GBT"])
    path = shared_dir(spark, "second_cohort")
    sink_table(df.where(F.col("split") == "test").select(
        F.col("l_orderkey").alias("order_no"), *[F.col(c) for c in LI_NUM], LABEL,
        F.lit("second").alias("site")), path)
    cohort = scan.scan_if_exists(spark, path)
    if cohort is None:  # nothing to validate on: no rows
        return mdl.external_score(model, df.limit(0), LI_NUM, LABEL, icu.PREDICT_THRESHOLDS["readmission"])
    return mdl.external_score(model, cohort, LI_NUM, LABEL, icu.PREDICT_THRESHOLDS["readmission"])


@query("train_review")
def q_train_review(spark, sf):
    """The whole modelling plan: engineered features on lineitem columns in clinical roles, group
    split, the three models with all rounds and trees, and every table of the review in one."""
    from cohortix.plans.q_clean import _ROLE_MAP
    from cohortix.plans.train import prepare, train_review

    li = lineitem(spark, sf).select("l_orderkey", "l_linenumber", *[F.expr(e).cast("double").alias(k)
                                                                   for k, e in _ROLE_MAP.items()],
                                    (F.col("l_returnflag") == "R").cast("int").alias(LABEL))
    flags = ["hypertension", "copd"]  # made from the label's column: they would give it away
    feat, features = prepare(li, ["l_orderkey", "l_linenumber", LABEL, *flags, "comorbidity_count"], ["l_orderkey"])
    rep = train_review(feat, [LABEL], features, list(QUERY_SPECS.values()), {LABEL: 0.5}, ["l_orderkey"],
                       {LABEL: (0.5, "ABOVE CHANCE", "BELOW CHANCE")}, icu.CV_FOLDS,
                       earlier={LABEL: {"chance": 0.5}}, shap_rows=icu.SHAP_ROWS, shap_top=icu.SHAP_TOP)

    def long(table, name, df, *values):
        return df.select(F.lit(table).alias("part"), name.alias("name"), F.inline(F.array(*[
            F.struct(F.lit(v).alias("value_name"), F.col(v).cast("double").alias("value")) for v in values])))

    model = F.col("model")
    parts = [
        long("test_metrics", model, rep.test_metrics, "accuracy", "precision", "recall", "f1", "roc_auc",
             "average_precision", "brier"),
        long("importances", F.concat_ws(":", "model", "feature"), rep.importances, "importance"),
        long("calibration", F.concat_ws(":", "model", "bin"), rep.calibration, "mean_predicted", "fraction_positive"),
        long("cv", F.lit("GBT"), rep.cv, "mean", "std"),
        long("leakage", F.col("verdict"), rep.leakage, "auc_correct", "auc_leaky", "diff"),
        long("benchmark", F.col("status"), rep.benchmark, "roc_auc"),
        long("class_report", F.concat_ws(":", "model", "row"), rep.class_report, "precision", "recall", "f1"),
        long("shap", F.col("feature"), rep.shap, "mean_abs_phi"),
        long("comparison", model, rep.comparison, "roc_auc", "earlier", "gain"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _shap_frame(spark, sf):
    """GBT fitted on the train split; 500 hash-sampled test rows; long-form TreeSHAP values."""
    from cohortix.operators import shap
    from cohortix.operators.ranking import sample_first_n

    df = model_frame(spark, sf)
    model = mdl.fit(df.where(F.col("split") == "train"), LI_NUM, LABEL, QUERY_SPECS["GBT"])
    keys = ["l_orderkey", "l_linenumber", *LI_NUM]
    rows = sample_first_n(df.where(F.col("split") == "test"), keys, icu.SHAP_ROWS)
    # order and line do not name a row: number the 500 sampled ones, and explain them in several tasks
    rows = rows.withColumn("row_id", F.row_number().over(Window.orderBy(*keys))).repartition(8, "row_id")
    return shap.shap_values(rows, model, ["row_id", "l_orderkey", "l_linenumber"])


@query("shap_values")
def q_shap_values(spark, sf):
    return _shap_frame(spark, sf)


@query("shap_additivity", f"""
SELECT least({icu.SHAP_ROWS}, count(*)) AS n_rows, least({icu.SHAP_ROWS}, count(*)) * {len(LI_NUM) + 2} AS n_values,
  true AS additive FROM lineitem WHERE {split_hash_sql("CAST(l_orderkey AS VARCHAR)")} % 1000000 < 200000
""")
def q_shap_additivity(spark, sf):
    """Explained rows and values, and whether each row's attributions and the base add up to its model value."""
    from cohortix.operators import shap

    values = _shap_frame(spark, sf)
    gaps = shap.additivity_gap(values, ["row_id"]).join(
        values.groupBy("row_id").agg(F.count(F.lit(1)).alias("n")), "row_id")
    return gaps.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").cast("bigint").alias("n_values"),
                    (F.max(F.abs("gap")) < 1e-9).alias("additive"))


@query("shap_mean_abs")
def q_shap_mean_abs(spark, sf):
    from cohortix.operators import shap

    return shap.shap_mean_abs(_shap_frame(spark, sf), top=icu.SHAP_TOP)


@query("stream_score")
def q_stream_score(spark, sf):
    """A pipeline fitted on the batch train split scores lineitem arriving as
    a file stream (threshold 0.5 per micro-batch); the sink is read back and
    evaluated with the batch metrics."""
    from cohortix.streaming import stateless as st

    df = model_frame(spark, sf)
    train = mdl.with_balanced_weight(df.where(F.col("split") == "train"), LABEL)
    model = mdl.fit(train, LI_NUM, LABEL, QUERY_SPECS["LR"])
    src = st.read_stream(spark, f"{sf}/lineitem.parquet", lineitem(spark, sf).schema)
    steps = [
        lambda d: d.select("l_orderkey", "l_linenumber", *LI_NUM,
                           (F.col("l_returnflag") == "R").cast("int").alias(LABEL)),
        st.score_step(model, LI_NUM, 0.5, ["l_orderkey", "l_linenumber", LABEL]),
    ]
    base = shared_dir(spark, "stream_score")
    st.write_stream(st.apply_steps(src, steps), f"{base}/out", f"{base}/checkpoint")
    out = spark.read.schema(f"l_orderkey long, l_linenumber int, {LABEL} int, score double, pred int").parquet(
        f"{base}/out")
    return evaluate(out, LABEL, "score", 0.5)
