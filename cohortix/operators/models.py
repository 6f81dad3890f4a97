"""Model fitting, tuning and comparison.

Design:
* logistic regression is fitted by ``operators.newton`` where models are compared
  or cross-validated: all folds step together and each model certifies its
  optimum. :func:`fit` makes a ``pyspark.ml`` pipeline, which can be saved and
  runs on streams; its scaling is fitted on the training rows only (one
  aggregate) and frozen into a ``SQLTransformer`` with the means / population
  stds as literals (``ml.feature.StandardScaler`` divides by the *sample* std).
  Its class weights are a column (``weightCol``);
* boosted models and forests are those of ``operators.trees``: all fits of a
  fold loop, a comparison or a search go on together, on all labelled rows (only
  a caller that gives ``fit_rows`` has about so many of them), and all are scored.
  Trees do not change if a feature is scaled, so they take features as they
  are; class weights follow from the fitted rows;
* every evaluation scores all folds / models first and computes the metrics
  in one job keyed by ``fold`` / ``model`` (see ``operators.metrics``).
"""

from __future__ import annotations

import json
import random
import statistics
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortix.operators import metrics as M
from cohortix.operators import newton as N
from cohortix.operators import trees as T
from cohortix.operators.cumulative import has_shuffle
from cohortix.operators.trees import Fit, TreeModel
from cohortix.session import drop_stored, stored

SCORE = "score"
WEIGHT = "weight"
MAX_CLASSES = 10_000


def kept(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, Callable[[], object]]:
    """``cols`` of a frame that several passes read, and what to call after the last of them.

    What comes out of a shuffle is written once, compressed, to the shared
    folder, so that no join runs again. Any other frame is read where it is;
    if it is small it is dealt to all cores and persisted.
    """
    src = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(cols)])
    if has_shuffle(df):
        out, path = stored(src)
        return out, lambda: drop_stored(df.sparkSession, path)
    if df.is_cached or src.count() * 8 * len(src.columns) > T.MEMORY_BYTES:
        return src, lambda: None
    out = src.repartition(df.sparkSession.sparkContext.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
    return out, out.unpersist


def _q(c: str) -> str:
    return f"`{c}`"


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> SQLTransformer:
    """(x - mean) / std_pop fitted on ``train``; zero variance gives x - mean."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m{len(aggs)}"), F.stddev_pop(c).alias(f"s{len(aggs) + 1}")]
    row = train.agg(*aggs).first()
    exprs = []
    for i, c in enumerate(cols):
        m, s = row[2 * i], row[2 * i + 1]
        m = 0.0 if m is None else float(m)
        s = 0.0 if s is None else float(s)
        body = f"({_q(c)} - {m!r})" if s == 0 else f"({_q(c)} - {m!r}) / {s!r}"
        exprs.append(f"CAST({body} AS DOUBLE) AS {_q(c + '__z')}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def scaled_names(cols: Sequence[str]) -> list[str]:
    return [c + "__z" for c in cols]


def with_balanced_weight(df: DataFrame, label: str, train: DataFrame | None = None) -> DataFrame:
    """``weight = n / (k * n_c)`` from the class counts of ``train``.

    The counts (one per class, bounded by the label's cardinality) are read
    once and applied as literals, so iterative learners that scan the frame
    many times do not re-run the count.
    """
    src = train if train is not None else df
    rows = src.groupBy(label).agg(F.count(F.lit(1))).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes; not a class label")
    counts = {r[0]: int(r[1]) for r in rows}
    n, k = sum(counts.values()), len(counts)
    expr = None
    for cls, nc in counts.items():
        if cls is None:
            continue
        w = F.lit(n / (k * nc))
        expr = F.when(F.col(label) == F.lit(cls), w) if expr is None else expr.when(F.col(label) == F.lit(cls), w)
    return df.withColumn(WEIGHT, expr if expr is not None else F.lit(None).cast("double"))


def with_pos_weight(df: DataFrame, label: str, train: DataFrame | None = None) -> DataFrame:
    """``weight = neg / max(pos, 1)`` on positives, 1 on negatives (scale_pos_weight)."""
    src = train if train is not None else df
    r = src.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")).first()
    spw = r["neg"] / max(r["pos"], 1)
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, F.lit(float(spw))).otherwise(F.lit(1.0)))


@dataclass
class ModelSpec:
    name: str
    kind: str  # logistic | forest | boosted
    params: Mapping


def estimator(spec: ModelSpec, label: str, n_train: float | None = None) -> LogisticRegression:
    p = dict(spec.params)
    c = float(p.get("C", 1.0))
    # sklearn minimises sum_i w_i loss_i + ||b||^2 / (2C); Spark the weighted
    # mean loss + regParam ||b||^2 / 2: regParam = 1 / (C * sum w), sum w = n
    reg = 1.0 / (c * max(n_train or 1, 1))
    return LogisticRegression(featuresCol="features", labelCol=label, weightCol=WEIGHT,
                              maxIter=int(p.get("max_iter", 100)), regParam=reg,
                              elasticNetParam=0.0, standardization=False)


Model = PipelineModel | TreeModel | N.Logistic


def is_trees(spec: ModelSpec) -> bool:
    if spec.kind not in ("logistic", "forest", "boosted"):
        raise ValueError(spec.kind)
    return spec.kind != "logistic"


def fit(train: DataFrame, features: Sequence[str], label: str, spec: ModelSpec,
        seed: int = 42, fit_rows: int | None = None) -> PipelineModel | TreeModel:
    """Logistic: scaler (fitted on ``train``) + assembler + estimator as one PipelineModel;
    ``train`` must carry the ``weight`` column. Forest and boosted: a TreeModel, fitted on all
    labelled rows, or on about ``fit_rows`` of them if a caller asks for that."""
    if is_trees(spec):
        one = Fit(spec.kind, spec.params, seed=seed)
        return T.fit_many(train, features, label, [one], fit_rows=fit_rows, seed=seed)[0]
    return _fit_scaled(train, features, label, spec, fit_scaler(train, features))


def _fit_scaled(train: DataFrame, features, label, spec: ModelSpec, scaler: SQLTransformer) -> PipelineModel:
    assembler = VectorAssembler(inputCols=scaled_names(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[scaler, assembler, estimator(spec, label, train.count())]).fit(train)


def score(model: Model, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Columns ``keep`` and ``score`` = P(y = 1)."""
    if isinstance(model, TreeModel):
        return T.score(model, df, keep)
    if isinstance(model, N.Logistic):
        return N.score(model, df, keep)
    out = model.transform(df)
    return out.select(*keep, vector_to_array("probability")[1].alias(SCORE))


def fit_logistic(train: DataFrame, features, label, params=None) -> PipelineModel:
    return fit(train, features, label, ModelSpec("LR", "logistic", params or {"max_iter": 1000, "C": 1.0}))


def fit_forest(train: DataFrame, features, label, params=None) -> TreeModel:
    return fit(train, features, label, ModelSpec("RF", "forest", params or {}))


def fit_boosted(train: DataFrame, features, label, params=None) -> TreeModel:
    return fit(train, features, label, ModelSpec("GBT", "boosted", params or {}))


# --- evaluation -------------------------------------------------------------------------------------


def fit_all(train: DataFrame, features, label, specs: Sequence[ModelSpec], parallelism: int = 3,
            fit_rows: int | None = None, seed: int = 42) -> dict[str, Model]:
    """A model for each spec: the tree models in one job, beside the logistic ones (Newton)."""
    from concurrent.futures import ThreadPoolExecutor

    tree_specs = [s for s in specs if is_trees(s)]
    others = [s for s in specs if not is_trees(s)]
    train, drop = kept(train, [*features, label])
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            made = pool.submit(T.fit_many, train, features, label, [Fit(s.kind, s.params, seed=seed) for s in tree_specs],
                               fit_rows=fit_rows, seed=seed) if tree_specs else None
            rest = [(s.name, pool.submit(_newton, train, features, label, s)) for s in others]
            out = {name: f.result()[0] for name, f in rest}
            if made:
                out |= {s.name: m for s, m in zip(tree_specs, made.result())}
    finally:
        drop()
    return {s.name: out[s.name] for s in specs}


def _newton(df: DataFrame, features, label, spec: ModelSpec, leave_out=(None,), fold=None) -> list[N.Logistic]:
    """Newton steps over a frame that is kept for them."""
    base, drop = kept(df, [*features, label, *([fold] if fold else [])])
    try:
        return N.fit(base, features, label, leave_out, fold, float(spec.params.get("C", 1.0)),
                     int(spec.params.get("max_iter", 100)))
    finally:
        drop()


def score_all(models: Mapping[str, Model], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep``, ``score`` and ``model`` of every row and model."""
    parts = [score(m, df, keep).withColumn("model", F.lit(name)) for name, m in models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def train_and_score(df: DataFrame, features, label, split_col: str, specs: Sequence[ModelSpec],
                    id_cols: Sequence[str], parallelism: int = 3, fit_rows: int | None = None) -> DataFrame:
    """Fit each spec on ``split == 'train'`` and score ``split == 'test'``.

    Returns ``(id..., label, score, model)`` for all models (one frame).
    """
    made = fit_all(df.where(F.col(split_col) == "train"), features, label, specs, parallelism, fit_rows)
    return score_all(made, df.where(F.col(split_col) == "test"), [*id_cols, label])


def _folds(df: DataFrame, fold_col: str) -> list:
    return sorted(r[0] for r in df.select(fold_col).distinct().collect())


def cv_metrics(df: DataFrame, features, label, fold_col: str, spec: ModelSpec,
               threshold: float = 0.5, fit_rows: int | None = None, seed: int = 42) -> DataFrame:
    """Per-fold metrics over all rows, each scored by the model fitted without its fold.

    Models of all folds are fitted together (trees: one job; logistic: one
    aggregation a Newton step, means and weights of each fold's training part)
    and score in one pass.
    """
    base, drop = kept(df, [*features, label, fold_col])
    try:
        folds = _folds(base, fold_col)
        if is_trees(spec):
            made = T.fit_many(base, features, label, [Fit(spec.kind, spec.params, f, seed) for f in folds], fold_col,
                              fit_rows, seed)
            scored = T.score(dict(zip(folds, made)), base, [label, fold_col], by=fold_col)
        else:
            made = _newton(base, features, label, spec, folds, fold_col)
            scored = N.score_by(dict(zip(folds, made)), base, fold_col, [label, fold_col])
        return M.evaluate(scored, label, SCORE, threshold, by=[fold_col])  # counts the scores at once
    finally:
        drop()


def draw_params(grid: Mapping[str, Sequence], n_iter: int, seed: int = 42) -> list[dict]:
    """``n_iter`` distinct random points of the grid (without replacement)."""
    keys = list(grid)
    sizes = [len(grid[k]) for k in keys]
    total = 1
    for s in sizes:
        total *= s
    rng = random.Random(seed)
    picks = rng.sample(range(total), min(n_iter, total))
    out = []
    for idx in picks:
        p = {}
        for k, s in zip(keys, sizes):
            p[k] = grid[k][idx % s]
            idx //= s
        out.append(p)
    return out


def random_search(df: DataFrame, features, label, fold_col: str, kind: str,
                  grid: Mapping[str, Sequence], n_iter: int, seed: int = 42,
                  parallelism: int = 4, fit_rows: int | None = None) -> DataFrame:
    """Random search scored by mean fold ROC-AUC: ``(candidate, params, mean_auc,
    std_auc, rank)``.

    Tree models: every (candidate, fold) is fitted on all labelled rows of the
    other folds and scores all of the held-out fold, as a task of one job where
    rows fit in memory (``trees.fit_many``). Logistic: each candidate is a
    :func:`cv_metrics` run, up to ``parallelism`` at once.
    """
    spark = df.sparkSession
    draws = draw_params(grid, n_iter, seed)
    base, drop = kept(df, [*features, label, fold_col])
    try:
        if kind != "logistic":
            folds = _folds(base, fold_col)
            got = T.fit_many(base, features, label, [Fit(kind, p, f, seed) for p in draws for f in folds], fold_col,
                             fit_rows, seed, models=False)
            aucs = [[a for a, _ in got[i * len(folds):(i + 1) * len(folds)] if a is not None]
                    for i in range(len(draws))]
        else:
            from concurrent.futures import ThreadPoolExecutor

            def run(p):
                m = cv_metrics(base, features, label, fold_col, ModelSpec("c", kind, p))
                return [r["roc_auc"] for r in m.select("roc_auc").collect() if r["roc_auc"] is not None]

            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                aucs = list(pool.map(run, draws))
    finally:
        drop()
    rows = [(i, json.dumps(p, sort_keys=True), statistics.fmean(a) if a else 0.0, statistics.pstdev(a) if a else 0.0)
            for i, (p, a) in enumerate(zip(draws, aucs))]
    res = spark.createDataFrame(rows, "candidate int, params string, mean_auc double, std_auc double")
    w = Window.orderBy(F.desc("mean_auc"), "candidate")  # table of n_iter rows
    return res.withColumn("rank", F.row_number().over(w))


def best_params(leaderboard: DataFrame) -> dict:
    """Parameters of the first candidate of :func:`random_search`, as values."""
    return json.loads(leaderboard.where("rank = 1").first()["params"])


def save(model: Model, spark, path: str) -> None:
    """Write a model below ``path``; read back by ``trees.load``, ``newton.load`` or ``PipelineModel.load``."""
    if isinstance(model, TreeModel):
        T.save(model, spark, path)
    elif isinstance(model, N.Logistic):
        N.save(model, spark, path)
    else:
        model.write().overwrite().save(path)


def tune(df: DataFrame, features, label, split_col: str, fold_col: str, kind: str,
         grid: Mapping[str, Sequence], n_iter: int, threshold: float, baseline: ModelSpec,
         path: str | None = None, seed: int = 42, parallelism: int = 4, fit_rows: int | None = None) -> DataFrame:
    """Search on the train folds, refit the best on the train rows, evaluate once on test.

    Returns one row: best params (JSON), mean and std of the folds' ROC-AUC
    and average precision with the tuned model, the test metrics at
    ``threshold``, the baseline's test ROC-AUC and the gain. The tuned model
    is saved to ``path``.
    """
    from concurrent.futures import ThreadPoolExecutor

    base, drop = kept(df, [*features, label, split_col, fold_col])
    try:
        train, test = base.where(F.col(split_col) == "train"), base.where(F.col(split_col) == "test")
        board = random_search(train, features, label, fold_col, kind, grid, n_iter, seed, parallelism, fit_rows)
        spec = ModelSpec("tuned", kind, best_params(board))
        with ThreadPoolExecutor(max_workers=1) as pool:  # the folds beside the refit
            folds = pool.submit(cv_metrics, train, features, label, fold_col, spec, threshold, fit_rows=fit_rows, seed=seed)
            made = fit_all(train, features, label, [spec, ModelSpec("baseline", baseline.kind, baseline.params)],
                           fit_rows=fit_rows, seed=seed)
        cv = folds.result().agg(
            F.avg("roc_auc").alias("cv_roc_auc"), F.stddev_pop("roc_auc").alias("cv_roc_auc_std"),
            F.avg("average_precision").alias("cv_pr_auc"), F.stddev_pop("average_precision").alias("cv_pr_auc_std"))
        if path:
            save(made["tuned"], df.sparkSession, path)
        m = M.evaluate(score_all(made, test, [label]), label, SCORE, threshold, by=["model"])
    finally:
        drop()
    b = m.where("model = 'baseline'").select(F.col("roc_auc").alias("baseline_roc_auc"))
    # three tables of one row each
    out = m.where("model = 'tuned'").crossJoin(F.broadcast(b)).crossJoin(F.broadcast(cv))
    return out.withColumn("gain", F.col("roc_auc") - F.col("baseline_roc_auc")).withColumn(
        "params", F.lit(json.dumps(spec.params, sort_keys=True)))


def feature_importance(model: TreeModel, spark, top: int | None = None) -> DataFrame:
    """Gain importances of a tree model, sorted, optionally top ``top``."""
    return T.importance(model, spark, top)


def run_compare(baseline: DataFrame, new: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Join baseline and new metric tables; gain = new - baseline."""
    b = baseline.select(*keys, F.col(value).alias("baseline"))
    n = new.select(*keys, F.col(value).alias("new"))
    return b.join(n, list(keys), "inner").withColumn("gain", F.col("new") - F.col("baseline"))


def scaling_leakage(df: DataFrame, features, label, split_col: str, spec: ModelSpec,
                    tolerance: float = 0.005, fit_rows: int | None = None) -> DataFrame:
    """Test AUC with the scaler fitted on train only vs on all rows."""
    from concurrent.futures import ThreadPoolExecutor

    base, drop = kept(df, [*features, label, split_col])
    train, test = base.where(F.col(split_col) == "train"), base.where(F.col(split_col) == "test")

    def variant(item) -> DataFrame:
        name, src = item
        scaler = fit_scaler(src, features)
        if is_trees(spec):
            model = fit(scaler.transform(train), scaled_names(features), label, spec, fit_rows=fit_rows)
            part = score(model, scaler.transform(test), [label])
        else:
            model = _fit_scaled(with_balanced_weight(train, label), features, label, spec, scaler)
            part = score(model, test, [label])
        return part.withColumn("variant", F.lit(name))

    try:
        with ThreadPoolExecutor(max_workers=2) as pool:
            # "leaky" scales by all rows: what the comparison is about
            one, two = pool.map(variant, (("correct", train), ("leaky", base)))
        auc = M.roc_auc(one.unionByName(two), label, SCORE, by=["variant"])
    finally:
        drop()
    piv = auc.groupBy().pivot("variant", ["correct", "leaky"]).agg(F.first("roc_auc"))
    return piv.select(
        F.col("correct").alias("auc_correct"), F.col("leaky").alias("auc_leaky"),
        (F.col("leaky") - F.col("correct")).alias("diff"),
    ).withColumn("verdict", F.when(F.abs("diff") < tolerance, "OK").otherwise("WARNING"))


def external_score(model: Model, external: DataFrame, features, label: str,
                   threshold: float) -> DataFrame:
    """Score another cohort with a fitted pipeline; refuse if features are missing."""
    from cohortix.sources.scan import require_columns

    require_columns(external, [*features, label])
    s = score(model, external, [label])
    return M.evaluate(s, label, SCORE, threshold)
