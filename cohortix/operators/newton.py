"""Logistic regression by Newton steps, many models a pass, each with a certificate.

Minimises  sum_i w_i log(1 + exp(-s_i m_i)) + |b|^2 / (2 C)  over standardised
features with a free intercept (the objective of the original's solver;
class weights balanced). A model may leave out the rows of one fold: its
means and deviations come from the same aggregate, as the sums over all folds
less its own.

A step is one aggregation over the rows for all models: each task adds up
their gradients and Hessians as matrices in numpy and hands on one number per
entry, and Spark sums the entries; the driver solves one small system per
model. Steps are halved where they would raise the loss. A model returns its
last gradient's largest entry: below a tolerance it proves the optimum, as the
objective is strictly convex.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.operators.trees import matrix
from cohortix.session import share_package

SCORE = "score"


@dataclass
class Logistic:
    features: list[str]
    mean: np.ndarray
    std: np.ndarray
    coef: np.ndarray       # of the standardised features
    intercept: float
    gradient: float        # largest entry of the objective's gradient, per training row
    steps: int
    rows: int

    def probability(self) -> Column:
        """P(y = 1) as a column expression; null where a feature is."""
        m = F.lit(float(self.intercept))
        for f, mu, sd, b in zip(self.features, self.mean, self.std, self.coef):
            m = m + (F.col(f"`{f}`").cast("double") - F.lit(float(mu))) * F.lit(float(b / sd))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-m))


def save(model: Logistic, spark: SparkSession, path: str) -> None:
    """Write a model as a Parquet table: a row per feature, and one for the intercept."""
    rows = [(-1, "", 0.0, 1.0, float(model.intercept), float(model.gradient), model.steps, model.rows)] + [
        (i, f, float(m), float(s), float(b), 0.0, 0, 0)
        for i, (f, m, s, b) in enumerate(zip(model.features, model.mean, model.std, model.coef))]
    spark.createDataFrame(rows, "place int, feature string, mean double, std double, coef double, gradient double, "
                                "steps int, n_rows long").write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Logistic:
    head, *rest = spark.read.parquet(path).orderBy("place").collect()
    return Logistic([r["feature"] for r in rest], *(np.array([r[c] for r in rest]) for c in ("mean", "std", "coef")),
                    head["coef"], head["gradient"], head["steps"], head["n_rows"])


def score(model: Logistic, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and ``score``, without leaving the JVM."""
    return df.select(*keep, model.probability().alias(SCORE))


def score_by(models: Mapping[int, Logistic], df: DataFrame, by: str, keep: Sequence[str]) -> DataFrame:
    """Each row scored by the model of its value in ``by`` (null where there is none)."""
    out = None
    for k, m in models.items():
        hit = F.col(by) == F.lit(k)
        out = F.when(hit, m.probability()) if out is None else out.when(hit, m.probability())
    return df.select(*keep, (F.lit(None).cast("double") if out is None else out).alias(SCORE))


def _moments(df: DataFrame, features: Sequence[str], y: Column, fold: Column):
    """Per fold and class: rows, and shifted sums of the features, from one aggregate."""
    first = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")) for c in features]).first() if features else []
    shift = np.array([v if v is not None else 0.0 for v in first], float)
    cols = [(F.col(f"`{c}`").cast("double") - F.lit(float(s))) for c, s in zip(features, shift)]
    got = df.groupBy(fold.alias("f"), y.alias("y")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)],
        *[F.sum(c * c).alias(f"q{i}") for i, c in enumerate(cols)]).collect()
    p = len(features)
    return shift, [(r["f"], r["y"], r["n"], np.array([r[f"s{i}"] for i in range(p)], float),
                    np.array([r[f"q{i}"] for i in range(p)], float)) for r in got]


def fit(df: DataFrame, features: Sequence[str], label: str, leave_out: Sequence[int | None] = (None,),
        fold: str | None = None, c: float = 1.0, max_iter: int = 100, tolerance: float = 1e-10,
        balanced: bool = True) -> list[Logistic]:
    """A model for each entry of ``leave_out`` (None: all rows), in at most ``max_iter`` passes.

    Rows with a null label or feature are left out. Without rows of both
    classes a model is its intercept at zero. ``df`` is read once a step: persist it.
    """
    share_package(df.sparkSession)
    x = df.where(F.col(label).isNotNull())
    for f in features:
        x = x.where(F.col(f"`{f}`").isNotNull())
    y, at = F.col(label).cast("int"), F.col(fold).cast("int") if fold else F.lit(0)
    shift, parts = _moments(x, features, y, at)
    p, models = len(features), []
    weights = []
    for out in leave_out:
        mine = [m for m in parts if out is None or m[0] != out]
        n = sum(m[2] for m in mine)
        pos = sum(m[2] for m in mine if m[1] == 1)
        s, q = (sum((m[i] for m in mine), np.zeros(p)) for i in (3, 4))
        mean = s / max(n, 1)
        std = np.sqrt(np.maximum(q / max(n, 1) - mean * mean, 0.0))
        std[std <= 1e-12 * np.maximum(np.abs(mean + shift), 1.0)] = 1.0
        models.append(Logistic(list(features), mean + shift, std, np.zeros(p), 0.0, 0.0, 0, n))
        weights.append((n / (2 * max(n - pos, 1)), n / (2 * max(pos, 1))) if balanced else (1.0, 1.0))
    names = [f"f{i}" for i in range(p)]
    rows = x.select(*[F.col(f"`{f}`").cast("double").alias(n) for f, n in zip(features, names)],
                    y.alias("y"), at.alias("fold"))
    todo = [i for i, m in enumerate(models) if m.rows and 0 < sum(
        r[2] for r in parts if r[1] == 1 and (leave_out[i] is None or r[0] != leave_out[i])) < m.rows]
    tried = {i: np.zeros(p + 1) for i in todo}
    best: dict[int, tuple] = {}
    for step in range(max_iter):
        if not todo:
            break
        got = _sums(rows, names, {i: (leave_out[i], models[i].mean, models[i].std, weights[i], tried[i]) for i in todo})
        for i in list(todo):
            loss, grad, hess = got[i]
            b = tried[i]
            ridge = np.append(0.0, np.full(p, 1.0 / c))
            loss += 0.5 * float((ridge * b * b).sum())
            grad = grad + ridge * b
            hess = hess + np.diag(ridge)
            m = models[i]
            if i in best and loss > best[i][0] + 1e-9 * abs(best[i][0]):
                tried[i] = (best[i][1] + b) / 2  # too far: half the way back
                continue
            norm = float(np.abs(grad).max()) / m.rows
            best[i] = (loss, b)
            m.coef, m.intercept, m.gradient, m.steps = b[1:], float(b[0]), norm, step
            if norm <= tolerance:
                todo.remove(i)
            else:
                tried[i] = b - np.linalg.lstsq(hess, grad, rcond=None)[0]
    return models


def _sums(rows: DataFrame, names: list[str], asked: dict) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Loss, gradient and Hessian of every asked model over all rows, in one aggregation."""
    p = len(names) + 1

    def run(batches):
        total = {i: np.zeros(1 + p + p * p) for i in asked}
        for b in batches:
            x = matrix(b, names)
            y = b.column("y").to_numpy(zero_copy_only=False)
            fold = b.column("fold").to_numpy(zero_copy_only=False)
            for i, (out, mean, std, (w0, w1), beta) in asked.items():
                mine = slice(None) if out is None else fold != out
                z = np.column_stack([np.ones(len(y[mine])), (x[mine] - mean) / std])
                t = y[mine] > 0
                w = np.where(t, w1, w0)
                m = z @ beta
                prob = 1.0 / (1.0 + np.exp(-m))
                total[i][0] += float((w * np.logaddexp(0.0, np.where(t, -m, m))).sum())
                total[i][1:1 + p] += z.T @ (w * (prob - t))
                total[i][1 + p:] += ((z * (w * prob * (1 - prob))[:, None]).T @ z).ravel()
        for i, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(v), pa.int32()), pa.array(np.arange(len(v)), pa.int32()),
                                              pa.array(v)], names=["i", "k", "v"])

    got = rows.mapInArrow(run, "i int, k int, v double").groupBy("i", "k").agg(F.sum("v").alias("v")).collect()
    out = {i: np.zeros(1 + p + p * p) for i in asked}
    for r in got:
        out[r["i"]][r["k"]] = r["v"]
    return {i: (float(v[0]), v[1:1 + p], v[1 + p:].reshape(p, p)) for i, v in out.items()}
