"""Newton's logistic regression: the optimum is certified, and equals Spark ML's and a plain solver's."""

import numpy as np
import pytest

from cohortix.operators import models, newton
from cohortix.operators.models import ModelSpec


def table(spark, n=900, parts=4):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 4)) * [1, 50, 0.01, 1] + [0, 1e4, 3, 0]
    y = (x[:, 0] + (x[:, 1] - 1e4) / 40 + rng.normal(size=n) > 0.8).astype(int)
    rows = [(i, *map(float, r), 5.0, int(k) if i % 101 else None, i % 3) for i, (r, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double, y int, fold int"
                                 ).repartition(parts, "id")


FEATURES = ["a", "b", "c", "d", "e"]


def gradient(df, m, c=1.0):
    """Largest entry of the objective's gradient, per row, from scratch."""
    pdf = df.where("y is not null").toPandas()
    x, y = pdf[FEATURES].to_numpy(), pdf["y"].to_numpy()
    std = x.std(0)
    std[std == 0] = 1
    z = (x - x.mean(0)) / std
    w = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    r = w * (1 / (1 + np.exp(-(m.intercept + z @ m.coef))) - y)
    return max(np.abs(z.T @ r + m.coef / c).max(), abs(r.sum())) / len(y)


@pytest.mark.parametrize("parts", [1, 13])
def test_certified_optimum(spark, parts):
    df = table(spark, parts=parts)
    (m,) = newton.fit(df, FEATURES, "y")
    assert m.gradient < 1e-10 and gradient(df, m) < 1e-9 and m.steps < 15
    assert m.coef[4] == 0  # a constant column
    ml = models.fit(models.with_balanced_weight(df.where("y is not null"), "y"), FEATURES, "y",
                    ModelSpec("LR", "logistic", {"max_iter": 1000, "C": 1.0}))
    one = {r["id"]: r["score"] for r in newton.score(m, df, ["id"]).collect()}
    two = {r["id"]: r["score"] for r in models.score(ml, df, ["id"]).collect()}
    assert max(abs(one[i] - two[i]) for i in one) < 1e-4


def test_saved_models_score_alike(spark, tmp_path):
    df = table(spark)
    (m,) = newton.fit(df, FEATURES, "y")
    models.save(m, spark, str(tmp_path / "m"))
    again = newton.load(spark, str(tmp_path / "m"))
    assert again.features == m.features and again.rows == m.rows and again.gradient == m.gradient
    rows = [newton.score(x, df, ["id"]).orderBy("id").collect() for x in (m, again)]
    assert rows[0] == rows[1]


def test_folds_equal_single_fits(spark):
    df = table(spark)
    many = newton.fit(df, FEATURES, "y", [0, 1, 2, None], "fold")
    for f, m in enumerate(many[:3]):
        (one,) = newton.fit(df.where(f"fold != {f}"), FEATURES, "y")
        assert one.rows == m.rows and np.allclose(one.coef, m.coef, atol=1e-8) and np.allclose(one.mean, m.mean)
    rows = newton.score_by({f: m for f, m in enumerate(many[:3])}, df, "fold", ["id", "fold"]).collect()
    for f in range(3):
        want = {r["id"]: r["score"] for r in newton.score(many[f], df.where(f"fold = {f}"), ["id"]).collect()}
        assert {r["id"]: r["score"] for r in rows if r["fold"] == f} == want


def test_one_class_and_no_rows(spark):
    df = table(spark)
    for part in (df.where("y = 1"), df.limit(0)):
        (m,) = newton.fit(part, FEATURES, "y")
        assert m.intercept == 0 and not m.coef.any()
        assert newton.score(m, df, ["id"]).where("score = 0.5").count() == df.count()


def test_separable_classes_stay_finite(spark):
    df = spark.createDataFrame([(float(i), int(i > 10)) for i in range(22)], "a double, y int")
    (m,) = newton.fit(df, ["a"], "y", c=100.0)
    assert m.gradient < 1e-10 and np.isfinite(m.coef).all() and m.coef[0] > 1
