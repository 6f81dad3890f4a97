"""The registered model queries run the reference's settings, and these make real trees."""

import pytest

from cohortix.config import icu
from cohortix.operators import models as mdl
from cohortix.plans import q_models as q
from cohortix.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def test_queries_have_the_reference_settings(spark, monkeypatch):
    assert [s.params for s in q.QUERY_SPECS.values()] == [icu.LOGISTIC, icu.FOREST, icu.BOOSTED]
    for name in ("cv_metrics", "scaling_leakage", "random_search", "tune"):
        monkeypatch.setattr(mdl, name, lambda *a, **k: (*a, *k.values()))
    assert q.q_cv_metrics(spark, SF)[-1].params == icu.BOOSTED
    leakage = q.q_scaling_leakage(spark, SF)[-1]
    assert leakage.kind == "boosted" and leakage.params == {
        "n_estimators": 400, "max_depth": 6, "learning_rate": 0.08}
    for made in (q.q_random_search(spark, SF), q.q_tune_boosted(spark, SF)):
        assert icu.SEARCH_GRID in made and icu.SEARCH_ITERATIONS in made


@pytest.mark.parametrize("gamma", [0.1, 0.3])
def test_gamma_of_the_reference_still_splits(spark, gamma):
    train = q.model_frame(spark, SF).where("split = 'train'")
    spec = mdl.ModelSpec("GBT", "boosted", {**icu.BOOSTED, "n_estimators": 3, "gamma": gamma})
    start = mdl.fit(train, q.LI_NUM, q.LABEL, spec).trees.start
    assert len(start) == 4 and (start[1:] - start[:-1] > 1).all()


def test_queries_end(spark):
    """The registered fits with all rounds and trees, on the smallest table."""
    for fn in (QUERIES["fit_boosted"], QUERIES["fit_forest"], q.q_cv_metrics, q.q_feature_importance):
        assert fn(spark, SF).count() > 0


def test_review_fits_side_by_side(spark, monkeypatch):
    """The compared models, the folds and the leakage check wait for one another: none is fitted after another."""
    import threading

    from cohortix.operators.split import group_split
    from cohortix.plans.train import train_review

    meet = threading.Barrier(3)
    for name in ("fit_all", "cv_metrics", "scaling_leakage"):
        plain = getattr(mdl, name)
        monkeypatch.setattr(mdl, name, lambda *a, plain=plain, **k: (meet.wait(60), plain(*a, **k))[1])
    rows = [(i, float(i % 13), float(i * 7 % 31), int(i * 5 % 13 > 6)) for i in range(400)]
    df = group_split(spark.createDataFrame(rows, "id long, a double, b double, y int"), ["id"])
    rep = train_review(df, ["y"], ["a", "b"], [mdl.ModelSpec("GBT", "boosted", {"n_estimators": 3})], {"y": 0.5}, ["id"],
                       {"y": (0.5, "ABOVE", "BELOW")}, 3, shap_rows=20)
    assert rep.cv.first()["n"] == 3 and rep.leakage.first()["verdict"] == "OK"
    assert rep.test_metrics.count() == 1


def test_tuned_folds_beside_the_refit(spark, monkeypatch):
    import threading

    from cohortix.operators.split import group_split, hash_kfold

    meet = threading.Barrier(2)
    for name in ("fit_all", "cv_metrics"):
        plain = getattr(mdl, name)
        monkeypatch.setattr(mdl, name, lambda *a, plain=plain, **k: (meet.wait(60), plain(*a, **k))[1])
    rows = [(i, float(i % 13), float(i * 7 % 31), int(i * 5 % 13 > 6)) for i in range(400)]
    df = hash_kfold(group_split(spark.createDataFrame(rows, "id long, a double, b double, y int"), ["id"]), ["id"], 3)
    row = mdl.tune(df, ["a", "b"], "y", "split", "fold", "boosted", {"n_estimators": [2, 3], "max_depth": [2]}, 2, 0.5,
                   mdl.ModelSpec("LR", "logistic", icu.LOGISTIC)).first()
    assert row["n"] == df.where("split = 'test'").count() and 0 <= row["cv_roc_auc"] <= 1
