"""All rows are fitted, in memory and where the rows are: the same cuts, trees and scores."""

import os
import tempfile

import numpy as np
import pytest

from cohortix.operators import models, steps, trees
from cohortix.operators.trees import Fit
from tests.test_trees import BOOSTED, FEATURES, FOREST, same, table


@pytest.fixture
def large(monkeypatch):
    """No table fits in memory, and blocks, buckets and brackets are small."""
    for module, name, value in ((trees, "MEMORY_BYTES", 0), (steps, "COARSE", 64), (steps, "FINE", 4), (steps, "FEW", 300)):
        monkeypatch.setattr(module, name, value)


def wide(spark, n):
    """More labelled rows than the 200,000 that fits were once cut to."""
    from pyspark.sql import functions as F

    a = F.pmod(F.xxhash64("id"), F.lit(1009)).cast("double")
    b = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 20)) / 7.0
    return spark.range(n).select("id", a.alias("a"), b.alias("b"), F.pmod("id", F.lit(3)).cast("int").alias("fold"),
                                 (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1300)) < a).cast("int").alias("y"))


def test_a_search_fits_and_scores_all_rows(spark, monkeypatch):
    n, seen = 210_000, []
    plain = trees.fit_rows_of
    monkeypatch.setattr(trees, "fit_rows_of", lambda *a: (seen.append(plain(*a)), seen[-1])[1])
    grid = {"n_estimators": [2], "max_depth": [2, 3]}
    board = models.random_search(wide(spark, n), ["a", "b"], "y", "fold", "boosted", grid, 2)
    assert [len(s[1]) for s in seen] == [n]
    few = {r["candidate"]: r["mean_auc"] for r in board.collect()}
    monkeypatch.setattr(trees, "MEMORY_BYTES", 0)
    again = models.random_search(wide(spark, n), ["a", "b"], "y", "fold", "boosted", grid, 2)
    assert {r["candidate"]: r["mean_auc"] for r in again.collect()} == pytest.approx(few, abs=1e-12)
    assert len(seen) == 1


def test_cuts_are_quantiles_of_all_rows(spark, large):
    rng = np.random.default_rng(5)
    n = 3000
    x = np.stack([rng.normal(size=n), np.round(rng.lognormal(0, 4, n), 2), rng.integers(-3, 3, n) * 0.5,
                  np.where(rng.random(n) < 0.4, 7.25, rng.normal(size=n) * 1e-300)], axis=1)
    x[::17, 1], x[5, 0], x[6, 0] = np.nan, -np.inf, np.inf
    x[x == 0] = -0.0
    fold = rng.integers(0, 3, n)
    rows = [(*[None if np.isnan(v) else float(v) for v in r], int(f)) for r, f in zip(x, fold)]
    df = spark.createDataFrame(rows, "f0 double, f1 double, f2 double, f3 double, fold int").repartition(5)
    got = steps.cuts_of(df, 4, [None, 0, 2])
    for s in got:
        with np.errstate(invalid="ignore"):
            want = trees.bin_cuts(x if s is None else x[fold != s])
        assert all(np.array_equal(a, b) for a, b in zip(got[s], want))


@pytest.mark.parametrize("state,driver", [(1 << 30, 0), (1, 1 << 20), (1 << 30, 1 << 20)])
def test_folds_where_rows_are(spark, large, monkeypatch, state, driver):
    """Fits of all folds step together, or, where the disk has no room, one after another; cells are
    added up by the driver or, where they are many, by tasks."""
    monkeypatch.setattr(steps, "DRIVER_BYTES", driver)
    df = table(spark)
    fits = [Fit("boosted", dict(BOOSTED, max_depth=d, n_estimators=3 + d), f) for d, f in ((2, 0), (4, 1), (3, None), (0, 2))]
    monkeypatch.setattr(trees, "MEMORY_BYTES", 1 << 30)
    want = trees.fit_many(df, FEATURES, "y", fits, "fold")
    monkeypatch.setattr(trees, "MEMORY_BYTES", 0)
    monkeypatch.setattr(steps, "STATE_BYTES", state)
    assert len(steps.waves(fits, 700, 5)) == (1 if state > 1 else 4)
    got = trees.fit_many(df, FEATURES, "y", fits, "fold")
    for a, b in zip(want, got):
        assert same(a, b) and a.rows == b.rows and all(np.array_equal(u, v) for u, v in zip(a.cuts, b.cuts))
    assert not [f for f in os.listdir(tempfile.gettempdir()) if f.startswith("cohortix-") and "ckpt" not in f]


def test_a_lost_scratch_file_is_made_again(spark, large, monkeypatch):
    import shutil

    df, plain, asked = table(spark), steps._level, []

    def losing(*a):
        asked.append(a[-1] is not None)
        if len(asked) % 7 == 0:
            shutil.rmtree(steps.scratch_folder(a[7]), ignore_errors=True)
        return plain(*a)

    fit = Fit("boosted", BOOSTED)
    want = trees.fit_distributed(df, FEATURES, "y", fit)
    monkeypatch.setattr(steps, "_level", losing)
    got = trees.fit_distributed(df, FEATURES, "y", fit)
    assert same(want, got) and any(asked)


@pytest.mark.parametrize("local", [1 << 20, 150, 5])
def test_forests_where_rows_are(spark, large, monkeypatch, local):
    """Levels of large nodes, then what is below them in one task: the trees of one worker."""
    df = table(spark)
    fits = [Fit("forest", dict(FOREST, max_depth=d, num_trees=3), f) for d, f in ((1, None), (7, 1))]
    monkeypatch.setattr(trees, "MEMORY_BYTES", 1 << 30)
    want = trees.fit_many(df, FEATURES, "y", fits, "fold")
    monkeypatch.setattr(trees, "MEMORY_BYTES", 0)
    monkeypatch.setattr(steps, "LOCAL_ROWS", local)
    got = trees.fit_many(df, FEATURES, "y", fits, "fold")
    assert all(same(a, b) for a, b in zip(want, got)) and want[1].trees.start[-1] > 60


def test_folds_are_fitted_and_scored_whole(spark, monkeypatch):
    """No row is left out of the fits, and neither fits nor scores run the folds' join again."""
    from pyspark.sql import functions as F

    from cohortix.operators import split

    n, seen, rows = 210_000, [], spark.sparkContext.accumulator(0)
    plain = trees.fit_rows_of
    monkeypatch.setattr(trees, "fit_rows_of", lambda *a: (seen.append(plain(*a)), seen[-1])[1])

    def count(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    df = wide(spark, n).drop("fold")
    df = split.group_kfold(df.withColumn("id", F.col("id") % 5003).mapInArrow(count, df.schema), ["id"], 3)
    spec = models.ModelSpec("GBT", "boosted", {"n_estimators": 2, "max_depth": 3})
    want = models.cv_metrics(df, ["a", "b"], "y", "fold", spec).orderBy("fold").collect()
    assert [len(s[1]) for s in seen] == [n] == [sum(r["n"] for r in want)] and rows.value == 2 * n
    monkeypatch.setattr(trees, "MEMORY_BYTES", 0)
    got = models.cv_metrics(df, ["a", "b"], "y", "fold", spec).orderBy("fold").collect()
    assert rows.value == 3 * n and len(seen) == 1
    for a, b in zip(want, got):
        assert a.asDict() == pytest.approx(b.asDict(), abs=1e-12)


def test_tuning_fits_all_rows(spark, monkeypatch, tmp_path):
    """The search, the folds of the tuned model and its refit: none reads a part of the rows."""
    from pyspark.sql import functions as F

    n, seen = 260_000, []
    plain = trees.fit_rows_of
    monkeypatch.setattr(trees, "fit_rows_of", lambda *a: (seen.append(plain(*a)), seen[-1])[1])
    split = F.when(F.col("id") % 26 < 5, "test").otherwise("train")
    row = models.tune(wide(spark, n).withColumn("split", split), ["a", "b"], "y", "split", "fold", "boosted",
                      {"n_estimators": [2], "max_depth": [3]}, 1, 0.5, models.ModelSpec("LR", "logistic", {}),
                      str(tmp_path / "m")).first()
    assert [len(s[1]) for s in seen] == [210_000] * 3 and row["n"] == 50_000
    assert trees.load(spark, str(tmp_path / "m")).rows == 210_000


def test_a_review_fits_all_rows(spark, monkeypatch):
    """Compared models, folds and both variants of the leakage check, in memory and where rows are."""
    from pyspark.sql import functions as F

    from cohortix.plans.train import train_review

    n, plain, seen, made = 260_000, trees.fit_rows_of, [], []
    monkeypatch.setattr(trees, "fit_rows_of", lambda *a: (seen.append(plain(*a)), seen[-1])[1])
    fit_all = steps.fit_all
    monkeypatch.setattr(steps, "fit_all", lambda *a: (made.append(fit_all(*a)), made[-1])[1])
    df = wide(spark, n).withColumn("split", F.when(F.col("id") % 26 < 5, "test").otherwise("train")).drop("fold")
    specs = [models.ModelSpec("RF", "forest", {"num_trees": 2, "max_depth": 4}),
             models.ModelSpec("GBT", "boosted", {"n_estimators": 2, "max_depth": 3})]

    def review():
        rep = train_review(df, ["y"], ["a", "b"], specs, {"y": 0.5}, ["id"], {"y": (0.5, "ABOVE", "BELOW")}, 3, shap_rows=20)
        return [[tuple(r) for r in t.orderBy(*t.columns[:3]).collect()] for t in (
            rep.test_metrics, rep.importances, rep.calibration, rep.cv, rep.leakage, rep.class_report, rep.shap)]

    one = review()
    assert [len(s[1]) for s in seen] == [210_000] * 4 and not made
    monkeypatch.setattr(trees, "MEMORY_BYTES", 0)
    two = review()
    assert len(seen) == 4 and sorted(m.rows for f in made for m in f) == [140_000] * 3 + [210_000] * 4
    for a, b in zip(one, two):
        for r, t in zip(a, b, strict=True):
            assert [v for v in r if not isinstance(v, float)] == [v for v in t if not isinstance(v, float)]
            assert [v for v in r if isinstance(v, float)] == pytest.approx([v for v in t if isinstance(v, float)], abs=1e-9)


def test_states_beside_each_other_are_bounded(monkeypatch):
    """Fits of several threads share STATE_BYTES; one that needs more waits until it is alone."""
    import threading
    import time

    monkeypatch.setattr(steps, "STATE_BYTES", 100)
    now, most, alone = [], [], []

    def fit(n):
        with steps.room(n):
            now.append(n)
            most.append(sum(now))
            time.sleep(0.05)
            alone.append(n <= 100 or now == [n])
            now.remove(n)

    threads = [threading.Thread(target=fit, args=(n,)) for n in (60, 50, 40, 300, 30, 70)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(30)
    assert len(alone) == 6 and all(alone) and sorted(most)[-1] == 300 and sorted(most)[-2] <= 100


def test_kept_rows_take_only_their_columns_and_are_dropped(spark, monkeypatch):
    """What a join made is one table of the columns in use, gone after the last pass; a frame too large
    for memory is read where it is, not persisted."""
    import glob

    from cohortix.operators import split
    from cohortix.session import ensure_checkpoint_dir

    df = table(spark)
    folds = split.group_kfold(df.drop("fold"), ["id"], 3)
    out, drop = models.kept(folds, ["a", "y", "fold"])
    at = glob.glob(ensure_checkpoint_dir(spark).removeprefix("file:") + "/kept-*")
    assert out.columns == ["a", "y", "fold"] and out.count() == df.count() and len(at) == 1 and not out.is_cached
    drop()
    assert not os.path.exists(at[0])
    monkeypatch.setattr(trees, "MEMORY_BYTES", 0)
    out, drop = models.kept(spark.range(100).withColumn("a", models.F.lit(1.0)), ["a"])
    drop()
    assert out.columns == ["a"] and not out.is_cached and out.count() == 100
