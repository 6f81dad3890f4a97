"""Tree ensembles equal plain loops, whatever the partitions and the path that fits them."""

import math

import numpy as np
import pytest

from cohortix.operators import metrics, models, trees
from cohortix.operators.trees import ONE, Fit

FEATURES = ["a", "b", "c", "d", "e"]
BOOSTED = {"n_estimators": 6, "max_depth": 4, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.7,
           "reg_alpha": 0.2, "reg_lambda": 1.5, "min_child_weight": 2, "gamma": 0.05}
FOREST = {"num_trees": 4, "max_depth": 6, "min_samples_split": 9, "min_samples_leaf": 3}


def table(spark, n=700, seed=0, parts=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    x[:, 1] = np.round(x[:, 1], 1)
    x[:, 2] = rng.integers(0, 3, n)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + 0.5 * rng.normal(size=n)) > 0.4).astype(int)
    rows = [(i, *map(float, r), int(k) if i % 97 else None, int(i % 3)) for i, (r, k) in enumerate(zip(x, y))]
    for i in range(0, n, 41):
        rows[i] = (*rows[i][:5], None, *rows[i][6:])
    rows += rows[:20]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double, y int, fold int"
                                 ).repartition(parts, "id")


def same(one, two):
    return all(np.array_equal(getattr(one.trees, k), getattr(two.trees, k)) for k in trees.Trees.ARRAYS)


def plain_boosting(x, y, rid, p, seed):
    """Margins by a loop over every node, feature and cut."""
    cuts = trees.bin_cuts(x)
    bins = trees.binned(x, cuts)
    w = np.where(y > 0, (y == 0).sum() / (y == 1).sum(), 1.0)
    margin = np.zeros(len(y))
    soft = lambda g: math.copysign(max(abs(g) - p["reg_alpha"], 0.0), g)
    for turn in range(p["n_estimators"]):
        prob = 1 / (1 + np.exp(-margin))
        drawn = trees.uniform(rid, seed, turn, 0) < p["subsample"]
        g = np.rint(w * (prob - y) * ONE) / ONE
        h = np.maximum(np.rint(w * prob * (1 - prob) * ONE), 1) / ONE
        m = max(1, int(len(bins) * p["colsample_bytree"]))
        cols = sorted(np.argsort(trees.uniform(np.arange(len(bins)), seed, turn, 1), kind="stable")[:m].tolist())

        def power(rows):
            return soft(g[rows].sum()) ** 2 / (h[rows].sum() + p["reg_lambda"])

        def node(rows, depth):
            here = rows & drawn
            best = (0.0, None, None)
            if depth < p["max_depth"]:
                for f in cols:
                    for b in sorted(set(bins[f][here].tolist()))[:-1]:
                        left, right = here & (bins[f] <= b), here & (bins[f] > b)
                        gain = power(left) + power(right) - power(here)
                        if (min(h[left].sum(), h[right].sum()) >= p["min_child_weight"] and gain >= p["gamma"]
                                and gain > 1e-6 and gain > best[0] + 1e-9):
                            best = (gain, f, b)
            if best[1] is None:
                margin[rows] += np.float32(np.float32(-soft(g[here].sum()) / (h[here].sum() + p["reg_lambda"]))
                                           * np.float32(p["learning_rate"]))
                return
            go = bins[best[1]] <= best[2]
            node(rows & go, depth + 1)
            node(rows & ~go, depth + 1)

        node(np.ones(len(y), bool), 0)
    return margin


def test_boosting_equals_a_plain_loop(spark):
    df = table(spark, 250)
    x, y, rid, _ = trees.fit_rows_of(df, FEATURES, "y", None, 10 ** 6, 7)
    assert len(y) == df.where("y is not null").count()
    want = plain_boosting(x, y, rid, BOOSTED, 7)
    model = trees.fit_many(df, FEATURES, "y", [Fit("boosted", BOOSTED, seed=7)])[0]
    got = model.trees.total(trees.binned(x, model.cuts))
    np.testing.assert_allclose(got, want, rtol=0, atol=1e-9)


@pytest.mark.parametrize("kind,params", [("boosted", BOOSTED), ("forest", FOREST)])
def test_same_trees_for_all_partitions_and_paths(spark, kind, params):
    fit = Fit(kind, params, seed=3)
    one = trees.fit_many(table(spark, parts=4), FEATURES, "y", [fit])[0]
    two = trees.fit_many(table(spark, parts=40), FEATURES, "y", [fit])[0]
    assert same(one, two) and one.trees.start[-1] > 20
    small = dict(params, n_estimators=3, num_trees=2)
    made = [trees.fit_distributed(table(spark, parts=n), FEATURES, "y", Fit(kind, small, seed=3), checkpoint_every=2)
            for n in (3, 9)]
    local = trees.fit_many(table(spark), FEATURES, "y", [Fit(kind, small, seed=3)])[0]
    assert same(made[0], made[1]) and same(made[0], local)
    keep = [trees.score(m, table(spark), ["id"]).orderBy("id", "score").collect() for m in (local, made[0])]
    assert keep[0] == keep[1]


def test_forest_rules(spark):
    """Every split node has min_samples_split rows of the bag, every leaf min_samples_leaf; a larger
    minimum makes fewer nodes."""
    df = table(spark)
    x, y, rid, _ = trees.fit_rows_of(df, FEATURES, "y", None, 10 ** 6, 42)
    sizes = {}
    for split in (2, 9, 60):
        params = dict(FOREST, min_samples_split=split, min_samples_leaf=3)
        model = trees.fit_many(df, FEATURES, "y", [Fit("forest", params)])[0]
        bins = trees.binned(x, model.cuts)
        t = model.trees
        w = np.where(y > 0, 1.0, 1.0)
        for i in range(len(t.start) - 1):
            bag = trees.forest_stats(42, i, rid, y, w)[0] > 0
            at = np.zeros(len(y), int)
            while True:  # rows that pass each node
                node = t.start[i] + at
                for k in set(node[bag].tolist()):
                    n = int((node[bag] == k).sum())
                    assert n >= (split if t.feature[k] >= 0 else 3)
                inner = t.feature[node] >= 0
                if not inner.any():
                    break
                f = np.maximum(t.feature[node], 0)
                at = np.where(inner, t.left[node] + (bins[f, np.arange(len(y))] > t.cut[node]), at)
                rows = inner
                if not rows.all():  # leaves have been seen
                    bag = bag & rows
        sizes[split] = t.start[-1]
    assert sizes[2] > sizes[9] > sizes[60]


def test_a_forest_learns(spark):
    df = table(spark, 1500)
    model = trees.fit_many(df, FEATURES, "y", [Fit("forest", dict(FOREST, num_trees=40))])[0]
    auc = metrics.roc_auc(trees.score(model, table(spark, 1500, seed=1), ["y"]).where("y is not null"), "y", "score")
    assert auc.first()["roc_auc"] > 0.85
    imp = model.importances()
    assert imp.sum() == pytest.approx(1) and set(np.argsort(-imp)[:3]) == {0, 1, 2}


def test_folds_and_search_equal_single_fits(spark):
    df = table(spark).where("y is not null")
    spec = models.ModelSpec("GBT", "boosted", BOOSTED)
    got = {r["fold"]: r["roc_auc"] for r in models.cv_metrics(df, FEATURES, "y", "fold", spec).collect()}
    board = models.random_search(df, FEATURES, "y", "fold", "boosted", {k: [v] for k, v in BOOSTED.items()}, 1)
    for f in range(3):
        one = models.fit(df.where(f"fold != {f}"), FEATURES, "y", spec)
        auc = metrics.roc_auc(models.score(one, df.where(f"fold = {f}"), ["y"]), "y", "score").first()["roc_auc"]
        assert got[f] == pytest.approx(auc, abs=1e-12)
    assert board.first()["mean_auc"] == pytest.approx(np.mean(list(got.values())), abs=1e-12)
    many = models.random_search(df, FEATURES, "y", "fold", "forest",
                                {"num_trees": [2, 3], "max_depth": [2, 5], "min_samples_split": [2, 50]}, 5).collect()
    assert sorted(r["rank"] for r in many) == [1, 2, 3, 4, 5] and many[0]["mean_auc"] > 0.6


def test_a_bound_on_the_fitted_rows(spark):
    df = table(spark)
    model = trees.fit_many(df, FEATURES, "y", [Fit("boosted", BOOSTED)], fit_rows=200)[0]
    assert 140 < model.rows < 260
    assert trees.score(model, df, ["id"]).where("score between 0 and 1").count() == df.count()


def test_edges(spark):
    df = table(spark, 60)
    one = df.where("y = 1")
    for kind in ("boosted", "forest"):
        m = models.fit(one, FEATURES, "y", models.ModelSpec("m", kind, {"n_estimators": 3, "num_trees": 3}))
        assert models.score(m, df, ["id", "a"]).columns == ["id", "a", "score"]
        none = models.fit(df.limit(0), FEATURES, "y", models.ModelSpec("m", kind, {"n_estimators": 2, "num_trees": 2}))
        assert none.rows == 0 and models.score(none, df, ["id"]).count() == df.count()
    assert models.score(m, df.limit(0), ["id"]).collect() == []
    with pytest.raises(ValueError):
        models.fit(df, FEATURES, "y", models.ModelSpec("m", "other", {}))


def test_saved_models_score_alike(spark, tmp_path):
    df = table(spark)
    model = trees.fit_many(df, FEATURES, "y", [Fit("boosted", BOOSTED)])[0]
    models.save(model, spark, str(tmp_path / "m"))
    again = trees.load(spark, str(tmp_path / "m"))
    assert same(model, again) and again.params == BOOSTED
    a, b = (trees.score(m, df, ["id"]).orderBy("id", "score").collect() for m in (model, again))
    assert a == b


@pytest.mark.parametrize("depth,weight,part,alpha", [(3, 2, 0.8, 0.2), (6, 0.5, 0.6, 0.0), (12, 0.01, 0.9, 0.1),
                                                     (4, 10 ** 9, 0.8, 0.0)])
def test_counting_the_lesser_child_makes_the_same_trees(spark, depth, weight, part, alpha):
    """Dense cells by difference equal cells of all rows, also where few rows a cell are sorted (depth 12)."""
    x, y, rid, _ = trees.fit_rows_of(table(spark), FEATURES, "y", None, 10 ** 6, 7)
    bins = trees.binned(x, trees.bin_cuts(x))
    params = dict(BOOSTED, max_depth=depth, min_child_weight=weight, subsample=part, reg_alpha=alpha, gamma=0)
    margin = np.sin(np.arange(len(y)))
    grower = trees.Grower(bins)
    for turn in range(3):
        stats = trees.boost_stats(params, 5, turn, rid, y, np.ones(len(y)), margin)
        drawn = stats[0] > 0
        want, leaf = trees.grow(bins[:, drawn], stats[:, drawn], trees.boost_plan(params, 5, 5, turn))
        got, at = grower.grow(stats, trees.boost_plan(params, 5, 5, turn))
        assert want.start[-1] == got.start[-1] and (want.start[-1] > 1) == (weight < 10 ** 9)
        assert all(np.array_equal(getattr(want, k), getattr(got, k)) for k in trees.Trees.ARRAYS)
        assert np.array_equal(at[drawn], leaf) and np.array_equal(at, got.leaves(bins, 0))


def test_a_level_counts_at_most_about_half_of_the_rows(monkeypatch):
    rng = np.random.default_rng(1)
    n, depth, counted, plain = 4000, 6, [], np.bincount
    bins = rng.integers(0, 200, (3, n)).astype(np.uint8)
    y = rng.integers(0, 2, n)
    monkeypatch.setattr(np, "bincount", lambda key, **k: (counted.append(len(key)), plain(key, **k))[1])
    made = trees._boosted(Fit("boosted", {"n_estimators": 1, "max_depth": depth, "min_child_weight": 0.1}), bins, y,
                          np.arange(n))
    assert made.start[-1] > 100
    assert sum(counted) < 2 * 3 * n * (1 + 0.55 * (depth - 1))  # two statistics of three columns


def test_words_of_reachable_leaves_equal_a_walk(spark):
    """Scores by words and by walking are the same digits, for trees of one leaf, up to 64 and more."""
    x, y, rid, _ = trees.fit_rows_of(table(spark), FEATURES, "y", None, 10 ** 6, 7)
    cuts = trees.bin_cuts(x)
    bins = trees.binned(x, cuts)
    made = [trees._boosted(Fit("boosted", dict(BOOSTED, min_child_weight=w, gamma=0, max_depth=d)), bins, y, rid)
            for d, w in ((6, 0.1), (1, 1), (5, 10 ** 9), (12, 0.01))]
    sizes = [int(np.diff(m.start).max()) for m in made]
    assert sizes[0] > 60 and sizes[1:3] == [3, 1] and sizes[3] > 127
    both = trees.Trees.join(made)
    both.value[np.flatnonzero(both.feature < 0)] += 0.25
    many = np.random.default_rng(3).integers(0, 256, (5, 3 * trees.BLOCK + 17)).astype(np.uint8)
    for b in (bins, many, many[:, :1], many[:, :0]):
        want = np.zeros(b.shape[1])
        for t in range(len(both.start) - 1):
            at = np.zeros(b.shape[1], int) + both.start[t]
            while (both.feature[at] >= 0).any():
                f = both.feature[at]
                right = b[np.maximum(f, 0), np.arange(b.shape[1])] > both.cut[at]
                at = np.where(f >= 0, both.start[t] + both.left[at] + right, at)
            want += both.value[at]
        assert np.array_equal(both.total(b), want)
    assert 0 < both.masks(5)[3].sum() < len(both.start) - 1


def test_folds_read_the_table_twice(spark):
    """Once for the groups' sizes, once to be joined with their folds and kept."""
    from cohortix.operators import split

    df = table(spark).where("y is not null")
    n, seen = df.count(), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    folds = split.group_kfold(df.drop("fold").mapInArrow(count, df.drop("fold").schema), ["id"], 3)
    spec = models.ModelSpec("GBT", "boosted", dict(BOOSTED, n_estimators=2))
    assert models.cv_metrics(folds, FEATURES, "y", "fold", spec).agg({"n": "sum"}).first()[0] == n
    assert seen.value == 2 * n
