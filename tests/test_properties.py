"""Property-based checks on generated inputs (few examples: each is a Spark job)."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortix.operators import clean, cumulative, metrics

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

scores = st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.7, 1.0])),
                  min_size=2, max_size=60).filter(lambda r: len({y for y, _ in r}) == 2)


def _brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))


@SETTINGS
@given(rows=scores)
def test_auc_brute_force_and_symmetry(spark, rows):
    df = spark.createDataFrame(rows, "y int, s double")
    auc = metrics.roc_auc(df, "y", "s").first()[0]
    assert auc == pytest.approx(_brute_auc(rows), abs=1e-12)
    flipped = spark.createDataFrame([(y, -s) for y, s in rows], "y int, s double")
    assert metrics.roc_auc(flipped, "y", "s").first()[0] == pytest.approx(1 - auc, abs=1e-12)


@SETTINGS
@given(xs=st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=40),
       lo=st.floats(-100, 0), width=st.floats(0, 200))
def test_winsorize_idempotent_and_bounded(spark, xs, lo, width):
    hi = lo + width
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    once = clean.winsorize(df, {"x": (lo, hi)})
    twice = clean.winsorize(once, {"x": (lo, hi)})
    a, b = [r[0] for r in once.collect()], [r[0] for r in twice.collect()]
    assert a == b
    assert all((v is None) == (x is None) for v, x in zip(a, xs))
    assert all(lo <= v <= hi for v in a if v is not None)


@SETTINGS
@given(xs=st.lists(st.integers(-50, 50), min_size=1, max_size=80),
       p=st.sampled_from([0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]))
def test_exact_quantile_matches_numpy(spark, xs, p):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = cumulative.quantile_table(df, ["x"], [p])["x"][0]
    assert got == pytest.approx(float(np.quantile(np.array(xs, dtype=float), p)), abs=1e-9)
