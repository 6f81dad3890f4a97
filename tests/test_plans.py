"""Physical-plan properties the scale design relies on."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    return entry.queries()


def test_profile_reads_only_its_columns_in_one_aggregate(spark, qs):
    p = plan(qs["range_violations"](spark, SF))
    assert "l_returnflag" not in p and "l_shipdate" not in p      # pruned at the scan
    assert p.count("Exchange") == 1 and "partial_count" in p       # one map-side combined agg


def test_filters_reach_the_scan(spark, qs):
    p = plan(qs["label_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p


def test_range_filter_on_a_double_reaches_the_scan(spark, qs):
    p = plan(qs["range_filter"](spark, SF))
    assert "LessThan(c_acctbal,0.0)" in p and "GreaterThan(c_acctbal,9000.0)" in p


def test_exact_split_does_not_join_the_table(spark):
    from cohortix.operators.split import group_split_exact
    from cohortix.plans.catalog import lineitem

    p = plan(group_split_exact(lineitem(spark, SF), ["l_orderkey"]))
    assert "SortMergeJoin" not in p and "BroadcastNestedLoopJoin" in p  # with the one-row cut


def test_metrics_read_the_scores_once(spark):
    from cohortix.operators import metrics

    ev = spark.read.parquet(f"{SF}/events.parquet").selectExpr("value / 500 AS s", "CAST(event_type = 'error' AS int) AS y")
    p = plan(metrics.evaluate(ev, "y", "s", 0.5))
    assert p.count("Scan parquet") + p.count("FileScan parquet") == 0  # the counted scores, already checkpointed


def test_splits_and_features_do_not_shuffle(spark, qs):
    from cohortix.operators.split import group_split, hash_kfold
    from cohortix.plans.catalog import lineitem

    li = lineitem(spark, SF)
    assert "Exchange" not in plan(group_split(li, ["l_orderkey"]))
    assert "Exchange" not in plan(hash_kfold(li, ["l_orderkey"], 5))
    for name in ("feat_pf_ratio", "winsorize", "normalize_text", "log1p"):
        assert "Exchange" not in plan(qs[name](spark, SF)), name


def test_dedup_is_partial_aggregation(spark, qs):
    p = plan(qs["dedup_majority"](spark, SF))
    assert "partial_min_by" in p and "partial_mode" in p


def test_no_python_in_row_operators(spark, qs):
    for name in ("dedup_majority", "roc_auc", "impute_median", "normalize_text", "issue_list", "histogram"):
        p = plan(qs[name](spark, SF))
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p, name


def test_running_totals_has_no_single_partition_over_rows(spark):
    from cohortix.operators.metrics import score_cumulative
    from cohortix.plans.catalog import scored_events

    p = plan(score_cumulative(scored_events(spark, SF), "label", "score"))
    # the only window over rows is partitioned by the range-partition id
    assert "Window [sum(pos" in p and "_cx_pid" in p


def scans(p):
    return p.count("FileScan parquet")


def test_correlations_of_many_columns_are_one_scan(spark):
    from cohortix.operators.profile import correlation_matrix

    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    wide = li.select(*[(F.col("l_quantity") * i + F.col("l_tax")).alias(f"x{i}") for i in range(300)])
    p = plan(correlation_matrix(wide, wide.columns))
    assert scans(p) == 1 and p.count("MapInArrow") == 1


def test_duplicates_shuffle_digests_only(spark, qs):
    import re

    p = plan(qs["dup_conflict"](spark, SF))
    for line in re.findall(r"Exchange hashpartitioning\(.*", p):
        assert "text" not in line
    shuffled = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert shuffled and all(re.fullmatch(r"(f1|f2|l1|l2|[\w(), .#]*)*", s) for s in shuffled)
    assert {re.sub(r"#\d+L?", "", c).strip() for c in shuffled[-1].split(",")[:-2]} <= {"f1", "f2", "l1", "l2"}


def test_readiness_reads_the_table_four_times_at_most(spark, qs):
    assert 0 < scans(plan(qs["readiness"](spark, SF))) <= 4


def test_exact_distinct_counts_shuffle_digests(spark, qs):
    p = plan(qs["schema_profile"](spark, SF))
    assert "Expand" not in p and scans(p) == 1 and "Exchange hashpartitioning(i#" in p
