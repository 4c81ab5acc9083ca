"""Every query with a SQL twin gives the twin's values; the others give rows."""

import os

import pytest

import __spark_entry__ as entry
from workload import check

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, TWINS = entry.queries(), entry.oracle_sql()
LARGE = ["numeric_profile", "numeric_summary", "column_assessment", "fe_clip", "fe_bins", "ks_two_sample", "histogram_data", "faceted_box",
         "seasonality_stats", "variance_decomposition", "run_chain", "phase_timing", "roc_curve", "auc_score", "lag_features", "mutual_information"]


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, con, name):
    ok, message = check.compare(spark, con, name, SF, QUERIES, TWINS)
    assert ok, message


@pytest.mark.parametrize("name", LARGE)
def test_twin_at_any_size(spark, con, large_mode, name):
    ok, message = check.compare(spark, con, name, SF, QUERIES, TWINS)
    assert ok, message


@pytest.mark.parametrize("name", ["gmm_labels", "anova_test", "regime_tests", "ols_inference", "cluster_verdict", "selection_full_run", "lag_scores"])
def test_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", ["correlation_pairs", "top_values", "box_stats_by_category", "run_chain", "current_flags", "near_duplicate_categories"])
def test_no_product_of_tables(spark, large_mode, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filter_and_columns_reach_the_scan(spark):
    from workload import Tables

    d = Tables(spark, SF).orders.filter("o_orderstatus = 'F'").groupBy("o_orderpriority").count()
    plan = d._jdf.queryExecution().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in plan
