"""Every catalogue query against its oracle, and the shape of its plan."""

import re

import pytest

import __spark_entry__
from check import compare, oracle
from loadlake import catalog

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


#: Results of a fit, which SQL cannot repeat; their digests and the models have tests of their own.
FITTED = {"train_gbt", "batch_forecast", "quantile_forecasts"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) - FITTED == set(ORACLE)
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLE) <= set(__spark_entry__.oracle_sql())


# Results of one row in all.
ONE_ROW = {"best_run", "last_approved_run", "run_success_7d", "retrain_decision", "train_gbt_digest"}


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, con, sf_dir, name):
    """The rows are the oracle's, and the plan has no cross join and gathers nothing in one task."""
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert "SinglePartition" not in plan or name in ONE_ROW
    assert compare(df, con, name) is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_scans_are_pruned_and_filters_reach_them(spark, sf_dir):
    plan = QUERIES["day_slice_half_open"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,value:double>" in plan
    plan = QUERIES["volume_anomaly_lineitem"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan


def test_gold_shuffles_each_row_once_for_all_load_windows(spark, sf_dir):
    plan = QUERIES["gold_features_serve"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"hashpartitioning\(series_id#\d+, _block#\d+L", plan)
    assert len(windows) == 1


def test_few_groups_are_broadcast_when_pooled(spark, sf_dir):
    plan = QUERIES["drift_psi_pooled"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
