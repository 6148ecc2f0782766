"""Registered queries against their oracle SQL, and the plans of the main ones."""

import re

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from conftest import SF

CHECKED = [
    "stg_order_items", "stg_products", "stg_geolocation", "cast_timestamps", "payments_aggregated", "latest_review",
    "int_orders_enriched", "primary_line", "dim_customers", "fact_order_items", "fact_orders", "met_daily_gmv",
    "met_daily_revenue", "met_daily_delay_rate", "order_features", "fct_predictions", "assert_relationships",
    "leakage_check", "monthly_metrics", "precision_at_k", "numeric_drift", "categorical_drift_top", "prepare_numeric",
    "category_vocabulary", "compare_models", "promote_registry", "evaluate_split", "evaluation_summary",
    "train_logistic", "top_coefficients", "score_orders", "trigger_performance",
]
NO_ORACLE: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_equals_oracle(spark, con, name):
    assert difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_registry_is_complete():
    # the operators of the optional package are counted in its own tests
    optional = lambda names: {n: v for n, v in names.items() if not re.match(r"op\d+_|pipeline$", n)}
    queries, oracles = optional(entry.queries()), optional(entry.oracle_sql())
    assert set(queries) - set(oracles) == NO_ORACLE and not set(oracles) - set(queries)
    assert len(queries) == 102


def test_entry(spark):
    assert entry.entry(spark).columns == ["order_date", "gmv"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_gets_filter_and_columns(spark):
    text = plan(entry.queries()["scan_parquet"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text
    assert re.search(r"ReadSchema: struct<l_returnflag:string,l_shipdate:timestamp_ntz>", text)


def test_metric_reads_few_columns_and_ranks_nothing(spark):
    text = plan(entry.queries()["met_daily_gmv"](spark, SF))
    assert "Window" not in text and "SortAggregate" not in text  # primary line and line numbers are pruned
    assert "l_suppkey" not in text and "o_orderpriority" not in text


@pytest.mark.parametrize("name", ["fact_orders", "int_orders_enriched", "order_features", "fact_order_items", "met_daily_delay_rate"])
def test_no_row_level_single_task_window_or_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "SinglePartition" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top1_is_limited_before_the_shuffle(spark, data):
    from stallwise.plans import marts

    text = plan(marts.latest_review(data.stg["stg_order_reviews"]))
    assert "WindowGroupLimit" in text and "Partial" in text
