"""The physical plans that the operators are written for."""

import re

import pytest

from pricemart.plans.catalogue import QUERIES

FOLDER = "/root/testdata/sf0.001"
# these write and read tables while they are built
RUNS_WHEN_BUILT = {
    "stream_feed_load", "stream_job_state", "batch_feed_load", "table_upsert_and_delete", "load_log", "job_outcomes",
    "load_leaves_jobs_and_sources", "rolling_job_table", "answered_questions", "entities_written", "portfolio_assets_latest",
    "analytics_results_latest", "risk_signals_latest", "recommendations_latest", "question_log_history",
    "price_one_instrument_compacted",
}


def plan_of(spark, capsys, name):
    frame = QUERIES[name](spark, FOLDER)
    capsys.readouterr()
    frame.explain("formatted")
    return capsys.readouterr().out


def count(plan, operator):
    tree = plan.split("\n\n")[0]
    return len(re.findall(rf"(?<![A-Za-z]){operator} \(", tree))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RUNS_WHEN_BUILT))
def test_no_cross_joins(spark, capsys, name):
    plan = plan_of(spark, capsys, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name, shuffles", [
    ("latest_daily_prices", 1), ("aggregates_all", 1), ("trend", 1), ("forecast_last_close", 1),
    ("rolling_avg_7", 2), ("rolling_avg_several", 2), ("features", 2), ("risk_signal_latest", 2), ("regression_statistics", 2),
    ("job_latest_state", 1), ("feed_casts", 0), ("symbol_mentions", 0),
])
def test_number_of_shuffles(spark, capsys, name, shuffles):
    assert count(plan_of(spark, capsys, name), "Exchange") == shuffles


@pytest.mark.parametrize("name, shuffles, windows", [
    ("returns", 1, 1), ("risk_signal", 2, 1), ("metrics_report", 2, 1), ("instrument_history", 2, 2), ("instrument_as_of", 1, 1),
    ("price_asof_requests", 2, 1),
])
def test_shuffles_left_where_no_series_is_long(spark, name, shuffles, windows):
    """Once the count finds no long series, what is about pieces and their summaries is gone from the plan."""
    frame = QUERIES[name](spark, FOLDER)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan and "SortMergeJoin" not in plan
    assert (plan.count("- Exchange hashpartitioning"), plan.count("Window [")) == (shuffles, windows)


def test_versions_are_merged_before_the_shuffle(spark, capsys):
    plan = plan_of(spark, capsys, "latest_daily_prices")
    assert "partial_max_by" in plan and "SortAggregate" not in plan
    assert "HashAggregate" in plan_of(spark, capsys, "trend") and "SortAggregate" not in plan_of(spark, capsys, "trend")


def test_top_rows_are_limited_before_the_shuffle(spark, capsys):
    for name in ("latest_point", "price_history_pages", "instrument_current", "recent_load_log"):
        assert count(plan_of(spark, capsys, name), "WindowGroupLimit") >= 2


def test_windows_share_one_sort(spark, capsys):
    plan = plan_of(spark, capsys, "rolling_avg_several")
    assert count(plan, "Window") == 1 and count(plan, "Sort") == 1
    assert count(plan_of(spark, capsys, "regression_statistics"), "Sort") == 1


def test_range_reaches_the_scan(spark, capsys):
    plan = plan_of(spark, capsys, "price_range_filter")
    assert "GreaterThanOrEqual(ts,2024-01-05" in plan and "LessThan(ts,2024-01-21" in plan


def test_only_needed_columns_are_read(spark, capsys):
    (schema,) = re.findall(r"ReadSchema: struct<(.*?)>", plan_of(spark, capsys, "aggregates_all"))
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_suppkey", "l_linestatus", "l_extendedprice", "l_quantity"}
