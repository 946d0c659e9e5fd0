"""The physical plans: what is scanned, pushed down, shuffled and broadcast."""

import re

import pytest

from checks import registry
from checks.registry import CFG, Inputs
from meterflow.operators import forecast, loads, renewables
from meterflow.plans import archive, status
from tests.conftest import SMALL

BATCH = [
    name
    for name in registry.REGISTRY
    if not name.startswith("s_") and name not in ("archive_export", "archive_late_rows", "compact_day", "history_union", "report_csv")
]


@pytest.fixture
def x(spark):
    return Inputs(spark, SMALL)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    return planned(df).split("Initial Plan")[0]


@pytest.mark.parametrize("name", BATCH)
def test_no_pairwise_joins_and_no_python_rows(spark, name):
    plan = planned(registry.run(name, spark, SMALL))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas|Arrow", plan)


def test_minute_loads_read_three_columns_once(x):
    plan = planned(loads.minute_load(x.readings, CFG))
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan and "SortAggregate" not in plan


def test_zone_loads_hash_before_the_shuffle(x):
    plan = planned(x.zones)
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_history_reads_the_raw_table_once(x):
    plan = executed(forecast.trend_forecast(x.minute, CFG))
    assert plan.count("FileScan") == 1
    assert "ReusedExchange" in plan
    assert "WindowGroupLimit" in plan


def test_day_slice_reaches_the_scan(x):
    plan = planned(archive.day_slice(x.readings, registry.ARCHIVE_DAY, "event_time"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,2024-01-10T00:00\).*LessThan\(ts,2024-01-11T00:00\)", plan)


@pytest.mark.parametrize("name", ["recent_window", "imminent_overload_recent", "correlated_surge_recent", "reallocation_plan_recent", "zone_status_recent"])
def test_look_backs_reach_the_scan(spark, name):
    plan = planned(registry.run(name, spark, SMALL))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,", plan)


def test_day_counts_and_costs_scan_their_days_only(spark):
    plan = planned(registry.run("archive_validate", spark, SMALL))
    assert plan.count("FileScan") == len(re.findall(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", plan)) == 3
    assert "LessThan(ts," in planned(registry.run("cost_savings", spark, SMALL))


@pytest.mark.parametrize("name", ["grid_header", "transfer_impact", "event_replay", "reallocation_plan", "zone_status"])
def test_products_of_several_tables_do_not_read_the_readings_again(spark, name):
    """They work on zone parts, for which the readings were read once."""
    plan = planned(registry.run(name, spark, SMALL))
    assert "events.parquet" not in plan and "zone-parts" in plan


def test_response_times_are_hashed(x):
    assert "SortAggregate" not in executed(x.responses)


def test_zone_filter_of_the_detail_view_is_below_the_windows(x):
    plan = planned(status.zone_detail(x.minute, registry.DETAIL_ZONE, CFG))
    assert "TakeOrderedAndProject" in plan


def test_transfers_shuffle_once_after_the_plan(x):
    plan_rows = renewables.plan_metrics(x.state, CFG)
    extra = planned(renewables.transfer_pairs(plan_rows, CFG)).count("Exchange hashpartitioning") - planned(
        plan_rows
    ).count("Exchange hashpartitioning")
    assert extra == 1


def test_newest_row_per_zone_is_hashed(x):
    plan = planned(status.zone_status(x.zones, x.predictions, x.capacity, CFG))
    assert "SortAggregate" not in plan
