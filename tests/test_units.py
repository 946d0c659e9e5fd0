"""What a load counts as: odd readings, nulls, units and the reach of look-backs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterflow import REFERENCE
from meterflow.operators import forecast, loads, renewables
from meterflow.plans import status
from meterflow.plans.live import live_frames
from tests.conftest import START, as_dicts

SCALED = REFERENCE.with_(load_decimals=3)
COLUMNS = (
    "zip_code STRING, event_time TIMESTAMP_NTZ, power_kw DOUBLE, voltage DOUBLE, frequency DOUBLE, "
    "temperature_f DOUBLE, grid_stress_indicator DOUBLE"
)


def readings_of(spark, values, zone="z", step_s=1):
    rows = [(zone, START + dt.timedelta(seconds=i * step_s), v, 240.0, 60.0, 80.0, 0.0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize("cfg", [REFERENCE, SCALED])
@pytest.mark.parametrize("odd", [float("nan"), float("inf"), float("-inf"), 1e30])
def test_one_rule_for_readings_that_are_no_loads(spark, cfg, odd):
    readings = readings_of(spark, [10.0, 20.0, odd, None])
    zone = loads.zip_load(readings, cfg).first()
    assert (zone.load_mw, zone.avg_load_kw, zone.peak_load_kw, zone.meter_count) == (0.03, 15.0, 20.0, 4)
    assert zone.load_stddev == pytest.approx(50**0.5)
    assert loads.minute_load(readings, cfg).first().minute_load_kw == 30.0
    grid = loads.grid_wide(readings, cfg).first()
    assert (grid.grid_load_mw, grid.single_peak_kw, grid.active_meters) == (0.03, 20.0, 4)
    rejected = loads.rejected_readings(readings, cfg).first()
    assert (rejected.readings, rejected.missing, rejected.rejected) == (4, 1, 1)


def test_small_and_large_readings_keep_their_digits(spark):
    assert loads.minute_load(readings_of(spark, [0.0004] * 9), REFERENCE).first().minute_load_kw == 0.0036
    assert loads.minute_load(readings_of(spark, [1e16, 5.0]), REFERENCE).first().minute_load_kw == 1e16 + 5
    assert loads.minute_load(readings_of(spark, [9e15] * 4), REFERENCE).first().minute_load_kw == 3.6e16


def test_totals_do_not_depend_on_the_order(spark):
    values = [0.1 * i + 1e7 * (i % 3) for i in range(60)]
    one, two = (loads.minute_load(readings_of(spark, v), REFERENCE).first().minute_load_kw for v in (values, values[::-1]))
    assert one == two


def test_null_minutes_are_points_without_weight(spark):
    rows = [(START, START, "z", 100.0), (START + dt.timedelta(minutes=1), START, "z", None)]
    minute = spark.createDataFrame(
        rows, "window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, zip_code STRING, minute_load_kw DOUBLE"
    )
    history = loads.load_history(minute, REFERENCE, 3_600).first()
    assert (history.points, history.avg_load_kw) == (2, 100.0)


def test_unknown_loads_use_no_generation(spark):
    zones = spark.createDataFrame(
        [(START, "z", 5.0), (START + dt.timedelta(seconds=10), "z", None)],
        "window_start TIMESTAMP_NTZ, zip_code STRING, load_mw DOUBLE",
    )
    assets = spark.createDataFrame([("z", 10.0, 10.0)], "zip_code STRING, solar_generation_mw DOUBLE, wind_generation_mw DOUBLE")
    assert renewables.renewable_utilization(zones, assets).first().utilization_pct == 25.0
    assert renewables.renewable_utilization(zones, assets, end=START).count() == 0


def test_lag_longer_than_the_frame(spark, minutes):
    cfg = REFERENCE.with_(frame_rows=3, slope_lag=5, history_chunk_s=600)
    df = minutes({"a": [float(i) for i in range(45)]})
    rows = as_dicts(forecast.trend_forecast(df, cfg), "window_start")
    assert sum(r["load_trend_slope"] is None for r in rows) == 5
    assert rows == as_dicts(forecast.trend_forecast(df, cfg, bounded=True), "window_start")


@pytest.fixture
def constant(spark):
    """A meter that draws 10 MW for half an hour, read every ten seconds."""
    return readings_of(spark, [10_000.0] * 180, step_s=10)


def test_a_constant_load_has_no_deficit_and_one_capacity_figure(spark, constant):
    cfg = REFERENCE
    frames = live_frames(constant, cfg)
    assets = spark.createDataFrame(
        [("z", 1.0, 1.0, 50.0)],
        "zip_code STRING, solar_generation_mw DOUBLE, wind_generation_mw DOUBLE, battery_soc_pct DOUBLE",
    )
    aligned = renewables.aligned_loads(frames.zones, cfg)
    state = renewables.renewable_state(aligned, frames.predictions, assets, cfg)
    plan = renewables.plan_metrics(state, cfg)
    assert {r.projected_deficit_mw for r in plan.collect()} == {0.0}
    assert renewables.transfer_pairs(plan, cfg).count() == 0
    capacity = spark.createDataFrame([("z", 50_000.0)], "zip_code STRING, capacity_kw DOUBLE")
    balance = renewables.renewable_balance(state, cfg)
    header = status.grid_header(frames.grid, frames.zones, balance, capacity, cfg).collect()
    card = status.zone_status(frames.zones, frames.predictions, capacity, cfg).first()
    minute = status.zone_capacity_pct(frames.minute, capacity, cfg).collect()
    assert {r.capacity_pct for r in minute} == {r.capacity_pct for r in header} == {card.capacity_utilization_pct} == {20.0}
    # Every window of a minute shows that minute's balance, where a forecast exists.
    assert sum(r.renewable_deficit_zones == 0 for r in header) == len(header)


def test_a_look_back_on_readings_is_one_on_windows(spark, constant):
    as_of = F.lit(START + dt.timedelta(minutes=25, seconds=17))
    whole = loads.minute_load(constant, REFERENCE)
    for seconds in (60, 613, 1_517):
        recent = loads.recent_readings(constant, as_of, seconds, REFERENCE.minute_window_s)
        ours = loads.minute_load(recent, REFERENCE)
        assert as_dicts(ours, "window_start") == as_dicts(loads.since(whole, as_of, seconds), "window_start")


@pytest.mark.parametrize("view", ["zone_status", "recent_alerts", "grid_tail"])
def test_look_backs_of_live_views_reach_the_scan(spark, tmp_path, constant, view):
    constant.write.parquet(str(tmp_path / "readings"))
    stored = spark.read.parquet(str(tmp_path / "readings"))
    capacity = spark.createDataFrame([("z", 50_000.0)], "zip_code STRING, capacity_kw DOUBLE")

    def plan_of(as_of):
        f = live_frames(stored, REFERENCE, as_of, 600)
        df = {
            "zone_status": lambda: status.zone_status(f.zones, f.predictions, capacity, REFERENCE),
            "recent_alerts": lambda: status.recent_alerts(f.predictions, REFERENCE),
            "grid_tail": lambda: status.grid_tail(f.grid, REFERENCE),
        }[view]()
        return df._jdf.queryExecution().executedPlan().toString()

    plan = plan_of(F.lit(START + dt.timedelta(minutes=25)))
    assert plan.count("FileScan") == plan.count("GreaterThanOrEqual(event_time,") // 1 >= 1
    assert "GreaterThanOrEqual" not in plan_of(None)


@pytest.mark.parametrize("cfg", [REFERENCE, SCALED])
def test_rolled_up_loads_equal_those_of_readings(spark, cfg):
    readings = readings_of(spark, [10.25, None, 20.5, float("nan"), 7.125] * 30, step_s=7)
    parts = loads.zone_parts(readings, cfg)
    assert as_dicts(loads.zip_load_of(parts, cfg), "window_start") == as_dicts(loads.zip_load(readings, cfg), "window_start")
    assert as_dicts(loads.minute_load_of(parts, cfg), "window_start") == as_dicts(loads.minute_load(readings, cfg), "window_start")
    assert as_dicts(loads.grid_wide_of(parts, cfg), "window_start") == as_dicts(loads.grid_wide(readings, cfg), "window_start")
    with pytest.raises(ValueError, match="no multiple"):
        loads.minute_load_of(parts, cfg.with_(minute_window_s=15))
