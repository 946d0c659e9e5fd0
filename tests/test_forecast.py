"""Trend, risk and minutes at the live thresholds: scenarios, borders and nulls."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterflow import REFERENCE
from meterflow.functions import labels
from meterflow.operators import forecast, loads, surge
from tests.conftest import START, as_dicts

CFG = REFERENCE


def by_minute(df):
    return {int((r["window_start"] - START).total_seconds() // 60): r for r in as_dicts(df)}


def test_normal_operations(minutes):
    rows = minutes({"90210": [32_000.0] * 20})
    predictions = by_minute(forecast.overload_predictions(rows, CFG))
    assert {r["alert_level"] for r in predictions.values()} == {"LOW"}
    assert {r["estimated_minutes_to_overload"] for r in predictions.values()} == {999.0}
    assert predictions[19]["overload_risk_score"] == 0
    regimes = {r["growth_regime"] for r in as_dicts(forecast.load_acceleration(rows, CFG))}
    assert regimes == {labels.STABLE}
    assert as_dicts(forecast.imminent_overload(rows, CFG)) == []


def test_imminent_overload(minutes):
    # 1.5 MW more each minute, up to 47.5 MW of 50.
    rows = minutes({"90210": [25_000.0 + 1_500 * i for i in range(16)]})
    last = by_minute(forecast.overload_predictions(rows, CFG))[15]
    assert last["load_trend_slope"] == 1_500
    assert last["predicted_15min"] == 47_500 + 15 * 1_500
    assert last["overload_risk_score"] == 100.0
    assert (last["alert_level"], last["recommended_action"]) == ("CRITICAL", "SHED")
    shown = by_minute(forecast.imminent_overload(rows, CFG))[15]
    assert shown["current_load_mw"] == 47.5
    assert shown["accel_mw_per_min"] == 1.5
    assert shown["projected_load_mw"] == 70.0
    assert shown["mins_to_overload"] == 1.7
    assert shown["capacity_pct"] == round(sum(25.0 + 1.5 * i for i in range(1, 16)) / 50 * 100, 1)
    assert (shown["grid_alert_status"], shown["recommended_action"]) == ("critical", "SHED")


def test_load_shedding(minutes):
    rising = [25_000.0 + 1_500 * i for i in range(16)]
    rows = minutes({"90210": [*rising, 43_000.0, 39_000.0]})
    predictions = by_minute(forecast.overload_predictions(rows, CFG))
    assert predictions[15]["alert_level"] == "CRITICAL"
    assert predictions[17]["alert_level"] == "LOW"
    assert predictions[17]["estimated_minutes_to_overload"] == 999.0


def test_first_rows_have_no_trend(minutes):
    predictions = by_minute(forecast.overload_predictions(minutes({"z": [10_000.0 * (i + 1) for i in range(8)]}), CFG))
    assert predictions[0]["load_acceleration"] is None
    assert predictions[0]["estimated_minutes_to_overload"] == 999.0
    assert all(predictions[i]["load_trend_slope"] is None and predictions[i]["alert_level"] == "LOW" for i in range(5))
    assert predictions[5]["load_trend_slope"] is not None
    assert by_minute(forecast.rolling_15(minutes({"z": [1.0, 2.0]}), CFG))[0]["load_volatility"] is None


def test_missing_minutes_are_not_filled(minutes):
    rows = minutes({"z": [100.0, None, None, 130.0]})
    assert by_minute(forecast.load_lag_lead(rows, CFG))[3]["prev_load"] == 100.0


@pytest.mark.parametrize(
    ("score", "level"),
    [(100.0, "CRITICAL"), (80.0001, "CRITICAL"), (80.0, "HIGH"), (60.0, "MEDIUM"), (40.0, "LOW"), (None, "LOW")],
)
def test_risk_levels_are_strict(spark, score, level):
    df = spark.createDataFrame([(score,)], "s DOUBLE").select(labels.risk_level(F.col("s"), CFG).alias("level"))
    assert df.first().level == level


@pytest.mark.parametrize(
    ("minutes_left", "status"),
    [(0.0, "critical"), (5.0, "high"), (15.0, "medium"), (30.0, "normal"), (999.0, "normal")],
)
def test_minute_levels_are_strict(spark, minutes_left, status):
    df = spark.createDataFrame([(minutes_left,)], "m DOUBLE").select(labels.minute_status(F.col("m"), CFG).alias("s"))
    assert df.first().s == status


@pytest.mark.parametrize(
    ("change", "volatility", "regime"),
    [
        (1_000.5, 5_000.5, labels.EXPLOSIVE),
        (1_000.0, 5_000.5, labels.RAPID),
        (1_000.5, 5_000.0, labels.RAPID),
        (1_000.5, None, labels.RAPID),
        (500.0, 0.0, labels.MODERATE),
        (0.0, 9_000.0, labels.STABLE),
        (None, None, labels.STABLE),
    ],
)
def test_growth_regimes(spark, change, volatility, regime):
    df = spark.createDataFrame([(change, volatility)], "c DOUBLE, v DOUBLE")
    assert df.select(labels.growth_regime(F.col("c"), F.col("v"), CFG).alias("r")).first().r == regime


def test_full_wording(minutes):
    cfg = CFG.with_(wording="full")
    rows = minutes({"90210": [25_000.0 + 1_500 * i for i in range(16)]})
    shown = by_minute(forecast.imminent_overload(rows, cfg))[15]
    assert "CRITICAL: Load shedding" in shown["grid_alert_status"]
    assert shown["recommended_action"].startswith("Execute emergency load shedding.")
    action = by_minute(forecast.overload_predictions(rows, cfg))[15]["recommended_action"]
    assert action.startswith("INITIATE_LOAD_SHEDDING")


def test_look_back_applies_before_and_after_the_trend(minutes):
    rows = minutes({"z": [20_000.0 + 900 * i for i in range(31)]})
    as_of = F.lit(START + dt.timedelta(minutes=30))
    shown = by_minute(forecast.imminent_overload(rows, CFG, as_of=as_of))
    assert sorted(shown) == list(range(25, 31))
    # The frame starts at minute 10, the edge of the twenty minutes looked at.
    first = shown[25]
    assert first["capacity_pct"] == round(sum(20.0 + 0.9 * i for i in range(11, 26)) / 50 * 100, 1)
    narrow = CFG.with_(overload_history_s=5 * 60)
    assert sorted(by_minute(forecast.imminent_overload(rows, narrow, as_of=as_of))) == list(range(26, 31))


def test_zone_capacity_overrides_the_default(spark, minutes):
    rows = minutes({"a": [9_000.0 + 1_200 * i for i in range(7)], "b": [9_000.0 + 1_200 * i for i in range(7)]})
    capacity = spark.createDataFrame([("a", 20_000.0)], "zip_code STRING, capacity_kw DOUBLE")
    result = {
        r["zip_code"]: r
        for r in as_dicts(forecast.overload_predictions(rows, CFG, capacity))
        if r["window_start"] == START + dt.timedelta(minutes=6)
    }
    assert result["a"]["overload_risk_score"] == 100.0
    assert result["b"]["overload_risk_score"] == pytest.approx((16_200 + 18_000) / 50_000 * 100)


def test_alert_rule(minutes):
    predictions = forecast.overload_predictions(minutes({"z": [48_000.0, 48_500.0, 49_000.0]}), CFG)
    fired = forecast.overload_alert_fires(predictions, CFG).first()
    assert (fired.matching_rows, fired.fires) == (2, True)
    calm = forecast.overload_predictions(minutes({"z": [1.0, 1.0]}), CFG)
    assert not forecast.overload_alert_fires(calm, CFG).first().fires


def test_correlated_surge_classes(minutes):
    def zones(n, rate):
        return minutes({f"{i:05d}": [1_000.0 + rate * k for k in range(4)] for i in range(n)})

    def only(df):
        (row,) = as_dicts(surge.correlated_surge(df, CFG))
        return row

    assert only(zones(6, 9_000))["event_classification"] == labels.WIDESPREAD
    assert only(zones(6, 2_000))["event_classification"] == labels.MULTI_ZONE
    assert only(zones(4, 9_000))["event_classification"] == labels.MULTI_ZONE
    three = only(zones(3, 9_000))
    assert three["event_classification"] == labels.LOCALIZED
    assert three["affected_zips"] == ["00000", "00001", "00002"]
    assert three["total_surge_mw"] == 27.0
    assert as_dicts(surge.correlated_surge(zones(1, 9_000), CFG)) == []
    assert as_dicts(surge.correlated_surge(zones(5, 1_000), CFG)) == []  # not above the threshold
    assert {r["is_surging"] for r in as_dicts(surge.surging_zones(zones(2, 2_000), CFG))} == {0}


def test_heatwave_runs_and_replay(spark, minutes):
    temps = [96, 97, 90, 99, 99, 99, 95, 101]  # 95 is not above the threshold
    rows = [(START + dt.timedelta(seconds=10 * i), "z", 1.0, float(t)) for i, t in enumerate(temps)]
    readings = spark.createDataFrame(
        rows, "event_time TIMESTAMP_NTZ, zip_code STRING, power_kw DOUBLE, temperature_f DOUBLE"
    )
    cfg = CFG.with_(history_chunk_s=40)
    grid = loads.grid_wide(readings, cfg)
    runs = as_dicts(surge.heatwave_runs(grid, cfg), "event_start")
    assert [(r["hot_windows"], r["max_temp_f"]) for r in runs] == [(2, 97.0), (3, 99.0), (1, 101.0)]
    replay = as_dicts(surge.event_replay(grid, loads.minute_load(readings, cfg), cfg), "event_start")
    # Minute 0 holds the first run and the second; minute 1 the last.
    assert [(r["hot_windows"], r["minute_load_kw"]) for r in replay] == [(2, 6.0), (3, 6.0), (1, 2.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(0, 80_000, allow_nan=False), min_size=1, max_size=25))
def test_invariants(minutes, values):
    rows = as_dicts(forecast.overload_predictions(minutes({"z": values}), CFG, bounded=True))
    assert len(rows) == len(values)
    for row in rows:
        assert 0 <= row["overload_risk_score"] <= 100
        assert row["estimated_minutes_to_overload"] >= 0
