import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterflow import REFERENCE
from meterflow.operators import forecast, loads
from meterflow.plans import reports, status
from tests.conftest import START, as_dicts

ACTIONS = "operator_id STRING, zip_code STRING, action STRING, ts TIMESTAMP_NTZ"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def test_accuracy(minutes):
    # Growth of 10 kW a minute goes on: every forecast is met.
    rows = minutes({"a": [1_000.0 + 10 * i for i in range(40)], "b": [500.0] * 40})
    predictions = forecast.overload_predictions(rows, REFERENCE)
    result = {r["zip_code"]: r for r in as_dicts(reports.prediction_accuracy(predictions, rows, REFERENCE))}
    assert result["a"]["accuracy_pct"] == pytest.approx(100.0)
    assert result["ALL"]["forecasts"] == result["a"]["forecasts"] + result["b"]["forecasts"] == 40
    recent = reports.prediction_accuracy(predictions, rows, REFERENCE, as_of=F.lit(START), days=30)
    assert {r["forecasts"] for r in as_dicts(recent)} == {20, 40}


def test_accuracy_without_pairs(minutes):
    rows = minutes({"a": [1.0]})
    predictions = forecast.overload_predictions(rows, REFERENCE)
    (row,) = as_dicts(reports.prediction_accuracy(predictions, rows, REFERENCE))
    assert (row["zip_code"], row["forecasts"], row["accuracy_pct"]) == ("ALL", 0, None)


def test_response_times_against_brute_force(spark, minutes):
    rng = random.Random(3)
    cfg = REFERENCE.with_(history_chunk_s=600)
    loads_kw = {z: [rng.uniform(20_000, 60_000) for _ in range(120)] for z in ("a", "b", "quiet")}
    predictions = forecast.overload_predictions(minutes(loads_kw), cfg)
    moments = sorted(rng.sample(range(7_300), 25))
    actions = [(f"op{i % 3}", rng.choice("ab"), "shed", at(s)) for i, s in enumerate(moments)]
    found = as_dicts(reports.response_times(predictions, spark.createDataFrame(actions, ACTIONS), cfg))
    assert any(r["zip_code"] == "quiet" for r in found)
    for row in found:
        later = [a for a in actions if a[1] == row["zip_code"] and a[3] >= row["alert_time"]]
        first = min(later, key=lambda a: a[3], default=None)
        assert row["action_time"] == (first[3] if first else None)
        assert row["operator_id"] == (first[0] if first else None)
        expected = (first[3] - row["alert_time"]).total_seconds() if first else None
        assert row["response_seconds"] == expected
    severe = predictions.filter(F.col("alert_level").isin("CRITICAL", "HIGH")).count()
    assert len(found) == severe > 0


def test_action_rate_against_brute_force(spark):
    rng = random.Random(4)
    cfg = REFERENCE.with_(rate_limit=3)
    seconds = [rng.randrange(0, 9_000) for _ in range(700)]
    actions = [("op", "z", "shed", at(s + rng.random() * 0.9)) for s in seconds]
    found = {r["at"]: r["actions_in_window"] for r in as_dicts(
        reports.action_rate(spark.createDataFrame(actions, ACTIONS), cfg)
    )}
    expected = {}
    for s in set(seconds):
        count = sum(1 for other in seconds if s - 60 < other <= s)
        if count > 3:
            expected[at(s)] = count
    assert found == expected and expected


def test_period_profile(spark):
    hours = [(6, 3.0), (8, 9.0), (9, 2.0), (17, 5.0), (21, 1.0), (3, 5.0)]
    rows = [(START.replace(hour=h), kw) for h, kw in hours]
    profile = reports.period_profile(spark.createDataFrame(rows, "event_time TIMESTAMP_NTZ, power_kw DOUBLE"))
    result = {r["period"]: (r["readings"], r["outside_share"]) for r in as_dicts(profile)}
    assert result == {"morning_peak": (2, 0.5), "midday": (1, 0.0), "evening_peak": (1, 0.0), "night": (2, 0.5)}


def test_zone_status(spark, minutes):
    readings = spark.createDataFrame(
        [("m", z, at(s), kw, 240.0, 60.0, 90.0, 0.0) for z, s, kw in [("a", 0, 1.0), ("a", 60, 46.0), ("b", 0, 9.0)]],
        "meter_id STRING, zip_code STRING, event_time TIMESTAMP_NTZ, power_kw DOUBLE, voltage DOUBLE, "
        "frequency DOUBLE, temperature_f DOUBLE, grid_stress_indicator DOUBLE",
    )
    cfg = REFERENCE.with_(default_zone_capacity_kw=50.0)
    predictions = forecast.overload_predictions(loads.minute_load(readings, cfg), cfg)
    capacity = spark.createDataFrame([("b", 10.0)], "zip_code STRING, capacity_kw DOUBLE")
    status_rows = status.zone_status(loads.zip_load(readings, cfg), predictions, capacity, cfg)
    cards = {r["zip_code"]: r for r in as_dicts(status_rows)}
    assert cards["a"]["last_update"] == at(60) and cards["a"]["trend"] == "UP"
    assert cards["a"]["capacity_utilization_pct"] == pytest.approx(92.0) and cards["a"]["capacity_band"] == "high"
    assert cards["b"]["trend"] == "STABLE" and cards["b"]["capacity_utilization_pct"] == pytest.approx(90.0)
    assert cards["b"]["temp_band"] == "warm" and cards["b"]["alert_level"] == "LOW"


def test_zone_detail_equals_the_end_of_the_whole_history(minutes):
    rng = random.Random(5)
    rows = minutes({"a": [round(rng.uniform(1, 99), 3) for _ in range(160)], "b": [1.0] * 160})
    detail = as_dicts(status.zone_detail(rows, "a", REFERENCE), "window_start")
    whole = {r["window_start"]: r for r in as_dicts(forecast.trend_forecast(rows, REFERENCE)) if r["zip_code"] == "a"}
    assert [r["window_start"] for r in detail] == sorted(whole)[-100:]
    for row in detail:
        assert row["cumulative_15min"] == whole[row["window_start"]]["cumulative_15min_load"]
        assert row["predicted_15min"] == whole[row["window_start"]]["predicted_15min"]


def test_recent_alerts_are_the_newest(minutes):
    rows = minutes({f"{i:02d}": [20_000.0 + 2_000 * k for k in range(12)] for i in range(20)})
    newest = as_dicts(status.recent_alerts(forecast.overload_predictions(rows, REFERENCE), REFERENCE))
    assert len(newest) == 50
    assert [r["zip_code"] for r in newest[:20]] == [f"{i:02d}" for i in range(20)]
    assert newest[0]["window_end"] == START + dt.timedelta(minutes=12)


def test_alert_history_by_severity(minutes):
    predictions = forecast.overload_predictions(minutes({"a": [20_000.0 + 2_000 * k for k in range(12)]}), REFERENCE)
    every = status.alert_history(predictions).count()
    by_level = [status.alert_history(predictions, severity=s).count() for s in ("CRITICAL", "HIGH", "MEDIUM")]
    assert every == sum(by_level) > 0
    assert status.alert_history(predictions, start=START, end=START).count() == 0
