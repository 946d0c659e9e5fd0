import datetime as dt
import json

from pyspark.sql import functions as F

from meterflow import REFERENCE
from meterflow.operators import loads
from meterflow.plans import status
from meterflow.sources import readings as source
from tests.conftest import START, as_dicts

GOOD = {
    "meter_id": "meter_0000001234",
    "zip_code": "02101",
    "timestamp": "2024-06-25T14:00:03.250000",
    "power_kw": 4.523,
    "voltage": 240.1,
    "frequency": 60.02,
    "temperature_f": 102.5,
    "grid_stress_indicator": 0.85,
    "reading_interval_sec": 10,
}


def parsed(spark, *values):
    rows = [("k", v.encode() if v is not None else None) for v in values]
    return source.parse_readings(spark.createDataFrame(rows, "key STRING, value BINARY"))


def test_decode(spark):
    row = parsed(spark, json.dumps(GOOD)).first()
    assert row.zip_code == "02101"
    assert row.power_kw == 4.523
    assert row.event_time == dt.datetime(2024, 6, 25, 14, 0, 3, 250_000)


def test_decode_zulu_time(spark):
    row = parsed(spark, json.dumps({**GOOD, "timestamp": "2024-06-25T14:00:00Z"})).first()
    assert row.event_time == START


def test_bad_messages_never_reach_a_window(spark):
    missing = {k: v for k, v in GOOD.items() if k != "voltage"}
    junk_time = {**GOOD, "timestamp": "yesterday"}
    readings = parsed(spark, "{not json", None, json.dumps(junk_time), json.dumps(missing), json.dumps(GOOD))
    rows = readings.collect()
    assert [r.event_time is None for r in rows] == [True, True, True, False, False]
    assert rows[0].meter_id is None and rows[2].meter_id is not None and rows[3].voltage is None
    (load,) = as_dicts(loads.zip_load(readings, REFERENCE))
    assert load["meter_count"] == 2
    assert load["avg_voltage"] == 240.1


def test_round_trip(spark):
    df = parsed(spark, json.dumps(GOOD))
    assert source.parse_readings(source.envelope(df)).first() == df.first()


def readings_of(spark, rows):
    schema = (
        "meter_id STRING, zip_code STRING, event_time TIMESTAMP_NTZ, power_kw DOUBLE, voltage DOUBLE, "
        "frequency DOUBLE, temperature_f DOUBLE, grid_stress_indicator DOUBLE"
    )
    return spark.createDataFrame([(f"m{i}", z, t, p, 240.0, 60.0, 75.0, 0.0) for i, (z, t, p) in enumerate(rows)], schema)


def test_zone_loads(spark):
    at = lambda s: START + dt.timedelta(seconds=s)
    df = readings_of(
        spark, [("a", at(0), 1.001), ("a", at(9.9), 2.002), ("a", at(10), 4.0), ("b", at(1), None), (None, at(2), 7.0)]
    )
    rows = {(r["zip_code"], r["window_start"]): r for r in as_dicts(loads.zip_load(df, REFERENCE))}
    first = rows["a", START]
    assert first["load_mw"] == 0.003003
    assert first["meter_count"] == 2 and first["avg_load_kw"] == 1.5015
    assert first["window_end"] == at(10)
    assert rows["a", at(10)]["load_stddev"] is None
    # A zone that reports no value has no load, and readings without a zone are kept apart.
    assert rows["b", START]["load_mw"] is None and rows["b", START]["meter_count"] == 1
    assert rows[None, START]["peak_load_kw"] == 7.0


def test_totals_do_not_depend_on_order_and_skip_values_that_are_not_finite(spark):
    values = [0.1, 0.2, 0.3, 1e6, float("nan"), float("inf")]
    df = readings_of(spark, [("a", START, v) for v in values])
    expected = loads.minute_load(df, REFERENCE).first().minute_load_kw
    assert expected == 1_000_000.6
    assert loads.minute_load(df.orderBy(F.desc("power_kw")).repartition(3), REFERENCE).first().minute_load_kw == expected


def test_repeated_readings(spark):
    df = parsed(spark, json.dumps(GOOD), json.dumps(GOOD))
    assert source.unique_readings(df, "1 minute").count() == 1


def test_load_history(spark, minutes):
    rows = minutes({"a": [10.0, 20.0, 60.0], "b": [1.0, 1.0, 1.0]})
    history = loads.load_history(rows, REFERENCE, 120, zone="a", start=START, end=START + dt.timedelta(minutes=3))
    assert [(r["points"], r["avg_load_kw"]) for r in as_dicts(history, "window_start")] == [(2, 15.0), (1, 60.0)]


def test_stale_zones(spark):
    df = readings_of(spark, [("a", START, 1.0), ("b", START - dt.timedelta(seconds=1), 1.0)])
    flags = status.stale_zones(df, F.lit(START + dt.timedelta(seconds=30)), REFERENCE)
    assert {r["zip_code"]: r["is_stale"] for r in as_dicts(flags)} == {"a": False, "b": True}
