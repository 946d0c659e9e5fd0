import random

import pytest
from pyspark.sql import functions as F

from meterflow import REFERENCE
from meterflow.functions import labels
from meterflow.operators import forecast, renewables
from tests.conftest import START, as_dicts

CFG = REFERENCE

STATE = (
    "window_start TIMESTAMP_NTZ, zip_code STRING, load_mw DOUBLE, predicted_load_mw DOUBLE, "
    "overload_risk_score DOUBLE, renewable_surplus_mw DOUBLE"
)


def plan_row(spark, load, forecast_mw, risk, surplus):
    state = spark.createDataFrame([(START, "z", load, forecast_mw, risk, surplus)], STATE)
    return as_dicts(renewables.reallocation_plan(state, CFG))[0]


@pytest.mark.parametrize(
    ("load", "forecast_mw", "risk", "surplus", "role", "command"),
    [
        (10.0, 10.0, 0.0, 6.0, "EXPORT_ZONE", "TRANSFER 4.8 MW TO NEAREST IMPORT ZONE"),
        (10.0, 10.0, 0.0, 5.0, "EXPORT_ZONE", "MAINTAIN_CURRENT_FLOWS"),
        (10.0, 12.0, 0.0, 0.0, "BALANCED_ZONE", "MAINTAIN_CURRENT_FLOWS"),
        (10.0, 12.1, 0.0, 0.0, "IMPORT_ZONE", "REQUEST 2.1 MW FROM NEAREST EXPORT ZONE"),
        (10.0, 10.0, 60.1, 0.0, "IMPORT_ZONE", "MAINTAIN_CURRENT_FLOWS"),
        (10.0, 20.0, 30.0, 8.0, "IMPORT_ZONE", "TRANSFER 6.4 MW TO NEAREST IMPORT ZONE"),
        (10.0, None, 0.0, 0.0, "BALANCED_ZONE", "MAINTAIN_CURRENT_FLOWS"),
        (0.0, 10.0, 50.0, 0.0, "IMPORT_ZONE", "REQUEST 10.0 MW FROM NEAREST EXPORT ZONE"),
        (10.0, 98_765_442.1, 50.0, 0.0, "IMPORT_ZONE", "REQUEST 98765432.1 MW FROM NEAREST EXPORT ZONE"),
    ],
)
def test_plan_rules(spark, load, forecast_mw, risk, surplus, role, command):
    row = plan_row(spark, load, forecast_mw, risk, surplus)
    assert (row["grid_role"], row["grid_command"]) == (role, command)


def test_plan_nulls(spark):
    row = plan_row(spark, 10.0, None, 0.0, 0.0)
    assert row["deficit_mw"] == 0 and row["priority_score"] is None
    assert plan_row(spark, 0.0, 5.0, 50.0, 0.0)["priority_score"] is None


def test_state_without_assets(spark, minutes):
    loads = spark.createDataFrame(
        [(START, "a", 5.0, 80.0), (START, "b", 5.0, 80.0), (START, "c", 5.0, 80.0)],
        "window_start TIMESTAMP_NTZ, zip_code STRING, load_mw DOUBLE, avg_temp_f DOUBLE",
    )
    predictions = forecast.overload_predictions(minutes({z: [5_000.0] for z in "abc"}), CFG)
    assets = spark.createDataFrame(
        [("a", 4.0, 3.0, 50.0), ("b", 4.0, None, 50.0)],
        "zip_code STRING, solar_generation_mw DOUBLE, wind_generation_mw DOUBLE, battery_soc_pct DOUBLE",
    )
    state = as_dicts(renewables.renewable_state(loads, predictions, assets, CFG), "zip_code")
    assert [r["renewable_surplus_mw"] for r in state] == [2.0, 0.0, 0.0]


def random_plan(spark, seed):
    rng = random.Random(seed)
    rows = []
    for w in range(6):
        for z in range(rng.choice([1, 3, 40])):
            role = rng.choice([labels.EXPORT_ZONE, labels.IMPORT_ZONE, labels.BALANCED_ZONE])
            rows.append(
                (w, f"{z:05d}", role, round(rng.choice([0.0, 5.0, rng.uniform(0, 90)]), 2),
                 round(rng.choice([0.0, 4.0, rng.uniform(0, 90)]), 2), rng.choice([None, 1.0, rng.uniform(0, 99)]))
            )
    return rows, spark.createDataFrame(
        rows,
        "window_start INT, zip_code STRING, grid_role STRING, renewable_surplus_mw DOUBLE, "
        "projected_deficit_mw DOUBLE, reallocation_priority DOUBLE",
    )


def routed_one_by_one(rows):
    """Fill the requests in order from the offers in order, the obvious way."""
    result = []
    for w in sorted({r[0] for r in rows}):
        offers = sorted(
            ([-r[3], r[1], round(round(r[3] * 0.8, 4) * 10_000)] for r in rows if r[0] == w and r[2] == "EXPORT_ZONE")
        )
        asks = sorted(
            ([-(r[5] if r[5] is not None else -1), r[1], round(r[4] * 10_000)] for r in rows
             if r[0] == w and r[2] == "IMPORT_ZONE")
        )
        for offer in offers:
            for ask in asks:
                moved = min(offer[2], ask[2])
                if moved > 0:
                    result.append((w, offer[1], ask[1], moved / 10_000))
                    offer[2] -= moved
                    ask[2] -= moved
    return sorted(result)


@pytest.mark.parametrize("seed", range(4))
def test_transfers_match_filling_one_by_one(spark, seed):
    rows, plan = random_plan(spark, seed)
    pairs = sorted(tuple(r) for r in renewables.transfer_pairs(plan, CFG).collect())
    assert pairs == routed_one_by_one(rows)


def test_transfers_never_exceed_either_side(spark):
    rows, plan = random_plan(spark, 99)
    moved = renewables.transfer_pairs(plan, CFG).groupBy("window_start").agg(F.sum("transfer_mw").alias("mw")).collect()
    for row in moved:
        offered = sum(r[3] * 0.8 for r in rows if r[0] == row.window_start and r[2] == labels.EXPORT_ZONE)
        asked = sum(r[4] for r in rows if r[0] == row.window_start and r[2] == labels.IMPORT_ZONE)
        assert row.mw == pytest.approx(min(offered, asked))


def test_transfer_impact(spark, minutes):
    predictions = forecast.overload_predictions(minutes({"t": [30_000.0 + 2_000 * i for i in range(8)]}), CFG)
    pairs = spark.createDataFrame(
        [(START.replace(minute=7), "s", "t", 10.0)],
        "window_start TIMESTAMP_NTZ, source_zip STRING, target_zip STRING, transfer_mw DOUBLE",
    )
    (row,) = as_dicts(renewables.transfer_impact(pairs, predictions, CFG))
    assert row["target_new_load_mw"] == 34.0
    assert row["target_new_minutes_to_overload"] == 8.0
    assert row["target_new_risk_score"] == 100.0
    (before,) = [r for r in as_dicts(predictions) if r["window_start"] == START.replace(minute=7)]
    assert before["estimated_minutes_to_overload"] == 3.0
