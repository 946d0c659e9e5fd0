"""Daily moments and sketches, merged over ranges of days, against the rows themselves."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.plans import reports

DAY0 = dt.date(2024, 6, 1)


@pytest.mark.parametrize("offset", [0.0, 1e7])
def test_correlation_from_moments(spark, offset):
    """Also far from zero, where sums of squares would cancel to nothing."""
    rng = random.Random(3)
    rows = []
    for d in range(12):
        for i in range(rng.randint(0, 30)):
            at = dt.datetime.combine(DAY0, dt.time()) + dt.timedelta(days=d, minutes=i)
            for zone in ("a", "b", None):
                temp = rng.gauss(80, 9)
                load = offset + temp * (1 if zone == "a" else -0.3) + rng.gauss(0, 5)
                rows.append((at, zone, None if i % 11 == 4 else load, None if i % 13 == 6 else offset + temp))
        rows.append((dt.datetime.combine(DAY0, dt.time()) + dt.timedelta(days=d), "flat", 5.0, float(d)))
        rows.append((dt.datetime.combine(DAY0, dt.time()) + dt.timedelta(days=d), "unknown", None, 1.0))
    frame = spark.createDataFrame(rows, "window_start TIMESTAMP_NTZ, zip_code STRING, load_mw DOUBLE, avg_temp_f DOUBLE")
    daily = reports.daily_moments(frame)
    for start, end in ((None, None), (2, 9), (5, 6), (20, 30)):
        bounds = [None if n is None else DAY0 + dt.timedelta(days=n) for n in (start, end)]
        found = reports.temp_correlation_range(daily, *[None if b is None else F.lit(b) for b in bounds])
        found = {r.zip_code: (r.points, r.temp_correlation) for r in found.collect()}
        inside = [r for r in rows if (bounds[0] is None or bounds[0] <= r[0].date() < bounds[1])]
        assert set(found) == {r[1] for r in inside}
        for zone, (points, value) in found.items():
            of_zone = [r for r in inside if r[1] == zone]
            assert points == len(of_zone)
            both = np.array([r[2:] for r in of_zone if r[2] is not None and r[3] is not None])
            if zone in ("flat", "unknown") or len(both) < 2:
                assert value is None
            else:
                assert value == pytest.approx(np.corrcoef((both - offset).T)[0, 1], abs=1e-6)


def test_accuracy_from_daily_sums(spark):
    rng = random.Random(1)
    start = dt.datetime(2024, 6, 1)
    minute = [(start + dt.timedelta(minutes=15 * i), z, rng.uniform(0, 9) if i % 7 else 0.0) for i in range(300) for z in "ab"]
    predicted = [(at, z, load + rng.uniform(-1, 1)) for at, z, load in minute]
    m = spark.createDataFrame(minute, "window_start TIMESTAMP_NTZ, zip_code STRING, minute_load_kw DOUBLE")
    p = spark.createDataFrame(predicted, "window_start TIMESTAMP_NTZ, zip_code STRING, predicted_15min DOUBLE")
    from meterflow import REFERENCE

    whole = {tuple(r)[:2]: r.accuracy_pct for r in reports.prediction_accuracy(p, m, REFERENCE).collect()}
    found = {tuple(r)[:2]: r.accuracy_pct for r in reports.prediction_accuracy_range(reports.daily_errors(p, m, REFERENCE)).collect()}
    assert found.keys() == whole.keys() and len(found) == 3
    assert all(found[k] == pytest.approx(whole[k]) for k in whole)


@pytest.mark.parametrize("count", [0, 5, 30_000])
def test_quantiles_from_sketches(spark, count):
    rng = random.Random(count)
    start = dt.datetime(2024, 6, 1)
    rows = [
        (start + dt.timedelta(days=rng.randint(0, 9)), "HIGH", rng.lognormvariate(3, 2) if i % 5 else None) for i in range(count)
    ] + [(start, "CRITICAL", None)]
    frame = spark.createDataFrame(rows, "alert_time TIMESTAMP_NTZ, alert_level STRING, response_seconds DOUBLE")
    daily = reports.daily_sketches(frame.repartition(5))
    for begin, end in ((None, None), (dt.date(2024, 6, 3), dt.date(2024, 6, 8))):
        found = reports.response_time_quantiles(daily, *[None if b is None else F.lit(b) for b in (begin, end)])
        found = {r.alert_level: r for r in found.collect()}
        known = sorted(s for at, level, s in rows if s is not None and (begin is None or begin <= at.date() < end))
        assert begin is not None or found["CRITICAL"].median_seconds is None and found["CRITICAL"].alerts == 1
        if known:
            for q, value in ((0.5, found["HIGH"].median_seconds), (0.95, found["HIGH"].p95_seconds)):
                near = np.searchsorted(known, [value - 1e-6, value + 1e-6]) / len(known)
                bound = reports.SKETCH_ERROR + 1 / len(known)
                assert near[0] <= q + bound and near[1] >= q - bound
            assert found["HIGH"].answered == len(known)
