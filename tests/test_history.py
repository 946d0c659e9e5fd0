"""Cut histories give what uncut ones give, whatever the gaps; checked against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterflow import REFERENCE
from meterflow.operators import forecast
from meterflow.operators.history import next_known, number_rows, over_history
from tests.conftest import START


def gappy(seed: int) -> dict[str | None, list[float | None]]:
    rng = random.Random(seed)
    zones = ["00001", "00002", None, "90210"]
    loads = {}
    for zone in zones:
        keep = rng.choice([0.02, 0.1, 0.5, 1.0])
        loads[zone] = [round(rng.uniform(0, 60_000), 3) if rng.random() < keep else None for _ in range(400)]
    loads["lonely"] = [None] * 200 + [1.0]
    return loads


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("chunk_minutes", [7, 60])
def test_cut_equals_uncut(spark, minutes, seed, chunk_minutes):
    cfg = REFERENCE.with_(history_chunk_s=chunk_minutes * 60)
    rows = minutes(gappy(seed)).cache()
    for function in (forecast.load_lag_lead, forecast.rolling_15, forecast.trend_forecast):
        cut = function(rows, cfg).collect()
        uncut = function(rows, cfg, bounded=True).collect()
        assert sorted(map(repr, cut)) == sorted(map(repr, uncut))


def test_frames_reach_over_several_short_chunks(spark, minutes):
    # One row per chunk: fourteen earlier chunks feed each frame.
    rows = minutes({"z": [float(i) if i % 10 == 0 else None for i in range(300)]})
    cfg = REFERENCE.with_(history_chunk_s=600)
    result = {r.window_start: r.total for r in over_history(
        rows, lambda w: {"total": F.sum("minute_load_kw").over(w.rowsBetween(-14, 0))}, cfg, back=14
    ).collect()}
    values = [float(i) for i in range(0, 300, 10)]
    for n, value in enumerate(values):
        assert result[START + dt.timedelta(minutes=value)] == sum(values[max(0, n - 14) : n + 1])


def test_number_rows(spark, minutes):
    rows = minutes(gappy(5))
    numbered = number_rows(rows, ["zip_code"], "window_start", 3_600, "n").collect()
    by_zone = {}
    for row in numbered:
        by_zone.setdefault(row.zip_code, []).append((row.window_start, row.n))
    for pairs in by_zone.values():
        assert [n for _, n in sorted(pairs)] == list(range(len(pairs)))
    assert len(numbered) == rows.count()


def test_next_known(spark, minutes):
    rng = random.Random(11)
    rows = minutes(gappy(8)).withColumn(
        "mark", F.when(F.abs(F.hash("window_start", "zip_code")) % 9 == 0, F.col("minute_load_kw"))
    )
    chunk = rng.choice([1_200, 3_600])
    found = next_known(rows, ["zip_code"], "window_start", "mark", "next_mark", chunk).collect()
    marks = {}
    for row in rows.collect():
        if row.mark is not None:
            marks.setdefault(row.zip_code, []).append((row.window_start, row.mark))
    for row in found:
        later = sorted(m for m in marks.get(row.zip_code, []) if m[0] >= row.window_start)
        assert row.next_mark == (later[0][1] if later else None)
