from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import registry
from tests.conftest import SMALL


@pytest.fixture
def spread(spark, tmp_path):
    """The small events with a third each years before, in and years after the month of the others."""
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    days = F.array(F.lit(-800), F.lit(0), F.lit(700))
    shift = F.make_dt_interval(F.element_at(days, (F.col("user_id") % 3 + 1).cast("int")))
    events.withColumn("ts", F.col("ts") + shift).write.parquet(f"{tmp_path}/events.parquet")
    return registry.Inputs(spark, str(tmp_path))


def test_history_union_has_every_day(spread):
    rows = Counter((r.window_start, r.zip_code) for r in registry.hot_and_cold(spread).collect())
    assert rows == Counter((r.window_start, r.zip_code) for r in spread.zones.collect())
    assert {w.year for w, _ in rows} >= {2021, 2024, 2025}


def test_prediction_stream_gets_every_reading(spread):
    found = registry._predicted(spread).read(spread.spark, "overload_predictions")
    windows = Counter((r.window_start, r.zip_code) for r in found.collect())
    batch = Counter((r.window_start, r.zip_code) for r in spread.predictions.collect())
    newest = max(w for w, _ in batch)  # the windows of the last 30 hours stay in the state
    assert all(batch[key] == n for key, n in windows.items())
    assert all((newest - w).total_seconds() < 32 * 3600 for w, _ in set(batch) - set(windows))
    assert {w.year for w, _ in windows} >= {2021, 2024, 2025}
