"""Streams against the batch operators: several micro-batches, late rows, reruns."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterflow import REFERENCE
from meterflow.operators import forecast, loads
from meterflow.sources.readings import envelope, parse_readings, unique_readings
from meterflow.sources.tables import FolderTable
from meterflow.streaming import jobs
from tests.conftest import START, as_dicts

CFG = REFERENCE.with_(history_chunk_s=600)
READING = "meter_id STRING, zip_code STRING, event_time TIMESTAMP, power_kw DOUBLE, temperature_f DOUBLE"
EXTRA = {"voltage": 240.0, "frequency": 60.0, "grid_stress_indicator": 0.0}


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def readings_of(spark, rows):
    return spark.createDataFrame(rows, READING).withColumns({k: F.lit(v) for k, v in EXTRA.items()})


def three_hours(seed=1):
    """Half-minute readings of three zones, one of them with long gaps, in time order."""
    rng = random.Random(seed)
    rows = []
    for s in range(0, 3 * 3_600, 30):
        for zone, keep in (("a", 1.0), ("b", 0.7), ("c", 0.03)):
            if rng.random() < keep:
                rows.append((f"m{zone}", zone, at(s), round(rng.uniform(5_000, 25_000), 3), 80.0))
    return rows


class Feed:
    """A folder that readings arrive in, slice by slice."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path = spark, str(tmp_path / "in")
        readings_of(spark, []).write.parquet(self.path)
        self.schema = spark.read.parquet(self.path).schema

    def deliver(self, rows):
        readings_of(self.spark, rows).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.path)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def slices(rows, count):
    step = -(-len(rows) // count)
    return [rows[i : i + step] for i in range(0, len(rows), step)]


def sentinel():
    """A reading far ahead: it moves the watermark past everything before it."""
    return [("m", "later", at(86_400), 1.0, 80.0)]


def run_slices(feed, start, rows, count=4):
    for part in [*slices(rows, count), sentinel()]:
        feed.deliver(part)
        start().awaitTermination()


@pytest.mark.parametrize("name", ["zip_load", "minute_load", "grid_wide"])
def test_loads_equal_batch(spark, feed, tmp_path, name):
    rows = three_hours()
    stream = getattr(jobs, f"{name}_stream")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def start():
        return jobs.append_to_path(stream(feed.stream(), CFG), out, checkpoint, partitions=2, availableNow=True)

    run_slices(feed, start, rows)
    batch = getattr(loads, name)(readings_of(spark, rows), CFG)
    streamed = spark.read.parquet(out).select(*batch.columns)
    assert streamed.count() == batch.count()
    # Averages may differ in their last bits, by the order of addition.
    keys = [c for c in ("window_start", "zip_code") if c in batch.columns]
    for ours, theirs in zip(as_dicts(streamed, *keys), as_dicts(batch, *keys)):
        for column, value in theirs.items():
            assert ours[column] == (pytest.approx(value) if isinstance(value, float) else value)


def test_dated_folders(spark, feed, tmp_path):
    rows = three_hours()
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def start():
        return jobs.append_dated(
            jobs.minute_load_stream(feed.stream(), CFG), path, "window_start", checkpoint, partitions=2, availableNow=True
        )

    run_slices(feed, start, rows, count=2)
    batch = loads.minute_load(readings_of(spark, rows), CFG)
    table = FolderTable(spark, path, jobs.MINUTE_SCHEMA)
    assert sorted(map(repr, table.rows(START.date()).collect())) == sorted(map(repr, batch.collect()))
    assert all(f"/event_date={START.date()}/" in f for f in table.rows(START.date()).inputFiles())


def test_append_to_table(spark, feed, tmp_path):
    rows = three_hours()
    feed.deliver(rows)
    stream = jobs.minute_load_stream(feed.stream(), CFG)
    spark.sql("DROP TABLE IF EXISTS live_minutes")
    jobs.append_to_table(
        stream, "live_minutes", str(tmp_path / "checkpoint"), partitions=2, availableNow=True
    ).awaitTermination()
    emitted = spark.table("live_minutes")
    newest = max(r[2] for r in rows)
    assert emitted.count() > 0
    assert emitted.agg(F.max("window_end")).first()[0] <= newest - dt.timedelta(minutes=5)


def test_predictions_and_alerts_equal_batch(spark, feed, tmp_path):
    rows = three_hours()
    tables = jobs.PredictionTables(str(tmp_path / "tables"))

    def start():
        return jobs.start_predictions(
            feed.stream(), tables, str(tmp_path / "checkpoint"), CFG, partitions=2, availableNow=True
        )

    run_slices(feed, start, rows, count=5)
    batch = forecast.overload_predictions(loads.minute_load(readings_of(spark, rows), CFG), CFG)
    streamed = tables.read(spark, "overload_predictions").select(*batch.columns)
    assert streamed.select(F.countDistinct("window_start")).first()[0] > 100
    assert sorted(map(repr, streamed.collect())) == sorted(map(repr, batch.collect()))
    alerts = tables.read(spark, "alerts").drop("window_start")
    assert {p.name.split("=")[0] for p in (tmp_path / "tables" / "alerts").iterdir() if p.is_dir()} == {"event_date"}
    expected = forecast.alert_payload(batch)
    assert sorted(map(repr, alerts.collect())) == sorted(map(repr, expected.collect()))
    assert alerts.count() > 0
    # Old carries are dropped; the last ones hold at most fourteen rows per zone.
    folders = sorted(int(p.name.split("=")[1]) for p in (tmp_path / "tables" / "carry").iterdir() if "=" in p.name)
    assert len(folders) == 2
    newest = spark.read.parquet(tables.folder("carry", folders[-1]))
    assert newest.groupBy("zip_code").count().agg(F.max("count")).first()[0] <= 14


def test_a_repeated_batch_changes_nothing(spark, minutes, tmp_path):
    tables = jobs.PredictionTables(str(tmp_path))
    process = jobs.prediction_batch(tables, CFG)

    def zoned(df):
        return df.withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})

    everything = zoned(minutes({"a": [1_000.0 * i for i in range(20)], "b": [5_000.0] * 20}))
    first = everything.filter(F.col("window_start") < at(600))
    second = everything.filter(F.col("window_start") >= at(600))
    process(first, 0)
    process(second, 1)
    once = sorted(map(repr, tables.read(spark, "overload_predictions").collect()))
    process(second, 1)
    assert sorted(map(repr, tables.read(spark, "overload_predictions").collect())) == once
    whole = forecast.overload_predictions(everything, CFG, bounded=True)
    assert once == sorted(map(repr, whole.collect()))


def test_late_rows_are_dropped_and_counted(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def start():
        return jobs.append_to_path(
            jobs.zip_load_stream(feed.stream(), CFG), out, checkpoint, partitions=2, availableNow=True
        )

    feed.deliver([("m", "a", at(s), 1.0, 80.0) for s in range(0, 120, 10)])
    start().awaitTermination()
    # Newest is 110 s, so the watermark is 80 s: 5 s is late, 85 s is not.
    feed.deliver([("m", "a", at(5), 100.0, 80.0), ("m", "a", at(85), 10.0, 80.0)])
    query = start()
    query.awaitTermination()
    assert jobs.late_rows_dropped(query) == 1
    feed.deliver(sentinel())
    start().awaitTermination()
    totals = {r["window_start"]: r["load_mw"] for r in as_dicts(spark.read.parquet(out))}
    assert totals[at(0)] == 0.001
    assert totals[at(80)] == 0.011


def test_messages_to_loads(spark, tmp_path):
    rows = readings_of(spark, three_hours()[:200]).withColumns(
        {"timestamp": F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss"), "reading_interval_sec": F.lit(10)}
    )
    junk = spark.createDataFrame([("k", bytearray(b"{broken"))], "key STRING, value BINARY")
    envelope(rows).unionByName(junk).write.parquet(str(tmp_path / "topic"))
    messages = spark.readStream.schema("key STRING, value BINARY").parquet(str(tmp_path / "topic"))
    unique = unique_readings(parse_readings(messages), "5 minutes")
    query = jobs.append_to_path(
        unique, str(tmp_path / "out"), str(tmp_path / "checkpoint"), partitions=2, availableNow=True
    )
    query.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out"))
    # The broken message stays a row of nulls, which no window takes in.
    assert rows.filter("event_time IS NULL").count() == 1
    assert rows.filter("event_time IS NOT NULL").count() == 200


def test_a_failed_query_ends_the_wait(spark, feed, tmp_path):
    feed.deliver(three_hours()[:10])

    def fail(rows, batch):
        raise ValueError("sink is gone")

    writer = feed.stream().writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).foreachBatch(fail)
    spark.streams.resetTerminated()
    writer.start()
    with pytest.raises(Exception, match="sink is gone"):
        jobs.run_until_failure(spark)
    spark.streams.resetTerminated()
