"""Meter readings: the message format, its decoding, and where readings come from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The message format of a meter reading.
READING_SCHEMA = T.StructType(
    [
        T.StructField("meter_id", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("power_kw", T.DoubleType()),
        T.StructField("voltage", T.DoubleType()),
        T.StructField("frequency", T.DoubleType()),
        T.StructField("temperature_f", T.DoubleType()),
        T.StructField("grid_stress_indicator", T.DoubleType()),
        T.StructField("reading_interval_sec", T.IntegerType()),
    ]
)
READINGS_TOPIC = "smart-meter-readings"
ALERTS_TOPIC = "grid-alerts"

# Zones the event adapter spreads users over.
ADAPTER_ZONES = 15

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def kafka_messages(
    spark: SparkSession, servers: str, topic: str = READINGS_TOPIC, security: dict[str, str] | None = None, **options
) -> DataFrame:
    """Subscribe to a topic. Needs the Kafka connector on the cluster's class path."""
    defaults = {"startingOffsets": "latest", "failOnDataLoss": "false"}
    reader = spark.readStream.format("kafka").options(**{**defaults, **options})
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    for key, value in (security or {}).items():
        reader = reader.option(f"kafka.{key}", value)
    return reader.load()


def parse_readings(messages: DataFrame) -> DataFrame:
    """Decode `(key, value)` messages. A broken message gives a row of nulls, a junk time a null event time."""
    decoded = messages.select(F.from_json(F.col("value").cast("string"), READING_SCHEMA).alias("data"))
    return decoded.select("data.*").withColumn("event_time", F.try_to_timestamp("timestamp"))


def unique_readings(readings: DataFrame, watermark: str) -> DataFrame:
    """Drop the repeats a retrying producer sends; on a stream, those within the watermark."""
    identity = ["meter_id", "event_time"]
    if readings.isStreaming:
        return readings.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(identity)
    return readings.dropDuplicates(identity)


def envelope(readings: DataFrame) -> DataFrame:
    """Inverse of `parse_readings`: zone-keyed JSON messages."""
    fields = [field.name for field in READING_SCHEMA]
    return readings.select(
        F.col("zip_code").alias("key"), F.encode(F.to_json(F.struct(*fields)), "UTF-8").alias("value")
    )


def readings_from_events(events: DataFrame) -> DataFrame:
    """View an event table as meter readings: user → meter and zone, value → power, props.k → weather."""
    zone = F.lpad((F.col("user_id") % ADAPTER_ZONES).cast("string"), 5, "0")
    meter = F.concat(F.lit("meter_"), F.lpad(F.col("user_id").cast("string"), 10, "0"))
    k = F.get_json_object("props", "$.k").try_cast("int")
    return events.select(
        meter.alias("meter_id"),
        zone.alias("zip_code"),
        F.col("value").alias("power_kw"),
        (228 + k % 25).cast("double").alias("voltage"),
        (F.lit(59.95) + (k % 11) / 100.0).alias("frequency"),
        k.cast("double").alias("temperature_f"),
        (k / 100.0).alias("grid_stress_indicator"),
        F.lit(10).alias("reading_interval_sec"),
        F.col("ts").alias("event_time"),
    )


def actions_from_events(events: DataFrame, operators: int = 20) -> DataFrame:
    """View click events as the actions operators take in a zone."""
    clicks = events.filter(F.col("event_type") == "click")
    return clicks.select(
        F.concat(F.lit("op_"), F.lpad((F.col("user_id") % operators).cast("string"), 5, "0")).alias("operator_id"),
        F.lpad((F.col("user_id") % ADAPTER_ZONES).cast("string"), 5, "0").alias("zip_code"),
        F.col("event_type").alias("action"),
        "ts",
    )


def stream_events(spark: SparkSession, path: str, **options) -> DataFrame:
    """Stream a parquet event table, be it one file or a folder of files.

    A plain path must be a folder for the file source, while a pattern may match either;
    so the last letter is written as a pattern that matches only itself.
    """
    return spark.readStream.schema(EVENTS_SCHEMA).options(**options).parquet(f"{path[:-1]}[{path[-1]}]")


def with_stream_time(readings: DataFrame) -> DataFrame:
    """Event time as the zoned type that watermarks need; the session zone must be UTC."""
    return readings.withColumn("event_time", F.col("event_time").cast("timestamp"))
