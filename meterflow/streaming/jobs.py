"""The live queries: zone loads, minute loads, grid totals, predictions and alerts.

Each takes any streaming frame of readings and any sink, so the message system and the
table format are the caller's choice. Windows are emitted once, when the watermark has
passed them; later readings for them are dropped and counted in the query's progress.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.config import GridConfig
from meterflow.operators import loads
from meterflow.operators.forecast import alert_payload, forecast_reach, overload_predictions
from meterflow.session import ROCKSDB_PROVIDER, settings
from meterflow.sources.tables import BATCH, DATE, delete, exists, write_dated

# The tables of the prediction stream.
MINUTE_SCHEMA = "window_start TIMESTAMP, window_end TIMESTAMP, zip_code STRING, minute_load_kw DOUBLE"
PREDICTION_SCHEMA = (
    f"{MINUTE_SCHEMA}, load_acceleration DOUBLE, cumulative_15min_load DOUBLE, avg_15min_load DOUBLE, "
    "load_trend_slope DOUBLE, predicted_next_minute DOUBLE, predicted_5min DOUBLE, predicted_15min DOUBLE, "
    "overload_risk_score DOUBLE, alert_level STRING, recommended_action STRING, current_load_kw DOUBLE, "
    "estimated_minutes_to_overload DOUBLE"
)
TABLE_SCHEMAS = {
    "minute_loads": MINUTE_SCHEMA,
    "overload_predictions": PREDICTION_SCHEMA,
    "alerts": "window_start TIMESTAMP, key STRING, value STRING",
}


def zip_load_stream(readings: DataFrame, cfg: GridConfig) -> DataFrame:
    return loads.zip_load(readings.withWatermark("event_time", cfg.zip_watermark), cfg)


def minute_load_stream(readings: DataFrame, cfg: GridConfig) -> DataFrame:
    return loads.minute_load(readings.withWatermark("event_time", cfg.minute_watermark), cfg)


def grid_wide_stream(readings: DataFrame, cfg: GridConfig) -> DataFrame:
    return loads.grid_wide(readings.withWatermark("event_time", cfg.grid_watermark), cfg)


def state_settings(spark: SparkSession, partitions: int | None = None):
    """State in RocksDB on executor disk, split over `partitions` (fixed by the first start of a query)."""
    count = partitions or spark.sparkContext.defaultParallelism
    return settings(
        spark,
        spark__sql__streaming__stateStore__providerClass=ROCKSDB_PROVIDER,
        spark__sql__shuffle__partitions=str(count),
    )


def _triggered(writer, trigger: dict):
    return writer.trigger(**trigger) if trigger else writer


def append_to_path(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partitions: int | None = None, **trigger
) -> StreamingQuery:
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    with state_settings(stream.sparkSession, partitions):
        return _triggered(writer, trigger).start(path)


def append_to_table(
    stream: DataFrame, table: str, checkpoint: str, fmt: str = "parquet", partitions: int | None = None, **trigger
) -> StreamingQuery:
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    with state_settings(stream.sparkSession, partitions):
        return _triggered(writer, trigger).toTable(table)


def dated_batch(path: str, time: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch function that stores a stream as a dated folder table, for the archive to work on."""

    def process(rows: DataFrame, batch: int) -> None:
        write_dated(rows, path, time, batch)

    return process


def append_dated(
    stream: DataFrame, path: str, time: str, checkpoint: str, partitions: int | None = None, **trigger
) -> StreamingQuery:
    """Like `append_to_path`, split by date. A repeated batch replaces its own folders, so rows are stored once."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    with state_settings(stream.sparkSession, partitions):
        return _triggered(writer.foreachBatch(dated_batch(path, time)), trigger).start()


class PredictionTables:
    """Folders of the prediction stream: minute rows, predictions and alerts by date, arrivals and carry by micro-batch.

    The carry holds each zone's newest rows, as many as a trend frame reaches back, so a
    batch reads one small folder instead of the history. A batch that is run again writes
    the same folders from the same carry.
    """

    def __init__(self, root: str):
        self.root = root

    def folder(self, table: str, batch: int | None = None) -> str:
        return f"{self.root}/{table}" if batch is None else f"{self.root}/{table}/{BATCH}={batch}"

    def of_batch(self, spark: SparkSession, table: str, batch: int, days: list[dt.date]) -> DataFrame:
        """The rows that one micro-batch stored in a dated table, on days that it may have written."""
        schema = TABLE_SCHEMAS[table]
        folders = [f"{self.folder(table)}/{DATE}={day.isoformat()}/{BATCH}={batch}" for day in days]
        found = [folder for folder in folders if exists(spark, folder)]
        return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if not exists(spark, self.folder(table)):
            return spark.createDataFrame([], TABLE_SCHEMAS[table])
        return spark.read.schema(TABLE_SCHEMAS[table]).parquet(self.folder(table)).drop(BATCH, DATE)


def to_kafka(servers: str, topic: str) -> Callable[[DataFrame], None]:
    """Alert sink for a message topic. Needs the Kafka connector on the cluster's class path.

    A batch that is run again publishes its alerts again; they carry zone and window to tell repeats by.
    """

    def publish(payload: DataFrame) -> None:
        payload.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return publish


def prediction_batch(
    tables: PredictionTables,
    cfg: GridConfig,
    publish: Callable[[DataFrame], None] | None = None,
    bounded: bool = False,
) -> Callable[[DataFrame, int], None]:
    """The micro-batch function of the prediction stream.

    It runs the same transform as a batch job would, over the new minute rows and the
    carry. Every result is written before it is used again, which leaves no long lineage
    to recompute when an executor is lost. Alerts are stored by date; `publish` gets their
    keys and values besides. `bounded` suits batches that hold few minutes.
    """
    reach = forecast_reach(cfg)

    def process(new_minutes: DataFrame, batch: int) -> None:
        spark = new_minutes.sparkSession
        new_minutes.write.mode("overwrite").parquet(tables.folder("arrived", batch))
        # What follows reads files only. Adaptive planning, off for the stream itself, fits it to the batch's size.
        with settings(spark, spark__sql__adaptive__enabled="true"):
            _predict(spark, batch)
        # Only the batch before can still be asked for, by a rerun of this one.
        for table in ("arrived", "carry"):
            delete(spark, tables.folder(table, batch - 2))

    def _predict(spark: SparkSession, batch: int) -> None:
        new = spark.read.schema(MINUTE_SCHEMA).parquet(tables.folder("arrived", batch))
        found = new.select(F.to_date("window_start").alias("day")).distinct().collect()  # a batch spans few days
        days = sorted(row.day for row in found if row.day is not None)
        write_dated(new, tables.folder("minute_loads"), "window_start", batch)
        rows = new.withColumn("is_new", F.lit(True))
        if batch > 0:
            carried = spark.read.schema(MINUTE_SCHEMA).parquet(tables.folder("carry", batch - 1))
            rows = rows.unionByName(carried.withColumn("is_new", F.lit(False)))

        if days:
            predicted = overload_predictions(rows, cfg, bounded=bounded).filter("is_new").drop("is_new")
            write_dated(predicted, tables.folder("overload_predictions"), "window_start", batch)
            stored = tables.of_batch(spark, "overload_predictions", batch, days)
            write_dated(alert_payload(stored, "window_start"), tables.folder("alerts"), "window_start", batch)
            if publish is not None:
                publish(tables.of_batch(spark, "alerts", batch, days).select("key", "value"))

        # A rank limit is applied before the shuffle too, so at most `reach` rows per zone and task move.
        newest = Window.partitionBy("zip_code").orderBy(F.col("window_start").desc())
        carry = rows.drop("is_new").withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= reach)
        carry.drop("rank").write.mode("overwrite").parquet(tables.folder("carry", batch))

    return process


def start_predictions(
    readings: DataFrame,
    tables: PredictionTables,
    checkpoint: str,
    cfg: GridConfig,
    publish: Callable[[DataFrame], None] | None = None,
    bounded: bool = False,
    partitions: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Predictions and alerts from the minute stream. Output folders belong to one checkpoint."""
    writer = (
        minute_load_stream(readings, cfg)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(prediction_batch(tables, cfg, publish, bounded))
    )
    with state_settings(readings.sparkSession, partitions):
        return _triggered(writer, trigger).start()


def run_until_failure(spark: SparkSession) -> None:
    """Keep the started queries running; return when one ends and raise if it failed."""
    spark.streams.awaitAnyTermination()


def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows the watermark shut out, as counted in the kept progress reports."""
    return sum(
        operator["numRowsDroppedByWatermark"] for report in query.recentProgress for operator in report["stateOperators"]
    )
