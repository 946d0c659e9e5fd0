"""Every operator as a query over the given tables, at fixture thresholds."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow import FIXTURE as CFG
from meterflow.operators import forecast, loads, renewables, surge
from meterflow.plans import archive, reports, status
from meterflow.plans.live import LiveFrames, live_frames, rolled_up
from meterflow.session import scratch_path, stored
from meterflow.sources import dimensions
from meterflow.sources import readings as source
from meterflow.sources.tables import FolderTable, write_dated
from meterflow.streaming import jobs, stateful

AS_OF = dt.datetime(2024, 1, 31)
ARCHIVE_RUN = dt.date(2024, 2, 9)
ARCHIVE_DAY = dt.date(2024, 1, 10)
DETAIL_ZONE = "00007"
SOME_DAYS = (dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 20))
SOME_WEEK = (dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 12))
SOME_DATES = (dt.date(2024, 1, 6), dt.date(2024, 1, 21))
PLACES = 6

Query = Callable[["Inputs"], DataFrame]


class Inputs:
    """The given tables and the frames the operators build on, each planned when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    @cached_property
    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/events.parquet")

    @cached_property
    def readings(self) -> DataFrame:
        return source.readings_from_events(self.events)

    @cached_property
    def messages(self) -> DataFrame:
        return as_messages(self.readings)

    @cached_property
    def actions(self) -> DataFrame:
        return source.actions_from_events(self.events)

    @cached_property
    def minute(self) -> DataFrame:
        return loads.minute_load(self.readings, CFG)

    @cached_property
    def zones(self) -> DataFrame:
        return loads.zip_load(self.readings, CFG)

    @cached_property
    def grid(self) -> DataFrame:
        return loads.grid_wide(self.readings, CFG)

    @cached_property
    def predictions(self) -> DataFrame:
        return forecast.overload_predictions(self.minute, CFG)

    @cached_property
    def assets(self) -> DataFrame:
        return dimensions.fixture_assets(self.spark)

    @cached_property
    def capacity(self) -> DataFrame:
        return dimensions.fixture_capacity(self.spark)

    @cached_property
    def rolled(self) -> LiveFrames:
        """The load tables rolled up from zone parts stored once, for products that join several of them."""
        return rolled_up(stored(loads.zone_parts(self.readings, CFG), "zone-parts"), CFG)

    @cached_property
    def state(self) -> DataFrame:
        return renewables.renewable_state(self.rolled.zones, self.rolled.predictions, self.assets, CFG)

    @cached_property
    def aligned_state(self) -> DataFrame:
        aligned = renewables.aligned_loads(self.rolled.zones, CFG)
        return renewables.renewable_state(aligned, self.rolled.predictions, self.assets, CFG)

    @cached_property
    def pairs(self) -> DataFrame:
        return renewables.transfer_pairs(renewables.plan_metrics(self.aligned_state, CFG), CFG)

    @cached_property
    def responses(self) -> DataFrame:
        return reports.response_times(self.predictions, self.actions, CFG)

    @cached_property
    def tiered(self) -> DataFrame:
        return archive.storage_tier(self.readings, AS_OF.date(), CFG)

    def stream(self) -> DataFrame:
        events = source.stream_events(self.spark, f"{self.sf_dir}/events.parquet")
        return source.with_stream_time(source.readings_from_events(events))

    def minute_since(self, seconds: int) -> DataFrame:
        recent = loads.recent_readings(self.readings, F.lit(AS_OF), seconds, CFG.minute_window_s)
        return loads.minute_load(recent, CFG)

    def day_tables(self) -> dict[str, archive.DatedTable]:
        of_day = archive.day_slice(self.readings, ARCHIVE_DAY, "event_time")
        return {
            "raw_readings": archive.DatedTable(self.readings, "event_time", CFG.minimum_raw_rows),
            "zip_aggregations": archive.DatedTable(loads.zip_load(of_day, CFG)),
            "predictions": archive.DatedTable(self.predictions),
        }

    def counted_tables(self) -> dict[str, archive.DatedTable]:
        """The same to count only: the day's predictions need the readings that their frames reach back to."""
        reach = dt.timedelta(seconds=forecast.forecast_reach(CFG) * CFG.minute_window_s)
        day = dt.datetime.combine(ARCHIVE_DAY, dt.time())
        near = loads.in_range(self.readings, None, day - reach, day + dt.timedelta(days=1), "event_time")
        predictions = forecast.overload_predictions(loads.minute_load(near, CFG), CFG, bounded=True)
        return self.day_tables() | {"predictions": archive.DatedTable(predictions)}


def as_messages(readings: DataFrame) -> DataFrame:
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return source.envelope(readings.withColumn("timestamp", iso))


def tidy(df: DataFrame) -> DataFrame:
    """Plain types for the comparison: doubles rounded, times without a zone, counts as bigint."""
    plain = {
        "double": lambda name: F.round(name, PLACES) + F.lit(0.0),
        "timestamp": lambda name: F.col(name).cast("timestamp_ntz"),
        "int": lambda name: F.col(name).cast("bigint"),
    }
    return df.select(*[plain[kind](name).alias(name) if kind in plain else F.col(name) for name, kind in df.dtypes])


def parsed_payload(payload: DataFrame) -> DataFrame:
    fields = (
        "zip_code STRING, window_start TIMESTAMP_NTZ, overload_risk_score DOUBLE, alert_level STRING, "
        "recommended_action STRING, predicted_15min DOUBLE, current_load_kw DOUBLE"
    )
    # A zoned time prints its offset; without it the text is the plain time.
    plain = F.regexp_replace("value", r"(\d\d:\d\d:\d\d\.\d+)Z", "$1")
    return payload.select("key", F.from_json(plain, fields).alias("data")).select("key", "data.*")


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


# ---- Batch keys that need more than one call ----


def first_event(x: Inputs) -> dt.datetime:
    """Start of the first heatwave from the third day on: one row, as a user picks it from the list of events."""
    runs = surge.heatwave_runs(x.rolled.grid, CFG).filter(F.col("event_start") >= F.lit(dt.datetime(2024, 1, 3)))
    return runs.agg(F.min("event_start")).first()[0]


def archive_dates(x: Inputs) -> DataFrame:
    runs = x.readings.groupBy(F.to_date("event_time").alias("run_date")).agg(F.count(F.lit(1)).alias("readings"))
    return runs.withColumn("archive_date", archive.archive_date(F.col("run_date"), CFG))


def tier_summary(x: Inputs) -> DataFrame:
    return x.tiered.groupBy("tier").agg(
        F.count(F.lit(1)).alias("readings"), F.min("age_days").alias("min_age"), F.max("age_days").alias("max_age")
    )


def savings(x: Inputs) -> DataFrame:
    return archive.cost_savings(x.readings, ARCHIVE_RUN, CFG)


def _stored_day(x: Inputs, root: str, name: str, table: archive.DatedTable) -> DataFrame:
    """The archive jobs read stored tables several times, so a day that is derived here is stored first."""
    day = archive.day_slice(table.rows, ARCHIVE_DAY, table.time)
    if name == "raw_readings":
        return day
    day.write.parquet(f"{root}/hot/{name}")
    return x.spark.read.schema(day.schema).parquet(f"{root}/hot/{name}")


def export_day(x: Inputs) -> DataFrame:
    root = scratch_path(x.spark, "export")
    return _union(
        [
            archive.archive_export(_stored_day(x, root, name, table), root, name, ARCHIVE_DAY, CFG, table.time)
            for name, table in x.day_tables().items()
        ]
    )


def compacted(x: Inputs, layout: str = "zone") -> DataFrame:
    root = scratch_path(x.spark, "compact")
    return _union(
        [
            archive.compact_day(
                _stored_day(x, root, name, table), f"{root}/staging", name, ARCHIVE_DAY, CFG, table.time, layout
            )
            for name, table in x.day_tables().items()
        ]
    )


def _hot_zones(x: Inputs, root: str) -> FolderTable:
    """The zone loads as a hot table whose archived day comes in two batches: before noon, and late."""
    noon = F.lit(dt.datetime.combine(ARCHIVE_DAY, dt.time(12))).cast("timestamp_ntz")
    late = (F.to_date("window_start") == F.lit(ARCHIVE_DAY)) & (F.col("window_start") >= noon)
    write_dated(x.zones.filter(~late), f"{root}/hot", "window_start", 0)
    table = FolderTable(x.spark, f"{root}/hot", x.zones.schema.toDDL())
    archive.archive_one_day(
        archive.ArchivedTable(table, minimum=0), "zip_aggregations", ARCHIVE_DAY, f"{root}/cold", CFG
    )
    write_dated(x.zones.filter(late), f"{root}/hot", "window_start", 1)
    return table


#: Days that are exported one by one where a query works on several segments.
SEGMENT_DAYS = [ARCHIVE_DAY + dt.timedelta(days=n) for n in range(3)]


def _segments(x: Inputs, root: str, name: str, rows: DataFrame, layout: str = "zone") -> DataFrame:
    """Export some days of a table as segments; returns its rows as they were stored before."""
    kept = stored(rows, "segment-rows")
    for day in SEGMENT_DAYS:
        archive.export_segment(archive.day_slice(kept, day), root, name, day, 0, CFG, "window_start", layout=layout)
    return kept


def archived_zone_history(x: Inputs) -> DataFrame:
    """One zone's load history from the archive alone, from the files that may hold it."""
    root = scratch_path(x.spark, "archived")
    schema = _segments(x, root, "minute_loads", x.minute, "zorder").schema.toDDL()
    begin = dt.datetime.combine(SEGMENT_DAYS[0], dt.time(6))
    end = dt.datetime.combine(SEGMENT_DAYS[-1], dt.time(12))
    found = archive.archived_rows(x.spark, root, "minute_loads", schema, DETAIL_ZONE, begin, end)
    return loads.load_history(found, CFG, 86_400)


LIFE = CFG.with_(hot_days=5, warm_days=10, archive_days=15, delete_days=20)


def planned_lifecycle(x: Inputs) -> DataFrame:
    """What would be due if every day of readings were a segment of a table that was archived at once."""
    days = x.readings.filter("event_time IS NOT NULL").select(F.to_date("event_time").alias("archive_date")).distinct()
    rows = days.select(F.lit("raw_readings").alias("table_name"), "archive_date", F.lit(0).alias("run"), F.lit("warm").alias("tier"))
    return archive.lifecycle_plan(rows, AS_OF.date(), LIFE)


def lived(x: Inputs) -> DataFrame:
    """Three segments of which one is young, one moves to the archive class and the oldest is deleted: what stays readable."""
    root = scratch_path(x.spark, "lifecycle")
    _segments(x, root, "zip_aggregations", x.zones)
    cfg = CFG.with_(hot_days=18, warm_days=18, archive_days=19, delete_days=20)
    archive.lifecycle(x.spark, {"zip_aggregations": "window_start"}, root, AS_OF.date(), cfg)
    left = archive.segments(x.spark, root, "zip_aggregations")
    homes = [
        x.spark.read.parquet(s.path).select(F.lit(s.tier).alias("tier"), F.lit(s.day).alias("archive_date"), "zip_code", "meter_count")
        for s in left
        if s.path is not None
    ]
    return _union(homes)


def archive_volume(x: Inputs) -> DataFrame:
    """Rows and measured volume of an archived day; a file's bytes are the writer's, so only the price per GB is compared."""
    root = scratch_path(x.spark, "volume")
    day = stored(archive.day_slice(x.zones, ARCHIVE_DAY), "volume-day")
    archive.export_segment(day, root, "zip_aggregations", ARCHIVE_DAY, 0, CFG, "window_start")
    found = archive.stored_bytes(x.spark, root, "zip_aggregations", ARCHIVE_DAY)
    return found.select("rows", "segments", (F.col("gb") > 0).alias("measured"), (F.col("monthly_savings") / F.col("gb")).alias("saved_per_gb"))


def _dated(x: Inputs, rows: DataFrame, purpose: str) -> FolderTable:
    root = scratch_path(x.spark, purpose)
    write_dated(rows, root, "window_start", 0)
    return FolderTable(x.spark, root, rows.schema.toDDL())


def sketched(x: Inputs) -> DataFrame:
    """Quantiles of response times from daily sketches, and whether their ranks are as near as the sketch promises."""
    responses = stored(x.responses, "responses")
    found = reports.response_time_quantiles(stored(reports.daily_sketches(responses), "sketches"))
    exact = responses.filter("response_seconds IS NOT NULL").select(F.col("alert_level").alias("level"), "response_seconds")
    ranked = found.join(exact, F.col("alert_level") == F.col("level"), "left").groupBy("alert_level", "alerts", "answered")

    def near(name: str, q: float) -> Column:
        """The share of values up to the found one, and of those below it, lie around the quantile."""
        share = lambda test: F.count_if(test) / F.nullif(F.count("response_seconds"), F.lit(0))
        upto, below = share(F.col("response_seconds") <= F.col(name)), share(F.col("response_seconds") < F.col(name))
        return ((upto >= q - reports.SKETCH_ERROR) & (below <= q + reports.SKETCH_ERROR)).alias(f"{name}_near")

    return ranked.agg(near("median_seconds", 0.5), near("p95_seconds", 0.95))


def hot_and_cold(x: Inputs) -> DataFrame:
    """One day archived, the others hot, and late rows of the archived day hot as well: every row once."""
    root = scratch_path(x.spark, "history")
    table = _hot_zones(x, root)
    days = sorted({*table.days(dt.date.max), ARCHIVE_DAY})
    both = archive.history_union(table, "zip_aggregations", days, f"{root}/cold")
    return both.select("window_start", "zip_code", "load_mw", "meter_count", "peak_load_kw")


def late_segments(x: Inputs) -> DataFrame:
    """What the archive of a day holds after its late rows came, by segment."""
    root = scratch_path(x.spark, "late-rows")
    table = _hot_zones(x, root)
    archive.archive_one_day(archive.ArchivedTable(table), "zip_aggregations", ARCHIVE_DAY, f"{root}/cold", CFG)
    found = archive.manifests(x.spark, f"{root}/cold", "zip_aggregations", ARCHIVE_DAY)
    return found.select("table_name", "archive_date", "run", "source_count", "exported_count")


def _live(x: Inputs) -> LiveFrames:
    """Over a look-back that is longer than the plan's by what a trend frame reaches back."""
    seconds = CFG.renewable_recent_s + CFG.frame_rows * CFG.minute_window_s
    return live_frames(x.readings, CFG, F.lit(AS_OF), seconds)


def recent_plan(x: Inputs) -> DataFrame:
    live = _live(x)
    state = renewables.renewable_state(live.zones, live.predictions, x.assets, CFG, as_of=F.lit(AS_OF))
    return renewables.reallocation_plan(state, CFG)


def accuracy_csv(x: Inputs) -> DataFrame:
    path = scratch_path(x.spark, "report")
    report = reports.prediction_accuracy(x.predictions, x.minute, CFG)
    reports.write_csv(report, path)
    return x.spark.read.schema(report.schema).option("header", True).csv(path)


# ---- Streams: run over what is there, then read back what was written ----


def _streamed(x: Inputs, stream: DataFrame) -> DataFrame:
    root = scratch_path(x.spark, "stream")
    jobs.append_to_path(stream, f"{root}/out", f"{root}/checkpoint", availableNow=True).awaitTermination()
    return x.spark.read.parquet(f"{root}/out")


def _into_table(x: Inputs, stream: DataFrame) -> DataFrame:
    """The same into a table of the catalog."""
    table = f"live_{uuid.uuid4().hex[:12]}"
    checkpoint = scratch_path(x.spark, "table-stream")
    jobs.append_to_table(stream, table, checkpoint, availableNow=True).awaitTermination()
    return x.spark.table(table)


#: The prediction stream gets the readings in this many arrivals, in the order of time.
ARRIVALS = 3


def _predicted(x: Inputs) -> jobs.PredictionTables:
    root = scratch_path(x.spark, "predictions")
    tables = jobs.PredictionTables(f"{root}/out")
    for arrival in in_order(x):
        arrival.write.mode("append").parquet(f"{root}/in")
        stream = source.with_stream_time(x.spark.readStream.schema(ARRIVING).parquet(f"{root}/in"))
        jobs.start_predictions(stream, tables, f"{root}/checkpoint", CFG, availableNow=True).awaitTermination()
    return tables


ARRIVING = "event_time TIMESTAMP_NTZ, zip_code STRING, power_kw DOUBLE"


def _arriving(x: Inputs, arrivals: list[DataFrame], live: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Deliver frames of readings one after the other, each to a query that resumes from the same checkpoint."""
    root = scratch_path(x.spark, "arrivals")
    for arrival in arrivals:
        arrival.write.mode("append").parquet(f"{root}/in")
        stream = source.with_stream_time(x.spark.readStream.schema(arrival.schema).parquet(f"{root}/in"))
        query = jobs.append_to_path(live(stream), f"{root}/out", f"{root}/checkpoint", availableNow=True)
        query.awaitTermination()
    return x.spark.read.parquet(f"{root}/out")


def in_order(x: Inputs) -> list[DataFrame]:
    """The readings in a few arrivals, in the order of time; those without a time come last."""
    needed = x.readings.select("event_time", "zip_code", "power_kw")
    first, last = needed.agg(F.min("event_time"), F.max("event_time")).first()
    cuts = [] if first is None else [first + (last - first) * n / ARRIVALS for n in range(1, ARRIVALS)]
    edges = [None, *cuts, None]
    return [loads.in_range(needed, None, begin, end, "event_time") for begin, end in zip(edges, edges[1:])]


def sent_twice(x: Inputs) -> DataFrame:
    """Every reading twice at once, then the newest ones and some that are long closed again."""
    readings = x.readings.select("meter_id", "event_time", "zip_code")
    newest = readings.agg(F.max("event_time")).first()[0]
    again = readings if newest is None else readings.filter(
        (F.col("event_time") >= F.lit(newest - dt.timedelta(hours=5))) | (F.col("event_time") < F.lit(newest - dt.timedelta(days=20)))
    )
    arrivals = [readings.unionByName(readings), again]
    return _arriving(x, arrivals, lambda stream: source.unique_readings(stream, CFG.grid_watermark))


def late_data(x: Inputs) -> DataFrame:
    """Deliver the younger half of the readings first; of the older half only rows the watermark still admits count."""
    root = scratch_path(x.spark, "late")
    needed = x.readings.select("event_time", "zip_code", "power_kw")
    half = F.lit(dt.datetime(2024, 1, 16))
    for arrival in (needed.filter(F.col("event_time") >= half), needed.filter(F.col("event_time") < half)):
        arrival.write.mode("append").parquet(f"{root}/in")
        stream = source.with_stream_time(x.spark.readStream.schema(ARRIVING).parquet(f"{root}/in"))
        query = jobs.append_to_path(
            jobs.minute_load_stream(stream, CFG), f"{root}/out", f"{root}/checkpoint", availableNow=True
        )
        query.awaitTermination()
    return x.spark.read.parquet(f"{root}/out")


REGISTRY: dict[str, Query] = {
    # readings and loads
    "readings_parse": lambda x: source.parse_readings(x.messages),
    "recent_window": lambda x: x.minute_since(CFG.overload_history_s),
    "zip_load": lambda x: x.zones,
    "minute_load": lambda x: x.minute,
    "grid_wide": lambda x: x.grid,
    "load_history": lambda x: loads.load_history(x.minute, CFG, 86_400),
    "load_history_zone": lambda x: loads.load_history(x.minute, CFG, 86_400, DETAIL_ZONE, *SOME_DAYS),
    "rejected_readings": lambda x: loads.rejected_readings(x.readings, CFG),
    # trend, forecast, overload
    "load_lag_lead": lambda x: forecast.load_lag_lead(x.minute, CFG),
    "rolling_15": lambda x: forecast.rolling_15(x.minute, CFG),
    "load_acceleration": lambda x: forecast.load_acceleration(x.minute, CFG).select(
        "zip_code", "window_start", "minute_load_kw", "prev_load", "load_acceleration"
    ),
    "growth_regime": lambda x: forecast.load_acceleration(x.minute, CFG).select(
        "zip_code", "window_start", "load_volatility", "growth_regime"
    ),
    "trend_forecast": lambda x: forecast.trend_forecast(x.minute, CFG),
    "minutes_to_overload": lambda x: forecast.minutes_to_overload(x.minute, CFG),
    "imminent_overload": lambda x: forecast.imminent_overload(x.minute, CFG),
    "imminent_overload_recent": lambda x: forecast.imminent_overload(
        x.minute_since(CFG.overload_history_s), CFG, as_of=F.lit(AS_OF)
    ),
    "overload_predictions": lambda x: x.predictions,
    "zone_overload_predictions": lambda x: forecast.overload_predictions(x.minute, CFG, x.capacity).select(
        "zip_code", "window_start", "overload_risk_score", "alert_level", "estimated_minutes_to_overload"
    ),
    "alert_payload": lambda x: parsed_payload(forecast.alert_payload(x.predictions)),
    "overload_alert_rule": lambda x: forecast.overload_alert_rule(x.predictions, CFG),
    "overload_alert_fires": lambda x: forecast.overload_alert_fires(x.predictions, CFG),
    # surges and heat
    "zip_trend": lambda x: surge.zip_trend(x.minute, CFG),
    "surging_zones": lambda x: surge.surging_zones(x.minute, CFG),
    "correlated_surge": lambda x: joined_zips(surge.correlated_surge(x.minute, CFG)),
    "correlated_surge_recent": lambda x: joined_zips(
        surge.correlated_surge(x.minute_since(CFG.surge_history_s), CFG, as_of=F.lit(AS_OF))
    ),
    "heatwave_runs": lambda x: surge.heatwave_runs(x.grid, CFG).drop("run"),
    "event_replay": lambda x: surge.event_replay(x.rolled.grid, x.rolled.minute, CFG),
    "event_replay_one": lambda x: surge.event_replay(x.rolled.grid, x.rolled.minute, CFG, first_event(x)),
    # renewables
    "load_prediction_join": lambda x: renewables.load_prediction_join(x.zones, x.predictions, CFG),
    "renewable_state": lambda x: x.state,
    "reallocation_plan": lambda x: renewables.reallocation_plan(x.state, CFG),
    "reallocation_plan_recent": recent_plan,
    "reallocation_plan_aligned": lambda x: renewables.reallocation_plan(x.aligned_state, CFG),
    "renewable_balance": lambda x: renewables.renewable_balance(x.aligned_state, CFG),
    "renewable_utilization": lambda x: renewables.renewable_utilization(x.zones, x.assets),
    "renewable_utilization_range": lambda x: renewables.renewable_utilization(x.zones, x.assets, *SOME_WEEK),
    "transfer_pairs": lambda x: x.pairs,
    "transfer_impact": lambda x: renewables.transfer_impact(x.pairs, x.rolled.predictions, CFG),
    # status
    "zone_capacity_pct": lambda x: status.zone_capacity_pct(x.minute, x.capacity, CFG),
    "critical_zones": lambda x: status.critical_zones(x.minute, x.capacity, CFG),
    "zone_status": lambda x: status.zone_status(x.rolled.zones, x.rolled.predictions, x.capacity, CFG),
    "zone_status_recent": lambda x: status.zone_status(_live(x).zones, _live(x).predictions, x.capacity, CFG),
    "grid_header": lambda x: status.grid_header(
        x.rolled.grid, x.rolled.zones, renewables.renewable_balance(x.aligned_state, CFG), x.capacity, CFG
    ),
    "silences": lambda x: status.silences(x.readings, CFG, F.lit(AS_OF)),
    "stale_zones": lambda x: status.stale_zones(x.readings, F.lit(AS_OF), CFG),
    "prediction_history": lambda x: status.prediction_history(x.predictions),
    "prediction_history_zone": lambda x: status.prediction_history(x.predictions, DETAIL_ZONE, *SOME_DAYS),
    "alert_history": lambda x: status.alert_history(x.predictions),
    "alert_history_zone": lambda x: status.alert_history(x.predictions, *SOME_DAYS, "HIGH", DETAIL_ZONE),
    "recent_alerts": lambda x: status.recent_alerts(x.predictions, CFG),
    "grid_tail": lambda x: status.grid_tail(x.grid, CFG),
    "recent_alerts_dated": lambda x: status.recent_alerts_of(_dated(x, x.predictions, "dated-predictions"), CFG),
    "grid_tail_dated": lambda x: status.grid_tail_of(_dated(x, x.grid, "dated-grid"), CFG),
    "zone_detail": lambda x: status.zone_detail(x.minute, DETAIL_ZONE, CFG),
    # reports
    "prediction_accuracy": lambda x: reports.prediction_accuracy(x.predictions, x.minute, CFG),
    "response_times": lambda x: x.responses,
    "response_time_stats": lambda x: reports.response_time_stats(x.responses),
    "response_time_stats_week": lambda x: reports.response_time_stats(
        reports.response_times(x.predictions, x.actions, CFG, F.lit(AS_OF), days=7)
    ),
    "action_rate": lambda x: reports.action_rate(x.actions, CFG),
    "period_profile": lambda x: reports.period_profile(x.readings),
    "temp_correlation": lambda x: reports.temp_correlation(x.zones),
    "temp_correlation_range": lambda x: reports.temp_correlation_range(
        stored(reports.daily_moments(x.zones), "moments"), *map(F.lit, SOME_DATES)
    ),
    "prediction_accuracy_range": lambda x: reports.prediction_accuracy_range(
        stored(reports.daily_errors(x.predictions, x.minute, CFG), "errors"), *map(F.lit, SOME_DATES)
    ),
    "response_time_quantiles": sketched,
    "report_csv": accuracy_csv,
    # archive
    "archive_date": archive_dates,
    "archive_slice": lambda x: archive.day_slice(x.readings, ARCHIVE_DAY, "event_time"),
    "archive_validate": lambda x: archive.archive_validate(x.counted_tables(), ARCHIVE_DAY, CFG),
    "compact_day": compacted,
    "compact_day_zorder": lambda x: compacted(x, "zorder"),
    "archived_zone_history": archived_zone_history,
    "lifecycle_plan": planned_lifecycle,
    "lifecycle_run": lived,
    "archive_volume": archive_volume,
    "archive_export": export_day,
    "archive_late_rows": late_segments,
    "purge_retained": lambda x: archive.purge_retained(x.zones, ARCHIVE_DAY).select(
        "window_start", "zip_code", "load_mw", "meter_count"
    ),
    "history_union": hot_and_cold,
    "storage_tier": tier_summary,
    "cost_savings": savings,
    # streams
    "s_readings": lambda x: _streamed(x, source.parse_readings(as_messages(x.stream()))),
    "s_zip_load": lambda x: _streamed(x, jobs.zip_load_stream(x.stream(), CFG)),
    "s_minute_load": lambda x: _streamed(x, jobs.minute_load_stream(x.stream(), CFG)),
    "s_minute_load_table": lambda x: _into_table(x, jobs.minute_load_stream(x.stream(), CFG)),
    "s_grid_wide": lambda x: _streamed(x, jobs.grid_wide_stream(x.stream(), CFG)),
    "s_predictions": lambda x: _predicted(x).read(x.spark, "overload_predictions"),
    "s_alerts": lambda x: parsed_payload(_predicted(x).read(x.spark, "alerts")),
    "s_predictions_stateful": lambda x: _arriving(x, in_order(x), lambda s: stateful.predictions_stream(s, CFG)),
    "s_alerts_stateful": lambda x: parsed_payload(_arriving(x, in_order(x), lambda s: stateful.alerts_stream(s, CFG))),
    "s_correlated_surge": lambda x: joined_zips(
        _arriving(x, in_order(x), lambda s: stateful.correlated_surge_stream(s, CFG))
    ),
    "s_stale_zones": lambda x: _arriving(x, in_order(x), lambda s: stateful.silence_stream(s, CFG)),
    "s_unique_readings": sent_twice,
    "s_late_data": late_data,
}


def joined_zips(df: DataFrame) -> DataFrame:
    return df.withColumn("affected_zips", F.array_join("affected_zips", ","))


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(REGISTRY[name](Inputs(spark, sf_dir)))
