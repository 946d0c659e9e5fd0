"""Load per zone and for the whole grid in tumbling windows. Runs on batch and streaming readings alike.

All aggregates combine on the map side, so a zone that holds a third of the readings
still sends one partial row per task and window into the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from meterflow.config import GridConfig
from meterflow.functions.exact import exact_total, to_mw, valid


def _by_window(
    df: DataFrame, seconds: int, *keys: str, time: str = "event_time"
) -> tuple[GroupedData, list[Column]]:
    """Group by tumbling window and keys; also the two window columns to select afterwards.

    A stream must group by the window itself for its watermark to apply. A batch groups by
    the window's start, so the result is already partitioned the way later joins on
    `window_start` need it.
    """
    window = F.window(time, f"{seconds} seconds")
    if df.isStreaming:
        edges = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
        return df.groupBy(window, *keys), edges
    start = F.col("window_start")
    edges = [start, (start + F.make_dt_interval(secs=F.lit(seconds))).alias("window_end")]
    return df.withColumn("window_start", window.getField("start")).groupBy("window_start", *keys), edges


def _measured(readings: DataFrame, cfg: GridConfig) -> DataFrame:
    return readings.withColumn("power_kw", valid("power_kw", cfg))


def zone_parts(readings: DataFrame, cfg: GridConfig) -> DataFrame:
    """Per zone and short window all that zone loads, minute loads and grid totals are made of."""
    windows, edges = _by_window(_measured(readings, cfg), cfg.zip_window_s, "zip_code")
    grouped = windows.agg(
        exact_total("power_kw", cfg.load_decimals).alias("total_kw"),
        F.count("power_kw").alias("measured"),
        F.count(F.lit(1)).alias("meter_count"),
        F.max("power_kw").alias("peak_load_kw"),
        F.stddev("power_kw").alias("load_stddev"),
        F.avg("voltage").alias("avg_voltage"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("temperature_f").alias("avg_temp_f"),
        F.avg("grid_stress_indicator").alias("avg_stress"),
        F.sum("temperature_f").alias("temp_sum"),
        F.count("temperature_f").alias("temp_count"),
    )
    names = [name for name in grouped.columns if name not in ("window", "window_start", "zip_code")]
    return grouped.select(*edges, "zip_code", *names)


def zip_load(readings: DataFrame, cfg: GridConfig) -> DataFrame:
    return zip_load_of(zone_parts(readings, cfg), cfg)


def zip_load_of(parts: DataFrame, cfg: GridConfig) -> DataFrame:
    return parts.select(
        "window_start",
        "window_end",
        "zip_code",
        to_mw(F.col("total_kw"), cfg).alias("load_mw"),
        F.try_divide("total_kw", "measured").alias("avg_load_kw"),
        "meter_count",
        "peak_load_kw",
        "load_stddev",
        "avg_voltage",
        "avg_frequency",
        "avg_temp_f",
        "avg_stress",
    )


def _whole_windows(cfg: GridConfig, seconds: int) -> None:
    if seconds % cfg.zip_window_s:
        raise ValueError(f"{seconds} s is no multiple of the zone windows of {cfg.zip_window_s} s")


def minute_load_of(parts: DataFrame, cfg: GridConfig) -> DataFrame:
    """Minute loads rolled up from stored zone parts instead of the readings."""
    _whole_windows(cfg, cfg.minute_window_s)
    windows, edges = _by_window(parts, cfg.minute_window_s, "zip_code", time="window_start")
    grouped = windows.agg(exact_total("total_kw", cfg.load_decimals).alias("minute_load_kw"))
    return grouped.select(*edges, "zip_code", "minute_load_kw")


def grid_wide_of(parts: DataFrame, cfg: GridConfig) -> DataFrame:
    """Grid totals rolled up from stored zone parts instead of the readings."""
    _whole_windows(cfg, cfg.grid_window_s)
    windows, edges = _by_window(parts, cfg.grid_window_s, time="window_start")
    grouped = windows.agg(
        exact_total("total_kw", cfg.load_decimals).alias("total_kw"),
        F.sum("meter_count").alias("active_meters"),
        F.max("peak_load_kw").alias("single_peak_kw"),
        F.try_divide(F.sum("temp_sum"), F.sum("temp_count")).alias("avg_temp_f"),
    )
    return _grid_columns(grouped, edges, cfg)


def minute_load(readings: DataFrame, cfg: GridConfig, *also: Column) -> DataFrame:
    """Load per zone and minute. A stream may ask for further columns of its `window`."""
    windows, edges = _by_window(_measured(readings, cfg), cfg.minute_window_s, "zip_code")
    grouped = windows.agg(exact_total("power_kw", cfg.load_decimals).alias("minute_load_kw"))
    return grouped.select(*edges, "zip_code", "minute_load_kw", *also)


def grid_wide(readings: DataFrame, cfg: GridConfig) -> DataFrame:
    windows, edges = _by_window(_measured(readings, cfg), cfg.grid_window_s)
    grouped = windows.agg(
        exact_total("power_kw", cfg.load_decimals).alias("total_kw"),
        F.count(F.lit(1)).alias("active_meters"),
        F.max("power_kw").alias("single_peak_kw"),
        F.avg("temperature_f").alias("avg_temp_f"),
    )
    return _grid_columns(grouped, edges, cfg)


def _grid_columns(grouped: DataFrame, edges: list[Column], cfg: GridConfig) -> DataFrame:
    return grouped.select(
        *edges,
        "active_meters",
        "single_peak_kw",
        "avg_temp_f",
        to_mw(F.col("total_kw"), cfg).alias("grid_load_mw"),
        (F.col("avg_temp_f") > cfg.heatwave_f).alias("heatwave_active"),
    )


def rejected_readings(readings: DataFrame, cfg: GridConfig) -> DataFrame:
    """Per zone and minute: readings, those without a load, and those whose load is not credible and left out."""
    windows, edges = _by_window(readings, cfg.minute_window_s, "zip_code")
    load = F.col("power_kw")
    return windows.agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if(load.isNull()).alias("missing"),
        F.count_if(load.isNotNull() & valid("power_kw", cfg).isNull()).alias("rejected"),
    ).select(*edges, "zip_code", "readings", "missing", "rejected")


def in_range(df: DataFrame, zone: str | None = None, start=None, end=None, time: str = "window_start") -> DataFrame:
    """Rows of one zone and of `start <= time < end`; each argument may be left out."""
    if zone is not None:
        df = df.filter(F.col("zip_code") == zone)
    if start is not None:
        df = df.filter(F.col(time) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(time) < F.lit(end))
    return df


def since(df: DataFrame, as_of: Column | None, seconds: int, time: str = "window_start") -> DataFrame:
    """Look-back filter; without `as_of` the whole history stays."""
    if as_of is None:
        return df
    limit = as_of - F.make_dt_interval(secs=F.lit(seconds))
    return df.filter(F.col(time) >= limit.cast(df.schema[time].dataType))  # of the column's own type, so that a scan can use it


def recent_readings(
    readings: DataFrame, as_of: Column, seconds: int, bucket_s: int, time: str = "event_time"
) -> DataFrame:
    """The readings of all buckets that start within a look-back.

    A bucket starts within it exactly if its readings do not lie before the first bucket
    edge in it, so the limit goes on the readings themselves, below any aggregate, and
    reaches the scan.
    """
    reach = F.unix_micros((as_of - F.make_dt_interval(secs=F.lit(seconds))).cast("timestamp"))
    edge = F.timestamp_micros(F.ceil(reach / (bucket_s * 1_000_000)) * bucket_s * 1_000_000)
    return readings.filter(F.col(time) >= edge.cast(readings.schema[time].dataType))


def load_history(
    minute: DataFrame, cfg: GridConfig, granularity_s: int, zone: str | None = None, start=None, end=None
) -> DataFrame:
    """Minute loads re-aggregated to a coarser grain. Minutes without a load count as points, not in the average."""
    windows, edges = _by_window(in_range(minute, zone, start, end), granularity_s, "zip_code", time="window_start")
    return windows.agg(
        exact_total("minute_load_kw", cfg.load_decimals).alias("total_kw"),
        F.count(F.lit(1)).alias("points"),
        F.count("minute_load_kw").alias("known"),
        F.min("minute_load_kw").alias("min_load_kw"),
        F.max("minute_load_kw").alias("max_load_kw"),
    ).select(
        *edges,
        "zip_code",
        "points",
        F.try_divide("total_kw", "known").alias("avg_load_kw"),
        "min_load_kw",
        "max_load_kw",
    )
