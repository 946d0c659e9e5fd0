"""What control rooms look at: zone cards, the grid header, alert lists, capacity and staleness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.config import GridConfig
from meterflow.functions import labels
from meterflow.functions.exact import exact_total, percent
from meterflow.operators.forecast import forecast_reach, trend_forecast, with_capacity
from meterflow.operators.history import over_history
from meterflow.operators.loads import in_range
from meterflow.sources.tables import HotTable, newest_rows


def _latest(df: DataFrame, measures: list[str]) -> DataFrame:
    """Newest row per zone, numeric columns only.

    Each task hashes its rows down to one per zone before anything moves, however long the
    history. (Strings or structs would make Spark sort the rows instead of hashing them.)
    """
    return df.groupBy("zip_code").agg(
        F.max("window_start").alias("last_update"), *(F.max_by(m, "window_start").alias(m) for m in measures)
    )


def zone_capacity_pct(minute: DataFrame, capacity: DataFrame, cfg: GridConfig) -> DataFrame:
    """Mean load of a minute against capacity. A minute load sums several readings of each meter."""
    rows = with_capacity(minute, capacity, cfg.default_zone_capacity_kw)
    return rows.select(
        "zip_code",
        "window_start",
        "minute_load_kw",
        "capacity_kw",
        percent(F.col("minute_load_kw") / cfg.readings_per_minute, F.col("capacity_kw")).alias("capacity_pct"),
    )


def critical_zones(minute: DataFrame, capacity: DataFrame, cfg: GridConfig) -> DataFrame:
    return zone_capacity_pct(minute, capacity, cfg).filter(F.col("capacity_pct") > cfg.critical_zone_pct)


def zone_status(loads: DataFrame, predictions: DataFrame, capacity: DataFrame, cfg: GridConfig) -> DataFrame:
    """One card per zone: its newest load, with the trend and alert level of its newest prediction."""
    cards = with_capacity(
        _latest(loads, ["load_mw", "avg_temp_f", "meter_count"]), capacity, cfg.default_zone_capacity_kw
    )
    outlook = _latest(predictions, ["load_acceleration", "overload_risk_score"]).drop("last_update")
    used = percent(F.col("load_mw") * cfg.kw_per_mw, F.col("capacity_kw"))
    return cards.join(outlook, "zip_code", "left").select(
        "zip_code",
        "last_update",
        F.col("load_mw").alias("current_load_mw"),
        used.alias("capacity_utilization_pct"),
        "avg_temp_f",
        "meter_count",
        labels.trend(F.col("load_acceleration")).alias("trend"),
        F.when(F.col("overload_risk_score").isNotNull(), labels.risk_level(F.col("overload_risk_score"), cfg)).alias(
            "alert_level"
        ),
        labels.capacity_band(used, cfg).alias("capacity_band"),
        labels.temp_band(F.col("avg_temp_f"), cfg).alias("temp_band"),
    )


def grid_header(
    grid: DataFrame, loads: DataFrame, balance: DataFrame, capacity: DataFrame, cfg: GridConfig
) -> DataFrame:
    """Grid totals per window with capacity use, headroom and the renewable balance of the minute it lies in, if known."""
    reporting = (
        with_capacity(loads, capacity, cfg.default_zone_capacity_kw)
        .groupBy("window_start")
        .agg(
            exact_total("load_mw", cfg.mw_decimals).alias("load_mw"),
            (F.sum("capacity_kw") / cfg.kw_per_mw).alias("capacity_mw"),
        )
    )
    return (
        grid.join(reporting, "window_start")
        .withColumn("_minute", F.window("window_start", f"{cfg.minute_window_s} seconds").getField("start"))
        .join(balance.withColumnRenamed("window_start", "_minute"), "_minute", "left")
        .select(
            "window_start",
            F.col("grid_load_mw").alias("total_grid_load_mw"),
            "active_meters",
            "single_peak_kw",
            "avg_temp_f",
            "heatwave_active",
            percent(F.col("load_mw"), F.col("capacity_mw")).alias("capacity_pct"),
            (F.col("capacity_mw") - F.col("load_mw")).alias("headroom_mw"),
            "renewable_surplus_mw",
            "renewable_deficit_zones",
        )
    )


def stale_zones(readings: DataFrame, as_of: Column, cfg: GridConfig) -> DataFrame:
    """Newest reading per zone, and whether it is too old at `as_of`."""
    newest = readings.groupBy("zip_code").agg(F.max("event_time").alias("last_update"))
    limit = as_of - F.make_dt_interval(secs=F.lit(cfg.stale_after_s))
    return newest.withColumn("is_stale", F.col("last_update") < limit)


SILENT, RETURNED = "SILENT", "RETURNED"


def seen_windows(readings: DataFrame, cfg: GridConfig, *also: Column) -> DataFrame:
    """First and last event time per zone and short window: all that a search for gaps needs of the readings."""
    if cfg.zip_window_s > cfg.stale_after_s:
        raise ValueError("a zone may fall silent inside one window")
    window = F.window("event_time", f"{cfg.zip_window_s} seconds")
    return (
        readings.groupBy(window, "zip_code")
        .agg(F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"))
        .select(F.col("window.start").alias("window_start"), "zip_code", "first_seen", "last_seen", *also)
    )


def silences(readings: DataFrame, cfg: GridConfig, as_of: Column | None = None) -> DataFrame:
    """When zones fell silent, `stale_after_s` after a last reading, and when they returned.

    `zip_code, status, changed_at, last_seen`. A zone that never returns is silent if its limit lies
    before `as_of` (without it, always). Rows without a time count for nothing; readings
    without a zone are one zone.
    """
    rows = over_history(
        seen_windows(readings, cfg),
        lambda w: {"before": F.lag("last_seen").over(w), "after": F.lead("first_seen").over(w)},
        cfg,
        back=1,
        ahead=1,
    )
    limit = F.make_dt_interval(secs=F.lit(cfg.stale_after_s))
    silent = rows.withColumn("changed_at", F.col("last_seen") + limit).filter(
        (F.col("after") > F.col("changed_at"))
        | F.col("after").isNull() & (F.lit(True) if as_of is None else F.col("changed_at") <= as_of)
    )
    returned = rows.filter(F.col("first_seen") > F.col("before") + limit)
    return silent.select("zip_code", F.lit(SILENT).alias("status"), "changed_at", "last_seen").unionByName(
        returned.select(
            "zip_code", F.lit(RETURNED).alias("status"), F.col("first_seen").alias("changed_at"), F.col("before").alias("last_seen")
        )
    )


def prediction_history(predictions: DataFrame, zone: str | None = None, start=None, end=None) -> DataFrame:
    return in_range(predictions, zone, start, end).select(
        "zip_code",
        "window_start",
        "current_load_kw",
        "load_trend_slope",
        "predicted_next_minute",
        "predicted_5min",
        "predicted_15min",
        "overload_risk_score",
        "alert_level",
    )


ALERT_FIELDS = ["zip_code", "window_start", "window_end", "alert_level", "overload_risk_score", "recommended_action"]


def alert_history(
    predictions: DataFrame, start=None, end=None, severity: str | None = None, zone: str | None = None
) -> DataFrame:
    """Predictions above the lowest level, or of one level."""
    rows = in_range(predictions, zone, start, end)
    wanted = [severity] if severity else list(labels.RISK_LABELS)
    return rows.filter(F.col("alert_level").isin(wanted)).select(*ALERT_FIELDS)


def published(predictions: DataFrame) -> DataFrame:
    return predictions.filter(F.col("alert_level").isin(*labels.PUBLISHED_LEVELS))


def recent_alerts(predictions: DataFrame, cfg: GridConfig) -> DataFrame:
    """The newest published alerts."""
    newest = published(predictions).orderBy(F.col("window_end").desc(), "zip_code")
    return newest.limit(cfg.recent_alerts).select(*ALERT_FIELDS)


def recent_alerts_of(table: HotTable, cfg: GridConfig) -> DataFrame:
    """The same from stored predictions, reading back only as many days as hold them."""
    return recent_alerts(newest_rows(table, published, cfg.recent_alerts), cfg)


def grid_tail(grid: DataFrame, cfg: GridConfig) -> DataFrame:
    """The newest points of the grid-load chart."""
    return (
        grid.orderBy(F.col("window_start").desc())
        .limit(cfg.tail_points)
        .select("window_start", "grid_load_mw", "avg_temp_f", "heatwave_active")
    )


def grid_tail_of(table: HotTable, cfg: GridConfig) -> DataFrame:
    """The same from stored grid totals, reading back only as many days as hold them."""
    return grid_tail(newest_rows(table, lambda rows: rows, cfg.tail_points), cfg)


def zone_detail(minute: DataFrame, zone: str, cfg: GridConfig) -> DataFrame:
    """The trend arithmetic behind one zone's newest forecasts.

    The newest rows, plus as many as their frames reach back, give the same result as the
    whole history.
    """
    newest = cfg.detail_rows + forecast_reach(cfg)
    rows = in_range(minute, zone).orderBy(F.col("window_start").desc()).limit(newest)
    return (
        trend_forecast(rows, cfg, bounded=True)
        .orderBy(F.col("window_start").desc())
        .limit(cfg.detail_rows)
        .select(
            "window_start",
            "zip_code",
            "minute_load_kw",
            (F.col("minute_load_kw") - F.col("load_acceleration")).alias("prev_load"),
            F.col("cumulative_15min_load").alias("cumulative_15min"),
            F.col("load_trend_slope").alias("trend_slope"),
            "predicted_15min",
        )
    )
