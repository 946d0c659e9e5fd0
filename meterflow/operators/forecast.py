"""Trend, forecast, risk and time to overload per zone, from its minute loads.

Frames count rows: over a missing minute the previous row is simply the one before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from meterflow.config import GridConfig
from meterflow.functions import labels
from meterflow.functions.exact import shown, to_mw
from meterflow.operators.history import over_history
from meterflow.operators.loads import since

LOAD = "minute_load_kw"


def _lag(rows: int, w: WindowSpec) -> Column:
    return F.lag(LOAD, rows).over(w)


def _rolling(w: WindowSpec, cfg: GridConfig) -> WindowSpec:
    return w.rowsBetween(1 - cfg.frame_rows, 0)


def forecast_reach(cfg: GridConfig) -> int:
    """Rows that the widest of a trend's frames and lags reaches back."""
    return max(cfg.frame_rows - 1, cfg.slope_lag, 1)


def load_lag_lead(minute: DataFrame, cfg: GridConfig, bounded: bool = False) -> DataFrame:
    def columns(w: WindowSpec) -> dict[str, Column]:
        return {
            "prev_load": _lag(1, w),
            "load_3min_ago": _lag(cfg.surge_lag, w),
            "load_5min_ago": _lag(cfg.slope_lag, w),
            "future_5min_load": F.lead(LOAD, cfg.lead_rows).over(w),
        }

    back = max(1, cfg.surge_lag, cfg.slope_lag)
    return over_history(minute, columns, cfg, back=back, ahead=cfg.lead_rows, bounded=bounded)


def rolling_15(minute: DataFrame, cfg: GridConfig, bounded: bool = False) -> DataFrame:
    def columns(w: WindowSpec) -> dict[str, Column]:
        frame = _rolling(w, cfg)
        return {
            "cumulative_15min_mw": F.sum(LOAD).over(frame),
            "ma_15min": F.avg(LOAD).over(frame),
            "load_volatility": F.stddev(LOAD).over(frame),
        }

    return over_history(minute, columns, cfg, back=cfg.frame_rows - 1, bounded=bounded)


def load_acceleration(minute: DataFrame, cfg: GridConfig, bounded: bool = False) -> DataFrame:
    """Change since the previous row, with the regime it means."""

    def columns(w: WindowSpec) -> dict[str, Column]:
        return {
            "prev_load": _lag(1, w),
            "cumulative_15min_mw": F.sum(LOAD).over(_rolling(w, cfg)),
            "load_volatility": F.stddev(LOAD).over(_rolling(w, cfg)),
        }

    rows = over_history(minute, columns, cfg, back=forecast_reach(cfg), bounded=bounded)
    change = F.col(LOAD) - F.col("prev_load")
    return rows.withColumn("load_acceleration", change).withColumn(
        "growth_regime", labels.growth_regime(F.col("load_acceleration"), F.col("load_volatility"), cfg)
    )


def overload_minutes(load: Column, change: Column, capacity: Column, cfg: GridConfig) -> Column:
    """Minutes until a load that keeps growing by `change` reaches its capacity."""
    left = (capacity * cfg.overload_fraction - load) / F.nullif(change, F.lit(0.0))
    return F.when(change > 0, F.greatest(F.lit(0.0), left)).otherwise(F.lit(cfg.no_overload_minutes))


def risk_score(forecast: Column, slope: Column, capacity: Column, cfg: GridConfig) -> Column:
    return F.when(slope > cfg.slope_gate_kw, F.least(F.lit(100.0), forecast / capacity * 100)).otherwise(F.lit(0.0))


def trend_forecast(minute: DataFrame, cfg: GridConfig, bounded: bool = False) -> DataFrame:
    def columns(w: WindowSpec) -> dict[str, Column]:
        load = F.col(LOAD)
        return {
            "load_acceleration": load - _lag(1, w),
            "cumulative_15min_load": F.sum(LOAD).over(_rolling(w, cfg)),
            "avg_15min_load": F.avg(LOAD).over(_rolling(w, cfg)),
            "load_trend_slope": (load - _lag(cfg.slope_lag, w)) / float(cfg.slope_lag),
        }

    return with_forecasts(over_history(minute, columns, cfg, back=forecast_reach(cfg), bounded=bounded), cfg)


def with_forecasts(rows: DataFrame, cfg: GridConfig) -> DataFrame:
    """Loads ahead, if the slope holds."""
    load, slope = F.col(LOAD), F.col("load_trend_slope")
    return rows.withColumns(
        {
            "predicted_next_minute": load + slope,
            "predicted_5min": load + slope * cfg.near_rows,
            "predicted_15min": load + slope * cfg.horizon_rows,
        }
    )


def with_capacity(df: DataFrame, capacity: DataFrame | None, default_kw: float) -> DataFrame:
    """Add `capacity_kw`: the zone's own where the dimension has one, else the default."""
    if capacity is None:
        return df.withColumn("capacity_kw", F.lit(float(default_kw)))
    own = capacity.select("zip_code", F.col("capacity_kw").alias("_own_kw"))
    return (
        df.join(own, "zip_code", "left")
        .withColumn("capacity_kw", F.coalesce("_own_kw", F.lit(float(default_kw))))
        .drop("_own_kw")
    )


def minutes_to_overload(
    minute: DataFrame, cfg: GridConfig, capacity: DataFrame | None = None, bounded: bool = False
) -> DataFrame:
    rows = over_history(minute, lambda w: {"prev_load": _lag(1, w)}, cfg, back=1, bounded=bounded)
    rows = with_capacity(rows, capacity, cfg.overload_capacity_kw)
    load, limit = F.col(LOAD), F.col("capacity_kw")
    minutes = overload_minutes(load, load - F.col("prev_load"), limit, cfg)
    return rows.select(
        "zip_code",
        "window_start",
        LOAD,
        "prev_load",
        (load / limit * 100.0).alias("capacity_pct_now"),
        minutes.alias("estimated_minutes_to_overload"),
        labels.minute_status(minutes, cfg).alias("grid_alert_status"),
    )


def overload_predictions(
    minute: DataFrame, cfg: GridConfig, capacity: DataFrame | None = None, bounded: bool = False
) -> DataFrame:
    """The prediction row: forecast, risk score, alert level, action, minutes left."""
    return with_risk(trend_forecast(minute, cfg, bounded), cfg, capacity)


def with_risk(rows: DataFrame, cfg: GridConfig, capacity: DataFrame | None = None) -> DataFrame:
    """Score rows that have their forecasts."""
    if capacity is None:
        risk_limit, overload_limit = F.lit(cfg.risk_capacity_kw), F.lit(cfg.overload_capacity_kw)
    else:
        rows = with_capacity(rows, capacity, cfg.default_zone_capacity_kw)
        risk_limit = overload_limit = F.col("capacity_kw")
    return (
        rows.withColumn(
            "overload_risk_score", risk_score(F.col("predicted_15min"), F.col("load_trend_slope"), risk_limit, cfg)
        )
        .withColumn("alert_level", labels.risk_level(F.col("overload_risk_score"), cfg))
        .withColumn("recommended_action", labels.risk_action(F.col("alert_level"), cfg))
        .withColumn("current_load_kw", F.col(LOAD))
        .withColumn(
            "estimated_minutes_to_overload",
            overload_minutes(F.col(LOAD), F.col("load_acceleration"), overload_limit, cfg),
        )
        .drop("capacity_kw")
    )


PAYLOAD_FIELDS = (
    "zip_code",
    "window_start",
    "overload_risk_score",
    "alert_level",
    "recommended_action",
    "predicted_15min",
    "current_load_kw",
)


def alert_payload(predictions: DataFrame, *also: str) -> DataFrame:
    """Zone-keyed JSON messages of the predictions severe enough to publish, with further columns to store them by."""
    severe = predictions.filter(F.col("alert_level").isin(*labels.PUBLISHED_LEVELS))
    return severe.select(F.col("zip_code").alias("key"), F.to_json(F.struct(*PAYLOAD_FIELDS)).alias("value"), *also)


def imminent_overload(minute: DataFrame, cfg: GridConfig, as_of: Column | None = None, ordered: bool = True) -> DataFrame:
    """Zones that reach capacity soon if they keep growing as they do.

    With `as_of` only recent minutes feed the trend (so the earliest of them have no
    previous row) and only the latest are reported; without it the whole history is.
    """
    recent = since(minute, as_of, cfg.overload_history_s)
    rows = load_acceleration(recent, cfg, bounded=as_of is not None)
    load, change = F.col(LOAD), F.col("load_acceleration")
    capacity_mw = cfg.overload_capacity_kw / cfg.kw_per_mw
    rows = rows.withColumn(
        "minutes", overload_minutes(load, change, F.lit(cfg.overload_capacity_kw), cfg)
    )
    rows = since(rows, as_of, cfg.overload_recent_s).filter(F.col("minutes") < cfg.concern_minutes)
    if ordered:
        rows = rows.orderBy(F.col("minutes").asc(), F.col("window_start").desc())
    return rows.select(
        "zip_code",
        "window_start",
        shown(to_mw(load, cfg), 2).alias("current_load_mw"),
        shown(to_mw(change, cfg), 2).alias("accel_mw_per_min"),
        shown(to_mw(load + change * cfg.horizon_rows, cfg), 2).alias("projected_load_mw"),
        shown(to_mw(F.col("cumulative_15min_mw"), cfg) / capacity_mw * 100, 1).alias("capacity_pct"),
        "growth_regime",
        shown(F.col("minutes"), 1).alias("mins_to_overload"),
        labels.minute_status(F.col("minutes"), cfg).alias("grid_alert_status"),
        labels.minute_action(F.col("minutes"), cfg).alias("recommended_action"),
    )


def overload_alert_rule(predictions: DataFrame, cfg: GridConfig) -> DataFrame:
    """The predictions that trip the overload rule."""
    return predictions.filter(F.col("estimated_minutes_to_overload") < cfg.rule_minutes).select(
        "zip_code",
        "window_start",
        F.col("estimated_minutes_to_overload").alias("mins_to_overload"),
        "alert_level",
    )


def overload_alert_fires(predictions: DataFrame, cfg: GridConfig) -> DataFrame:
    """One row: how many predictions trip the rule, and whether it fires."""
    return (
        overload_alert_rule(predictions, cfg)
        .agg(F.count(F.lit(1)).alias("matching_rows"))
        .withColumn("fires", F.col("matching_rows") > 0)
    )
