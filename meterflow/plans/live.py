"""The frames behind live views, over a look-back that reaches the scan of the readings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from meterflow.config import GridConfig
from meterflow.operators import forecast, loads


@dataclass(frozen=True)
class LiveFrames:
    zones: DataFrame
    minute: DataFrame
    grid: DataFrame
    predictions: DataFrame


def live_frames(readings: DataFrame, cfg: GridConfig, as_of: Column | None = None, seconds: int = 86_400) -> LiveFrames:
    """Zone loads, minute loads, grid totals and predictions; with `as_of`, of the windows that start in a look-back.

    The limit is a bound on the readings' own time, below every aggregate. Predictions whose
    frames reach further back see only the rows inside, so the look-back should be longer
    than the views on it by as many minutes as a frame has rows.
    """

    def within(bucket_s: int) -> DataFrame:
        return readings if as_of is None else loads.recent_readings(readings, as_of, seconds, bucket_s)

    minute = loads.minute_load(within(cfg.minute_window_s), cfg)
    return LiveFrames(
        zones=loads.zip_load(within(cfg.zip_window_s), cfg),
        minute=minute,
        grid=loads.grid_wide(within(cfg.grid_window_s), cfg),
        predictions=forecast.overload_predictions(minute, cfg, bounded=as_of is not None),
    )


def rolled_up(parts: DataFrame, cfg: GridConfig) -> LiveFrames:
    """The same frames from stored `loads.zone_parts`: however many of them a product joins, the readings are read once."""
    minute = loads.minute_load_of(parts, cfg)
    return LiveFrames(
        zones=loads.zip_load_of(parts, cfg),
        minute=minute,
        grid=loads.grid_wide_of(parts, cfg),
        predictions=forecast.overload_predictions(minute, cfg),
    )
