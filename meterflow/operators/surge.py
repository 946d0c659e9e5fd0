"""Zones that surge together, and heatwaves as runs of hot grid windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from meterflow.config import GridConfig
from meterflow.functions import labels
from meterflow.functions.exact import to_mw
from meterflow.operators.history import number_rows, over_history
from meterflow.operators.loads import since

LOAD = "minute_load_kw"


def zip_trend(minute: DataFrame, cfg: GridConfig, bounded: bool = False) -> DataFrame:
    rows = over_history(
        minute,
        lambda w: {"load_3min_ago": F.lag(LOAD, cfg.surge_lag).over(w)},
        cfg,
        back=cfg.surge_lag,
        bounded=bounded,
    )
    return rows.withColumn("roc_3min", (F.col(LOAD) - F.col("load_3min_ago")) / float(cfg.surge_lag))


def surging_zones(minute: DataFrame, cfg: GridConfig, bounded: bool = False) -> DataFrame:
    rate = F.col("roc_3min")
    return (
        significant(zip_trend(minute, cfg, bounded), cfg)
        .select("window_start", "zip_code", "roc_3min", (rate > cfg.surge_surging_kw).cast("int").alias("is_surging"))
    )


def significant(rows: DataFrame, cfg: GridConfig) -> DataFrame:
    return rows.filter(F.col("roc_3min") > cfg.surge_significant_kw)


def correlated_surge(
    minute: DataFrame, cfg: GridConfig, as_of: Column | None = None, ordered: bool = True
) -> DataFrame:
    """Windows in which several zones surge at once. A window has one row per zone, so counting rows counts zones."""
    recent = since(minute, as_of, cfg.surge_history_s)
    zones = surging_zones(recent, cfg, bounded=as_of is not None)
    together = joint_surges(zones.groupBy("window_start"), F.col("window_start"), cfg)
    return together.orderBy(F.col("window_start").desc()) if ordered else together


def joint_surges(zones: GroupedData, window_start: Column, cfg: GridConfig) -> DataFrame:
    """Surging zones grouped by window: the windows with enough of them, and what that amounts to."""
    together = zones.agg(
        F.count(F.lit(1)).alias("surging_zones"),
        F.sum("roc_3min").alias("total_kw"),
        F.sort_array(F.collect_list("zip_code")).alias("affected_zips"),
    ).filter(F.col("surging_zones") >= cfg.surge_min_zones)
    return together.select(
        window_start.alias("window_start"),
        "surging_zones",
        to_mw(F.col("total_kw"), cfg).alias("total_surge_mw"),
        "affected_zips",
        labels.surge_class(F.col("surging_zones"), F.col("total_kw"), cfg).alias("event_classification"),
    )


def _bucket_start(time: str, seconds: int) -> Column:
    return F.window(time, f"{seconds} seconds").getField("start")


def heatwave_windows(grid: DataFrame, cfg: GridConfig) -> DataFrame:
    """Hot grid windows, each with the first window of the unbroken run it belongs to.

    In a run, time and row number advance together, so their difference names the run.
    """
    hot = grid.filter("heatwave_active").select("window_start", "window_end", "avg_temp_f")
    numbered = number_rows(hot, [], "window_start", cfg.history_chunk_s, "place")
    seconds = F.unix_seconds(F.col("window_start").cast("timestamp"))
    return numbered.withColumn("run", F.floor(seconds / cfg.grid_window_s) - F.col("place")).drop("place")


def _event() -> dict[str, Column]:
    """What is told of a run of hot windows."""
    return {
        "event_start": F.min("window_start"),
        "event_end": F.max("window_end"),
        "hot_windows": F.count(F.lit(1)),
        "max_temp_f": F.max("avg_temp_f"),
    }


def heatwave_runs(grid: DataFrame, cfg: GridConfig) -> DataFrame:
    return heatwave_windows(grid, cfg).groupBy("run").agg(*[column.alias(name) for name, column in _event().items()])


def event_replay(
    grid: DataFrame, minute: DataFrame, cfg: GridConfig, event_start: dt.datetime | None = None
) -> DataFrame:
    """Every minute row in which a heatwave was on, under the event it belongs to; or those of one event.

    Hot windows name the minute they fall into, so the lookup is an equality join. A
    minute that touches two events is replayed in both. Events are summed up beside their
    windows, so the grid is gone through once.
    """
    whole = Window.partitionBy("run")
    windows = heatwave_windows(grid, cfg).withColumns({name: column.over(whole) for name, column in _event().items()})
    if event_start is not None:
        windows = windows.filter(F.col("event_start") == F.lit(event_start))
    minutes = windows.select("run", *_event(), _bucket_start("window_start", cfg.minute_window_s).alias("window_start"))
    return minutes.distinct().join(minute, "window_start").select(*_event(), "window_start", "zip_code", LOAD)
