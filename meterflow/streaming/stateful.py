"""Live queries that keep a zone's own state: trends, joint surges, silences.

Windows come out of the aggregate before each of these once the watermark has passed them,
so a zone's rows arrive in time order from batch to batch. What a zone has to remember is
a handful of values in RocksDB; no folder is carried along and no batch is looked up, so
any append sink will do and a restart resumes from the checkpoint alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterflow.config import GridConfig
from meterflow.operators import forecast, surge
from meterflow.operators.loads import minute_load
from meterflow.plans.status import RETURNED, SILENT, seen_windows
from meterflow.session import ship_package

#: Event time of a closed window, which later steps of a chain group by.
CLOSED_AT = "closed_at"
TREND_SCHEMA = (
    "window_start TIMESTAMP, window_end TIMESTAMP, zip_code STRING, minute_load_kw DOUBLE, load_acceleration DOUBLE, "
    "cumulative_15min_load DOUBLE, avg_15min_load DOUBLE, load_trend_slope DOUBLE, roc_3min DOUBLE, "
    f"{CLOSED_AT} TIMESTAMP"
)
MICROS = 1_000_000
SILENCE_SCHEMA = "zip_code STRING, status STRING, changed_at BIGINT, last_seen BIGINT"


class TrendRing(StatefulProcessor):
    """A zone's newest loads, as many as its frames and lags reach back, and the trends that they give.

    The same arithmetic as the row frames of a batch, in the same order, so that both agree
    bit by bit. A null load takes a place in the frame without weight.
    """

    def __init__(self, cfg: GridConfig):
        self.frame, self.slope_lag, self.surge_lag = cfg.frame_rows, cfg.slope_lag, cfg.surge_lag
        self.held = max(self.frame - 1, self.slope_lag, self.surge_lag, 1) + 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.loads = handle.getValueState("loads", "loads array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        ring = list(self.loads.get()[0]) if self.loads.exists() else []
        for row in sorted(rows, key=lambda row: row.window_start):
            ring = [*ring, row.minute_load_kw][-self.held :]
            known = [load for load in ring[-self.frame :] if load is not None]
            # One after the other, as Spark adds them; `sum` would correct its rounding on the way.
            total = reduce(add, known, 0.0) if known else None
            yield Row(
                window_start=row.window_start,
                window_end=row.window_end,
                zip_code=row.zip_code,
                minute_load_kw=row.minute_load_kw,
                load_acceleration=self._change(ring, 1),
                cumulative_15min_load=total,
                avg_15min_load=total / len(known) if known else None,
                load_trend_slope=self._rate(ring, self.slope_lag),
                roc_3min=self._rate(ring, self.surge_lag),
                closed_at=row.closed_at,
            )
        self.loads.update((ring,))

    @staticmethod
    def _change(ring: list, rows: int) -> float | None:
        if len(ring) <= rows or ring[-1] is None or ring[-1 - rows] is None:
            return None
        return ring[-1] - ring[-1 - rows]

    def _rate(self, ring: list, rows: int) -> float | None:
        change = self._change(ring, rows)
        return None if change is None else change / float(rows)

    def close(self) -> None:
        pass


def _trends(readings: DataFrame, cfg: GridConfig, time_mode: str) -> DataFrame:
    ship_package(readings.sparkSession)
    timed = readings.withWatermark("event_time", cfg.minute_watermark)
    minutes = minute_load(timed, cfg, F.window_time("window").alias(CLOSED_AT))
    named = {"eventTimeColumnName": CLOSED_AT} if time_mode == "eventTime" else {}
    return minutes.groupBy("zip_code").transformWithState(TrendRing(cfg), TREND_SCHEMA, "append", time_mode, **named)


def predictions_stream(readings: DataFrame, cfg: GridConfig, capacity: DataFrame | None = None) -> DataFrame:
    """Predictions of every closed minute, as `overload_predictions` gives them for a batch."""
    trends = _trends(readings, cfg, "none").drop("roc_3min", CLOSED_AT)
    return forecast.with_risk(forecast.with_forecasts(trends, cfg), cfg, capacity)


def alerts_stream(readings: DataFrame, cfg: GridConfig, capacity: DataFrame | None = None) -> DataFrame:
    """Keyed messages of the severe predictions, for a message sink."""
    return forecast.alert_payload(predictions_stream(readings, cfg, capacity))


def correlated_surge_stream(readings: DataFrame, cfg: GridConfig) -> DataFrame:
    """Windows in which several zones surge at once, each as soon as it is closed: minute sums, rings, then a set per window."""
    surging = surge.significant(_trends(readings, cfg, "eventTime"), cfg)
    windows = surging.groupBy(F.window(CLOSED_AT, f"{cfg.minute_window_s} seconds"))
    return surge.joint_surges(windows, F.col("window.start"), cfg)


class SilenceTimer(StatefulProcessor):
    """A zone's last reading, and a timer for the time at which it counts as silent.

    Readings reach this step once their window has closed, so the timer waits one window
    longer than the limit: by then everything before the limit has arrived. Times are
    microseconds, which do not depend on a worker's time zone.
    """

    def __init__(self, cfg: GridConfig):
        self.limit, self.window = cfg.stale_after_s * MICROS, cfg.zip_window_s * MICROS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "last_seen bigint, silent boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        last, silent = self.seen.get() if self.seen.exists() else (None, False)
        for row in sorted(rows, key=lambda row: row.first_seen):
            if last is not None and row.first_seen > last + self.limit:
                if not silent:
                    yield self._event(key, SILENT, last + self.limit, last)
                yield self._event(key, RETURNED, row.first_seen, last)
            last, silent = row.last_seen, False
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(self._due(last))
        self.seen.update((last, silent))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        last, silent = self.seen.get()
        if not silent:
            self.seen.update((last, True))
            yield self._event(key, SILENT, last + self.limit, last)

    def _due(self, last: int) -> int:
        """In milliseconds, rounded up."""
        return -(-(last + self.limit + self.window) // 1000)

    @staticmethod
    def _event(key, status: str, at: int, last: int) -> Row:
        return Row(zip_code=key[0], status=status, changed_at=at, last_seen=last)

    def close(self) -> None:
        pass


def silence_stream(readings: DataFrame, cfg: GridConfig) -> DataFrame:
    """One row when a zone falls silent and one when it returns, as `silences` finds them in a batch."""
    ship_package(readings.sparkSession)
    timed = readings.withWatermark("event_time", cfg.zip_watermark)
    seen = seen_windows(timed, cfg, F.window_time("window").alias(CLOSED_AT))
    seen = seen.withColumns({name: F.unix_micros(name) for name in ("first_seen", "last_seen")})
    events = seen.groupBy("zip_code").transformWithState(SilenceTimer(cfg), SILENCE_SCHEMA, "append", "eventTime")
    return events.withColumns({name: F.timestamp_micros(name) for name in ("changed_at", "last_seen")})
