"""Every threshold, span and price of the engine, in one immutable record.

The defaults are the values of the live grid (10 s zone windows, one-minute trend
windows, 50 MW zones). ``FIXTURE`` keeps the same rules on the sparse event table used
for checks: 10 s becomes one hour, one minute becomes six hours.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class GridConfig:
    # Event-time buckets (seconds) and watermarks of the streams.
    zip_window_s: int = 10
    minute_window_s: int = 60
    grid_window_s: int = 10
    zip_watermark: str = "30 seconds"
    minute_watermark: str = "5 minutes"
    grid_watermark: str = "1 minute"

    # Units. Totals don't depend on the order of addition. Where readings are known to carry
    # `load_decimals` decimals they are summed as scaled integers, which is faster; None
    # sums them as decimals that keep all digits.
    kw_per_mw: float = 1000.0
    load_decimals: int | None = None
    # A reading from here on is no load of a meter: it is left out of every measure and counted by `rejected_readings`.
    # Totals in scaled integers have room for less.
    largest_load_kw: float = 1e20
    largest_scaled_load_kw: float = 1e9
    reading_interval_s: int = 10

    # Row frames of the trend queries. They count rows, not minutes.
    frame_rows: int = 15
    slope_lag: int = 5
    surge_lag: int = 3
    lead_rows: int = 5
    near_rows: int = 5
    horizon_rows: int = 15

    # How a long ordered history is cut for the row frames (see operators.history).
    history_chunk_s: int = 4 * 86_400

    # Overload.
    overload_capacity_kw: float = 50_000.0
    overload_fraction: float = 1.0
    risk_capacity_kw: float = 50_000.0
    default_zone_capacity_kw: float = 50_000.0
    slope_gate_kw: float = 1_000.0
    volatility_kw: float = 5_000.0
    explosive_kw: float = 1_000.0
    rapid_kw: float = 500.0
    no_overload_minutes: float = 999.0
    concern_minutes: float = 60.0
    minute_levels: tuple[float, float, float] = (5.0, 15.0, 30.0)
    risk_levels: tuple[float, float, float] = (80.0, 60.0, 40.0)
    rule_minutes: float = 15.0
    wording: str = "codes"  # or "full": spell status and action out as sentences

    # Surges and heat.
    surge_significant_kw: float = 1_000.0
    surge_surging_kw: float = 2_000.0
    surge_min_zones: int = 2
    multi_zone_above: int = 3
    widespread_above: int = 5
    widespread_total_kw: float = 50_000.0
    heatwave_f: float = 95.0

    # Renewables.
    deficit_ratio: float = 1.2
    transfer_share: float = 0.8
    transfer_floor_mw: float = 5.0
    request_floor_mw: float = 2.0
    export_risk_below: float = 30.0
    import_risk_above: float = 60.0

    # Look-backs of the live queries (seconds before `as_of`).
    overload_history_s: int = 20 * 60
    overload_recent_s: int = 5 * 60
    surge_history_s: int = 10 * 60
    renewable_recent_s: int = 2 * 60

    # Status cards.
    capacity_bands: tuple[float, float, float] = (95.0, 80.0, 60.0)
    temp_bands: tuple[float, float] = (95.0, 85.0)
    critical_zone_pct: float = 80.0
    stale_after_s: int = 30
    recent_alerts: int = 50
    tail_points: int = 101
    detail_rows: int = 100
    rate_window_s: int = 60
    rate_limit: int = 10

    # Archive.
    archive_after_days: int = 30
    hot_days: int = 7
    warm_days: int = 30
    archive_days: int = 90
    delete_days: int = 2_555
    minimum_raw_rows: int = 1_000
    minimum_rows: int = 100
    hot_price_gb_month: float = 0.0184
    archive_price_gb_month: float = 0.00099
    row_bytes: int = 120
    rows_per_file: int = 5_000_000

    @property
    def readings_per_minute(self) -> float:
        """Readings of one meter in a minute window; a minute load is their sum."""
        return self.minute_window_s / self.reading_interval_s

    @property
    def credible_below_kw(self) -> float:
        """The limit that holds with this way of adding up."""
        return self.largest_load_kw if self.load_decimals is None else self.largest_scaled_load_kw

    @property
    def mw_decimals(self) -> int | None:
        """Decimals of an exact load expressed in MW."""
        if self.load_decimals is None:
            return None
        return self.load_decimals + round(math.log10(self.kw_per_mw))

    def with_(self, **changes) -> GridConfig:
        return replace(self, **changes)


REFERENCE = GridConfig()

FIXTURE = GridConfig(
    zip_window_s=3_600,
    minute_window_s=6 * 3_600,
    grid_window_s=3_600,
    zip_watermark="3 hours",
    minute_watermark="30 hours",
    grid_watermark="6 hours",
    kw_per_mw=10.0,
    load_decimals=2,
    reading_interval_s=3_600,
    history_chunk_s=10 * 86_400,
    overload_capacity_kw=1_000.0,
    risk_capacity_kw=2_200.0,
    slope_gate_kw=20.0,
    volatility_kw=120.0,
    explosive_kw=200.0,
    rapid_kw=100.0,
    surge_significant_kw=20.0,
    surge_surging_kw=40.0,
    widespread_total_kw=800.0,
    heatwave_f=55.0,
    critical_zone_pct=15.0,
    overload_history_s=20 * 60 * 360,
    overload_recent_s=5 * 60 * 360,
    surge_history_s=10 * 60 * 360,
    renewable_recent_s=2 * 60 * 360,
    stale_after_s=30 * 360,
    rate_window_s=60 * 360,
    rate_limit=3,
    minimum_raw_rows=100,
    minimum_rows=50,
    row_bytes=1_000_000,
)
