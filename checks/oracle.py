"""The registered queries in plain SQL, for a second engine to run on the same tables.

Written from the rules, at the fixture's thresholds, and independent of the Spark code.
"""

from __future__ import annotations

import re


def _bucket(time: str, seconds: int) -> str:
    return f"(to_timestamp(floor(epoch({time}) / {seconds}) * {seconds}) AT TIME ZONE 'UTC')"


def _r(expression: str, name: str | None = None) -> str:
    return f"round({expression}, 6) + 0.0 AS {name or expression}"


def _shown(expression: str, places: int, name: str) -> str:
    """Rounded for display: binary noise first, then the places shown, as decimals so that a half goes up."""
    return _r(f"CAST(round(CAST(round({expression}, 9) AS DECIMAL(38,9)), {places}) AS DOUBLE)", name)


# Times before which the streams have emitted every window: newest reading less the delay.
_WM = "(SELECT max(event_time) FROM readings) - INTERVAL {} HOUR"

# Shared steps; a step may use earlier ones.
STEPS = {
    "readings": """
        SELECT 'meter_' || lpad(CAST(user_id AS VARCHAR), 10, '0') AS meter_id,
               lpad(CAST(user_id % 15 AS VARCHAR), 5, '0') AS zip_code,
               value AS power_kw,
               CAST(228 + k % 25 AS DOUBLE) AS voltage,
               CAST(59.95 AS DOUBLE) + (k % 11) / 100.0 AS frequency,
               CAST(k AS DOUBLE) AS temperature_f,
               k / 100.0 AS grid_stress_indicator,
               10 AS reading_interval_sec,
               ts AS event_time
        FROM (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM events)""",
    "actions": """
        SELECT 'op_' || lpad(CAST(user_id % 20 AS VARCHAR), 5, '0') AS operator_id,
               lpad(CAST(user_id % 15 AS VARCHAR), 5, '0') AS zip_code, ts
        FROM events WHERE event_type = 'click'""",
    "zones_list": """
        SELECT z, lpad(CAST(z AS VARCHAR), 5, '0') AS zip_code FROM range(15) AS t(z)""",
    "capacity": "SELECT zip_code, 800.0 + 50.0 * z AS capacity_kw FROM zones_list",
    "assets": """
        SELECT zip_code, CAST((z * 37 % 11) * 12.0 AS DOUBLE) AS solar_generation_mw,
               CASE WHEN z % 7 = 3 THEN NULL ELSE CAST((z * 53 % 7) * 9.0 AS DOUBLE) END AS wind_generation_mw,
               CAST(40 + z * 4.0 AS DOUBLE) AS battery_soc_pct
        FROM zones_list WHERE z % 5 <> 4""",
    "zone_loads": f"""
        SELECT {_bucket("event_time", 3600)} AS window_start,
               {_bucket("event_time", 3600)} + INTERVAL 1 HOUR AS window_end,
               zip_code,
               CAST(sum(CAST(power_kw AS DECIMAL(18,2))) AS DOUBLE) / 10.0 AS load_mw,
               CAST(sum(CAST(power_kw AS DECIMAL(18,2))) AS DOUBLE) / count(power_kw) AS avg_load_kw,
               count(*) AS meter_count, max(power_kw) AS peak_load_kw, stddev(power_kw) AS load_stddev,
               avg(voltage) AS avg_voltage, avg(frequency) AS avg_frequency,
               avg(temperature_f) AS avg_temp_f, avg(grid_stress_indicator) AS avg_stress
        FROM readings GROUP BY 1, 2, 3""",
    "minute": f"""
        SELECT {_bucket("event_time", 21600)} AS window_start,
               {_bucket("event_time", 21600)} + INTERVAL 6 HOUR AS window_end,
               zip_code, CAST(sum(CAST(power_kw AS DECIMAL(18,2))) AS DOUBLE) AS minute_load_kw
        FROM readings GROUP BY 1, 2, 3""",
    "grid": f"""
        SELECT {_bucket("event_time", 3600)} AS window_start,
               {_bucket("event_time", 3600)} + INTERVAL 1 HOUR AS window_end,
               count(*) AS active_meters, max(power_kw) AS single_peak_kw, avg(temperature_f) AS avg_temp_f,
               CAST(sum(CAST(power_kw AS DECIMAL(18,2))) AS DOUBLE) / 10.0 AS grid_load_mw,
               avg(temperature_f) > 55 AS heatwave_active
        FROM readings GROUP BY 1, 2""",
    "gaps": f"""
        SELECT zip_code, event_time AS last_seen, next_time, {_bucket("next_time", 3600)} + INTERVAL 1 HOUR AS returned_window_end
        FROM (SELECT zip_code, event_time, lead(event_time) OVER (PARTITION BY zip_code ORDER BY event_time) AS next_time
              FROM readings)
        WHERE next_time IS NULL OR next_time > event_time + INTERVAL 3 HOUR""",
    "silences": """
        SELECT zip_code, 'SILENT' AS status, last_seen + INTERVAL 3 HOUR AS changed_at, last_seen, returned_window_end FROM gaps
        UNION ALL
        SELECT zip_code, 'RETURNED', next_time, last_seen, returned_window_end FROM gaps WHERE next_time IS NOT NULL""",
    "minute_recent": """
        SELECT * FROM minute WHERE window_start >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 5 DAY""",
    "minute_surge_recent": """
        SELECT * FROM minute WHERE window_start >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 60 HOUR""",
    "lagged": """
        SELECT *, lag(minute_load_kw, 1) OVER w AS prev_load, lag(minute_load_kw, 3) OVER w AS load_3min_ago,
               lag(minute_load_kw, 5) OVER w AS load_5min_ago, lead(minute_load_kw, 5) OVER w AS future_5min_load
        FROM minute WINDOW w AS (PARTITION BY zip_code ORDER BY window_start)""",
    "rolled": """
        SELECT *, minute_load_kw - prev_load AS diff, (minute_load_kw - load_5min_ago) / 5.0 AS slope,
               sum(minute_load_kw) OVER f AS sum15, avg(minute_load_kw) OVER f AS avg15,
               stddev(minute_load_kw) OVER f AS std15
        FROM lagged
        WINDOW f AS (PARTITION BY zip_code ORDER BY window_start ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)""",
    "graded": """
        SELECT *,
               CASE WHEN std15 > 120 AND diff > 200 THEN 'EXPLOSIVE_GROWTH' WHEN diff > 100 THEN 'RAPID_ACCEL'
                    WHEN diff > 0 THEN 'MODERATE_GROWTH' ELSE 'STABLE_OR_DECLINING' END AS growth_regime,
               CASE WHEN diff > 0 THEN greatest(0.0, (1000 - minute_load_kw) / nullif(diff, 0))
                    ELSE 999.0 END AS minutes
        FROM rolled""",
    "recent_graded": """
        SELECT *,
               CASE WHEN std15 > 120 AND diff > 200 THEN 'EXPLOSIVE_GROWTH' WHEN diff > 100 THEN 'RAPID_ACCEL'
                    WHEN diff > 0 THEN 'MODERATE_GROWTH' ELSE 'STABLE_OR_DECLINING' END AS growth_regime,
               CASE WHEN diff > 0 THEN greatest(0.0, (1000 - minute_load_kw) / nullif(diff, 0))
                    ELSE 999.0 END AS minutes
        FROM (SELECT *, minute_load_kw - lag(minute_load_kw, 1) OVER w AS diff,
                     sum(minute_load_kw) OVER f AS sum15, stddev(minute_load_kw) OVER f AS std15
              FROM minute_recent
              WINDOW w AS (PARTITION BY zip_code ORDER BY window_start),
                     f AS (PARTITION BY zip_code ORDER BY window_start ROWS BETWEEN 14 PRECEDING AND CURRENT ROW))
        WHERE window_start >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 HOUR""",
    "predicted": """
        SELECT *, CASE WHEN score > 80 THEN 'CRITICAL' WHEN score > 60 THEN 'HIGH' WHEN score > 40 THEN 'MEDIUM'
                       ELSE 'LOW' END AS alert_level,
               CASE WHEN score > 80 THEN 'SHED' WHEN score > 60 THEN 'RESERVES' WHEN score > 40 THEN 'MONITOR'
                    ELSE 'NORMAL' END AS recommended_action
        FROM (SELECT *, minute_load_kw + slope * 15 AS p15,
                     CASE WHEN slope > 20 THEN least(100.0, (minute_load_kw + slope * 15) / 2200.0 * 100)
                          ELSE 0.0 END AS score
              FROM graded)""",
    "trends": """
        SELECT window_start, zip_code, (minute_load_kw - load_3min_ago) / 3.0 AS roc FROM lagged""",
    "trends_recent": """
        SELECT window_start, zip_code, (minute_load_kw - lag(minute_load_kw, 3) OVER (
               PARTITION BY zip_code ORDER BY window_start)) / 3.0 AS roc
        FROM minute_surge_recent""",
    "aligned": f"""
        SELECT {_bucket("window_start", 21600)} AS window_start, zip_code,
               CAST(sum(CAST(load_mw AS DECIMAL(18,3))) AS DOUBLE) AS load_mw,
               sum(avg_temp_f * meter_count) / sum(meter_count) AS avg_temp_f
        FROM zone_loads GROUP BY 1, 2""",
    "state": """
        SELECT l.window_start, l.zip_code, l.load_mw, l.avg_temp_f, p.score AS overload_risk_score,
               p.p15 / 10.0 AS predicted_load_mw, a.solar_generation_mw, a.wind_generation_mw, a.battery_soc_pct,
               greatest(0.0, a.solar_generation_mw + a.wind_generation_mw - l.load_mw) AS renewable_surplus_mw
        FROM zone_loads l JOIN predicted p USING (zip_code, window_start) LEFT JOIN assets a USING (zip_code)""",
    "predicted_recent": """
        SELECT *, CASE WHEN score > 80 THEN 'CRITICAL' WHEN score > 60 THEN 'HIGH' WHEN score > 40 THEN 'MEDIUM'
                       ELSE 'LOW' END AS alert_level
        FROM (SELECT *, CASE WHEN slope > 20 THEN least(100.0, p15 / 2200.0 * 100) ELSE 0.0 END AS score
              FROM (SELECT *, minute_load_kw + slope * 15 AS p15
                    FROM (SELECT *, (minute_load_kw - lag(minute_load_kw, 5) OVER w) / 5.0 AS slope,
                                 minute_load_kw - lag(minute_load_kw, 1) OVER w AS diff
                          FROM minute
                          WHERE window_start >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 102 HOUR
                          WINDOW w AS (PARTITION BY zip_code ORDER BY window_start))))""",
    "state_recent": """
        SELECT l.window_start, l.zip_code, l.load_mw, l.avg_temp_f, p.score AS overload_risk_score,
               p.p15 / 10.0 AS predicted_load_mw, a.solar_generation_mw, a.wind_generation_mw, a.battery_soc_pct,
               greatest(0.0, a.solar_generation_mw + a.wind_generation_mw - l.load_mw) AS renewable_surplus_mw
        FROM zone_loads l JOIN predicted_recent p USING (zip_code, window_start) LEFT JOIN assets a USING (zip_code)""",
    "aligned_state": """
        SELECT l.window_start, l.zip_code, l.load_mw, l.avg_temp_f, p.score AS overload_risk_score,
               p.p15 / 10.0 AS predicted_load_mw,
               greatest(0.0, a.solar_generation_mw + a.wind_generation_mw - l.load_mw) AS renewable_surplus_mw
        FROM aligned l JOIN predicted p USING (zip_code, window_start) LEFT JOIN assets a USING (zip_code)""",
    "plan": """
        SELECT *, CASE WHEN renewable_surplus_mw > 0 AND overload_risk_score < 30 THEN 'EXPORT_ZONE'
                       WHEN deficit > 0 OR overload_risk_score > 60 THEN 'IMPORT_ZONE'
                       ELSE 'BALANCED_ZONE' END AS grid_role
        FROM (SELECT *, CASE WHEN predicted_load_mw > load_mw * 1.2 THEN predicted_load_mw - load_mw
                             ELSE 0.0 END AS deficit,
                     overload_risk_score * (predicted_load_mw / nullif(load_mw, 0)) + 0.0 AS priority
              FROM aligned_state)""",
    "balance": """
        SELECT window_start, sum(renewable_surplus_mw) AS surplus, count(*) FILTER (WHERE deficit > 0) AS zones
        FROM plan GROUP BY 1""",
    "offers": """
        SELECT *, sum(mw) OVER (PARTITION BY window_start ORDER BY renewable_surplus_mw DESC, zip_code
                                ROWS UNBOUNDED PRECEDING) AS hi
        FROM (SELECT *, CAST(round(renewable_surplus_mw * 0.8, 4) AS DECIMAL(18,4)) AS mw
              FROM plan WHERE grid_role = 'EXPORT_ZONE') WHERE mw > 0""",
    "requests": """
        SELECT *, sum(mw) OVER (PARTITION BY window_start ORDER BY priority DESC NULLS LAST, zip_code
                                ROWS UNBOUNDED PRECEDING) AS hi
        FROM (SELECT *, CAST(round(deficit, 4) AS DECIMAL(18,4)) AS mw
              FROM plan WHERE grid_role = 'IMPORT_ZONE') WHERE mw > 0""",
    "pairs": """
        SELECT o.window_start, o.zip_code AS source_zip, r.zip_code AS target_zip,
               CAST(least(o.hi, r.hi) - greatest(o.hi - o.mw, r.hi - r.mw) AS DOUBLE) AS transfer_mw
        FROM offers o JOIN requests r ON o.window_start = r.window_start
             AND o.hi - o.mw < r.hi AND r.hi - r.mw < o.hi""",
    "hot": """
        SELECT window_start, window_end, avg_temp_f,
               epoch(window_start) / 3600 - row_number() OVER (ORDER BY window_start) AS run
        FROM grid WHERE heatwave_active""",
    "runs": """
        SELECT run, min(window_start) AS event_start, max(window_end) AS event_end, count(*) AS hot_windows,
               max(avg_temp_f) AS max_temp_f
        FROM hot GROUP BY 1""",
    "compared": """
        SELECT p.zip_code, m.window_start AS due, abs(p.p15 - m.minute_load_kw) / nullif(m.minute_load_kw, 0) AS error
        FROM predicted p JOIN minute m
             ON m.zip_code = p.zip_code AND m.window_start = p.window_start + INTERVAL 90 HOUR""",
    "alerts": """
        SELECT zip_code, window_start, window_end, alert_level, score, recommended_action, p15, minute_load_kw
        FROM predicted WHERE alert_level IN ('CRITICAL', 'HIGH')""",
    "responses": """
        SELECT zip_code, alert_level, window_end AS alert_time, ts AS action_time, operator_id,
               date_diff('microsecond', window_end, ts) / 1e6 AS response_seconds
        FROM (SELECT l.zip_code, l.alert_level, l.window_end, a.ts, a.operator_id,
                     row_number() OVER (PARTITION BY l.zip_code, l.window_end ORDER BY a.ts, a.operator_id) AS n
              FROM alerts l LEFT JOIN actions a ON a.zip_code = l.zip_code AND a.ts >= l.window_end)
        WHERE n = 1""",
}

_LOADS = (
    "window_start, window_end, zip_code, "
    + ", ".join(
        [
            _r("load_mw"),
            _r("avg_load_kw"),
            "meter_count",
            _r("peak_load_kw"),
            *(_r(c) for c in ("load_stddev", "avg_voltage", "avg_frequency", "avg_temp_f", "avg_stress")),
        ]
    )
)
_GRID = (
    "window_start, window_end, active_meters, "
    + ", ".join(_r(c) for c in ("single_peak_kw", "avg_temp_f", "grid_load_mw"))
    + ", heatwave_active"
)
_READING = (
    "meter_id, zip_code, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS \"timestamp\", "
    + ", ".join(_r(c) for c in ("power_kw", "voltage", "frequency", "temperature_f", "grid_stress_indicator"))
    + ", CAST(reading_interval_sec AS BIGINT) AS reading_interval_sec, event_time"
)
_PREDICTION = (
    "zip_code, window_start, window_end, "
    + ", ".join(
        [
            _r("minute_load_kw"),
            _r("diff", "load_acceleration"),
            _r("sum15", "cumulative_15min_load"),
            _r("avg15", "avg_15min_load"),
            _r("slope", "load_trend_slope"),
            _r("minute_load_kw + slope", "predicted_next_minute"),
            _r("minute_load_kw + slope * 5", "predicted_5min"),
            _r("minute_load_kw + slope * 15", "predicted_15min"),
        ]
    )
)
_SCORED = (
    _PREDICTION
    + ", "
    + ", ".join([_r("score", "overload_risk_score"), _r("minute_load_kw", "current_load_kw")])
    + ", alert_level, recommended_action, "
    + _r("minutes", "estimated_minutes_to_overload")
)
_PAYLOAD = (
    "zip_code AS key, zip_code, window_start, "
    + ", ".join(
        [_r("score", "overload_risk_score"), _r("p15", "predicted_15min"), _r("minute_load_kw", "current_load_kw")]
    )
    + ", alert_level, recommended_action"
)
_ALERT = "zip_code, window_start, window_end, alert_level, " + _r("score", "overload_risk_score") + ", recommended_action"


def _imminent(source: str) -> str:
    return f"""
        SELECT zip_code, window_start, {_shown("minute_load_kw / 10.0", 2, "current_load_mw")},
               {_shown("diff / 10.0", 2, "accel_mw_per_min")},
               {_shown("(minute_load_kw + diff * 15) / 10.0", 2, "projected_load_mw")},
               {_shown("sum15 / 10.0 / 100.0 * 100", 1, "capacity_pct")}, growth_regime,
               {_shown("minutes", 1, "mins_to_overload")},
               CASE WHEN minutes < 5 THEN 'critical' WHEN minutes < 15 THEN 'high' WHEN minutes < 30 THEN 'medium'
                    ELSE 'normal' END AS grid_alert_status,
               CASE WHEN minutes < 5 THEN 'SHED' WHEN minutes < 15 THEN 'RESERVES' WHEN minutes < 30 THEN 'PREPARE'
                    ELSE 'NORMAL' END AS recommended_action
        FROM {source} WHERE minutes < 60"""


def _cards(loads: str, predicted: str) -> str:
    return f"""
        SELECT l.zip_code, l.window_start AS last_update, {_r("l.load_mw", "current_load_mw")},
               {_r("l.load_mw * 10.0 / c.capacity_kw * 100", "capacity_utilization_pct")},
               {_r("l.avg_temp_f", "avg_temp_f")}, l.meter_count,
               CASE WHEN p.diff > 0 THEN 'UP' WHEN p.diff < 0 THEN 'DOWN' ELSE 'STABLE' END AS trend, p.alert_level,
               CASE WHEN l.load_mw * 10.0 / c.capacity_kw * 100 > 95 THEN 'critical'
                    WHEN l.load_mw * 10.0 / c.capacity_kw * 100 > 80 THEN 'high'
                    WHEN l.load_mw * 10.0 / c.capacity_kw * 100 > 60 THEN 'elevated' ELSE 'normal' END AS capacity_band,
               CASE WHEN l.avg_temp_f > 95 THEN 'hot' WHEN l.avg_temp_f >= 85 THEN 'warm' ELSE 'cool' END AS temp_band
        FROM (SELECT *, row_number() OVER (PARTITION BY zip_code ORDER BY window_start DESC) AS n FROM {loads}) l
             JOIN capacity c USING (zip_code)
             LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY zip_code ORDER BY window_start DESC) AS n
                        FROM {predicted}) p ON p.zip_code = l.zip_code AND p.n = 1
        WHERE l.n = 1"""


def _surge(source: str) -> str:
    return f"""
        SELECT window_start, count(*) AS surging_zones, {_r("sum(roc) / 10.0", "total_surge_mw")},
               string_agg(zip_code, ',' ORDER BY zip_code) AS affected_zips,
               CASE WHEN count(*) > 5 AND sum(roc) > 800 THEN 'WIDESPREAD_GRID_EMERGENCY'
                    WHEN count(*) > 3 THEN 'MULTI_ZONE_EVENT' ELSE 'LOCALIZED_EVENT' END AS event_classification
        FROM {source} WHERE roc > 20 GROUP BY window_start HAVING count(*) >= 2"""


def _plan(source: str, condition: str = "TRUE") -> str:
    return f"""
        SELECT window_start, zip_code, {_shown("load_mw", 2, "current_load")},
               {_shown("predicted_load_mw", 2, "predicted_load")},
               {_shown("overload_risk_score", 1, "risk_score")},
               {_shown("renewable_surplus_mw", 2, "surplus_mw")}, {_shown("deficit", 2, "deficit_mw")},
               {_shown("priority", 2, "priority_score")},
               CASE WHEN renewable_surplus_mw > 0 AND overload_risk_score < 30 THEN 'EXPORT_ZONE'
                    WHEN deficit > 0 OR overload_risk_score > 60 THEN 'IMPORT_ZONE'
                    ELSE 'BALANCED_ZONE' END AS grid_role,
               CASE WHEN renewable_surplus_mw > 5 THEN 'TRANSFER '
                         || CAST(CAST(round(CAST(round(renewable_surplus_mw * 0.8, 9) AS DECIMAL(38,9)), 1) AS DECIMAL(18,1)) AS VARCHAR)
                         || ' MW TO NEAREST IMPORT ZONE'
                    WHEN deficit > 2 THEN 'REQUEST ' || CAST(CAST(round(CAST(round(deficit, 9) AS DECIMAL(38,9)), 1) AS DECIMAL(18,1)) AS VARCHAR)
                         || ' MW FROM NEAREST EXPORT ZONE'
                    ELSE 'MAINTAIN_CURRENT_FLOWS' END AS grid_command
        FROM (SELECT *, CASE WHEN predicted_load_mw > load_mw * 1.2 THEN predicted_load_mw - load_mw
                             ELSE 0.0 END AS deficit,
                     overload_risk_score * (predicted_load_mw / nullif(load_mw, 0)) + 0.0 AS priority
              FROM {source} WHERE {condition})"""


_ACCURACY = f"""
    SELECT zip_code, count(error) AS forecasts, {_r("100 * (1 - sum(error) / nullif(count(error), 0))", "accuracy_pct")}
    FROM compared GROUP BY zip_code
    UNION ALL
    SELECT 'ALL', count(error), {_r("100 * (1 - sum(error) / nullif(count(error), 0))", "accuracy_pct")} FROM compared"""

_DAY = "DATE '2024-01-10'"
_SOME = (
    "zip_code = '00007' AND window_start >= TIMESTAMP '2024-01-05 06:00:00' "
    "AND window_start < TIMESTAMP '2024-01-20 00:00:00'"
)


def _day_counts(first: str, second: str) -> str:
    day = f"CAST({{}} AS DATE) = {_DAY}"
    tables = (("raw_readings", "readings", "event_time"), ("zip_aggregations", "zone_loads", "window_start"),
              ("predictions", "predicted", "window_start"))
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {_DAY} AS archive_date, count(*) AS {first}, count(*) AS {second} "
        f"FROM {table} WHERE {day.format(time)}"
        for name, table, time in tables
    )


QUERIES = {
    "readings_parse": f"SELECT {_READING} FROM readings",
    "recent_window": f"SELECT window_start, window_end, zip_code, {_r('minute_load_kw')} FROM minute_recent",
    "zip_load": f"SELECT {_LOADS} FROM zone_loads",
    "minute_load": f"SELECT window_start, window_end, zip_code, {_r('minute_load_kw')} FROM minute",
    "grid_wide": f"SELECT {_GRID} FROM grid",
    "load_history": f"""
        SELECT {_bucket("window_start", 86400)} AS window_start,
               {_bucket("window_start", 86400)} + INTERVAL 1 DAY AS window_end, zip_code, count(*) AS points,
               {_r("CAST(sum(CAST(minute_load_kw AS DECIMAL(18,2))) AS DOUBLE) / count(minute_load_kw)", "avg_load_kw")},
               {_r("min(minute_load_kw)", "min_load_kw")}, {_r("max(minute_load_kw)", "max_load_kw")}
        FROM minute GROUP BY 1, 2, 3""",
    "load_history_zone": f"""
        SELECT {_bucket("window_start", 86400)} AS window_start,
               {_bucket("window_start", 86400)} + INTERVAL 1 DAY AS window_end, zip_code, count(*) AS points,
               {_r("CAST(sum(CAST(minute_load_kw AS DECIMAL(18,2))) AS DOUBLE) / count(minute_load_kw)", "avg_load_kw")},
               {_r("min(minute_load_kw)", "min_load_kw")}, {_r("max(minute_load_kw)", "max_load_kw")}
        FROM minute WHERE {_SOME} GROUP BY 1, 2, 3""",
    "rejected_readings": f"""
        SELECT {_bucket("event_time", 21600)} AS window_start,
               {_bucket("event_time", 21600)} + INTERVAL 6 HOUR AS window_end, zip_code, count(*) AS readings,
               count(*) FILTER (WHERE power_kw IS NULL) AS missing,
               count(*) FILTER (WHERE NOT coalesce(isfinite(power_kw) AND abs(power_kw) < 1e9, TRUE)) AS rejected
        FROM readings GROUP BY 1, 2, 3""",
    "load_lag_lead": f"""
        SELECT window_start, window_end, zip_code, {_r("minute_load_kw")}, {_r("prev_load")}, {_r("load_3min_ago")},
               {_r("load_5min_ago")}, {_r("future_5min_load")} FROM lagged""",
    "rolling_15": f"""
        SELECT window_start, window_end, zip_code, {_r("minute_load_kw")}, {_r("sum15", "cumulative_15min_mw")},
               {_r("avg15", "ma_15min")}, {_r("std15", "load_volatility")} FROM rolled""",
    "load_acceleration": f"""
        SELECT zip_code, window_start, {_r("minute_load_kw")}, {_r("prev_load")}, {_r("diff", "load_acceleration")}
        FROM rolled""",
    "growth_regime": f"""
        SELECT zip_code, window_start, {_r("std15", "load_volatility")}, growth_regime FROM graded""",
    "trend_forecast": f"SELECT {_PREDICTION} FROM rolled",
    "minutes_to_overload": f"""
        SELECT zip_code, window_start, {_r("minute_load_kw")}, {_r("prev_load")},
               {_r("minute_load_kw / 1000.0 * 100", "capacity_pct_now")},
               {_r("minutes", "estimated_minutes_to_overload")},
               CASE WHEN minutes < 5 THEN 'critical' WHEN minutes < 15 THEN 'high' WHEN minutes < 30 THEN 'medium'
                    ELSE 'normal' END AS grid_alert_status
        FROM graded""",
    "imminent_overload": _imminent("graded"),
    "imminent_overload_recent": _imminent("recent_graded"),
    "overload_predictions": f"SELECT {_SCORED} FROM predicted",
    "zone_overload_predictions": f"""
        SELECT zip_code, window_start, {_r("score", "overload_risk_score")},
               CASE WHEN score > 80 THEN 'CRITICAL' WHEN score > 60 THEN 'HIGH' WHEN score > 40 THEN 'MEDIUM'
                    ELSE 'LOW' END AS alert_level,
               {_r("minutes", "estimated_minutes_to_overload")}
        FROM (SELECT r.zip_code, r.window_start,
                     CASE WHEN slope > 20 THEN least(100.0, (minute_load_kw + slope * 15) / capacity_kw * 100)
                          ELSE 0.0 END AS score,
                     CASE WHEN diff > 0 THEN greatest(0.0, (capacity_kw - minute_load_kw) / nullif(diff, 0))
                          ELSE 999.0 END AS minutes
              FROM rolled r JOIN capacity USING (zip_code))""",
    "alert_payload": f"SELECT {_PAYLOAD} FROM alerts",
    "overload_alert_rule": f"""
        SELECT zip_code, window_start, {_r("minutes", "mins_to_overload")}, alert_level
        FROM predicted WHERE minutes < 15""",
    "overload_alert_fires": """
        SELECT count(*) AS matching_rows, count(*) > 0 AS fires FROM predicted WHERE minutes < 15""",
    "zip_trend": f"""
        SELECT window_start, window_end, zip_code, {_r("minute_load_kw")}, {_r("load_3min_ago")},
               {_r("(minute_load_kw - load_3min_ago) / 3.0", "roc_3min")} FROM lagged""",
    "surging_zones": f"""
        SELECT window_start, zip_code, {_r("roc", "roc_3min")},
               CAST(CASE WHEN roc > 40 THEN 1 ELSE 0 END AS BIGINT) AS is_surging FROM trends WHERE roc > 20""",
    "correlated_surge": _surge("trends"),
    "correlated_surge_recent": _surge("trends_recent"),
    "heatwave_runs": f"SELECT event_start, event_end, hot_windows, {_r('max_temp_f')} FROM runs",
    "event_replay": f"""
        SELECT event_start, event_end, hot_windows, {_r("max_temp_f")}, m.window_start, m.zip_code,
               {_r("minute_load_kw")}
        FROM (SELECT DISTINCT run, {_bucket("window_start", 21600)} AS at FROM hot) h
             JOIN runs USING (run) JOIN minute m ON m.window_start = h.at""",
    "event_replay_one": f"""
        SELECT event_start, event_end, hot_windows, {_r("max_temp_f")}, m.window_start, m.zip_code,
               {_r("minute_load_kw")}
        FROM (SELECT DISTINCT run, {_bucket("window_start", 21600)} AS at FROM hot) h
             JOIN runs USING (run) JOIN minute m ON m.window_start = h.at
        WHERE event_start = (SELECT event_start FROM runs
                             WHERE event_start >= TIMESTAMP '2024-01-03 00:00:00' ORDER BY 1 LIMIT 1)""",
    "load_prediction_join": f"""
        SELECT zip_code, window_start, {_r("load_mw")}, {_r("avg_temp_f")}, {_r("score", "overload_risk_score")},
               {_r("p15 / 10.0", "predicted_load_mw")}
        FROM zone_loads JOIN predicted USING (zip_code, window_start)""",
    "renewable_state": "SELECT zip_code, window_start, "
    + ", ".join(
        _r(c)
        for c in (
            "load_mw", "avg_temp_f", "overload_risk_score", "predicted_load_mw", "solar_generation_mw",
            "wind_generation_mw", "battery_soc_pct", "renewable_surplus_mw",
        )
    )
    + " FROM state",
    "reallocation_plan": _plan("state"),
    "reallocation_plan_recent": _plan(
        "state_recent", "window_start >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 12 HOUR"
    ),
    "reallocation_plan_aligned": _plan("aligned_state"),
    "renewable_balance": f"""
        SELECT window_start, {_r("surplus", "renewable_surplus_mw")}, zones AS renewable_deficit_zones FROM balance""",
    "renewable_utilization": f"""
        SELECT zip_code, {_r("sum(gen)", "generation_mw")}, {_r("sum(least(gen, load_mw))", "used_mw")},
               {_r("sum(least(gen, load_mw)) / nullif(sum(gen), 0) * 100", "utilization_pct")}
        FROM (SELECT zip_code, load_mw, solar_generation_mw + wind_generation_mw AS gen
              FROM zone_loads JOIN assets USING (zip_code))
        WHERE gen IS NOT NULL AND load_mw IS NOT NULL GROUP BY zip_code""",
    "renewable_utilization_range": f"""
        SELECT zip_code, {_r("sum(gen)", "generation_mw")}, {_r("sum(least(gen, load_mw))", "used_mw")},
               {_r("sum(least(gen, load_mw)) / nullif(sum(gen), 0) * 100", "utilization_pct")}
        FROM (SELECT zip_code, load_mw, solar_generation_mw + wind_generation_mw AS gen
              FROM zone_loads JOIN assets USING (zip_code)
              WHERE window_start >= TIMESTAMP '2024-01-05 00:00:00' AND window_start < TIMESTAMP '2024-01-12 00:00:00')
        WHERE gen IS NOT NULL AND load_mw IS NOT NULL GROUP BY zip_code""",
    "transfer_pairs": f"SELECT window_start, source_zip, target_zip, {_r('transfer_mw')} FROM pairs",
    "transfer_impact": f"""
        SELECT window_start, source_zip, target_zip, {_r("transfer_mw")},
               {_r("new_load / 10.0", "target_new_load_mw")},
               {_r("CASE WHEN diff > 0 THEN greatest(0.0, (1000 - new_load) / nullif(diff, 0)) ELSE 999.0 END",
                   "target_new_minutes_to_overload")},
               {_r("CASE WHEN slope > 20 THEN least(100.0, (p15 - transfer_mw * 10) / 2200.0 * 100) ELSE 0.0 END",
                   "target_new_risk_score")}
        FROM (SELECT t.*, p.minute_load_kw - t.transfer_mw * 10 AS new_load, p.diff, p.slope, p.p15
              FROM pairs t JOIN predicted p ON p.window_start = t.window_start AND p.zip_code = t.target_zip)""",
    "zone_capacity_pct": f"""
        SELECT zip_code, window_start, {_r("minute_load_kw")}, {_r("capacity_kw")},
               {_r("minute_load_kw / 6.0 / capacity_kw * 100", "capacity_pct")}
        FROM minute JOIN capacity USING (zip_code)""",
    "critical_zones": f"""
        SELECT zip_code, window_start, {_r("minute_load_kw")}, {_r("capacity_kw")},
               {_r("minute_load_kw / 6.0 / capacity_kw * 100", "capacity_pct")}
        FROM minute JOIN capacity USING (zip_code) WHERE minute_load_kw / 6.0 / capacity_kw * 100 > 15""",
    "zone_status": _cards("zone_loads", "predicted"),
    "zone_status_recent": _cards(
        "zone_loads WHERE window_start >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 102 HOUR", "predicted_recent"
    ),
    "grid_header": f"""
        SELECT g.window_start, {_r("grid_load_mw", "total_grid_load_mw")}, active_meters, {_r("single_peak_kw")},
               {_r("g.avg_temp_f", "avg_temp_f")}, heatwave_active,
               {_r("load / capacity * 100", "capacity_pct")}, {_r("capacity - load", "headroom_mw")},
               {_r("surplus", "renewable_surplus_mw")}, zones AS renewable_deficit_zones
        FROM grid g JOIN (SELECT window_start, CAST(sum(CAST(load_mw AS DECIMAL(18,3))) AS DOUBLE) AS load,
                                 sum(CAST(capacity_kw AS DOUBLE)) / 10.0 AS capacity
                          FROM zone_loads JOIN capacity USING (zip_code) GROUP BY 1) c USING (window_start)
             LEFT JOIN balance b ON b.window_start = {_bucket("g.window_start", 21600)}""",
    "stale_zones": """
        SELECT zip_code, max(event_time) AS last_update,
               max(event_time) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 3 HOUR AS is_stale
        FROM readings GROUP BY zip_code""",
    "prediction_history": f"""
        SELECT zip_code, window_start, {_r("minute_load_kw", "current_load_kw")}, {_r("slope", "load_trend_slope")},
               {_r("minute_load_kw + slope", "predicted_next_minute")},
               {_r("minute_load_kw + slope * 5", "predicted_5min")}, {_r("p15", "predicted_15min")},
               {_r("score", "overload_risk_score")}, alert_level FROM predicted""",
    "prediction_history_zone": f"""
        SELECT zip_code, window_start, {_r("minute_load_kw", "current_load_kw")}, {_r("slope", "load_trend_slope")},
               {_r("minute_load_kw + slope", "predicted_next_minute")},
               {_r("minute_load_kw + slope * 5", "predicted_5min")}, {_r("p15", "predicted_15min")},
               {_r("score", "overload_risk_score")}, alert_level FROM predicted WHERE {_SOME}""",
    "alert_history_zone": f"SELECT {_ALERT} FROM predicted WHERE alert_level = 'HIGH' AND {_SOME}",
    "alert_history": f"SELECT {_ALERT} FROM predicted WHERE alert_level IN ('CRITICAL', 'HIGH', 'MEDIUM')",
    "recent_alerts": f"SELECT {_ALERT} FROM alerts ORDER BY window_end DESC, zip_code LIMIT 50",
    "recent_alerts_dated": f"SELECT {_ALERT} FROM alerts ORDER BY window_end DESC, zip_code LIMIT 50",
    "grid_tail_dated": f"""
        SELECT window_start, {_r("grid_load_mw")}, {_r("avg_temp_f")}, heatwave_active
        FROM grid ORDER BY window_start DESC LIMIT 101""",
    "grid_tail": f"""
        SELECT window_start, {_r("grid_load_mw")}, {_r("avg_temp_f")}, heatwave_active
        FROM grid ORDER BY window_start DESC LIMIT 101""",
    "zone_detail": f"""
        SELECT window_start, zip_code, {_r("minute_load_kw")}, {_r("prev_load")}, {_r("sum15", "cumulative_15min")},
               {_r("slope", "trend_slope")}, {_r("minute_load_kw + slope * 15", "predicted_15min")}
        FROM rolled WHERE zip_code = '00007' ORDER BY window_start DESC LIMIT 100""",
    "prediction_accuracy": _ACCURACY,
    "report_csv": _ACCURACY,
    "response_times": f"""
        SELECT zip_code, alert_level, alert_time, action_time, operator_id, {_r("response_seconds")} FROM responses""",
    "response_time_stats": f"""
        SELECT alert_level, count(*) AS alerts, count(response_seconds) AS answered,
               {_r("avg(response_seconds)", "avg_seconds")}, {_r("max(response_seconds)", "max_seconds")},
               {_r("quantile_disc(response_seconds, 0.5)", "median_seconds")}
        FROM responses GROUP BY alert_level""",
    "response_time_stats_week": f"""
        SELECT alert_level, count(*) AS alerts, count(response_seconds) AS answered,
               {_r("avg(response_seconds)", "avg_seconds")}, {_r("max(response_seconds)", "max_seconds")},
               {_r("quantile_disc(response_seconds, 0.5)", "median_seconds")}
        FROM responses WHERE alert_time >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY alert_level""",
    "action_rate": """
        SELECT operator_id, to_timestamp(second) AT TIME ZONE 'UTC' AS at, actions_in_window
        FROM (SELECT operator_id, second, CAST(sum(actions) OVER (
                     PARTITION BY operator_id ORDER BY second
                     RANGE BETWEEN 21599 PRECEDING AND CURRENT ROW) AS BIGINT) AS actions_in_window
              FROM (SELECT operator_id, CAST(floor(epoch(ts)) AS BIGINT) AS second, count(*) AS actions
                    FROM actions GROUP BY 1, 2))
        WHERE actions_in_window > 3""",
    "period_profile": f"""
        SELECT period, count(*) AS readings, {_r("min(power_kw)", "min_kw")}, {_r("avg(power_kw)", "avg_kw")},
               {_r("max(power_kw)", "max_kw")},
               {_r("avg(CASE WHEN power_kw BETWEEN low AND high THEN 0.0 ELSE 1.0 END)", "outside_share")}
        FROM (SELECT power_kw, CASE WHEN h BETWEEN 6 AND 8 THEN 'morning_peak' WHEN h BETWEEN 9 AND 16 THEN 'midday'
                                    WHEN h BETWEEN 17 AND 20 THEN 'evening_peak' ELSE 'night' END AS period
              FROM (SELECT power_kw, hour(event_time) AS h FROM readings))
             JOIN (VALUES ('morning_peak', 2.5, 4.0), ('midday', 1.5, 2.5), ('evening_peak', 4.0, 7.0),
                          ('night', 0.8, 1.5)) AS b(period, low, high) USING (period)
        GROUP BY period""",
    "temp_correlation": f"""
        SELECT zip_code, count(*) AS points, {_r("corr(load_mw, avg_temp_f)", "temp_correlation")}
        FROM zone_loads GROUP BY zip_code""",
    "temp_correlation_range": f"""
        SELECT zip_code, count(*) AS points,
               CASE WHEN count(load_mw) > 1 THEN {_r("corr(load_mw, avg_temp_f)").replace(" + 0.0 AS corr(load_mw, avg_temp_f)", "")} + 0.0 END AS temp_correlation
        FROM zone_loads WHERE CAST(window_start AS DATE) BETWEEN DATE '2024-01-06' AND DATE '2024-01-20' GROUP BY zip_code""",
    "prediction_accuracy_range": f"""
        WITH due_then AS (SELECT * FROM compared WHERE CAST(due AS DATE) BETWEEN DATE '2024-01-06' AND DATE '2024-01-20')
        SELECT zip_code, count(error) AS forecasts, {_r("100 * (1 - sum(error) / nullif(count(error), 0))", "accuracy_pct")}
        FROM due_then GROUP BY zip_code
        UNION ALL
        SELECT 'ALL', count(error), {_r("100 * (1 - sum(error) / nullif(count(error), 0))", "accuracy_pct")} FROM due_then""",
    "response_time_quantiles": """
        SELECT alert_level, count(*) AS alerts, count(response_seconds) AS answered,
               CASE WHEN count(response_seconds) > 0 THEN TRUE END AS median_seconds_near,
               CASE WHEN count(response_seconds) > 0 THEN TRUE END AS p95_seconds_near
        FROM responses GROUP BY alert_level""",
    "archive_date": """
        SELECT CAST(event_time AS DATE) AS run_date, count(*) AS readings,
               CAST(CAST(event_time AS DATE) - INTERVAL 30 DAY AS DATE) AS archive_date
        FROM readings GROUP BY 1, 3""",
    "archive_slice": "SELECT meter_id, zip_code, "
    + ", ".join(_r(c) for c in ("power_kw", "voltage", "frequency", "temperature_f", "grid_stress_indicator"))
    + f""", CAST(reading_interval_sec AS BIGINT) AS reading_interval_sec, event_time
        FROM readings WHERE CAST(event_time AS DATE) = {_DAY}""",
    "archive_validate": f"""
        SELECT table_name, n AS record_count, CAST(least_rows AS BIGINT) AS expected_min, n >= least_rows AS ok FROM (
            SELECT 'raw_readings' AS table_name, count(*) AS n, 100 AS least_rows
            FROM readings WHERE CAST(event_time AS DATE) = {_DAY}
            UNION ALL SELECT 'zip_aggregations', count(*), 50 FROM zone_loads WHERE CAST(window_start AS DATE) = {_DAY}
            UNION ALL SELECT 'predictions', count(*), 50 FROM predicted WHERE CAST(window_start AS DATE) = {_DAY})""",
    "archive_export": _day_counts("source_count", "exported_count"),
    "compact_day": _day_counts("rows_before", "rows_after"),
    "compact_day_zorder": _day_counts("rows_before", "rows_after"),
    "archived_zone_history": f"""
        SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, zip_code, count(*) AS points,
               {_r("sum(minute_load_kw) / count(minute_load_kw)", "avg_load_kw")},
               {_r("min(minute_load_kw)", "min_load_kw")}, {_r("max(minute_load_kw)", "max_load_kw")}
        FROM (SELECT date_trunc('day', window_start)::TIMESTAMP AS window_start, zip_code, minute_load_kw FROM minute
              WHERE zip_code = '00007' AND window_start >= TIMESTAMP '2024-01-10 06:00:00'
                AND window_start < TIMESTAMP '2024-01-12 12:00:00')
        GROUP BY 1, 2, 3""",
    "lifecycle_plan": """
        SELECT 'raw_readings' AS table_name, day AS archive_date, CAST(0 AS BIGINT) AS run, 'warm' AS tier, age AS age_days,
               CASE WHEN age > 20 THEN 'delete' WHEN age > 15 THEN 'archive' WHEN age > 10 THEN 'cool' ELSE 'warm' END AS due_tier,
               CASE WHEN age > 20 THEN 'delete' WHEN age > 10 THEN 'move' ELSE 'keep' END AS action
        FROM (SELECT DISTINCT CAST(event_time AS DATE) AS day, date_diff('day', CAST(event_time AS DATE), DATE '2024-01-31') AS age
              FROM readings WHERE event_time IS NOT NULL)""",
    "lifecycle_run": """
        SELECT CASE CAST(window_start AS DATE) WHEN DATE '2024-01-11' THEN 'archive' ELSE 'cool' END AS tier,
               CAST(window_start AS DATE) AS archive_date, zip_code, meter_count
        FROM zone_loads WHERE CAST(window_start AS DATE) IN (DATE '2024-01-11', DATE '2024-01-12')""",
    "archive_volume": """
        SELECT count(*) AS rows, CAST(1 AS BIGINT) AS segments, TRUE AS measured, CAST(0.0184 - 0.00099 AS DOUBLE) AS saved_per_gb
        FROM zone_loads WHERE CAST(window_start AS DATE) = DATE '2024-01-10'""",
    "purge_retained": f"""
        SELECT window_start, zip_code, {_r("load_mw")}, meter_count
        FROM zone_loads WHERE CAST(window_start AS DATE) <> {_DAY}""",
    "archive_late_rows": """
        SELECT 'zip_aggregations' AS table_name, DATE '2024-01-10' AS archive_date,
               CAST(extract(hour FROM window_start) >= 12 AS BIGINT) AS run,
               count(*) AS source_count, count(*) AS exported_count
        FROM zone_loads WHERE CAST(window_start AS DATE) = DATE '2024-01-10' GROUP BY ALL""",
    "history_union": f"""
        SELECT window_start, zip_code, {_r("load_mw")}, meter_count, {_r("peak_load_kw")} FROM zone_loads""",
    "storage_tier": """
        SELECT CASE WHEN age > 2555 THEN 'delete' WHEN age > 90 THEN 'archive' WHEN age > 30 THEN 'cool'
                    WHEN age > 7 THEN 'warm' ELSE 'hot' END AS tier,
               count(*) AS readings, min(age) AS min_age, max(age) AS max_age
        FROM (SELECT date_diff('day', CAST(event_time AS DATE), DATE '2024-01-31') AS age FROM readings) GROUP BY 1""",
    "cost_savings": f"""
        SELECT month, n AS archived_rows, {_r("n * 1000000 / 1e9", "gb")},
               {_r("n * 1000000 / 1e9 * (0.0184 - 0.00099)", "monthly_savings")},
               {_r("n * 1000000 / 1e9 * (0.0184 - 0.00099) * 12", "annual_savings")}
        FROM (SELECT strftime(event_time, '%Y-%m') AS month, count(*) AS n FROM readings
              WHERE CAST(event_time AS DATE) <= DATE '2024-01-10' GROUP BY 1)""",
    "s_readings": f"SELECT {_READING} FROM readings",
    "s_zip_load": f"SELECT {_LOADS} FROM zone_loads WHERE window_end <= {_WM.format(3)}",
    "s_minute_load": f"""
        SELECT window_start, window_end, zip_code, {_r("minute_load_kw")} FROM minute
        WHERE window_end <= {_WM.format(30)}""",
    "s_minute_load_table": f"""
        SELECT window_start, window_end, zip_code, {_r("minute_load_kw")} FROM minute
        WHERE window_end <= {_WM.format(30)}""",
    "s_grid_wide": f"SELECT {_GRID} FROM grid WHERE window_end <= {_WM.format(6)}",
    "s_predictions": f"SELECT {_SCORED} FROM predicted WHERE window_end <= {_WM.format(30)}",
    "s_predictions_stateful": f"SELECT {_SCORED} FROM predicted WHERE window_end <= {_WM.format(30)}",
    "s_alerts_stateful": f"SELECT {_PAYLOAD} FROM alerts WHERE window_end <= {_WM.format(30)}",
    "s_correlated_surge": f"""
        SELECT * FROM ({_surge("trends")}) WHERE window_start + INTERVAL 6 HOUR <= {_WM.format(30)}""",
    "s_stale_zones": f"""
        SELECT zip_code, status, changed_at, last_seen FROM silences
        WHERE returned_window_end <= {_WM.format(3)}
           OR (status = 'SILENT' AND changed_at + INTERVAL 1 HOUR <= {_WM.format(3)})""",
    "silences": """
        SELECT zip_code, status, changed_at, last_seen FROM silences
        WHERE returned_window_end IS NOT NULL OR changed_at <= TIMESTAMP '2024-01-31 00:00:00'""",
    "s_unique_readings": "SELECT DISTINCT meter_id, event_time, zip_code FROM readings",
    "s_late_data": f"""
        SELECT window_start, window_end, zip_code, {_r("minute_load_kw")} FROM minute
        WHERE window_start >= TIMESTAMP '2024-01-16 00:00:00' AND window_end <= {_WM.format(30)}""",
    "s_alerts": f"SELECT {_PAYLOAD} FROM alerts WHERE window_end <= {_WM.format(30)}",
}

_WORD = re.compile(r"\w+")


def _needed(text: str) -> list[str]:
    """Steps a statement uses, directly or through other steps, in the order they are defined."""
    found: set[str] = set()
    open_texts = [text]
    while open_texts:
        for word in _WORD.findall(open_texts.pop()):
            if word in STEPS and word not in found:
                found.add(word)
                open_texts.append(STEPS[word])
    return [name for name in STEPS if name in found]


def statement(name: str) -> str:
    body = QUERIES[name]
    steps = ",\n".join(f"{step} AS ({STEPS[step]})" for step in _needed(body))
    return f"WITH {steps}\nSELECT * FROM ({body})"


def statements() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES}
