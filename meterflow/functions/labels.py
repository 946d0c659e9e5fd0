"""Labels: the graded scales of the grid and the sentences behind their codes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow.config import GridConfig
from meterflow.functions.exact import shown

# ---- Fixed values: names and texts that consumers of the results match on. ----

RISK_LABELS = ("CRITICAL", "HIGH", "MEDIUM")
RISK_DEFAULT = "LOW"
PUBLISHED_LEVELS = ("CRITICAL", "HIGH")

RISK_ACTIONS = {
    "CRITICAL": "SHED",
    "HIGH": "RESERVES",
    "MEDIUM": "MONITOR",
    "LOW": "NORMAL",
}
RISK_ACTION_TEXTS = {
    "SHED": "INITIATE_LOAD_SHEDDING: Reduce non-essential loads immediately",
    "RESERVES": "SPIN_UP_RESERVES: Activate peaker plants and demand response",
    "MONITOR": "MONITOR_CLOSELY: Prepare contingency protocols",
    "NORMAL": "NORMAL_OPERATIONS",
}

MINUTE_LABELS = ("critical", "high", "medium")
MINUTE_DEFAULT = "normal"
MINUTE_STATUS_TEXTS = {
    "critical": "🔴 CRITICAL: Load shedding required NOW",
    "high": "🟠 HIGH: Spin up reserves immediately",
    "medium": "🟡 MEDIUM: Alert operators, prep DR",
    "normal": "🟢 NORMAL",
}
MINUTE_ACTIONS = {
    "critical": "SHED",
    "high": "RESERVES",
    "medium": "PREPARE",
    "normal": "NORMAL",
}
MINUTE_ACTION_TEXTS = {
    "SHED": "Execute emergency load shedding. Disconnect non-essential industrial. Deploy battery reserves.",
    "RESERVES": "Start peaker plants. Send demand response signals to smart thermostats. "
    "Import power from neighboring grid.",
    "PREPARE": "Pre-position crews. Notify large industrial customers of potential curtailment.",
    "NORMAL": "Continue normal operations",
}

EXPLOSIVE, RAPID, MODERATE, STABLE = (
    "EXPLOSIVE_GROWTH",
    "RAPID_ACCEL",
    "MODERATE_GROWTH",
    "STABLE_OR_DECLINING",
)
WIDESPREAD, MULTI_ZONE, LOCALIZED = (
    "WIDESPREAD_GRID_EMERGENCY",
    "MULTI_ZONE_EVENT",
    "LOCALIZED_EVENT",
)
EXPORT_ZONE, IMPORT_ZONE, BALANCED_ZONE = "EXPORT_ZONE", "IMPORT_ZONE", "BALANCED_ZONE"
TRANSFER_COMMAND = ("TRANSFER ", " MW TO NEAREST IMPORT ZONE")
REQUEST_COMMAND = ("REQUEST ", " MW FROM NEAREST EXPORT ZONE")
HOLD_COMMAND = "MAINTAIN_CURRENT_FLOWS"

# Hours of the day (from, to) and the load one meter is expected to draw then (kW).
DAY_PERIODS = {
    "morning_peak": ((6, 9), (2.5, 4.0)),
    "midday": ((9, 17), (1.5, 2.5)),
    "evening_peak": ((17, 21), (4.0, 7.0)),
}
NIGHT_PERIOD = ("night", (0.8, 1.5))

# ---- End of fixed values. ----


def first_match(cases: Iterable[tuple[Column, str]], otherwise: str) -> Column:
    """Label of the first condition that holds; a null condition does not."""
    result = None
    for condition, label in cases:
        result = F.when(condition, label) if result is None else result.when(condition, label)
    return result.otherwise(otherwise)


def translated(code: Column, texts: dict[str, str]) -> Column:
    *head, (_, last) = texts.items()
    return first_match(((code == key, text) for key, text in head), last)


def risk_level(score: Column, cfg: GridConfig) -> Column:
    return first_match(((score > bound, label) for bound, label in zip(cfg.risk_levels, RISK_LABELS)), RISK_DEFAULT)


def risk_action(level: Column, cfg: GridConfig) -> Column:
    code = translated(level, RISK_ACTIONS)
    return translated(code, RISK_ACTION_TEXTS) if cfg.wording == "full" else code


def minute_status(minutes: Column, cfg: GridConfig) -> Column:
    code = _minute_code(minutes, cfg)
    return translated(code, MINUTE_STATUS_TEXTS) if cfg.wording == "full" else code


def minute_action(minutes: Column, cfg: GridConfig) -> Column:
    code = translated(_minute_code(minutes, cfg), MINUTE_ACTIONS)
    return translated(code, MINUTE_ACTION_TEXTS) if cfg.wording == "full" else code


def _minute_code(minutes: Column, cfg: GridConfig) -> Column:
    return first_match(
        ((minutes < bound, label) for bound, label in zip(cfg.minute_levels, MINUTE_LABELS)), MINUTE_DEFAULT
    )


def growth_regime(change: Column, volatility: Column, cfg: GridConfig) -> Column:
    return first_match(
        [
            ((volatility > cfg.volatility_kw) & (change > cfg.explosive_kw), EXPLOSIVE),
            (change > cfg.rapid_kw, RAPID),
            (change > 0, MODERATE),
        ],
        STABLE,
    )


def surge_class(zones: Column, total: Column, cfg: GridConfig) -> Column:
    return first_match(
        [
            ((zones > cfg.widespread_above) & (total > cfg.widespread_total_kw), WIDESPREAD),
            (zones > cfg.multi_zone_above, MULTI_ZONE),
        ],
        LOCALIZED,
    )


def grid_role(surplus: Column, deficit: Column, risk: Column, cfg: GridConfig) -> Column:
    return first_match(
        [
            ((surplus > 0) & (risk < cfg.export_risk_below), EXPORT_ZONE),
            ((deficit > 0) | (risk > cfg.import_risk_above), IMPORT_ZONE),
        ],
        BALANCED_ZONE,
    )


def grid_command(surplus: Column, deficit: Column, cfg: GridConfig) -> Column:
    def sentence(parts: tuple[str, str], amount: Column) -> Column:
        # A decimal prints plainly at any size; a double turns to E notation from 1e7 on.
        text = shown(amount, 1).cast("decimal(18,1)").cast("string")
        return F.concat(F.lit(parts[0]), text, F.lit(parts[1]))

    return (
        F.when(surplus > cfg.transfer_floor_mw, sentence(TRANSFER_COMMAND, surplus * cfg.transfer_share))
        .when(deficit > cfg.request_floor_mw, sentence(REQUEST_COMMAND, deficit))
        .otherwise(HOLD_COMMAND)
    )


def trend(change: Column) -> Column:
    return first_match([(change > 0, "UP"), (change < 0, "DOWN")], "STABLE")


def capacity_band(percent: Column, cfg: GridConfig) -> Column:
    labels = ("critical", "high", "elevated")
    return F.when(
        percent.isNotNull(),
        first_match(((percent > bound, label) for bound, label in zip(cfg.capacity_bands, labels)), "normal"),
    )


def temp_band(temperature: Column, cfg: GridConfig) -> Column:
    hot, warm = cfg.temp_bands
    return F.when(
        temperature.isNotNull(), first_match([(temperature > hot, "hot"), (temperature >= warm, "warm")], "cool")
    )


def day_period(hour: Column) -> Column:
    cases = ((hour.between(start, end - 1), name) for name, ((start, end), _) in DAY_PERIODS.items())
    return first_match(cases, NIGHT_PERIOD[0])


def outside_expected(period: Column, power: Column) -> Column:
    """Whether a reading lies outside the load expected in its period of the day."""
    outside = None
    for name, (_, (low, high)) in DAY_PERIODS.items():
        test = ~power.between(low, high)
        outside = F.when(period == name, test) if outside is None else outside.when(period == name, test)
    return outside.otherwise(~power.between(*NIGHT_PERIOD[1]))


def storage_tier(age_days: Column, cfg: GridConfig) -> Column:
    return first_match(
        [
            (age_days > cfg.delete_days, "delete"),
            (age_days > cfg.archive_days, "archive"),
            (age_days > cfg.warm_days, "cool"),
            (age_days > cfg.hot_days, "warm"),
        ],
        "hot",
    )
