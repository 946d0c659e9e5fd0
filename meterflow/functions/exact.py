"""Arithmetic that gives the same bits whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow.config import GridConfig


#: Sums of doubles are kept with so many decimals, which leaves room for totals up to 1e28.
SUM_TYPE = "decimal(38,10)"


def valid(measure: str, cfg: GridConfig) -> Column:
    """The measure if it is a credible number, else null: not if infinite, not a number or too large to be a load.

    Every measure of a load is taken over the same valid readings.
    """
    value = F.col(measure)
    return F.when(F.abs(value) < cfg.credible_below_kw, value)  # a NaN is larger than any number


def exact_total(measure: Column | str, decimals: int | None = None) -> Column:
    """Sum of a measure that doesn't depend on the order of addition.

    With a known number of decimals the addends become whole numbers, the fast way.
    Without, they become decimals that keep what a double of ordinary size holds.
    """
    value = F.col(measure) if isinstance(measure, str) else measure
    if decimals is None:
        return F.sum(value.cast(SUM_TYPE)).cast("double")
    scale = float(10**decimals)
    return F.sum(F.round(value * scale).cast("long")) / F.lit(scale)


def to_mw(kw: Column, cfg: GridConfig) -> Column:
    return kw / F.lit(cfg.kw_per_mw)


def percent(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0.0)) * 100.0


def unsigned_zero(value: Column) -> Column:
    """Turn -0.0 into 0.0; anything else is unchanged."""
    return value + F.lit(0.0)


def shown(value: Column, places: int) -> Column:
    """Round for display. Binary noise goes first, so that a half is rounded up as its decimals read."""
    return F.round(F.round(value, 9), places)
