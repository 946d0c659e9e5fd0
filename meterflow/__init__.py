"""Meter telemetry analytics as Spark DataFrame transforms."""

from meterflow.config import FIXTURE, REFERENCE, GridConfig

__all__ = ["FIXTURE", "REFERENCE", "GridConfig"]
