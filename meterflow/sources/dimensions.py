"""Small zone dimensions. One row per zone; joined without hints, so that Spark weighs their size itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.sources.readings import ADAPTER_ZONES


def _zones(spark: SparkSession) -> DataFrame:
    return spark.range(ADAPTER_ZONES).select(
        F.col("id").alias("z"), F.lpad(F.col("id").cast("string"), 5, "0").alias("zip_code")
    )


def fixture_capacity(spark: SparkSession) -> DataFrame:
    """`zip_code, capacity_kw` for the zones of the event adapter."""
    return _zones(spark).select("zip_code", (800.0 + 50.0 * F.col("z")).alias("capacity_kw"))


def fixture_assets(spark: SparkSession) -> DataFrame:
    """Solar, wind and battery per zone; every fifth zone has none and some wind feeds are unknown."""
    z = F.col("z")
    return (
        _zones(spark)
        .filter(z % 5 != 4)
        .select(
            "zip_code",
            ((z * 37 % 11) * 12.0).alias("solar_generation_mw"),
            F.when(z % 7 != 3, (z * 53 % 7) * 9.0).alias("wind_generation_mw"),
            (40.0 + z * 4.0).alias("battery_soc_pct"),
        )
    )
