from __future__ import annotations

import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterflow.session import apply_settings  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        apply_settings(SparkSession.builder.master("local[4]").appName("meterflow-tests"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


START = dt.datetime(2024, 6, 25, 14, 0)


@pytest.fixture
def minutes(spark):
    """Build minute rows from `{zone: [load, ...]}`; None leaves the minute out."""

    def build(loads: dict[str | None, list[float | None]], step_s: int = 60):
        rows = []
        for zone, values in loads.items():
            for i, value in enumerate(values):
                if value is not None:
                    at = START + dt.timedelta(seconds=i * step_s)
                    rows.append((at, at + dt.timedelta(seconds=step_s), zone, float(value)))
        return spark.createDataFrame(
            rows, "window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, zip_code STRING, minute_load_kw DOUBLE"
        )

    return build


def as_dicts(df, *order):
    rows = [row.asDict(recursive=True) for row in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in order)) if order else rows
