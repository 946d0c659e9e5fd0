"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_local_roots: dict[str, str] = {}


def apply_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not share the driver's folders or its import path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # Spark serves the file from the driver, so a folder of the driver's own is right for it.
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="package-")), "package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors, as named in `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder: on a cluster one machine's
    folder is out of the others' reach and is lost with that machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="meterflow-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name for one run of a job."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame into the scratch folder and read it back, so that what is built on it computes it once."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Set SQL options for the duration of a block (dots written as double underscores)."""
    keys = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in keys}
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
