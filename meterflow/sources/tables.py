"""Hot tables, stored by `event_date` so that a day is read, compacted and purged on its own.

A day is known by its files. Jobs that move data out list the files they read and later
remove exactly those, so rows that arrive in between are never touched.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.session import settings

DATE, BATCH = "event_date", "batch_id"


class HotTable(Protocol):
    spark: SparkSession

    def days(self, last: dt.date) -> list[dt.date]:
        """Days up to `last` that the table may hold rows of."""

    def files(self, day: dt.date) -> list[str]:
        """The data files of one day."""

    def files_by_day(self) -> dict[dt.date, list[str]]:
        """The data files of all days that have any, by one listing."""

    def home(self, day: dt.date) -> str:
        """The folder that new files of a day go to."""

    def read(self, files: list[str]) -> DataFrame:
        """The rows of some files, without the storage columns."""

    def rows(self, day: dt.date) -> DataFrame:
        """The rows of one day, without the storage columns."""

    def changed(self) -> None:
        """Forget what is cached about the files."""


class _ByFiles:
    spark: SparkSession

    def rows(self, day: dt.date) -> DataFrame:
        return self.read(self.files(day))

    def files_by_day(self) -> dict[dt.date, list[str]]:
        found: dict[dt.date, list[str]] = {}
        for path in self._all_files():
            days = [day for part in path.split("/") if (day := dates_in(part)) is not None]
            if days:
                found.setdefault(days[0], []).append(path)
        return found

    def read(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self._stored_schema())
        return self.spark.read.schema(self._stored_schema()).parquet(*files)


class CatalogTable(_ByFiles):
    """A parquet table of the catalog, partitioned by `event_date`."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def __str__(self) -> str:
        return self.name

    def _stored_schema(self):
        return self.spark.table(self.name).drop(DATE).schema

    def days(self, last: dt.date) -> list[dt.date]:
        found = self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()
        dates = (dates_in(row.partition) for row in found)
        return sorted(day for day in dates if day is not None and day <= last)

    def files(self, day: dt.date) -> list[str]:
        self.changed()
        return sorted(self.spark.table(self.name).filter(F.col(DATE) == F.lit(day)).inputFiles())

    def _all_files(self) -> list[str]:
        self.changed()
        return sorted(self.spark.table(self.name).inputFiles())

    def home(self, day: dt.date) -> str:
        root = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").filter("col_name = 'Location'").first().data_type
        return f"{root}/{DATE}={day.isoformat()}"

    def changed(self) -> None:
        self.spark.catalog.refreshTable(self.name)


class FolderTable(_ByFiles):
    """What a stream wrote with `dated_batch`: `<path>/event_date=<day>/batch_id=<n>/` parquet files.

    The date comes first, so a day's read lists that day's folders only.
    """

    COMPACTED = -1

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def __str__(self) -> str:
        return self.path

    def _stored_schema(self) -> str:
        return self.schema

    def all_rows(self) -> DataFrame:
        """Every row, with its `event_date`."""
        stored = self.spark.read.schema(f"{self.schema}, {BATCH} BIGINT, {DATE} DATE").parquet(self.path)
        return stored.drop(BATCH)

    def days(self, last: dt.date) -> list[dt.date]:
        names = (found.getPath().getName() for found in listed(self.spark, self.path))
        dates = (dates_in(name) for name in names)
        return sorted(day for day in dates if day is not None and day <= last)

    def files(self, day: dt.date) -> list[str]:
        return files_below(self.spark, f"{self.path}/{DATE}={day.isoformat()}")

    def _all_files(self) -> list[str]:
        return files_below(self.spark, self.path)

    def home(self, day: dt.date) -> str:
        return f"{self.path}/{DATE}={day.isoformat()}/{BATCH}={self.COMPACTED}"

    def changed(self) -> None:
        pass


def newest_rows(table: HotTable, wanted: Callable[[DataFrame], DataFrame], limit: int) -> DataFrame:
    """Rows of the newest days of a table, as many days as hold `limit` wanted rows; of all days if they hold fewer.

    Every row of a later day is newer than any of an earlier one, so what is newest among
    these rows is newest in the table. The number of days doubles until they suffice.
    """
    days = table.days(dt.date.max)[::-1]
    files: list[str] = []
    begin, width = 0, 1
    while True:
        files += [path for day in days[begin : begin + width] for path in table.files(day)]
        begin += width
        rows = table.read(files)
        if begin >= len(days) or wanted(rows).limit(limit).count() >= limit:
            return rows
        width = begin


def dates_in(partition: str) -> dt.date | None:
    """The day that a partition's name states; None for other names and for rows without a date."""
    key, _, value = partition.partition("=")
    try:
        return dt.date.fromisoformat(value) if key == DATE else None
    except ValueError:
        return None


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(hadoop_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, creating the folder it goes to."""
    files = file_system(spark, target)
    files.mkdirs(hadoop_path(spark, target).getParent())
    if not files.rename(hadoop_path(spark, source), hadoop_path(spark, target)):
        raise RuntimeError(f"{source} could not be moved to {target}")


def listed(spark: SparkSession, folder: str) -> list:
    """What lies directly in a folder."""
    return list(file_system(spark, folder).listStatus(hadoop_path(spark, folder))) if exists(spark, folder) else []


def files_below(spark: SparkSession, folder: str) -> list[str]:
    """Data files at any depth; hidden ones and markers don't count."""
    found, top = [], hadoop_path(spark, folder)
    if not exists(spark, folder):
        return found
    prefix = len(file_system(spark, folder).getFileStatus(top).getPath().toString())
    files = file_system(spark, folder).listFiles(top, True)
    while files.hasNext():
        path = files.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in path[prefix:].split("/")):
            found.append(path)
    return sorted(found)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern matches."""
    found = file_system(spark, pattern).globStatus(hadoop_path(spark, pattern))
    return sorted(status.getPath().toString() for status in found or [])


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, and the folders above it."""
    file_system(spark, path).create(hadoop_path(spark, path), True).close()


def bytes_of(spark: SparkSession, files: list[str]) -> int:
    return sum(file_system(spark, path).getFileStatus(hadoop_path(spark, path)).getLen() for path in files)


def write_dated(rows: DataFrame, path: str, time: str, batch: int) -> None:
    """Store one batch's rows by the date of `time`; writing the batch again replaces its own folders.

    Rows without a time are kept apart, under the date of no day. Adaptive execution
    chooses the number of files by the size of the batch.
    """
    with settings(rows.sparkSession, spark__sql__adaptive__enabled="true"):
        (
            rows.withColumns({DATE: F.to_date(time), BATCH: F.lit(batch)})
            .hint("rebalance", DATE)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DATE, BATCH)
            .parquet(path)
        )
