"""Nightly table maintenance: date, check, compact, export, purge, tier, cost.

An export is a segment: rows in a folder of its own, an index of its files, and a manifest,
written last, with the number of rows, an order-free checksum, their bytes and the files they
came from. A segment with a manifest is never written again, and only the files it names
are purged. So a night that stops anywhere is resumed by the next one, and rows that come
late make a further segment.

As segments age they change storage class (`lifecycle`). A change is an empty marker file
named by version and tier: it is set once the copy is verified, and readers follow the
newest one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.config import GridConfig
from meterflow.functions import labels
from meterflow.operators.loads import in_range
from meterflow.sources.tables import HotTable, bytes_of, delete, exists, files_below, listed, matching, move, touch


@dataclass(frozen=True)
class DatedTable:
    """A table to archive and the column that dates its rows."""

    rows: DataFrame
    time: str = "window_start"
    minimum: int | None = None


@dataclass(frozen=True)
class ArchivedTable:
    """A hot table for the night: the column that dates its rows, and the fewest rows a whole day has."""

    hot: HotTable
    time: str = "window_start"
    minimum: int | None = None

    def least(self, cfg: GridConfig) -> int:
        return self.minimum if self.minimum is not None else cfg.minimum_rows


def archive_date(run_date: Column, cfg: GridConfig) -> Column:
    return F.date_sub(run_date, cfg.archive_after_days)


def day_slice(df: DataFrame, day: dt.date, time: str = "window_start") -> DataFrame:
    """Rows of one day. Parquet sees it as a range on the time column and skips the rest."""
    return df.filter(F.to_date(time) == F.lit(day))


def archive_validate(tables: Mapping[str, DatedTable], day: dt.date, cfg: GridConfig) -> DataFrame:
    """Rows per table on a day against the least expected; an empty table counts 0."""
    checks = []
    for name, table in tables.items():
        least = table.minimum if table.minimum is not None else cfg.minimum_rows
        checks.append(
            day_slice(table.rows, day, table.time)
            .agg(F.count(F.lit(1)).alias("record_count"))
            .select(
                F.lit(name).alias("table_name"),
                "record_count",
                F.lit(least).cast("long").alias("expected_min"),
                (F.col("record_count") >= least).alias("ok"),
            )
        )
    return reduce(DataFrame.unionByName, checks)


def require_valid(checks: DataFrame) -> None:
    """Stop the job if a table has too few rows. The frame has one row per table."""
    short = [f"{r.table_name}: {r.record_count} of {r.expected_min}" for r in checks.filter(~F.col("ok")).collect()]
    if short:
        raise ValueError("too few rows to archive: " + "; ".join(short))


def files_for(rows: int, cfg: GridConfig) -> int:
    return max(1, -(-rows // cfg.rows_per_file))


def clustered(df: DataFrame, files: int, time: str = "window_start") -> DataFrame:
    """Range-partitioned by zone, then time: a zone that holds much of the day spreads over several files."""
    return df.repartitionByRange(files, "zip_code", time).sortWithinPartitions("zip_code", time)


#: Bits of a rank along each side of the Z-order curve.
RANK_BITS = 10


def _rank(rows: DataFrame, value: Column) -> DataFrame:
    """`(value, rank)`: which share of the rows lies before a value, in 2**RANK_BITS steps.

    Only counts per value are ordered in one place. A value that holds many rows keeps one
    rank, and the values after it start as much later.
    """
    counts = rows.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()
    before = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    share = F.coalesce(F.sum("n").over(before), F.lit(0)) / F.sum("n").over(everything)
    return counts.select("value", F.floor(share * (1 << RANK_BITS)).alias("rank"))


def zordered(df: DataFrame, files: int, time: str = "window_start") -> DataFrame:
    """Range-partitioned along a Z-order curve over zone and time, so that filters on either one skip files.

    The curve interleaves the bits of both ranks. Rows are first told apart by the curve, then
    by zone and time, so a crowded place on it spreads over files too. Times count by minute;
    rows without zone or time come first.
    """
    minute = F.date_trunc("minute", F.col(time))
    zones, times = _rank(df, F.col("zip_code")), _rank(df, minute)
    placed = df.join(zones.toDF("_zone", "_zone_rank"), F.col("zip_code").eqNullSafe(F.col("_zone"))).join(
        times.toDF("_minute", "_time_rank"), minute.eqNullSafe(F.col("_minute"))
    )
    curve = F.lit(0).cast("long")
    for bit in range(RANK_BITS):
        for place, name in enumerate(("_time_rank", "_zone_rank")):
            one = F.shiftright(F.col(name), bit).bitwiseAND(F.lit(1).cast("long"))
            curve = curve.bitwiseOR(F.shiftleft(one, 2 * bit + place))
    order = ["_curve", "zip_code", time]
    placed = placed.withColumn("_curve", curve).repartitionByRange(files, *order).sortWithinPartitions(*order)
    return placed.select(*df.columns)


LAYOUTS = {"zone": clustered, "zorder": zordered}


CHECKSUM = "decimal(38,0)"


def _checked(rows: DataFrame) -> list[Column]:
    """Number of rows and a sum of their hashes, which don't depend on the order of rows."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.xxhash64(*rows.columns).cast(CHECKSUM)), F.lit(0).cast(CHECKSUM)).alias("checksum"),
    ]


#: Seeds of the two hashes by which a file's zones are kept as bitmaps.
ZONE_SEEDS = (1, 2)


def _zone_bit(zone: Column, seed: int) -> Column:
    """A place among the 32,768 bits of a bitmap."""
    return F.pmod(F.xxhash64(F.lit(seed), zone), F.lit(32_768))


def _index_of(back: DataFrame, time: str) -> DataFrame:
    """Per file what a reader needs to skip it: bounds of zone and time, and which zones it may hold."""
    return back.groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")).agg(
        *_checked(back),
        F.min("zip_code").alias("min_zone"),
        F.max("zip_code").alias("max_zone"),
        F.min(time).cast("timestamp").alias("min_time"),
        F.max(time).cast("timestamp").alias("max_time"),
        *[
            F.bitmap_construct_agg(F.when(F.col("zip_code").isNotNull(), _zone_bit(F.col("zip_code"), seed))).alias(f"zones_{seed}")
            for seed in ZONE_SEEDS
        ],
    )


def _write_verified(
    rows: DataFrame, path: str, index: str, cfg: GridConfig, time: str, layout: str = "zone"
) -> tuple[int, object]:
    """Write rows laid out and ZSTD-packed with an index of the files; their number and checksum.

    One pass over what was written makes the index, and its sums are compared with the source's.
    """
    spark = rows.sparkSession
    seen = Observation()
    files = files_for(rows.count(), cfg)  # needs no column, so parquet answers it from footers
    LAYOUTS[layout](rows, files, time).observe(seen, *_checked(rows)).write.mode("overwrite").parquet(path, compression="zstd")
    back = spark.read.schema(rows.schema).parquet(path)
    _index_of(back, time).coalesce(1).write.mode("overwrite").parquet(index)
    sums = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("checksum"), F.lit(0)).cast(CHECKSUM).alias("checksum")]
    written = spark.read.parquet(index).agg(*sums).first()
    source = seen.get
    if (source["rows"], source["checksum"]) != (written.rows, written.checksum):
        raise RuntimeError(f"{path}: {written.rows} rows written of {source['rows']}, or their content differs")
    return written.rows, written.checksum


def export_path(root: str, name: str, day: dt.date, run: int = 0) -> str:
    return f"{root}/{day.isoformat()}/{name}/run={run}"


def manifest_path(root: str, name: str, day: dt.date, run: int = 0) -> str:
    return f"{root}/manifests/{day.isoformat()}/{name}/run={run}"


def index_path(root: str, name: str, day: dt.date, run: int = 0, version: int = 0) -> str:
    return f"{root}/index/{day.isoformat()}/{name}/run={run}/version={version}"


MANIFEST = (
    "table_name string, archive_date date, run int, source_count bigint, exported_count bigint, "
    f"checksum {CHECKSUM}, bytes bigint, files array<string>"
)


def is_exported(spark: SparkSession, root: str, name: str, day: dt.date, run: int = 0) -> bool:
    return exists(spark, f"{manifest_path(root, name, day, run)}/_SUCCESS")


def exported_runs(spark: SparkSession, root: str, name: str, day: dt.date) -> list[int]:
    """Numbers of the finished segments of a day."""
    names = (found.getPath().getName() for found in listed(spark, f"{root}/manifests/{day.isoformat()}/{name}"))
    runs = sorted(int(name.removeprefix("run=")) for name in names if name.startswith("run="))
    return [run for run in runs if is_exported(spark, root, name, day, run)]


def manifests(spark: SparkSession, root: str, name: str, day: dt.date) -> DataFrame:
    """The manifests of a day's finished segments."""
    paths = [manifest_path(root, name, day, run) for run in exported_runs(spark, root, name, day)]
    return spark.read.schema(MANIFEST).parquet(*paths) if paths else spark.createDataFrame([], MANIFEST)


def export_segment(
    rows: DataFrame,
    root: str,
    name: str,
    day: dt.date,
    run: int,
    cfg: GridConfig,
    time: str,
    files: Sequence[str] = (),
    layout: str = "zone",
) -> DataFrame:
    """Write one segment and its manifest. A finished one stays as it is; an unfinished one is written anew."""
    spark = rows.sparkSession
    path = export_path(root, name, day, run)
    if not is_exported(spark, root, name, day, run):
        count, checksum = _write_verified(rows, path, index_path(root, name, day, run), cfg, time, layout)
        size = bytes_of(spark, files_below(spark, path))
        entry = [(name, day, run, count, count, checksum, size, list(files))]
        spark.createDataFrame(entry, MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            manifest_path(root, name, day, run)
        )
    return spark.read.schema(MANIFEST).parquet(manifest_path(root, name, day, run))


def archive_export(
    df: DataFrame, root: str, name: str, day: dt.date, cfg: GridConfig, time: str = "window_start"
) -> DataFrame:
    """Export one day of a frame as a first segment, unless that is finished already; returns its manifest."""
    found = export_segment(day_slice(df, day, time), root, name, day, 0, cfg, time)
    return found.select("table_name", "archive_date", "source_count", "exported_count")


def segment_paths(spark: SparkSession, root: str, name: str, day: dt.date) -> list[str]:
    return [export_path(root, name, day, run) for run in exported_runs(spark, root, name, day)]


def compact_day(
    df: DataFrame,
    staging: str,
    name: str,
    day: dt.date,
    cfg: GridConfig,
    time: str = "window_start",
    layout: str = "zone",
) -> DataFrame:
    """Rewrite one day of a frame into few files, in a staging folder: clustered by zone, or along a curve over both columns."""
    found = export_segment(day_slice(df, day, time), staging, name, day, 0, cfg, time, layout=layout)
    return found.select(
        "table_name",
        "archive_date",
        F.col("source_count").alias("rows_before"),
        F.col("exported_count").alias("rows_after"),
    )


def swap_day(table: HotTable, name: str, day: dt.date, staging: str) -> None:
    """Put a staged copy in the place of the files it was made from, or finish a swap that was stopped.

    The staged manifest names both sides until the swap is done: first the copy's files
    move in, then the sources go, then the manifest. Repeating any step is harmless.
    """
    spark = table.spark
    found = manifests(spark, staging, name, day).first()
    if found is None:
        return
    staged, home = export_path(staging, name, day), table.home(day)
    for path in files_below(spark, staged):
        move(spark, path, f"{home}/{path.rpartition('/')[2]}")
    for path in found.files:
        delete(spark, path)
    table.changed()
    delete(spark, manifest_path(staging, name, day))


def visible_files(table: HotTable, name: str, day: dt.date, root: str) -> list[str]:
    """Files that hold each hot row of a day once: without those exported, nor those that a stopped swap replaces."""
    spark = table.spark
    gone = {path for row in manifests(spark, root, name, day).collect() for path in row.files}
    staging = f"{root}/staging"
    staged: list[str] = []
    for row in manifests(spark, staging, name, day).collect():
        gone |= set(row.files)
        staged = files_below(spark, export_path(staging, name, day))
    return [path for path in table.files(day) if path not in gone] + staged


def compact_hot_day(table: ArchivedTable, name: str, day: dt.date, root: str, cfg: GridConfig) -> None:
    """Rewrite the files of one hot day into few, after finishing a swap that was stopped."""
    staging = f"{root}/staging"
    swap_day(table.hot, name, day, staging)
    files = table.hot.files(day)
    if files:
        export_segment(table.hot.read(files), staging, name, day, 0, cfg, table.time, files)
        swap_day(table.hot, name, day, staging)


def purge_segments(table: HotTable, name: str, day: dt.date, root: str) -> int:
    """Delete the hot files that a day's finished segments name; the rows that these hold."""
    spark, purged = table.spark, 0
    for row in manifests(spark, root, name, day).collect():  # a row per segment
        for path in row.files:
            delete(spark, path)
        purged += row.exported_count
    table.changed()
    return purged


def purge_retained(df: DataFrame, day: dt.date, time: str = "window_start") -> DataFrame:
    """What stays in a table once a day is purged. Rows without a time are not of that day and stay."""
    return df.filter(~F.to_date(time).eqNullSafe(F.lit(day)))


@dataclass(frozen=True)
class Segment:
    """A finished segment and where its rows lie now; nowhere (None) once it was deleted."""

    name: str
    day: dt.date
    run: int
    version: int = 0
    tier: str = "hot"
    path: str | None = None

    def index(self, root: str) -> str:
        return index_path(root, self.name, self.day, self.run, self.version)


def tier_root(root: str, tier: str) -> str:
    """The folder of a storage class; segments lie where they were exported until their first change."""
    return root if tier == "hot" else f"{root}/tiers/{tier}"


def location_path(root: str, segment: Segment, version: int, tier: str) -> str:
    return f"{root}/locations/{segment.day.isoformat()}/{segment.name}/run={segment.run}/{version}-{tier}"


def segments(spark: SparkSession, root: str, name: str) -> list[Segment]:
    """All finished segments of a table, by one listing of the manifests and one of the changes of class."""

    def key(path: str) -> tuple[dt.date, int]:
        day, _, run = path.split("/")[-4:-1]
        return dt.date.fromisoformat(day), int(run.removeprefix("run="))

    newest: dict[tuple[dt.date, int], tuple[int, str]] = {}
    for path in matching(spark, f"{root}/locations/*/{name}/run=*/*"):
        version, _, tier = path.rpartition("/")[2].partition("-")
        newest[key(path)] = max(newest.get(key(path), (0, "hot")), (int(version), tier))
    found = []
    for day, run in sorted(key(path) for path in matching(spark, f"{root}/manifests/*/{name}/run=*/_SUCCESS")):
        version, tier = newest.get((day, run), (0, "hot"))
        path = None if tier == DELETED else export_path(tier_root(root, tier), name, day, run)
        found.append(Segment(name, day, run, version, tier, path))
    return found


def _purged_files(spark: SparkSession, root: str, found: Iterable[Segment]) -> set[str]:
    """The hot files whose rows some segments hold."""
    paths = [manifest_path(root, s.name, s.day, s.run) for s in found]
    if not paths:
        return set()
    rows = spark.read.schema(MANIFEST).parquet(*paths).select(F.explode("files").alias("file")).collect()
    return {row.file for row in rows}


def history_union(table: HotTable, name: str, days: Sequence[dt.date], root: str) -> DataFrame:
    """Every row of some days once, wherever it is: the hot files that no segment names, and the segments.

    The number of listings does not grow with the days, and manifests are read only for days
    that still have hot files, or a swap that was stopped.
    """
    spark, wanted = table.spark, set(days)
    archived = [s for s in segments(spark, root, name) if s.day in wanted]
    staging = f"{root}/staging"
    staged = [s for s in segments(spark, staging, name) if s.day in wanted]
    hot = {day: files for day, files in table.files_by_day().items() if day in wanted}
    gone = _purged_files(spark, root, [s for s in archived if s.day in hot]) | _purged_files(spark, staging, staged)
    files = [path for day in sorted(hot) for path in hot[day] if path not in gone]
    files += [path for s in staged for path in files_below(spark, export_path(staging, name, s.day))]
    rows = table.read(files)
    cold = [s.path for s in archived if s.path is not None]
    return rows.unionByName(spark.read.schema(rows.schema).parquet(*cold)) if cold else rows


def archived_files(
    spark: SparkSession, root: str, name: str, zone: str | None = None, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> list[str]:
    """Files of the archive that may hold rows of a zone and of `start <= time < end`.

    Other days are left out by their names, other files by the index: by the bounds of time
    and zone, and by the bitmaps of the zones.
    """
    found = [
        s
        for s in segments(spark, root, name)
        if s.path is not None and (start is None or s.day >= start.date()) and (end is None or s.day <= end.date())
    ]
    if not found:
        return []
    paths = {s.index(root): s.path for s in found}
    folder = F.regexp_extract(F.input_file_name(), r"/index/([^/]+/.+)/[^/]+$", 1)
    index = spark.read.parquet(*paths).withColumn("at", folder)
    if start is not None:
        index = index.filter(F.col("max_time") >= F.lit(start).cast("timestamp"))
    if end is not None:
        index = index.filter(F.col("min_time") < F.lit(end).cast("timestamp"))
    if zone is not None:
        index = index.filter((F.col("min_zone") <= zone) & (F.col("max_zone") >= zone))
        for seed in ZONE_SEEDS:
            bit = _zone_bit(F.lit(zone), seed)
            byte = F.conv(F.hex(F.substring(F.col(f"zones_{seed}"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            index = index.filter(F.getbit(byte, (bit % 8).cast("int")) == 1)
    homes = {path.partition("/index/")[2]: home for path, home in paths.items()}
    return sorted(f"{homes[row.at]}/{row.file}" for row in index.select("at", "file").collect())


def archived_rows(
    spark: SparkSession,
    root: str,
    name: str,
    schema: str,
    zone: str | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    time: str = "window_start",
) -> DataFrame:
    """Archived rows of a zone and a span of time, from the files that may hold any."""
    files = archived_files(spark, root, name, zone, start, end)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return in_range(rows, zone, start, end, time)


TIERS = ("hot", "warm", "cool", "archive", "delete")
DELETED = "delete"


def lifecycle_plan(found: DataFrame, as_of: dt.date, cfg: GridConfig) -> DataFrame:
    """What is due for segments (`table_name, archive_date, run, tier`): their age, the tier for it, and the action.

    Segments only move on, never back; what was deleted stays so.
    """
    age = F.date_diff(F.lit(as_of), F.col("archive_date"))
    place = lambda tier: F.array_position(F.array(*[F.lit(t) for t in TIERS]), tier)
    due = labels.storage_tier(F.col("age_days"), cfg)
    return (
        found.withColumn("age_days", age)
        .withColumn("due_tier", F.when(place(due) > place(F.col("tier")), due).otherwise(F.col("tier")))
        .withColumn(
            "action",
            F.when(F.col("due_tier") == F.col("tier"), "keep").when(F.col("due_tier") == DELETED, DELETED).otherwise("move"),
        )
    )


SEGMENTS = "table_name string, archive_date date, run int, tier string"


def segment_table(spark: SparkSession, found: Iterable[Segment]) -> DataFrame:
    return spark.createDataFrame([(s.name, s.day, s.run, s.tier) for s in found], SEGMENTS)


def change_tier(spark: SparkSession, root: str, segment: Segment, tier: str, cfg: GridConfig, time: str) -> Segment:
    """Move a segment to another storage class, or delete it. A change that stops anywhere is done by the next one.

    A copy is written and verified against the manifest, then the marker makes it the
    segment, and only then the old copy goes. Deletion sets its marker first.
    """
    version = segment.version + 1
    target = None
    if tier != DELETED:
        target = export_path(tier_root(root, tier), segment.name, segment.day, segment.run)
        index = index_path(root, segment.name, segment.day, segment.run, version)
        copied = _write_verified(spark.read.parquet(segment.path), target, index, cfg, time)
        stated = spark.read.schema(MANIFEST).parquet(manifest_path(root, segment.name, segment.day, segment.run)).first()
        if copied != (stated.exported_count, stated.checksum):
            raise RuntimeError(f"{segment.path}: {copied[0]} rows found of {stated.exported_count}, or their content differs")
    touch(spark, location_path(root, segment, version, tier))
    moved = replace(segment, version=version, tier=tier, path=target)
    drop_old_copies(spark, root, moved)
    return moved


def drop_old_copies(spark: SparkSession, root: str, segment: Segment) -> None:
    """Delete what earlier versions of a segment left, and then their markers."""
    markers = matching(spark, f"{root}/locations/{segment.day.isoformat()}/{segment.name}/run={segment.run}/*")
    for marker in markers:
        version, _, tier = marker.rpartition("/")[2].partition("-")
        if int(version) < segment.version:
            _drop_copy(spark, root, replace(segment, version=int(version), tier=tier))
            delete(spark, marker)
    if segment.version:
        _drop_copy(spark, root, replace(segment, version=0, tier="hot"))


def _drop_copy(spark: SparkSession, root: str, old: Segment) -> None:
    for path in (export_path(tier_root(root, old.tier), old.name, old.day, old.run), old.index(root)):
        if exists(spark, path):
            delete(spark, path)


def lifecycle(
    spark: SparkSession, names: Mapping[str, str], root: str, as_of: dt.date, cfg: GridConfig
) -> DataFrame:
    """Bring all segments of some tables (with their time columns) to the tier their age asks for.

    Every row stays readable once until its deletion is due. Returns the plan as it stood.
    """
    found = {(s.name, s.day, s.run): s for name in names for s in segments(spark, root, name)}
    plan = lifecycle_plan(segment_table(spark, found.values()), as_of, cfg)
    steps = plan.collect()  # a row per segment
    for segment in found.values():
        drop_old_copies(spark, root, segment)
    for step in steps:
        if step.action != "keep":
            segment = found[step.table_name, step.archive_date, step.run]
            change_tier(spark, root, segment, step.due_tier, cfg, names[segment.name])
    return spark.createDataFrame(steps, plan.schema)


def storage_tier(df: DataFrame, as_of: dt.date, cfg: GridConfig, time: str = "event_time") -> DataFrame:
    age = F.date_diff(F.lit(as_of), F.to_date(time))
    return df.withColumn("age_days", age).withColumn("tier", labels.storage_tier(F.col("age_days"), cfg))


def cost_savings(
    df: DataFrame, as_of: dt.date, cfg: GridConfig, time: str = "event_time", bytes_per_row: float | None = None
) -> DataFrame:
    """What archiving the rows old enough for it saves, by month of the rows.

    `bytes_per_row` is measured (`stored_bytes`); without it the configured size is assumed.
    """
    price_gap = cfg.hot_price_gb_month - cfg.archive_price_gb_month
    size = cfg.row_bytes if bytes_per_row is None else bytes_per_row
    newest = as_of - dt.timedelta(days=cfg.archive_after_days)
    return (
        df.filter(F.to_date(time) <= F.lit(newest))
        .groupBy(F.date_format(time, "yyyy-MM").alias("month"))
        .agg(F.count(F.lit(1)).alias("archived_rows"))
        .withColumn("gb", F.col("archived_rows") * size / F.lit(1e9))
        .withColumn("monthly_savings", F.col("gb") * price_gap)
        .withColumn("annual_savings", F.col("monthly_savings") * 12)
    )


def savings_for(gb: float, cfg: GridConfig) -> tuple[float, float]:
    """Monthly and annual saving for a known volume."""
    monthly = gb * (cfg.hot_price_gb_month - cfg.archive_price_gb_month)
    return monthly, monthly * 12


def stored_bytes(spark: SparkSession, root: str, name: str, day: dt.date, cfg: GridConfig = GridConfig()) -> DataFrame:
    """Volume of a day's segments as their manifests state it, with what keeping them cold saves."""
    found = manifests(spark, root, name, day).agg(
        (F.coalesce(F.sum("bytes"), F.lit(0)) / F.lit(1e9)).alias("gb"),
        F.coalesce(F.sum("exported_count"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("segments"),
    )
    price_gap = cfg.hot_price_gb_month - cfg.archive_price_gb_month
    return found.withColumn("monthly_savings", F.col("gb") * price_gap).withColumn("annual_savings", F.col("monthly_savings") * 12)


def archive_one_day(
    table: ArchivedTable, name: str, day: dt.date, root: str, cfg: GridConfig, compact_first: bool = False
) -> str | None:
    """Resume, export and purge one day of one table; what is wrong with it, if anything."""
    spark, hot = table.hot.spark, table.hot
    purge_segments(hot, name, day, root)  # what an earlier night exported but didn't finish purging
    swap_day(hot, name, day, f"{root}/staging")
    files, runs = hot.files(day), exported_runs(spark, root, name, day)
    if not files and runs:
        return None
    if not runs and (count := hot.read(files).count()) < table.least(cfg):
        return f"{name} {day}: {count} of {table.least(cfg)}"
    if compact_first:
        compact_hot_day(table, name, day, root, cfg)
        files = hot.files(day)
    export_segment(hot.read(files), root, name, day, runs[-1] + 1 if runs else 0, cfg, table.time, files)
    purge_segments(hot, name, day, root)
    return None


def nightly_archive(
    spark: SparkSession,
    tables: Mapping[str, ArchivedTable],
    run_date: dt.date,
    root: str,
    cfg: GridConfig,
    compact_first: bool = False,
) -> DataFrame:
    """The whole night: check, export and purge every day that is old enough and still has hot files.

    Days that earlier nights missed are caught up. Rows that came late to an archived day
    become a further segment, however few they are. A first export needs the table's
    minimum: days with fewer rows stay hot, and the night ends with an error that names
    them, after it has done the others. Returns the manifests of the days it worked on.
    """
    last = run_date - dt.timedelta(days=cfg.archive_after_days)
    short, worked = [], []
    for name, table in tables.items():
        # Days that earlier nights purged have no files.
        for day in sorted({day for day in table.hot.files_by_day() if day <= last} | {last}):
            problem = archive_one_day(table, name, day, root, cfg, compact_first)
            short += [problem] if problem else []
            worked.append((name, day))
    if short:
        raise ValueError("too few rows to archive: " + "; ".join(short))
    found = [manifests(spark, root, name, day) for name, day in worked]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], MANIFEST)
