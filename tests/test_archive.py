import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterflow import REFERENCE
from meterflow.functions import labels
from meterflow.plans import archive, reports
from meterflow.sources import tables as source_tables
from meterflow.sources.tables import CatalogTable, FolderTable, write_dated
from tests.conftest import as_dicts

CFG = REFERENCE.with_(minimum_raw_rows=100, minimum_rows=10, rows_per_file=50)
RUN = dt.date(2024, 7, 25)
DAY = dt.date(2024, 6, 25)


def rows_of(spark, per_day, days=3, time="window_start", first=dt.datetime(2024, 6, 24)):
    rows = []
    for d in range(days):
        for i in range(per_day):
            zone = "hot" if i % 3 == 0 else f"{i % 7:05d}"
            rows.append((first + dt.timedelta(days=d, seconds=i * 86_400 // per_day), zone, float(i)))
    return spark.createDataFrame(rows, f"{time} TIMESTAMP_NTZ, zip_code STRING, load_mw DOUBLE")


class Hot:
    """A hot table of either kind that rows can be added to."""

    def __init__(self, spark, kind, name, time, where):
        self.spark, self.kind, self.time, self.batches = spark, kind, time, 0
        self.name, self.path = f"{name}_rows", f"{where}/hot/{name}"
        schema = f"{time} TIMESTAMP_NTZ, zip_code STRING, load_mw DOUBLE"
        if kind == "folder":
            self.table = FolderTable(spark, self.path, schema)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {self.name}")
            spark.sql(f"CREATE TABLE {self.name} ({schema}, event_date DATE) USING parquet PARTITIONED BY (event_date)")
            self.table = CatalogTable(spark, self.name)

    def add(self, rows):
        if self.kind == "folder":
            write_dated(rows, self.path, self.time, self.batches)
        else:
            rows.withColumn("event_date", F.to_date(self.time)).write.insertInto(self.name)
        self.batches += 1

    def archived(self, minimum=None):
        return archive.ArchivedTable(self.table, self.time, minimum)


@pytest.fixture(params=["catalog", "folder"])
def make(spark, tmp_path, request):
    return lambda name="zones", time="window_start": Hot(spark, request.param, name, time, str(tmp_path))


@pytest.fixture
def zones(spark, make):
    """Three days of 120 rows, each in two batches."""
    hot = make()
    rows = rows_of(spark, 120)
    for part in ("hour(window_start) < 8", "hour(window_start) >= 8"):
        hot.add(rows.filter(part))
    return hot


def everywhere(hot, root, days=range(-3, 5)):
    """All rows, hot and archived, as the reader of the history sees them."""
    wanted = [DAY + dt.timedelta(days=d) for d in days]
    found = archive.history_union(hot.table, "zones", wanted, root)
    return sorted(map(repr, found.select(hot.time, "zip_code", "load_mw").collect()))


def night(spark, hot, root, compact_first=False, run=RUN, cfg=CFG):
    return archive.nightly_archive(spark, {"zones": hot.archived()}, run, root, cfg, compact_first)


class Stop(Exception):
    pass


def stopping(monkeypatch, after):
    """Let the job stop after so many deletions and moves of files."""
    left = [after]

    def counted(step):
        def run(*arguments):
            if left[0] == 0:
                raise Stop
            left[0] -= 1
            return step(*arguments)

        return run

    monkeypatch.setattr(archive, "delete", counted(source_tables.delete))
    monkeypatch.setattr(archive, "move", counted(source_tables.move))


@pytest.mark.parametrize("compact_first", [False, True])
def test_nightly(spark, tmp_path, zones, make, compact_first):
    raw, root = make("raw", "event_time"), str(tmp_path / "cold")
    raw.add(rows_of(spark, 300, time="event_time", days=2))
    tables = {"raw": raw.archived(minimum=100), "zones": zones.archived()}
    before = everywhere(zones, root)
    manifest = as_dicts(archive.nightly_archive(spark, tables, RUN, root, CFG, compact_first), "table_name", "archive_date")
    # The day before was missed by earlier nights and is caught up.
    assert [(r["table_name"], r["archive_date"], r["exported_count"]) for r in manifest] == [
        ("raw", DAY - dt.timedelta(days=1), 300), ("raw", DAY, 300),
        ("zones", DAY - dt.timedelta(days=1), 120), ("zones", DAY, 120),
    ]
    assert raw.table.rows(DAY).isEmpty() and zones.table.rows(DAY).isEmpty()
    assert zones.table.rows(DAY + dt.timedelta(days=1)).count() == 120
    assert everywhere(zones, root) == before
    exported = spark.read.parquet(archive.export_path(root, "zones", DAY))
    assert exported.columns == ["window_start", "zip_code", "load_mw"]
    again = archive.nightly_archive(spark, tables, RUN, root, CFG, compact_first)
    assert {r["exported_count"] for r in as_dicts(again)} == {120, 300}
    assert everywhere(zones, root) == before


@pytest.mark.parametrize("compact_first", [False, True])
def test_stopped_anywhere_and_resumed(spark, tmp_path, make, monkeypatch, compact_first):
    """After each deletion or move: the history is whole at the stop, and whole after the next night."""
    after = 0
    while True:
        hot, root = make(f"stop{after}"), str(tmp_path / f"cold{after}")
        rows = rows_of(spark, 40, days=1, first=dt.datetime.combine(DAY, dt.time()))
        for part in ("load_mw < 15", "load_mw >= 15"):
            hot.add(rows.filter(part).coalesce(1))
        before = everywhere(hot, root, [0])
        with monkeypatch.context() as patch:
            stopping(patch, after)
            try:
                night(spark, hot, root, compact_first)
                finished = True
            except Stop:
                finished = False
        assert everywhere(hot, root, [0]) == before
        night(spark, hot, root, compact_first)
        assert everywhere(hot, root, [0]) == before and hot.table.rows(DAY).isEmpty()
        if finished:
            assert after > 0
            return
        after += 1


@pytest.mark.parametrize("compact_first", [False, True])
@pytest.mark.parametrize("late", [1, 50])
def test_late_rows_make_a_further_segment(spark, tmp_path, zones, late, compact_first):
    root = str(tmp_path / "cold")
    night(spark, zones, root, compact_first)
    zones.add(rows_of(spark, late, days=1, first=dt.datetime.combine(DAY, dt.time())))
    before = everywhere(zones, root)
    assert len(before) == 360 + late
    found = as_dicts(night(spark, zones, root, compact_first).filter(F.col("archive_date") == DAY), "run")
    assert [(r["run"], r["exported_count"]) for r in found] == [(0, 120), (1, late)]
    assert everywhere(zones, root) == before and zones.table.rows(DAY).isEmpty()


def test_rows_that_come_during_the_night_stay(spark, tmp_path, zones, monkeypatch):
    """Between the export and the purge: only the files that were exported go."""
    root = str(tmp_path / "cold")
    purge = archive.purge_segments
    calls = []

    def late_arrival(table, name, day, where):
        if archive.exported_runs(spark, where, name, day) and not calls:
            calls.append(day)
            zones.add(rows_of(spark, 7, days=1, first=dt.datetime.combine(day, dt.time())))
        return purge(table, name, day, where)

    monkeypatch.setattr(archive, "purge_segments", late_arrival)
    night(spark, zones, root)
    assert calls and len(everywhere(zones, root)) == 367
    assert zones.table.rows(calls[0]).count() == 7


@pytest.mark.parametrize("compact_first", [False, True])
def test_too_few_rows_stay_hot_and_stop_nothing_else(spark, tmp_path, zones, make, compact_first):
    few, root = make("few"), str(tmp_path / "cold")
    few.add(rows_of(spark, 9, days=1, first=dt.datetime.combine(DAY, dt.time())))
    tables = {"few": few.archived(), "zones": zones.archived()}
    with pytest.raises(ValueError, match="few 2024-06-25: 9 of 10"):
        archive.nightly_archive(spark, tables, RUN, root, CFG, compact_first)
    assert few.table.rows(DAY).count() == 9 and zones.table.rows(DAY).isEmpty()
    few.add(rows_of(spark, 1, days=1, first=dt.datetime.combine(DAY, dt.time(9))))
    archive.nightly_archive(spark, tables, RUN, root, CFG, compact_first)
    assert few.table.rows(DAY).isEmpty()


def test_swap_keeps_rows_that_came_since(spark, tmp_path, zones):
    root, table = str(tmp_path / "cold"), zones.table
    files = table.files(DAY)
    archive.export_segment(table.read(files), f"{root}/staging", "zones", DAY, 0, CFG, "window_start", files)
    zones.add(rows_of(spark, 5, days=1, first=dt.datetime.combine(DAY, dt.time(9))))
    before = everywhere(zones, root)
    archive.swap_day(table, "zones", DAY, f"{root}/staging")
    assert everywhere(zones, root) == before and len(before) == 365
    assert not set(files) & set(table.files(DAY))


def test_a_finished_export_is_never_written_again(spark, tmp_path):
    df, root = rows_of(spark, 100), str(tmp_path)
    first = as_dicts(archive.archive_export(df, root, "zones", DAY, CFG))
    assert as_dicts(archive.archive_export(df.limit(3), root, "zones", DAY, CFG)) == first
    assert spark.read.parquet(archive.export_path(root, "zones", DAY)).count() == 100
    volume = archive.stored_bytes(spark, root, "zones", DAY).first()
    assert 0 < volume.gb < 1e-3 and (volume.rows, volume.segments) == (100, 1)


def test_content_is_compared_not_just_counted(spark):
    a = rows_of(spark, 20, days=1)
    b = a.withColumn("load_mw", F.col("load_mw") + (F.col("load_mw") == 7).cast("int"))
    one, two, three = (df.agg(*archive._checked(df)).first() for df in (a, b, a.repartition(3)))
    assert one == three and one.rows == two.rows and one.checksum != two.checksum


def test_missing_day_counts_zero(spark):
    checks = archive.archive_validate(
        {"zip_aggregations": archive.DatedTable(rows_of(spark, 20))}, dt.date(2030, 1, 1), CFG
    )
    assert as_dicts(checks) == [
        {"table_name": "zip_aggregations", "record_count": 0, "expected_min": 10, "ok": False}
    ]


def test_compacted_files_are_clustered_and_split_the_hot_zone(spark, tmp_path):
    archive.compact_day(rows_of(spark, 1_000), str(tmp_path), "zones", DAY, CFG)
    files = spark.read.parquet(archive.export_path(str(tmp_path), "zones", DAY)).withColumn("file", F.input_file_name())
    per_zone = {r.zip_code: r.n for r in files.groupBy("zip_code").agg(F.countDistinct("file").alias("n")).collect()}
    assert per_zone["hot"] > 3
    assert max(n for zone, n in per_zone.items() if zone != "hot") <= 5
    assert files.groupBy("file").count().agg(F.max("count")).first()[0] < 200


def test_a_days_read_lists_its_own_folders_only(spark, tmp_path):
    """Over 200 batches, most of them of other days."""
    path = tmp_path / "dated"
    for batch in range(200):
        day = DAY + dt.timedelta(days=batch % 20)
        folder = path / f"event_date={day}" / f"batch_id={batch}"
        folder.mkdir(parents=True)
        (folder / "part-0.parquet").write_bytes(b"")
    table = FolderTable(spark, str(path), "window_start TIMESTAMP, zip_code STRING, load_mw DOUBLE")
    files = table.files(DAY)
    assert len(files) == 10 and all(f"event_date={DAY}" in f for f in files)
    assert len(table.days(DAY + dt.timedelta(days=30))) == 20


def test_retained_rows_keep_those_without_time(spark):
    df = rows_of(spark, 10).unionByName(
        spark.createDataFrame([(None, "z", 1.0)], "window_start TIMESTAMP_NTZ, zip_code STRING, load_mw DOUBLE")
    )
    assert archive.purge_retained(df, DAY).count() == 21


def test_rows_without_a_time_are_of_no_day(spark, make):
    hot = make("undated")
    hot.add(spark.createDataFrame([(None, "z", 1.0)], "window_start TIMESTAMP_NTZ, zip_code STRING, load_mw DOUBLE"))
    hot.add(rows_of(spark, 2, days=1))
    assert hot.table.days(DAY) == [dt.date(2024, 6, 24)]


@pytest.mark.parametrize(
    ("age", "tier"),
    [(0, "hot"), (7, "hot"), (8, "warm"), (30, "warm"), (31, "cool"), (90, "cool"), (91, "archive"),
     (2_555, "archive"), (2_556, "delete")],
)
def test_tiers(spark, age, tier):
    df = spark.createDataFrame([(age,)], "age INT")
    assert df.select(labels.storage_tier(F.col("age"), REFERENCE).alias("t")).first().t == tier


def test_savings():
    monthly, annual = archive.savings_for(500, REFERENCE)
    assert (round(monthly, 3), round(annual, 2)) == (8.705, 104.46)


def test_cost_by_month(spark):
    df = rows_of(spark, 10, days=10, time="event_time")  # 24 June to 3 July
    rows = {r["month"]: r for r in as_dicts(archive.cost_savings(df, dt.date(2024, 8, 1), REFERENCE, bytes_per_row=1e9))}
    assert {m: r["archived_rows"] for m, r in rows.items()} == {"2024-06": 70, "2024-07": 20}
    assert rows["2024-06"]["monthly_savings"] == pytest.approx(70 * (0.0184 - 0.00099))


def test_csv(spark, tmp_path):
    reports.write_csv(rows_of(spark, 5, days=1), str(tmp_path / "report"))
    back = spark.read.option("header", True).csv(str(tmp_path / "report"))
    assert back.columns == ["window_start", "zip_code", "load_mw"] and back.count() == 5
