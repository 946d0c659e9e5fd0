"""Z-order and file index: what a filter on either column opens. Newest-first reads and the history's listings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterflow import REFERENCE
from meterflow.plans import archive, status
from meterflow.sources.tables import FolderTable, newest_rows, write_dated

CFG = REFERENCE.with_(rows_per_file=250, recent_alerts=5, tail_points=7)
DAY = dt.date(2024, 6, 25)
SCHEMA = "window_start TIMESTAMP_NTZ, zip_code STRING, load_mw DOUBLE"


@pytest.fixture
def day(spark):
    """A day of 40 zones by 10 minutes, a third of all rows in one zone, some rows without a zone or repeated."""
    rows = []
    for minute in range(0, 1_440, 10):
        at = dt.datetime.combine(DAY, dt.time()) + dt.timedelta(minutes=minute)
        rows += [(at, f"{z:05d}", float(minute + z)) for z in range(40)]
        rows += [(at + dt.timedelta(seconds=s), "00017", float(s)) for s in range(1, 20)]
    rows += [(rows[0][0], None, 1.0)] * 3 + [rows[5]] * 2
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def exported(spark, day, root, layout):
    return archive.export_segment(day, root, "zones", DAY, 0, CFG, "window_start", layout=layout).first()


def opened(spark, root, **wanted):
    return len(archive.archived_files(spark, root, "zones", **wanted))


@pytest.mark.parametrize("layout", ["zone", "zorder"])
def test_every_row_is_kept(spark, day, tmp_path, layout):
    manifest = exported(spark, day, str(tmp_path), layout)
    back = spark.read.schema(SCHEMA).parquet(archive.export_path(str(tmp_path), "zones", DAY))
    assert manifest.exported_count == day.count()
    assert sorted(map(repr, back.collect())) == sorted(map(repr, day.collect()))


def test_curve_serves_both_filters(spark, day, tmp_path):
    roots = {layout: str(tmp_path / layout) for layout in archive.LAYOUTS}
    for layout, root in roots.items():
        exported(spark, day, root, layout)
    total = {layout: opened(spark, root) for layout, root in roots.items()}
    assert min(total.values()) >= 25
    hour = {"start": dt.datetime(2024, 6, 25, 9), "end": dt.datetime(2024, 6, 25, 10)}
    for zone in ("00003", "00030"):
        assert opened(spark, roots["zorder"], zone=zone) <= total["zorder"] * 0.35
    assert opened(spark, roots["zorder"], **hour) <= total["zorder"] * 0.4
    # Zone first, by contrast, leaves a filter on time alone little to skip.
    assert opened(spark, roots["zone"], **hour) >= total["zone"] * 0.6


def test_index_opens_what_may_match(spark, day, tmp_path):
    root = str(tmp_path)
    exported(spark, day, root, "zorder")
    begin, end = dt.datetime(2024, 6, 25, 9), dt.datetime(2024, 6, 25, 12)
    for zone in (None, "00003", "00017", "00039", "absent"):
        found = archive.archived_rows(spark, root, "zones", SCHEMA, zone, begin, end)
        want = day.filter((F.col("window_start") >= F.lit(begin)) & (F.col("window_start") < F.lit(end)))
        want = want if zone is None else want.filter(F.col("zip_code") == zone)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
        files = archive.archived_files(spark, root, "zones", zone, begin, end)
        assert {f.rpartition("/")[2] for f in found.inputFiles()} == {f.rpartition("/")[2] for f in files}
    assert opened(spark, root, zone="absent") == 0
    # A zone inside a file's bounds that the file does not hold is told by the bitmaps.
    assert opened(spark, root, zone="00003x") <= 1
    assert opened(spark, root, start=dt.datetime(2024, 7, 1)) == 0
    assert archive.archived_rows(spark, root, "other", SCHEMA).count() == 0


def test_lists_do_not_grow_with_the_days(spark, tmp_path, monkeypatch):
    """The same number of listings and jobs whether ten or thirty days are asked for."""
    first = dt.datetime(2024, 5, 1)
    rows = spark.createDataFrame(
        [(first + dt.timedelta(hours=h), f"{h % 3:05d}", float(h)) for h in range(24 * 30)], SCHEMA
    )
    write_dated(rows, str(tmp_path / "hot"), "window_start", 0)
    table, root = FolderTable(spark, str(tmp_path / "hot"), SCHEMA), str(tmp_path / "cold")
    days = [first.date() + dt.timedelta(days=n) for n in range(30)]
    for day in days[:3]:
        archive.archive_one_day(archive.ArchivedTable(table, minimum=1), "zones", day, root, CFG)
    calls = []
    for name in ("matching", "files_below", "listed", "exists"):
        real = getattr(archive, name)
        monkeypatch.setattr(archive, name, lambda *a, real=real, name=name: calls.append(name) or real(*a))
    counts = []
    for n in (10, 30):
        calls.clear()
        found = archive.history_union(table, "zones", days[:n], root)
        counts.append(len(calls))
        assert found.count() == 24 * n
    assert counts[0] == counts[1] <= 5


def thirty_days(spark, path, cfg=CFG):
    """Two batches of predictions a day, of which one in nine is published."""
    rows = []
    for d in range(30):
        for h in range(0, 24, 2):
            at = dt.datetime(2024, 6, 1) + dt.timedelta(days=d, hours=h)
            for z in range(3):
                level = "CRITICAL" if (d * 36 + h * 3 + z) % 9 == 0 else "LOW"
                rows.append((at, at + dt.timedelta(minutes=1), f"{z:05d}", level, float(d), "SHED"))
    schema = (
        "window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, zip_code STRING, alert_level STRING, "
        "overload_risk_score DOUBLE, recommended_action STRING"
    )
    frame = spark.createDataFrame(rows, schema)
    for batch, part in enumerate(("hour(window_start) < 12", "hour(window_start) >= 12")):
        write_dated(frame.filter(part), path, "window_start", batch)
    return frame, FolderTable(spark, path, schema)


@pytest.mark.parametrize("limit", [1, 5, 40, 10_000])
def test_newest_alerts_read_few_days(spark, tmp_path, limit):
    frame, table = thirty_days(spark, str(tmp_path))
    cfg = CFG.with_(recent_alerts=limit)
    found = status.recent_alerts_of(table, cfg)
    assert list(map(repr, found.collect())) == list(map(repr, status.recent_alerts(frame, cfg).collect()))
    days = {path.split("event_date=")[1][:10] for path in newest_rows(table, status.published, limit).inputFiles()}
    per_day = status.published(frame).count() / 30
    assert len(days) <= max(1, 2 * -(-limit // per_day)) or len(days) == 30


def test_newest_rows_of_an_empty_table(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "none"), SCHEMA)
    assert newest_rows(table, lambda rows: rows, 3).count() == 0
