import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterflow import REFERENCE
from meterflow.plans import archive
from meterflow.sources import tables as source_tables

CFG = REFERENCE.with_(rows_per_file=20, hot_days=5, warm_days=10, archive_days=20, delete_days=40)
FIRST = dt.date(2024, 6, 1)
DAYS = [FIRST + dt.timedelta(days=n) for n in (0, 1)]
SCHEMA = "window_start TIMESTAMP_NTZ, zip_code STRING, load_mw DOUBLE"


@pytest.fixture
def archived(spark, tmp_path):
    """Days of one table as segments, the second one in two runs."""

    def make(name="cold", days=DAYS):
        root = str(tmp_path / name)
        for n, day in enumerate(days):
            for run in range(n + 1):
                begin = dt.datetime.combine(day, dt.time())
                rows = [(begin + dt.timedelta(minutes=10 * i + run), f"{i % 4:05d}", float(i)) for i in range(30)]
                archive.export_segment(spark.createDataFrame(rows, SCHEMA), root, "zones", day, run, CFG, "window_start")
        return root

    return make


def readable(spark, root):
    return sorted(map(repr, archive.archived_rows(spark, root, "zones", SCHEMA).collect()))


def live(spark, root, day):
    return archive.lifecycle(spark, {"zones": "window_start"}, root, day, CFG)


def tiers(spark, root):
    return [(s.day, s.run, s.tier) for s in archive.segments(spark, root, "zones")]


def test_segments_age(spark, archived):
    root = archived()
    whole = readable(spark, root)
    assert len(whole) == 90
    for age, tier in ((3, "hot"), (7, "warm"), (12, "cool"), (15, "cool"), (25, "archive")):
        plan = live(spark, root, DAYS[1] + dt.timedelta(days=age)).collect()
        assert {r.due_tier for r in plan} == {tier}
        assert {t for *_, t in tiers(spark, root)} == {tier}
        assert readable(spark, root) == whole
        # One copy only, where the tier says.
        assert source_tables.exists(spark, archive.export_path(root, "zones", DAYS[0])) == (tier == "hot")
        assert len(source_tables.matching(spark, f"{root}/index/*/zones/run=*/version=*")) == 3
    assert all(r.action == "keep" for r in live(spark, root, DAYS[1] + dt.timedelta(days=25)).collect())
    live(spark, root, DAYS[0] + dt.timedelta(days=41))
    assert tiers(spark, root) == [(DAYS[0], 0, "delete"), (DAYS[1], 0, "archive"), (DAYS[1], 1, "archive")]
    assert len(readable(spark, root)) == 60
    assert not source_tables.files_below(spark, f"{root}/tiers/archive/{DAYS[0]}")
    # Nothing comes back, and the manifests still tell what was there.
    assert all(r.action == "keep" for r in live(spark, root, DAYS[1]).collect())
    assert archive.manifests(spark, root, "zones", DAYS[0]).first().exported_count == 30


class Stop(Exception):
    pass


@pytest.mark.parametrize("age", [12, 45])
def test_stopped_after_every_step(spark, archived, monkeypatch, age):
    """Steps are markers, deletions and written copies. Rows stay readable once until their deletion is due."""
    as_of, after = DAYS[0] + dt.timedelta(days=age), 0
    while True:
        root = archived(f"stop{after}", DAYS[:1])
        whole = readable(spark, root)
        left = [after]

        def counted(step):
            def run(*arguments, **named):
                if left[0] == 0:
                    raise Stop
                left[0] -= 1
                return step(*arguments, **named)

            return run

        with monkeypatch.context() as patch:
            for name in ("delete", "touch", "_write_verified"):
                patch.setattr(archive, name, counted(getattr(archive, name)))
            try:
                live(spark, root, as_of)
                finished = True
            except Stop:
                finished = False
        seen = readable(spark, root)
        assert len(set(seen)) == len(seen) and set(seen) <= set(whole)
        if age < CFG.delete_days:
            assert seen == whole
        live(spark, root, as_of)
        assert readable(spark, root) == (whole if age < CFG.delete_days else [])
        assert len({t for *_, t in tiers(spark, root)}) == 1
        copies = source_tables.matching(spark, f"{root}/tiers/*/*/zones/run=*") + source_tables.matching(spark, f"{root}/2024*/zones/run=*")
        assert len(copies) == (1 if age < CFG.delete_days else 0)
        if finished:
            assert after >= (4 if age < CFG.delete_days else 3)
            return
        after += 1


def test_a_damaged_copy_is_not_taken_over(spark, archived):
    root = archived()
    path = archive.export_path(root, "zones", DAYS[0])
    source_tables.delete(spark, source_tables.files_below(spark, path)[0])
    with pytest.raises(RuntimeError, match="rows found of"):
        live(spark, root, DAYS[0] + dt.timedelta(days=12))
    assert tiers(spark, root)[0][2] == "hot"


def test_validation_misses_no_prediction(spark):
    """One prediction less than the least: the day does not pass."""
    from checks.registry import ARCHIVE_DAY, Inputs
    from tests.conftest import MEDIUM

    rows = Inputs(spark, MEDIUM).counted_tables()["predictions"].rows
    of_day = archive.day_slice(rows, ARCHIVE_DAY)
    whole = of_day.count()
    first = of_day.orderBy("window_start", "zip_code").first()
    less = rows.filter(~((F.col("window_start") == F.lit(first.window_start)) & (F.col("zip_code") == first.zip_code)))
    for frame, ok in ((rows, True), (less, False)):
        table = {"predictions": archive.DatedTable(frame, minimum=whole)}
        assert archive.archive_validate(table, ARCHIVE_DAY, CFG).first().ok is ok
