"""Every registered query against the same query in SQL on a second engine."""

import pytest

from checks import compare, oracle, registry
from tests.conftest import MEDIUM, SMALL


@pytest.fixture(scope="module")
def connection():
    return compare.open_tables(SMALL)


@pytest.mark.parametrize("name", list(registry.REGISTRY))
def test_same_result_as_sql(spark, connection, name):
    assert compare.difference(spark, connection, name, SMALL) is None


def test_every_query_has_sql():
    assert set(oracle.QUERIES) == set(registry.REGISTRY)


@pytest.mark.parametrize(
    ("name", "rows"),
    [
        ("zip_load", 6526),
        ("minute_load", 1796),
        ("grid_wide", 720),
        ("imminent_overload", 841),
        ("alert_payload", 182),
        ("load_prediction_join", 1062),
        ("transfer_pairs", 799),
        ("archive_slice", 330),
    ],
)
def test_known_counts(spark, name, rows):
    assert registry.run(name, spark, MEDIUM).count() == rows


def test_known_labels(spark):
    def counts(name, column):
        return {r[column]: r["count"] for r in registry.run(name, spark, MEDIUM).groupBy(column).count().collect()}

    assert counts("growth_regime", "growth_regime") == {
        "EXPLOSIVE_GROWTH": 304, "RAPID_ACCEL": 267, "MODERATE_GROWTH": 313, "STABLE_OR_DECLINING": 912,
    }
    assert counts("overload_predictions", "alert_level") == {"CRITICAL": 74, "HIGH": 108, "MEDIUM": 182, "LOW": 1432}
    assert counts("correlated_surge", "event_classification") == {
        "WIDESPREAD_GRID_EMERGENCY": 6, "MULTI_ZONE_EVENT": 92, "LOCALIZED_EVENT": 17,
    }


def test_heatwave_windows(spark):
    assert registry.run("grid_wide", spark, MEDIUM).filter("heatwave_active").count() == 167


def test_archive_counts(spark):
    rows = registry.run("archive_export", spark, MEDIUM).collect()
    assert {r.table_name: (r.source_count, r.exported_count) for r in rows} == {
        "raw_readings": (330, 330), "zip_aggregations": (217, 217), "predictions": (60, 60),
    }
    checks = {r.table_name: r.ok for r in registry.run("archive_validate", spark, MEDIUM).collect()}
    assert all(checks.values())
    assert not any(r.ok for r in registry.run("archive_validate", spark, SMALL).collect())
