from __future__ import annotations

import pytest

from climate_lake.operators import quality
from climate_lake.schemas import RAW_DOCUMENT


@pytest.fixture
def files(spark):
    def build(*items):
        return spark.createDataFrame(list(items), "path string, length bigint")

    return build


ROOT = "/lake"
LAKE = [
    ("file:/lake/raw/weather-api/cali/2025/06/01/weather_data_1.json", 100),
    ("file:/lake/raw/weather-api/neiva/2025/06/01/weather_data_1.json", 0),
    ("file:/lake/raw/database/weather_stations/2025/06/01/x.json", 50),
    ("file:/lake/raw/database/climate_events/2025/06/01/x.json", 50),
    ("file:/lake/trusted/weather_data/year=2025/part-0.parquet", 0),
]


def test_zone_report_and_status(files):
    report = quality.zone_report(files(*LAKE), ROOT)
    got = {(row.zone, row.folder): (row.total_files, row.non_empty_files, row.total_size) for row in report.collect()}
    assert got == {
        ("raw", "weather-api"): (2, 1, 100),
        ("raw", "database/weather_stations"): (1, 1, 50),
        ("raw", "database/weather_thresholds"): (0, 0, 0),
        ("trusted", "weather_data"): (1, 0, 0),
        ("trusted", "weather_stations"): (0, 0, 0),
        ("refined", "temperature_trends_monthly"): (0, 0, 0),
    }
    status = {row.zone: row.status for row in quality.zone_status(report).collect()}
    assert status == {"raw": "OK", "trusted": "EMPTY_FILES", "refined": "NO_FILES"}


def test_short_zone_form(files):
    folders = {"raw": "weather-api", "trusted": "weather_data", "refined": "temperature_trends_monthly"}
    got = {row.zone: (row.files_count, row.status) for row in quality.zone_presence(files(*LAKE), ROOT, folders).collect()}
    assert got == {"raw": (2, "OK"), "trusted": (1, "OK"), "refined": (0, "EMPTY")}


def test_snapshots_and_readiness(files):
    tables = {row.table: row.files for row in quality.snapshot_files(files(*LAKE), ROOT).collect()}
    assert tables == {"weather_stations": 1, "climate_events": 1}
    assert tuple(quality.snapshot_status(files(*LAKE), ROOT).first()) == (2, "OK")
    assert quality.snapshot_status(files(LAKE[0]), ROOT).first().status == "NO_DB_DATA"
    assert quality.readiness(files(*LAKE), ROOT).first().status == "READY_FOR_ETL"
    assert tuple(quality.readiness(files(LAKE[0]), ROOT).first()) == (0, "NEEDS_ETL")


@pytest.mark.parametrize("root", ["/lake/trusted/x", "file:/lake/trusted/x/", "file:///lake/trusted/x", "s3a://b/lake/trusted/x"])
def test_zones_lie_directly_below_the_root(files, root):
    inside = ("file:/lake/trusted/x/raw/weather-api/a.json", 1)
    assert quality.readiness(files(inside), root).first().status == "NEEDS_ETL"
    report = quality.zone_report(files(inside, ("file:/lake/trusted/y/raw/weather-api/a.json", 1)), root)
    assert {row.zone: row.total_files for row in quality.zone_status(report).collect()} == {
        "raw": 1, "trusted": 0, "refined": 0,
    }


def test_document_structure(spark):
    city = ("Cali", 1.0, 2.0)
    daily = (["2025-06-01", "2025-06-02"], [1.0], [1.0], None, None, None)
    documents = spark.createDataFrame(
        [
            (city, daily, "2025", "api"),
            (None, daily, "2025", "api"),
            (city, None, "2025", "api"),
            (city, (None, None, [1.0], [1.0], [1.0], [1.0]), "2025", "api"),
            (city, daily, None, "api"),
        ],
        RAW_DOCUMENT,
    )
    checks = quality.document_checks(documents).collect()
    assert [row.status for row in checks] == ["OK", "ISSUES", "ISSUES", "ISSUES", "ISSUES"]
    assert [row.days_of_data for row in checks] == [2, 2, 0, 0, 2]
    summary = quality.document_summary(documents).first()
    assert (summary.files_found, summary.cities_covered, summary.documents_ok, summary.status) == (5, 1, 1, "ISSUES")
    assert quality.document_summary(documents.filter("false")).first().status == "NO_API_DATA"


def test_table_counts(spark):
    tables = {"full": spark.range(3), "empty": spark.range(0), "absent": None}
    got = {row.table: (row.record_count, row.status) for row in quality.table_counts(spark, tables).collect()}
    assert got == {"full": (3, "OK"), "empty": (0, "OK"), "absent": (0, "ERROR")}
    strict = quality.table_counts(spark, tables, empty_status="NO_DATA")
    assert {row.table for row in strict.filter("status = 'NO_DATA'").collect()} == {"empty"}


def test_plausibility_rules(spark):
    temps = spark.createDataFrame(
        [(t, 0.0) for t in (15.5, 35.2, -5.0, 45.0, -50.0, 60.0, -100.0, 100.0, None)],
        "temp_max double, temp_min double",
    )
    assert sorted(row.temp_max for row in quality.temperature_violations(temps).collect()) == [-100.0, 100.0]
    cities = spark.createDataFrame(
        [(4.6097, -74.0817), (10.9639, -74.7964), (-5.0, -85.0), (15.1, -70.0), (4.0, -64.9)],
        "latitude double, longitude double",
    )
    assert sorted(row.latitude for row in quality.position_violations(cities).collect()) == [4.0, 15.1]


def test_domain_violations(spark):
    table = spark.createDataFrame([("low", "x"), ("odd", None), ("odd", "y")], "severity string, kind string")
    got = quality.domain_violations(table, {"severity": ["low", "high"], "kind": ["x", "y"]}).collect()
    assert [tuple(row) for row in got] == [("severity", "odd", 2)]


def test_load_status(spark):
    manifest = spark.createDataFrame(
        [(5, True, True), (5, True, False), (5, False, True), (5, False, False), (0, True, True), (None, True, True)],
        "records bigint, has_local boolean, has_lake boolean",
    )
    log = quality.load_status(manifest)
    assert [row.status for row in log.collect()] == [
        "success", "partial_success_local", "partial_success_s3", "save_failed", "no_data_or_error",
        "no_data_or_error",
    ]
    assert quality.load_status(manifest, "fetch_failed").collect()[-1].status == "fetch_failed"
    assert tuple(quality.load_rollup(log).first()) == (6, 1, 5, 20)
    unanswered = spark.createDataFrame(
        [(True, 5), (False, 5), (None, 0), (True, 0)], "fetched boolean, records bigint"
    ).selectExpr("*", "true as has_local", "true as has_lake")
    assert [row.status for row in quality.load_status(unanswered).collect()] == [
        "success", "fetch_failed", "fetch_failed", "no_data_or_error",
    ]


def test_step_rollup(spark):
    steps = spark.createDataFrame([("completed",), ("COMPLETED",), ("FAILED",), ("Completed",)], "status string")
    assert tuple(quality.step_rollup(steps).first()) == (2, 4)


@pytest.mark.parametrize(
    ("statuses", "improved", "expected"),
    [
        (["OK"] * 11 + ["NO_DATA"], False, (12, 11, "validated", True)),
        (["OK", "EMPTY", "ERROR", "ERROR"], False, (4, 2, "partial", False)),
        (["OK", "EMPTY", "ERROR", "ERROR"], True, (4, 1, "attention", False)),
        (["OK", "READY_FOR_ETL", "OK", "OK", "NO_FILES"], True, (5, 4, "excellent", True)),
        (["OK", "OK", "OK", "X", "X"], True, (5, 3, "good", False)),
        (["OK", "OK", "X", "X"], True, (4, 2, "functional", False)),
        (["ERROR"], False, (1, 0, "attention", False)),
        ([], True, (0, 0, "attention", False)),
    ],
)
def test_score(spark, statuses, improved, expected):
    checks = spark.createDataFrame([("c", status) for status in statuses], "check string, status string")
    row = quality.score(checks, improved).first()
    assert (row.total_checks, row.passed_checks, row.label, row["pass"]) == expected
    rate = 100 * expected[1] / expected[0] if expected[0] else 0.0
    assert row.success_rate == pytest.approx(rate)
