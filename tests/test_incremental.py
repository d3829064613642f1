"""Incremental runs against full ones."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from climate_lake.functions.columns import ExtremeLimits
from climate_lake.operators import trends
from climate_lake.operators.cleaning import clean_observations
from climate_lake.operators.flatten import flatten_daily
from climate_lake.plans import incremental, pipeline
from climate_lake.sources import commits
from climate_lake.sources.raw import list_documents, read_document_files, read_documents
from climate_lake.sources.tables import LakePaths, read_table
from tests.test_sources import STATION, put

TRENDS = ["temperature_trends_monthly", "extreme_weather_events", "annual_weather_summary"]


def fetch(raw, city, first, days, high=30.0, at="205540", name="weather_data"):
    """A document of one fetch, with ``days`` days from ``first`` on."""
    year, month, day = map(int, first.split("-"))
    times = [f"{year}-{month:02}-{day + k:02}" for k in range(days)]
    document = {
        "city_info": {"name": city, "lat": 4.0, "lon": -74.0},
        "daily": {
            "time": times, "temperature_2m_max": [high + k for k in range(days)], "temperature_2m_min": [10.0] * days,
            "precipitation_sum": [60.0 if city == "Cali" else 0.5] * days, "windspeed_10m_max": [20.0] * days,
            "relative_humidity_2m_mean": [80.0] * days,
        },
        "ingestion_timestamp": f"{first}T{at}", "data_source": "api",
    }
    folder = raw / f"weather-api/{city} [x]+é/{year}/{month:02}/{day:02}"
    put(folder, f"{name}_{at}.json", json.dumps(document, indent=1))
    return folder / f"{name}_{at}.json"


def rounded(frame):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in row) for row in frame.collect())


def assert_like_a_full_run(spark, paths, latest=False, limits=ExtremeLimits()):
    full = clean_observations(flatten_daily(read_documents(spark, paths.raw)))
    if latest:
        from climate_lake.operators.cleaning import latest_only

        full = latest_only(full)
    weather = read_table(spark, paths, "weather_data")
    assert rounded(weather) == rounded(full.select(*weather.columns))
    integrated = read_table(spark, paths, "integrated_weather_data")
    wanted = [trends.monthly_trends(integrated), trends.extreme_summary(integrated, limits), trends.annual_summary(integrated)]
    for name, expected in zip(TRENDS, wanted):
        table = read_table(spark, paths, name)
        assert rounded(table) == rounded(expected.select(*table.columns)), name


@pytest.fixture
def lake_with_two_fetches(spark, tmp_path):
    raw, paths = tmp_path / "raw", LakePaths(str(tmp_path))
    put(raw / "database/weather_stations/2025/06/01", "weather_stations_data_151153.json", json.dumps([STATION]))
    first = fetch(raw, "Bogotá", "2025-05-28", 4)
    fetch(raw, "Cali", "2025-06-01", 5)
    report = incremental.run(spark, paths).first()
    assert (report.files_listed, report.files_new, report.rows_new, report.partitions_changed) == (2, 2, 9, 2)
    assert_like_a_full_run(spark, paths)
    return raw, paths, first


def test_listing_names_what_the_reader_reads(spark, tmp_path):
    raw = tmp_path / "raw"
    fetch(raw, "Bogotá", "2025-05-28", 4)
    put(raw / "weather-api/x", "part-0.json", '{"city_info": {"name": "a"}}\n{"city_info": {"name": "b"}}')
    put(raw / "weather-api/x", "notes.json", "{}")
    listed = list_documents(spark, str(raw))
    assert listed.count() == 2
    found = read_document_files(spark, str(raw), listed)
    assert sorted(row.city_info.name for row in found.collect()) == ["Bogotá", "a", "b"]
    names = found.select("_file", "_length", "_modified").distinct()
    assert names.exceptAll(listed).isEmpty() and listed.exceptAll(names).isEmpty()
    assert read_document_files(spark, str(raw)).count() == 3
    one = listed.filter(F.col("_file").contains("part-"))
    assert read_document_files(spark, str(raw), one).count() == 2
    assert read_document_files(spark, str(raw), listed.limit(0)).count() == 0
    assert list_documents(spark, str(tmp_path / "absent")).count() == 0


def test_more_files_than_can_be_named(spark, tmp_path, monkeypatch):
    from climate_lake.sources import raw as reader

    monkeypatch.setattr(reader, "MOST_NAMED", 2)
    for day in range(1, 6):
        fetch(tmp_path / "raw", "Cali", f"2025-06-0{day}", 1)
    listed = list_documents(spark, str(tmp_path / "raw")).filter(~F.col("_file").contains("/05/"))
    assert read_document_files(spark, str(tmp_path / "raw"), listed).count() == 4


def test_second_run_reads_only_new_files(spark, lake_with_two_fetches):
    raw, paths, first = lake_with_two_fetches
    # An old file that can't be parsed any more, but is of the same size and time: it is not read again.
    before = first.stat()
    first.write_text("x" * before.st_size)
    os.utime(first, ns=(before.st_atime_ns, before.st_mtime_ns))
    fetch(raw, "Bogotá", "2025-06-03", 3)
    report = incremental.run(spark, paths).first()
    assert (report.files_new, report.files_gone, report.files_read_again) == (1, 0, 0)
    assert (report.rows_new, report.partitions_changed) == (3, 1)
    weather = read_table(spark, paths, "weather_data")
    assert weather.count() == 12 and weather.filter("month = 5").count() == 4
    log = commits.read_commits(spark, paths.root, "integrated_weather_data").filter("version = 2 and partition is not null")
    assert {row.partition for row in log.collect()} == {"year=2025/month=6"}


def test_a_run_without_news_writes_nothing(spark, lake_with_two_fetches):
    _, paths, _ = lake_with_two_fetches
    state = lambda: {name: commits.read_log(spark, paths.root, name).version for name in incremental.stored_tables(spark, paths)}
    before = state()
    report = incremental.run(spark, paths).first()
    assert (report.files_new, report.rows_new, report.partitions_changed) == (0, 0, 0)
    assert state() == before


def test_late_days_merge_with_the_rows_of_their_month(spark, tmp_path):
    raw, paths = tmp_path / "raw", LakePaths(str(tmp_path))
    fetch(raw, "Cali", "2025-06-01", 5)
    incremental.run(spark, paths, latest=True)
    fetch(raw, "Cali", "2025-06-01", 3, high=40.0, at="215540")
    fetch(raw, "Cali", "2025-05-30", 2)
    incremental.run(spark, paths, latest=True)
    assert_like_a_full_run(spark, paths, latest=True)
    highs = {row.date.day: row.temp_max for row in read_table(spark, paths, "weather_data").filter("month = 6").collect()}
    assert highs == {1: 40.0, 2: 41.0, 3: 42.0, 4: 33.0, 5: 34.0}


def test_replaced_and_deleted_files(spark, lake_with_two_fetches):
    raw, paths, first = lake_with_two_fetches
    fetch(raw, "Cali", "2025-07-01", 2)
    incremental.run(spark, paths)
    fetch(raw, "Bogotá", "2025-05-28", 2, high=20.0)
    os.utime(first, (1, 1))
    report = incremental.run(spark, paths).first()
    assert (report.files_new, report.files_gone, report.files_read_again, report.rows_new) == (1, 1, 0, 2)
    assert_like_a_full_run(spark, paths)
    fetch(raw, "Tunja", "2025-05-30", 2)
    incremental.run(spark, paths)
    first.unlink()
    report = incremental.run(spark, paths).first()
    # What reached the file's months now (May alone) is read again; June and July are not.
    assert (report.files_new, report.files_gone, report.files_read_again, report.partitions_changed) == (0, 1, 1, 1)
    assert_like_a_full_run(spark, paths)


def test_files_without_rows_are_consumed_too(spark, lake_with_two_fetches):
    raw, paths, _ = lake_with_two_fetches
    put(raw / "weather-api/none", "weather_data_1.json", json.dumps({"city_info": {"name": "x"}}))
    assert incremental.run(spark, paths).first().files_new == 1
    assert incremental.run(spark, paths).first().files_new == 0
    assert_like_a_full_run(spark, paths)


def test_a_run_that_died_is_taken_up(spark, lake_with_two_fetches, monkeypatch):
    raw, paths, _ = lake_with_two_fetches
    fetch(raw, "Bogotá", "2025-06-03", 3)

    def broken(*_, **__):
        raise RuntimeError("lost")

    for name in ("refresh_partitions", "refresh_integrated", "refresh_trends"):
        with monkeypatch.context() as patched:
            patched.setattr(incremental, name, broken)
            with pytest.raises(RuntimeError):
                incremental.run(spark, paths)
    assert incremental.run(spark, paths).first().files_new == 0
    assert_like_a_full_run(spark, paths)


def test_a_full_run_in_between(spark, lake_with_two_fetches):
    raw, paths, _ = lake_with_two_fetches
    fetch(raw, "Bogotá", "2025-06-03", 3)
    pipeline.run_etl(spark, paths)
    pipeline.run_analytics(spark, paths)
    fetch(raw, "Bogotá", "2025-06-07", 1)
    assert incremental.run(spark, paths).first().files_new == 4
    assert_like_a_full_run(spark, paths)


def test_changed_stations_match_everything_again(spark, lake_with_two_fetches):
    raw, paths, _ = lake_with_two_fetches
    near = {**STATION, "station_id": "S9", "city": "Bogotá"}
    put(raw / "database/weather_stations/2025/06/02", "weather_stations_data_151153.json", json.dumps([near]))
    incremental.run(spark, paths)
    matched = read_table(spark, paths, "integrated_weather_data").groupBy("city_name", "station_id").count().collect()
    assert {(row.city_name, row.station_id): row["count"] for row in matched} == {("Bogotá", "S9"): 4, ("Cali", None): 5}
    assert_like_a_full_run(spark, paths)


def test_other_limits_make_the_events_anew(spark, lake_with_two_fetches):
    _, paths, _ = lake_with_two_fetches
    limits = ExtremeLimits(heat=31.5, rain=100.0)
    incremental.run(spark, paths, limits=limits)
    assert_like_a_full_run(spark, paths, limits=limits)


def test_an_empty_raw_zone(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    assert incremental.run(spark, paths).first().rows_new == 0
    assert incremental.run(spark, paths).first().files_new == 0
    for name in ("weather_data", "integrated_weather_data", *TRENDS):
        assert read_table(spark, paths, name).count() == 0
    fetch(tmp_path / "raw", "Cali", "2025-06-01", 5)
    incremental.run(spark, paths)
    assert_like_a_full_run(spark, paths)
