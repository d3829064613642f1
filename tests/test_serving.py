from __future__ import annotations

import json
from datetime import date, timedelta

import pytest

from climate_lake.operators import serving

AS_OF = date(2025, 6, 10)


@pytest.fixture
def weather(spark):
    rows = [
        (city, AS_OF - timedelta(days=back), 20.0 + back, 30.0, 10.0, 0.0, 50.0, 2025, 5 if back > 9 else 6)
        for city in ("Cali", "Neiva")
        for back in range(12)
    ]
    return spark.createDataFrame(
        rows,
        "city_name string, date date, temp_avg double, temp_max double, temp_min double, precipitation double, "
        "humidity double, year int, month int",
    )


def test_latest_covers_seven_days(weather):
    result = serving.latest_observations(weather, AS_OF, limit=100).collect()
    assert len(result) == 16
    assert [row.date for row in result] == sorted((row.date for row in result), reverse=True)
    assert min(row.date for row in result) == date(2025, 6, 3)
    assert result[0].asDict().keys() == set(serving.LATEST_COLUMNS)


def test_latest_of_one_city_with_default_limit(weather):
    assert {row.city_name for row in serving.latest_observations(weather, AS_OF, "Cali").collect()} == {"Cali"}
    assert serving.latest_observations(weather, AS_OF).count() == 10
    assert serving.latest_observations(weather, AS_OF, "x' OR '1'='1").count() == 0


@pytest.fixture
def monthly(spark):
    rows = [(f"C{city:02}", year, month, 20.0, 30.0, 10.0, 1.0, 50.0, 5)
            for city in range(10) for year in (2024, 2025) for month in range(1, 13)]
    return spark.createDataFrame(
        rows,
        "city_name string, year int, month int, avg_temperature double, max_temperature double, "
        "min_temperature double, avg_precipitation double, avg_humidity double, data_points bigint",
    )


def test_trends(monthly):
    assert [row.month for row in serving.trends(monthly, "C03").collect()] == list(range(1, 13))
    everything = serving.trends(monthly).collect()
    assert len(everything) == 100
    assert everything[0][:3] == ("C00", 2024, 1) and everything[-1][:3] == ("C08", 2024, 4)
    assert serving.monthly_precipitation(monthly).count() == 120


def test_extreme_events(spark):
    rows = [(f"C{n}", kind, 2024, n, 20.0, 1.0, 2.0) for n in range(60) for kind in ("heavy_rain", "strong_winds")]
    summary = spark.createDataFrame(
        rows,
        "city_name string, event_type string, year int, event_count bigint, avg_temp_during_event double, "
        "max_precipitation double, max_wind_speed double",
    )
    top = serving.extreme_events(summary).collect()
    assert len(top) == 50 and [row.event_count for row in top[:3]] == [59, 59, 58]
    assert {row.event_type for row in serving.extreme_events(summary, "heavy_rain").collect()} == {"heavy_rain"}
    assert serving.extreme_events(summary, year=2023).count() == 0


def test_annual_limit_applies_only_to_all_categories(spark):
    rows = [(f"C{n:02}", 2024, float(n), 30.0, 10.0, 100.0, 50.0, "arid" if n else "cold") for n in range(30)]
    summary = spark.createDataFrame(
        rows,
        "city_name string, year int, annual_avg_temp double, annual_max_temp double, annual_min_temp double, "
        "annual_precipitation double, annual_avg_humidity double, climate_category string",
    )
    top = serving.annual(summary).collect()
    assert len(top) == 20 and top[0].annual_avg_temp == 29.0
    assert serving.annual(summary, climate_category="arid").count() == 29


def test_json_rows_are_text_and_keep_null(spark):
    frame = spark.createDataFrame([("Bogotá", None, 1.5, 3)], "city string, note string, temp double, n int")
    row = json.loads(serving.json_rows(frame).first().json)
    assert row == {"city": "Bogotá", "note": None, "temp": "1.5", "n": "3"}


def test_response_header(monthly):
    row = serving.response_header(serving.trends(monthly, "C01"), {"city": "C01"}).first()
    assert (row.total_records, json.loads(row.query_params)) == (12, {"city": "C01"})


def test_latest_prunes_partitions(spark, lake, plan, sf_dir):
    from climate_lake.plans.queries import weather
    from climate_lake.sinks.tables import write_table
    from climate_lake.sources.tables import read_table

    write_table(weather(spark, sf_dir), lake, "weather_data")
    text = plan(serving.latest_observations(read_table(spark, lake, "weather_data"), date(2001, 11, 4), "NATION_3"))
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "month" in filters
    assert "EqualTo(city_name" in text.split("PushedFilters: [")[1].split("]")[0]
    assert "wind_speed" not in text.split("ReadSchema")[1].splitlines()[0]
    assert "TakeOrderedAndProject" in text
