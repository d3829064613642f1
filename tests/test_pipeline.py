"""All jobs over a small raw zone, checked against numbers worked out by hand or by SQL."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from climate_lake.__main__ import main
from climate_lake.operators import model, quality
from climate_lake.plans import pipeline, report
from climate_lake.plans.incremental import stored_tables
from climate_lake.schemas import TABLES
from climate_lake.session import materialise
from climate_lake.sinks import catalog
from climate_lake.sources.files import list_files
from climate_lake.sources.raw import read_documents
from climate_lake.sources.tables import LakePaths, read_table
from tests.test_sources import STATION, put

AS_OF = datetime(2025, 6, 1, 12)
DAYS = [f"2025-06-0{day}" for day in range(1, 8)]
# City, coordinates, highest and lowest temperature of the first day, daily rain.
CITIES = {
    "cartagena": ("Cartagena", 10.391, -75.4794, 35.1, 26.0, 2.0),
    "bogota": ("Bogotá", 4.6097, -74.0817, 16.4, 9.4, 0.1),
    "tunja": ("Tunja", 5.5353, -73.3678, 14.0, 4.5, 60.0),
}


def build_raw(folder):
    """Two fetches of seven days for each city, station and threshold snapshots, no events."""
    for code, (name, lat, lon, high, low, rain) in CITIES.items():
        for fetch in ("150912", "205540"):
            text = json.dumps(
                {
                    "latitude": lat,
                    "city_info": {"lat": lat, "lon": lon, "name": name},
                    "current_weather": {"temperature": 12.2},
                    "daily": {
                        "time": DAYS,
                        "temperature_2m_max": [high - day for day in range(7)],
                        "temperature_2m_min": [low] * 7,
                        "temperature_2m_mean": [0.0] * 7,
                        "precipitation_sum": [rain] * 7,
                        "windspeed_10m_max": [20.0] * 7,
                        "relative_humidity_2m_mean": [80] * 7,
                        "surface_pressure_mean": [750.0] * 7,
                    },
                    "ingestion_timestamp": f"2025-06-01T{fetch[:2]}:00:00",
                    "data_source": "api",
                },
                indent=2,
                ensure_ascii=False,
            )
            put(folder / f"weather-api/{code}/2025/06/01", f"weather_data_{fetch}.json", text)
    stations = [
        {**STATION, "station_id": "CTG", "city": "Cartagena", "latitude": 10.4, "longitude": -75.5},
        {**STATION, "station_id": "BOG", "city": "Santa Fe", "latitude": 4.61, "longitude": -74.08},
    ]
    for fetch in ("151153", "205546"):
        put(folder / "database/weather_stations/2025/06/01", f"weather_stations_data_{fetch}.json", json.dumps(stations))
    threshold = {"threshold_id": 1, "station_id": "BOG", "parameter_name": "temperature", "min_value": -5.0,
                 "max_value": 30.0, "alert_level": "warning", "notification_enabled": 1, "station_name": "One",
                 "city": "Bogotá"}
    put(folder / "database/weather_thresholds/2025/06/01", "weather_thresholds_data_205548.json", json.dumps([threshold]))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    build_raw(root / "raw")
    paths = LakePaths(str(root))
    steps = pipeline.run(spark, paths, AS_OF, all_stations=True)
    assert {(row.step, row.status) for row in steps.collect()} == {
        ("etl", "COMPLETED"), ("analytics", "COMPLETED"), ("climatology", "COMPLETED"),
    }
    assert tuple(quality.step_rollup(steps).first()) == (3, 3)
    return paths


def test_every_fetch_is_kept(spark, lake):
    weather = read_table(spark, lake, "weather_data")
    assert weather.count() == 3 * 2 * 7
    assert weather.select("city_name", "date").distinct().count() == 21


def test_snapshots_fan_out(spark, lake):
    joined = read_table(spark, lake, "integrated_weather_data")
    counts = {(row.city_name, row.station_id): row["count"] for row in
              joined.groupBy("city_name", "station_id").count().collect()}
    assert counts == {("Cartagena", "CTG"): 28, ("Bogotá", "BOG"): 28, ("Tunja", None): 14}


def test_trend_tables(spark, lake):
    monthly = {row.city_name: row for row in read_table(spark, lake, "temperature_trends_monthly").collect()}
    assert monthly["Bogotá"].avg_temperature == pytest.approx(((16.4 - 3) + 9.4) / 2)
    assert (monthly["Bogotá"].data_points, monthly["Bogotá"].max_temperature) == (28, 16.4)
    events = {(row.city_name, row.event_type): row.event_count for row in
              read_table(spark, lake, "extreme_weather_events").collect()}
    assert events == {("Cartagena", "extreme_heat"): 4, ("Tunja", "heavy_rain"): 14}
    annual = {row.city_name: row for row in read_table(spark, lake, "annual_weather_summary").collect()}
    assert {name: row.climate_category for name, row in annual.items()} == {
        "Cartagena": "arid", "Bogotá": "cold", "Tunja": "cold",
    }
    assert annual["Tunja"].annual_precipitation == pytest.approx(14 * 60)


def test_climatology_tables(spark, lake):
    metrics = read_table(spark, lake, "ml_model_metrics")
    assert metrics.count() == 6
    assert metrics.filter("city_name = 'Tunja' and model_name = 'precipitation_statistics'").first().metric_value == 60
    assert read_table(spark, lake, "temperature_predictions").count() == 3
    assert read_table(spark, lake, "precipitation_predictions").count() == 3
    forecasts = read_table(spark, lake, "weather_forecasts")
    # Days 153 to 158 of the seven fetched days lie ahead of June 1.
    assert sorted({row.day_of_year for row in forecasts.collect()}) == list(range(153, 159))
    assert {row.forecast_date for row in forecasts.collect()} == {"2025-06-01"}


def test_absent_events_leave_no_table(spark, lake):
    assert quality.table_counts(spark, {"t": read_table(spark, lake, "weather_thresholds")}).first().record_count == 1
    folders = {row.path.split("/trusted/")[1].split("/")[0] for row in list_files(spark, lake.zone("trusted")).collect()}
    assert folders == {"weather_data", "weather_stations", "weather_thresholds", "integrated_weather_data"}


def test_partition_layout(spark, lake):
    files = [row.path for row in list_files(spark, lake.table("integrated_weather_data")).collect()]
    assert files and all("/year=2025/month=6/" in path for path in files)


def test_catalog_queries(spark, lake):
    names = catalog.register_tables(spark, lake, "lake_test")
    assert len(names) == 7
    assert catalog.register_tables(spark, lake, "lake_test") == names
    assert spark.table("lake_test.integrated_weather_data").count() == 0
    catalog.repair_partitions(spark, lake, "lake_test")
    assert spark.table("lake_test.integrated_weather_data").count() == 70
    for name in names:
        stored = spark.table(f"lake_test.{name}")
        assert set(stored.dtypes) == {(f.name, f.dataType.simpleString()) for f in TABLES[name].schema}
    warmest = spark.sql(
        "SELECT city_name, AVG(temp_avg) AS avg_temp FROM lake_test.integrated_weather_data "
        "GROUP BY city_name ORDER BY avg_temp DESC"
    )
    assert [row.city_name for row in warmest.collect()] == ["Cartagena", "Bogotá", "Tunja"]
    rain = spark.sql(
        "SELECT city_name, month, avg_precipitation FROM lake_test.temperature_trends_monthly "
        "WHERE year = 2025 ORDER BY city_name, month"
    )
    assert rain.count() == 3
    events = spark.sql(
        "SELECT city_name, event_type, SUM(event_count) AS total_events FROM lake_test.extreme_weather_events "
        "GROUP BY city_name, event_type ORDER BY total_events DESC"
    )
    assert events.first().total_events == 14


def test_reports_on_the_lake(spark, lake):
    checks = {row.check: row.status for row in report.improved_checks(spark, lake).collect()}
    assert checks == {
        "raw": "OK", "trusted": "OK", "refined": "OK", "api_data_structure": "OK", "database_data": "OK",
        "readiness": "READY_FOR_ETL",
    }
    score = report.save_report(spark, lake, "improved").first()
    assert (score.total_checks, score.passed_checks, score.label) == (6, 6, "excellent")
    basic = report.save_report(spark, lake, "basic", improved=False).first()
    assert (basic.total_checks, basic.passed_checks, basic.label) == (8, 8, "validated")
    documents = quality.document_summary(read_documents(spark, lake.raw))
    assert tuple(documents.first()) == (6, 3, 6, 6, 7, 7, "OK")


def test_reports_on_nothing(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    checks = {row.check: row.status for row in report.improved_checks(spark, paths).collect()}
    assert checks == {
        "raw": "NO_FILES", "trusted": "NO_FILES", "refined": "NO_FILES", "api_data_structure": "NO_API_DATA",
        "database_data": "NO_DB_DATA", "readiness": "NEEDS_ETL",
    }
    basic = quality.score(report.basic_checks(spark, paths), improved=False).first()
    # Empty zones pass, absent tables and the absence of documents do not.
    assert (basic.total_checks, basic.passed_checks) == (8, 3)


def test_stations_of_the_newest_snapshot(spark, tmp_path):
    build_raw(tmp_path / "raw")
    paths = LakePaths(str(tmp_path))
    pipeline.run_etl(spark, paths)
    assert read_table(spark, paths, "weather_data").count() == 42
    assert read_table(spark, paths, "weather_stations").count() == 2
    assert read_table(spark, paths, "integrated_weather_data").count() == 42


def test_latest_option(spark, tmp_path):
    build_raw(tmp_path / "raw")
    paths = LakePaths(str(tmp_path))
    pipeline.run(spark, paths, AS_OF, latest=True, corrected=True)
    assert read_table(spark, paths, "weather_data").count() == 21
    assert read_table(spark, paths, "weather_data").select("ingestion_timestamp").distinct().first()[0].endswith("T20:00:00")
    assert read_table(spark, paths, "integrated_weather_data").count() == 21


def test_empty_lake_runs(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    pipeline.run(spark, paths, AS_OF)
    for name in TABLES.keys() - {"climate_events", "weather_thresholds"}:
        table = read_table(spark, paths, name)
        assert table.count() == 0 and table.schema == TABLES[name].schema


def test_failures_are_raised_or_reported(spark, tmp_path, monkeypatch):
    def broken(*_):
        raise RuntimeError("no disk")

    monkeypatch.setattr(pipeline, "run_analytics", broken)
    build_raw(tmp_path / "raw")
    with pytest.raises(RuntimeError):
        pipeline.run(spark, LakePaths(str(tmp_path)), AS_OF)
    steps = pipeline.run(spark, LakePaths(str(tmp_path)), AS_OF, keep_going=True)
    assert [(row.step, row.status) for row in steps.collect()] == [
        ("etl", "COMPLETED"), ("analytics", "FAILED"), ("climatology", "COMPLETED"),
    ]
    assert tuple(quality.step_rollup(steps).first()) == (2, 3)


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    build_raw(tmp_path / "raw")
    for job in ("etl", "analytics", "climatology"):
        main([job, str(tmp_path), "--as-of", "2025-06-01T12:00:00", "--latest"])
    paths = LakePaths(str(tmp_path))
    assert read_table(spark, paths, "integrated_weather_data").count() == 21
    assert read_table(spark, paths, "weather_forecasts").count() == 0  # one row per day is below the minimum
    main(["catalog", str(tmp_path), "--database", "lake_cli"])
    assert spark.table("lake_cli.annual_weather_summary").count() == 3
    main(["report", str(tmp_path)])
    assert "excellent" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["unknown", str(tmp_path)])


def test_lags_skip_repeated_fetches(spark, lake):
    lagged = model.lag_features(read_table(spark, lake, "weather_data")).filter("city_name = 'Bogotá'")
    rows = lagged.orderBy("date").collect()
    assert len(rows) == 7
    temps = [row.temp_avg for row in rows]
    assert [row.temp_lag1 for row in rows] == [None, *temps[:-1]]
    assert [row.temp_lag2 for row in rows] == [None, None, *temps[:-2]]


def test_model_learns(spark):
    rows = spark.sql(
        "select concat('C', id % 5) as city_name, date_add(date'2020-01-01', cast(id div 5 as int)) as date, "
        "20 + 5 * sin((id div 5) / 30.0) + (id % 5) as temp_avg, 0d as precipitation, 50d as humidity, "
        "10d as wind_speed, 100 * (id % 5) as elevation, cast('t' as string) as ingestion_timestamp from range(4000)"
    ).selectExpr("*", "month(date) as month")
    rows = rows.withColumn("elevation", F.expr("if(city_name = 'C0', null, elevation)"))
    prepared = model.model_rows(rows)
    training, test = model.split(prepared)
    assert training.count() + test.count() == 4000
    assert training.agg(F.max("date")).first()[0] < test.agg(F.min("date")).first()[0]
    # A row without a station, or without predecessors, stays.
    assert model._ready(prepared, model.TEMPERATURE).count() == 4000
    assert model.evaluate(model.train(training), test) < 1.5
    rain = model.train(training, model.PRECIPITATION)
    assert model.evaluate(rain, test, model.PRECIPITATION) == 0


def test_errors_equal_sql_over_the_stored_predictions(spark, duck):
    rows = spark.sql(
        "select concat('C', id % 3) as city_name, date_add(date'2020-01-01', cast(id div 3 as int)) as date, "
        "20 + 5 * sin((id div 3) / 30.0) + rand(3) as temp_avg, 0d as precipitation, 50d as humidity, 10d as wind_speed, "
        "100 as elevation, 't' as ingestion_timestamp from range(1500)"
    ).selectExpr("*", "month(date) as month")
    training, test = model.split(model.model_rows(rows))
    stored = materialise(model.predicted(model.train(training), test), "tested")
    files = stored.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    expected = duck.sql(
        "select city_name, month, count(*), avg(prediction - measured), sqrt(avg((prediction - measured) ** 2)) "
        f"from read_parquet('{files}/*.parquet') group by all order by all"
    ).fetchall()
    got = sorted(tuple(row) for row in model.prediction_errors(stored, "city_name", "month").collect())
    assert len(got) == len(expected) > 3
    for one, other in zip(got, expected):
        assert one[:3] == other[:3] and one[3:] == pytest.approx(other[3:])
    whole = model.prediction_errors(stored).first()
    assert whole.rmse == pytest.approx(model.evaluate(model.train(training), test))


def test_only_what_a_table_is_made_from(spark, tmp_path):
    build_raw(tmp_path / "raw")
    paths = LakePaths(str(tmp_path))
    steps = pipeline.run(spark, paths, AS_OF, only=["temperature_trends_monthly"])
    assert [row.step for row in steps.collect()] == ["etl", "analytics"]
    made = {"weather_data", "weather_stations", "integrated_weather_data", "trend_state", "temperature_trends_monthly"}
    assert made == pipeline.needed_for("temperature_trends_monthly") == set(stored_tables(spark, paths))
    assert read_table(spark, paths, "temperature_trends_monthly").count() == 3
    with pytest.raises(ValueError):
        pipeline.run(spark, paths, AS_OF, only=["unknown"])
    # What the jobs write is what they say, together all tables.
    assert {*pipeline.ETL, *pipeline.ANALYTICS, *pipeline.CLIMATOLOGY} == TABLES.keys()
