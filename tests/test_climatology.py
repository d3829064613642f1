from __future__ import annotations

from datetime import date, datetime

import pytest

from climate_lake.operators import climatology as cl

ROWS = "city_name string, date date, temp_avg double, precipitation double, humidity double"
AS_OF = datetime(2025, 6, 1, 12, 0)


@pytest.fixture
def weather(spark):
    def build(*rows, schema=ROWS):
        return spark.createDataFrame(list(rows), schema)

    return build


def days(city, month, temps, year=2024):
    return [(city, date(year, month, day + 1), float(temp), temp / 10, 50.0) for day, temp in enumerate(temps)]


def test_features_drop_incomplete_rows_and_add_calendar(weather):
    frame = weather(
        ("Cali", date(2024, 12, 31), 20.0, 1.0, 50.0),
        ("Cali", date(2023, 3, 1), None, 1.0, 50.0),
        (None, date(2023, 3, 1), 20.0, 1.0, 50.0),
        ("Cali", None, 20.0, 1.0, 50.0),
    )
    (row,) = cl.features(frame).collect()
    assert (row.day_of_year, row.month, row.season) == (366, 12, 1)


def test_features_derive_mean_only_from_both_extremes(spark):
    frame = spark.createDataFrame(
        [("Cali", date(2024, 6, 1), 30.0, 20.0), ("Cali", date(2024, 6, 2), 30.0, None)],
        "city_name string, date date, temp_max double, temp_min double",
    )
    assert [row.temp_avg for row in cl.features(frame).collect()] == [25.0]
    bare = cl.features(frame.select("city_name", "date"))
    assert bare.columns == ["city_name", "date", "day_of_year", "month", "season"]
    assert bare.count() == 2


def test_season_codes(spark):
    from climate_lake.functions.columns import season_code

    months = spark.createDataFrame([(month,) for month in [*range(1, 13), None, 0, 13]], "month int")
    seasons = [row.s for row in months.select(season_code().alias("s")).collect()]
    assert seasons == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1, 4, 4, 4]


def test_months_need_five_rows(weather):
    frame = weather(*days("Cali", 6, [20.0, 21, 22, 23, 24]), *days("Cali", 7, [20.0, 21, 22, 23]))
    (row,) = cl.temperature_stats(cl.features(frame)).collect()
    assert (row.month, row.historical_avg_temp, row.historical_max_temp, row.historical_min_temp) == (6, 22, 24, 20)
    assert row.temp_std == pytest.approx(1.5811388)
    (rain,) = cl.precipitation_stats(cl.features(frame)).collect()
    assert (rain.data_points, rain.historical_total_precip) == (5, pytest.approx(11.0))


def test_metrics_and_predictions(weather):
    stats = cl.month_stats(cl.features(weather(*days("Cali", 6, [20.0, 21, 22, 23, 24]))))
    metrics = {row.model_name: (row.metric_name, row.metric_value, row.evaluation_date) for row in
               cl.model_metrics(stats, AS_OF).collect()}
    assert metrics == {
        "temperature_statistics": ("basic_stats", 22.0, "2025-06-01T12:00:00"),
        "precipitation_statistics": ("basic_stats", pytest.approx(2.2), "2025-06-01T12:00:00"),
    }
    row = cl.predictions(stats, cl.TEMPERATURE).first()
    assert tuple(row) == ("Cali", None, 22.0, 22.0, 0.0, 6)
    assert cl.predictions(stats, cl.PRECIPITATION).columns[2] == "precipitation"


def test_metrics_without_rain(weather):
    frame = weather(*days("Cali", 6, [20.0, 21, 22, 23, 24])).drop("precipitation")
    stats = cl.month_stats(cl.features(frame))
    assert [row.model_name for row in cl.model_metrics(stats, AS_OF).collect()] == ["temperature_statistics"]
    with pytest.raises(ValueError):
        cl.predictions(stats, cl.PRECIPITATION)


def test_climatology_counts_rows_or_years(weather):
    frame = cl.features(
        weather(
            ("Cali", date(2023, 6, 5), 20.0, 0.0, 50.0),
            ("Cali", date(2023, 6, 5), 22.0, 0.0, 50.0),
            ("Cali", date(2023, 6, 6), 22.0, 0.0, 50.0),
            ("Neiva", date(2023, 6, 5), 30.0, 0.0, 50.0),
            ("Neiva", date(2022, 6, 5), 32.0, 0.0, 50.0),
        )
    )
    plain = {(row.city_name, row.years_of_data, row.historical_avg_temp) for row in cl.climatology(frame).collect()}
    assert plain == {("Cali", 2, 21.0), ("Neiva", 2, 31.0)}
    assert [row.city_name for row in cl.climatology(frame, count_years=True).collect()] == ["Neiva"]


@pytest.mark.parametrize(
    ("as_of", "first", "last"),
    [
        (date(2025, 6, 1), 153, 182),
        (date(2024, 12, 31), 1, 30),  # day 366
        (date(2025, 12, 31), 366, 29),  # day 365, the following number is 366 in any year
        (date(2025, 12, 30), 365, 28),
    ],
)
def test_calendar_runs_on_modulo_366(as_of, first, last):
    calendar = cl.calendar_days(as_of)
    assert len(calendar) == 30
    assert (calendar[0][0], calendar[-1][0]) == (first, last)
    assert {text for _, text in calendar} == {as_of.isoformat()}


def test_corrected_calendar():
    calendar = cl.calendar_days(date(2025, 12, 30), corrected=True)
    assert calendar[:3] == [(365, "2025-12-31"), (1, "2026-01-01"), (2, "2026-01-02")]


def test_forecasts(weather):
    frame = cl.features(
        weather(
            *[("Cali", date(year, 6, 2), float(year - 2000), 0.0, 50.0) for year in (2022, 2023)],
            *[("Cali", date(year, 6, 1), 99.0, 0.0, 50.0) for year in (2022, 2023)],
            *[("Cali", date(year, 8, 1), 99.0, 0.0, 50.0) for year in (2022, 2023)],
        )
    )
    result = cl.forecasts(frame, date(2025, 6, 1))
    assert result.columns == [
        "day_of_year", "city_name", "years_of_data", "historical_avg_temp", "historical_avg_precip",
        "historical_avg_humidity", "forecast_date", "forecast_type",
    ]
    (row,) = result.collect()
    assert tuple(row) == (153, "Cali", 2, 22.5, 0.0, 50.0, "2025-06-01", "historical_average")


@pytest.mark.parametrize(
    ("days", "months"), [([60], [2, 3]), ([61], [3]), ([366, 1], [1, 12]), ([366], [1, 12]), ([1], [1]), ([182], [6, 7])]
)
def test_months_of_day_numbers(days, months):
    assert cl._months(days) == months


def test_forecasts_prune_partitions(spark, tmp_path, plan, sf_dir):
    from climate_lake.plans.queries import weather as test_weather
    from climate_lake.sinks.tables import write_table
    from climate_lake.sources.tables import LakePaths, read_table

    lake = LakePaths(str(tmp_path))
    write_table(test_weather(spark, sf_dir), lake, "weather_data")
    rows = cl.features(read_table(spark, lake, "weather_data"))
    text = plan(cl.forecasts(rows, date(2001, 11, 4)))
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line)
    assert "month" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "NestedLoop" not in text
