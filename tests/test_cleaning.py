from __future__ import annotations

from climate_lake.operators import cleaning
from climate_lake.schemas import OBSERVATION, RAW_EVENTS, RAW_STATIONS, RAW_THRESHOLDS


def test_rows_without_id_are_dropped(spark):
    station = ("S1", "One", 1.0, 2.0, 3, "Cali", "Valle", "CO", "2020-01-01", "urban", "active")
    stations = spark.createDataFrame([station, (None, *station[1:])], RAW_STATIONS)
    assert [row.station_id for row in cleaning.clean_stations(stations).collect()] == ["S1"]


def test_event_dates(spark):
    rest = ("S1", "storm", "high", "text", "area", 1.0, 2, "One", "Cali", "Valle")
    events = spark.createDataFrame(
        [
            (1, rest[0], rest[1], "2024-03-15", *rest[2:]),
            (2, rest[0], rest[1], "2024-03-15T00:00:00.000", *rest[2:]),
            (3, rest[0], rest[1], "soon", *rest[2:]),
            (None, rest[0], rest[1], "2024-03-15", *rest[2:]),
        ],
        RAW_EVENTS,
    )
    got = {row.event_id: (str(row.event_date), row.year) for row in cleaning.clean_events(events).collect()}
    assert got == {1: ("2024-03-15", 2024), 2: ("2024-03-15", 2024), 3: ("None", None)}


def test_nan_threshold_is_null(spark):
    nan = float("nan")
    thresholds = spark.createDataFrame(
        [(1, "S1", "temperature", nan, 30.0, "info", 1, "One", "Cali")], RAW_THRESHOLDS
    )
    row = cleaning.clean_thresholds(thresholds).first()
    assert (row.min_value, row.max_value) == (None, 30.0)


def test_latest_only_prefers_newest_fetch(spark):
    from datetime import date

    def observation(city, day, temp, fetched):
        return (city, 1.0, 2.0, date(2025, 6, day), temp, None, 0.0, 1.0, 50.0, fetched, "api", temp, 2025, 6)

    frame = spark.createDataFrame(
        [
            observation("Cali", 1, 20.0, "2025-06-01T10:00:00"),
            observation("Cali", 1, 22.0, "2025-06-01T20:00:00"),
            observation("Cali", 1, 21.0, "2025-06-01T15:00:00"),
            observation("Cali", 1, 19.0, None),
            observation("Cali", 2, 25.0, None),
            observation("Neiva", 1, 30.0, "2025-06-01T10:00:00"),
        ],
        OBSERVATION,
    )
    latest = cleaning.latest_only(frame)
    assert latest.columns == OBSERVATION.fieldNames()
    got = sorted((row.city_name, row.date.day, row.temp_max) for row in latest.collect())
    assert got == [("Cali", 1, 22.0), ("Cali", 2, 25.0), ("Neiva", 1, 30.0)]
