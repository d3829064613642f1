from __future__ import annotations

import random
from collections import Counter

import pytest

from climate_lake.operators.cleaning import clean_observations
from climate_lake.operators.integrate import integrate_in_place, integrate_stations
from climate_lake.plans import pipeline
from climate_lake.schemas import RAW_STATIONS
from climate_lake.sinks.tables import write_table
from climate_lake.sources.files import list_files
from climate_lake.sources.tables import read_table

FORMS = {
    "broadcast": {},
    "shuffle": {"broadcast_rows": 0, "rows_per_split": 20},
}
OBSERVED = "city_name string, latitude double, longitude double, temp_max double"


def station(number, city, latitude, longitude):
    return (f"S{number}", f"Name {number}", latitude, longitude, number, city, "D", "CO", "2020-01-01", "urban", "active")


def brute_force(observations, stations):
    out = Counter()
    for city, latitude, longitude, temp in observations:
        matches = [
            s
            for s in stations
            if (city is not None and city == s[5])
            or (
                None not in (latitude, longitude, s[2], s[3])
                and abs(latitude - s[2]) < 0.1
                and abs(longitude - s[3]) < 0.1
            )
        ]
        for s in matches or [None]:
            attributes = (s[0], s[1], s[4], s[9]) if s else (None,) * 4
            out[(city, latitude, longitude, temp, *attributes)] += 1
    return out


@pytest.fixture
def check(spark):
    def run(observations, stations, form):
        left = spark.createDataFrame(observations, OBSERVED).repartition(5)
        right = spark.createDataFrame(stations, RAW_STATIONS)
        joined = integrate_stations(left, right, **FORMS[form])
        assert Counter(tuple(row) for row in joined.collect()) == brute_force(observations, stations)

    return run


@pytest.mark.parametrize("form", FORMS)
def test_edges(check, form):
    observations = [
        ("Cali", 3.45, -76.53, 1.0),  # by city and by position: one row
        ("Cali", 3.45, -76.53, 1.0),  # identical copy
        ("Elsewhere", 3.45, -76.53, 2.0),  # by position only
        ("Far", 3.55, -76.53, 3.0),  # difference of about the tolerance
        ("Cali", None, None, 4.0),  # by city, position unknown
        (None, 3.46, -76.54, 5.0),  # by position, city unknown
        (None, None, None, 6.0),
        ("Nowhere", 80.0, 80.0, 7.0),
        ("Half", 3.45, 10.0, 8.0),  # only the latitude is close
        ("Edge", 0.5, 0.5, 9.0),
        ("Zero", -0.04, 0.04, 10.0),
    ]
    stations = [
        station(1, "Cali", 3.4516, -76.532),
        station(1, "Cali", 3.4516, -76.532),  # second snapshot of the same station
        station(2, None, 3.4516, -76.532),
        station(3, "Cali", None, None),
        station(4, "Other", 0.4, 0.5),
        station(5, "Other", 0.6, 0.5),
        station(6, "Other", 0.04, -0.04),
    ]
    check(observations, stations, form)


@pytest.mark.parametrize("form", FORMS)
def test_random_raster(check, form):
    """Coordinates on a 0.01 raster, many of them near a cell border; one city holds a third of both sides."""
    source = random.Random(11)

    def point():
        return round(source.uniform(-1, 1), 2), round(source.uniform(-1, 1), 2)

    def city(number):
        return "Hot" if number % 3 == 0 else f"C{source.randrange(60)}"

    observations = [(city(i), *point(), float(i % 5)) for i in range(300)]
    stations = [station(i, city(i) if i % 6 else f"X{i}", *point()) for i in range(120)]
    check(observations, stations, form)


@pytest.mark.parametrize("form", FORMS)
def test_no_stations(check, form):
    check([("Cali", 1.0, 1.0, 1.0)], [], form)


def test_absent_station_table(spark):
    observations = spark.createDataFrame([("Cali", 1.0, 1.0, 1.0)], OBSERVED)
    joined = integrate_stations(observations, None)
    assert dict(joined.dtypes)["elevation"] == "bigint"
    assert tuple(joined.first())[4:] == (None,) * 4


def test_few_matches_need_no_shuffle_of_observations(spark, plan):
    observations = spark.range(1000).selectExpr(
        "cast(id as string) as city_name", "id * 0.01d as latitude", "id * 0.02d as longitude", "2d as temp_max"
    )
    text = plan(integrate_stations(observations, spark.createDataFrame([station(1, "a", 1.0, 1.0)], RAW_STATIONS)))
    assert "NestedLoop" not in text and "SortMergeJoin" not in text
    assert "Exchange hashpartitioning(city_name" not in text


def test_written_where_the_observations_lie(spark, lake, monkeypatch, plan):
    """The joined table is written without a shuffle, in no more files than the observations, and is the same."""
    rows = spark.range(4000, numPartitions=4).selectExpr(
        "concat('C', id % 3) as city_name", "4d as latitude", "cast(id % 3 as double) as longitude",
        "date'2025-01-01' + cast(id % 90 as int) as date", "cast(id as double) as temp_max", "0d as temp_min",
        "0d as precipitation", "0d as wind_speed", "50d as humidity", "'t' as ingestion_timestamp", "'api' as data_source",
    )
    write_table(clean_observations(rows), lake, "weather_data")
    stations = [station(1, "C0", 50.0, 50.0), station(2, "Other", 4.01, 0.01), station(3, "C1", 50.0, 50.0)]
    write_table(spark.createDataFrame(stations, RAW_STATIONS), lake, "weather_stations")
    written, write = [], pipeline.write_table
    monkeypatch.setattr(pipeline, "write_table", lambda df, *a, **b: (written.append(b), write(df, *a, **b)))
    pipeline.run_etl(spark, lake, only=["integrated_weather_data"])
    assert written == [{"in_place": True}]
    found = read_table(spark, lake, "integrated_weather_data")
    expected, same = integrate_in_place(
        read_table(spark, lake, "weather_data"), spark.createDataFrame(stations, RAW_STATIONS)
    )
    assert same and "Exchange hash" not in plan(expected)
    wanted = sorted(tuple(row) for row in expected.select(found.columns).na.fill("").na.fill(-1).collect())
    assert sorted(tuple(row) for row in found.na.fill("").na.fill(-1).collect()) == wanted and len(wanted) == 4000 + 1334

    def files(name):
        return list_files(spark, lake.table(name)).filter("path like '%.parquet'").count()

    assert files("integrated_weather_data") <= files("weather_data")


def test_many_stations_of_a_location_are_spread(spark):
    """Rows that grow many times by the join, or that it shuffles, are not left in place."""
    seen = spark.createDataFrame([("Cali", 3.45, -76.53, 1.0)] * 3, OBSERVED)
    few, many = ([station(k, "Cali", 1.0, 1.0) for k in range(n)] for n in (4, 5))
    for stations, form, stays in [(few, "broadcast", True), (many, "broadcast", False), (few, "shuffle", False)]:
        rows, in_place = integrate_in_place(seen, spark.createDataFrame(stations, RAW_STATIONS), **FORMS[form])
        assert (rows.count(), in_place) == (3 * len(stations), stays)


def test_rows_in_place_are_not_sorted_again(spark, lake):
    """A task's rows may be many times its memory: they are written in the order they come, several partitions at a time."""
    rows = clean_observations(
        spark.range(0, 3000, numPartitions=1).selectExpr(
            "concat('C', id % 3) as city_name", "4d as latitude", "5d as longitude",
            "date'2025-01-01' + cast(id % 90 as int) as date", "cast(3000 - id as double) as temp_max", "0d as temp_min",
            "0d as precipitation", "0d as wind_speed", "50d as humidity", "'t' as ingestion_timestamp", "'api' as data_source",
        )
    )
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    write_table(rows, lake, "weather_data", in_place=True)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    parts = read_table(spark, lake, "weather_data").coalesce(1).select("year", "month", "temp_max").collect()
    assert len(parts) == 3000
    for month in (1, 2, 3):
        temps = [row["temp_max"] for row in parts if row["month"] == month]
        assert temps == sorted(temps, reverse=True) and len(temps) >= 900
