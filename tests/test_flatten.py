from __future__ import annotations

import json
import random
from collections import Counter
from itertools import zip_longest

import pytest

from climate_lake.operators.cleaning import clean_observations
from climate_lake.operators.flatten import EXPORT_COLUMNS, flatten_daily, flatten_for_export
from climate_lake.schemas import RAW_DOCUMENT


def document(name="Bogotá", source="api", **arrays):
    daily = {
        "time": ["2025-06-01", "2025-06-02", "2025-06-03"],
        "temperature_2m_max": [30.0, 31.0, 32.0],
        "temperature_2m_min": [20.0, 21.0, 22.0],
        "precipitation_sum": [0.0, 1.5, 2.5],
        "windspeed_10m_max": [10.0, 11.0, 12.0],
        "relative_humidity_2m_mean": [80, 81, 82],
        "surface_pressure_mean": [750.0, 751.0, 752.0],
    }
    daily.update(arrays)
    return {
        "city_info": {"lat": 4.6, "lon": -74.1, "name": name},
        "daily": daily,
        "ingestion_timestamp": "2025-06-01T20:00:00",
        "data_source": source,
    }


@pytest.fixture
def documents(spark):
    def build(*items):
        lines = spark.createDataFrame([(json.dumps(item),) for item in items], "line string")
        return spark.read.schema(RAW_DOCUMENT).json(lines.rdd.map(lambda row: row.line))

    return build


def test_one_row_per_day(documents):
    flat = flatten_daily(documents(document()))
    assert flat.columns == [
        "city_name", "latitude", "longitude", "date", "temp_max", "temp_min", "precipitation", "wind_speed",
        "humidity", "ingestion_timestamp", "data_source",
    ]
    assert [tuple(row)[:9] for row in flat.orderBy("date").collect()] == [
        ("Bogotá", 4.6, -74.1, "2025-06-01", 30.0, 20.0, 0.0, 10.0, 80.0),
        ("Bogotá", 4.6, -74.1, "2025-06-02", 31.0, 21.0, 1.5, 11.0, 81.0),
        ("Bogotá", 4.6, -74.1, "2025-06-03", 32.0, 22.0, 2.5, 12.0, 82.0),
    ]


def test_short_arrays_are_padded(documents):
    flat = flatten_daily(documents(document(temperature_2m_min=[20.0], precipitation_sum=[])))
    got = [(row.temp_min, row.precipitation) for row in flat.orderBy("date").collect()]
    assert got == [(20.0, None), (None, None), (None, None)]


def test_longer_measure_has_no_date_and_is_dropped(documents):
    assert flatten_daily(documents(document(temperature_2m_max=[1.0, 2.0, 3.0, 4.0]))).count() == 3


def test_null_array_drops_document_unless_lenient(documents):
    docs = documents(document(windspeed_10m_max=None), document("Cali"))
    assert {row.city_name for row in flatten_daily(docs).collect()} == {"Cali"}
    lenient = flatten_daily(docs, lenient=True).filter("city_name = 'Bogotá'")
    assert [row.wind_speed for row in lenient.collect()] == [None, None, None]
    assert flatten_daily(documents(document(time=None)), lenient=True).count() == 0


def test_unnamed_city_and_null_day(documents):
    docs = documents(document(name=None), document(time=["2025-06-01", None, "2025-06-03"]))
    assert flatten_daily(docs).count() == 2


def test_cleaning_rules(documents):
    docs = documents(
        document(
            time=["2025-06-01", "garbage", "2025-12-31"],
            temperature_2m_max=[30.0, 31.0, 32.0],
            temperature_2m_min=[20.0, 21.0, None],
        ),
        document("Cali", temperature_2m_max=[None, 25.0]),
    )
    got = {
        (row.city_name, str(row.date), row.temp_avg, row.year, row.month)
        for row in clean_observations(flatten_daily(docs)).collect()
    }
    assert got == {
        ("Bogotá", "2025-06-01", 25.0, 2025, 6),
        ("Bogotá", "2025-12-31", 32.0, 2025, 12),
        ("Cali", "2025-06-02", 23.0, 2025, 6),
    }


def test_export_form(documents):
    docs = documents(
        document(name=None, source=None, temperature_2m_max=[30.0, 31.0], temperature_2m_min=[20.0]),
        document("Cali", precipitation_sum=None),
        document("Neiva", temperature_2m_max=None),
    )
    export = flatten_for_export(docs)
    assert export.columns == EXPORT_COLUMNS
    unknown = export.filter("city_name = 'Unknown'").orderBy("date").collect()
    assert [(str(row.date), row.temp_max, row.temp_min, row.temp_avg) for row in unknown] == [
        ("2025-06-01", 30.0, 20.0, 25.0),
        ("2025-06-02", 31.0, None, None),
    ]
    assert {row.data_source for row in unknown} == {"openmeteo_api"}
    assert [row.precipitation for row in export.filter("city_name = 'Cali'").collect()] == [None] * 3
    assert export.filter("city_name = 'Neiva'").count() == 0


# Observation columns in the order of the arrays below.
ARRAYS = [
    "time",
    "temperature_2m_max",
    "temperature_2m_min",
    "precipitation_sum",
    "windspeed_10m_max",
    "relative_humidity_2m_mean",
]


def random_document(source, number):
    def values(make):
        if source.random() < 0.08:
            return None
        return [None if source.random() < 0.1 else make() for _ in range(source.randrange(0, 6))]

    arrays = {name: values(lambda: float(source.randrange(400)) / 10) for name in ARRAYS[1:]}
    arrays["time"] = values(lambda: source.choice(["2025-06-01", "2024-02-29", "2023-02-29", "soon"]))
    name = None if source.random() < 0.1 else f"City {number}"
    return document(name, None if source.random() < 0.2 else "api", **arrays)


def flat_model(doc, lenient):
    arrays = [doc["daily"][name] for name in ARRAYS]
    if lenient:
        arrays[1:] = [array or [] for array in arrays[1:]]
    if any(array is None for array in arrays) or doc["city_info"]["name"] is None:
        return []
    days = zip_longest(*arrays)
    return [(doc["city_info"]["name"], *day, doc["data_source"]) for day in days if day[0] is not None]


def export_model(doc):
    arrays = [doc["daily"][name] or [] for name in ARRAYS]

    def at(array, position):
        return array[position] if position < len(array) else None

    out = []
    for position, day in enumerate(arrays[0][: len(arrays[1])]):
        if day not in ("2025-06-01", "2024-02-29"):
            continue
        high, low, rain, wind, humidity = (at(array, position) for array in arrays[1:])
        mean = (high + low) / 2 if None not in (high, low) else None
        source = doc["data_source"] or "openmeteo_api"
        out.append((doc["city_info"]["name"] or "Unknown", day, high, low, mean, rain, humidity, wind, source))
    return out


def test_random_documents(documents):
    source = random.Random(5)
    docs = [random_document(source, number) for number in range(400)]
    frame = documents(*docs)
    columns = ["city_name", "date", "temp_max", "temp_min", "precipitation", "wind_speed", "humidity", "data_source"]
    for lenient in (False, True):
        flat = flatten_daily(frame, lenient).select(*columns)
        expected = Counter(row for doc in docs for row in flat_model(doc, lenient))
        assert expected and Counter(tuple(row) for row in flat.collect()) == expected
    export = flatten_for_export(frame).selectExpr(
        "city_name", "cast(date as string)", "temp_max", "temp_min", "temp_avg", "precipitation", "humidity",
        "wind_speed", "data_source",
    )
    expected = Counter(row for doc in docs for row in export_model(doc))
    assert expected and Counter(tuple(row) for row in export.collect()) == expected
