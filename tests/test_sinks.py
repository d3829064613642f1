from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from climate_lake.operators.cleaning import clean_observations
from climate_lake.session import materialise, settings_for, work_path
from climate_lake.sinks.tables import land_documents, land_table, write_csv, write_json, write_table
from climate_lake.sources.files import list_files
from climate_lake.sources.raw import FILE, list_documents, read_document_files, read_documents, read_snapshots
from climate_lake.sources.tables import read_table


@pytest.fixture
def weather(spark):
    """200,000 observations, nearly all of them in one month."""
    return clean_observations(
        spark.range(200_000, numPartitions=8).selectExpr(
            "concat('C', id % 50) as city_name", "1d as latitude", "2d as longitude",
            "case when id < 200 then date'2024-01-01' + cast(id % 100 as int) "
            "else date'2025-06-01' + cast(id % 30 as int) end as date",
            "rand(1) * 30 as temp_max", "rand(2) * 10 as temp_min", "rand(3) as precipitation", "rand(4) as wind_speed",
            "rand(5) as humidity", "cast(id as string) as ingestion_timestamp", "'api' as data_source",
        )
    )


def files_per_month(spark, lake):
    paths = [row.path for row in list_files(spark, lake.table("weather_data")).collect()]
    return Counter("/".join(path.split("/")[-3:-1]) for path in paths)


def test_small_months_share_a_task_and_a_hot_month_is_split(spark, lake, weather):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        write_table(weather, lake, "weather_data")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = files_per_month(spark, lake)
    assert files["year=2025/month=6"] > 4
    assert max(count for month, count in files.items() if month != "year=2025/month=6") == 1
    assert read_table(spark, lake, "weather_data").count() == 200_000


def test_overwrite_replaces_and_append_adds(spark, lake, weather):
    write_table(weather, lake, "weather_data")
    write_table(weather.filter("year = 2024"), lake, "weather_data")
    assert read_table(spark, lake, "weather_data").count() == 200
    write_table(weather.filter("year = 2024"), lake, "weather_data", mode="append")
    assert read_table(spark, lake, "weather_data").count() == 400


def test_csv_has_a_header(spark, tmp_path, weather):
    path = str(tmp_path / "csv")
    write_csv(weather.limit(3).select("city_name", "date"), path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["city_name", "date"] and back.count() == 3


def test_materialise_computes_once(spark):
    frame = materialise(spark.range(10).selectExpr("id", "uuid() as mark"), "marks")
    assert frame.collect() == frame.collect()
    assert frame.schema.fieldNames() == ["id", "mark"]


def test_work_paths_lie_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_path(spark, "x"), work_path(spark, "x")
    assert first != second
    if base:
        assert first.startswith(base)


def test_settings_follow_the_data_size():
    assert settings_for(10**9)["spark.sql.shuffle.partitions"] == "200"
    partitions = int(settings_for(10 * 10**12)["spark.sql.shuffle.partitions"])
    assert 70_000 < partitions < 80_000
    assert int(settings_for(100 * 10**12)["spark.sql.shuffle.partitions"]) > 700_000


def test_second_landing_in_an_hour_keeps_the_first(spark, tmp_path):
    def fetch(*cities, elevation):
        fields = "city_info struct<name:string>, elevation double"
        return spark.createDataFrame([((city,), elevation) for city in cities], fields)

    as_of, raw = datetime(2025, 6, 1, 20, 55), str(tmp_path / "raw")
    land_documents(fetch("a", "b", elevation=1.0), raw, as_of)
    land_documents(fetch("c", elevation=1.0), raw, as_of)
    path = land_documents(fetch("b", elevation=2.0), raw, as_of)
    found = spark.read.json(path).select("city", "elevation").collect()
    assert sorted(map(tuple, found)) == [("a", 1.0), ("b", 2.0), ("c", 1.0)]


def test_json_is_written_compressed_and_read_back(spark, tmp_path, rows):
    """Field names that repeat in every row are not written out: landed documents, snapshots and exports."""
    raw, as_of = str(tmp_path / "raw"), datetime(2025, 6, 1, 5)
    documents = spark.range(20_000).selectExpr(
        "named_struct('name', concat('c', id % 3), 'lat', 1.5D, 'lon', 2.5D) as city_info",
        "named_struct('time', array('2025-06-01'), 'temperature_2m_max', array(double(id))) as daily",
        "cast(id as string) as ingestion_timestamp", "cast(null as string) as data_source",
    )
    land_documents(documents, raw, as_of)
    land_table(spark.range(20_000).select(F.col("id").alias("event_id")), raw, "climate_events", as_of)
    write_json(documents, str(tmp_path / "export"))
    plain = sum(len(row.line) + 1 for row in documents.select(F.to_json(F.struct("*")).alias("line")).collect())
    for folder in ("raw/weather-api", "export"):
        files = [path for path in (tmp_path / folder).rglob("part-*") if path.is_file()]
        assert sum(path.stat().st_size for path in files) < plain / 5
    wanted = sorted((f"c{k % 3}", float(k), str(k)) for k in range(20_000))
    fields = ["city_info.name", F.element_at("daily.temperature_2m_max", 1), "ingestion_timestamp"]
    assert sorted(map(tuple, read_documents(spark, raw).select(*fields).collect())) == wanted
    listed = list_documents(spark, raw)
    assert sorted(map(tuple, read_document_files(spark, raw, listed).select(*fields).collect())) == wanted
    assert rows(read_document_files(spark, raw).select(*FILE).distinct()) == rows(listed.select(*FILE)) != []
    for latest in (False, True):
        assert read_snapshots(spark, raw, "climate_events", latest).agg(F.sum("event_id")).first()[0] == sum(range(20_000))
