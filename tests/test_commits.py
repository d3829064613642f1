"""Writes that die, refreshed partitions, appended rows, and what the catalog makes of them."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from climate_lake.schemas import TABLES
from climate_lake.sinks import catalog
from climate_lake.sinks.tables import expire_versions, only_parts, parts_of, refresh_partitions, write_table
from climate_lake.sources import commits
from climate_lake.sources.tables import read_table, read_table_if_present

NAME = "weather_data"


def observed(spark, *rows):
    """Observations of (city, date, highest temperature)."""
    frame = spark.createDataFrame(
        [(city, 1.0, 2.0, day, high, 1.0, 0.0, 3.0, 50.0, "t", "api", high, day.year, day.month) for city, day, high in rows],
        TABLES[NAME].schema,
    )
    return frame


def stored(spark, lake, name=NAME):
    return sorted((row.city_name, row.date, row.temp_max) for row in read_table(spark, lake, name).collect())


MAY, JUNE, LAST = date(2025, 5, 3), date(2025, 6, 1), date(2024, 6, 9)
ROWS = [("a", MAY, 1.0), ("a", JUNE, 2.0), ("b", LAST, 3.0)]


def failing(frame):
    dies = F.when(F.col("month") == 6, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("temp_max"))
    return frame.withColumn("temp_max", dies)


def test_a_write_that_dies_leaves_the_old_rows(spark, lake):
    frame = observed(spark, *ROWS)
    with pytest.raises(PySparkException):
        write_table(failing(frame), lake, NAME)
    assert read_table_if_present(spark, lake, NAME) is None or read_table(spark, lake, NAME).count() == 0
    write_table(frame, lake, NAME)
    for write in (
        lambda: write_table(failing(frame), lake, NAME),
        lambda: refresh_partitions(failing(frame), lake, NAME, parts_of(frame, NAME)),
        lambda: write_table(failing(frame), lake, NAME, mode="append"),
    ):
        with pytest.raises(PySparkException):
            write()
        assert stored(spark, lake) == ROWS
    assert commits.read_log(spark, lake.root, NAME).version == 1


def test_a_write_whose_commit_dies_is_not_seen(spark, lake, monkeypatch):
    from climate_lake.sinks import tables

    write_table(observed(spark, *ROWS), lake, NAME)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "_commit", broken)
        with pytest.raises(RuntimeError):
            write_table(observed(spark, ("z", MAY, 9.0)), lake, NAME)
    assert stored(spark, lake) == ROWS
    write_table(observed(spark, ("z", MAY, 9.0)), lake, NAME)
    assert stored(spark, lake) == [("z", MAY, 9.0)]


def test_a_table_is_overwritten_from_itself(spark, lake):
    write_table(observed(spark, *ROWS), lake, NAME)
    write_table(read_table(spark, lake, NAME).withColumn("temp_max", F.col("temp_max") + 1), lake, NAME)
    assert stored(spark, lake) == [(city, day, high + 1) for city, day, high in ROWS]


def test_only_the_listed_partitions_are_replaced(spark, lake):
    write_table(observed(spark, *ROWS), lake, NAME)
    refresh_partitions(observed(spark, ("c", MAY, 7.0)), lake, NAME, ["year=2025/month=5", "year=2024/month=6"])
    assert stored(spark, lake) == [("a", JUNE, 2.0), ("c", MAY, 7.0)]
    paths = read_table(spark, lake, NAME).inputFiles()
    assert len({path.split("/v=")[1].split("/")[0] for path in paths}) == 2
    refresh_partitions(observed(spark), lake, NAME, ["year=2025/month=6"])
    assert stored(spark, lake) == [("c", MAY, 7.0)]
    write_table(observed(spark, *ROWS), lake, NAME)
    assert stored(spark, lake) == ROWS


def test_changes_since_a_version(spark, lake):
    write_table(observed(spark, *ROWS), lake, NAME)
    changed = lambda since: commits.read_log(spark, lake.root, NAME).changed_since(since)
    assert changed(None) is None and changed(0) is None and changed(1) == []
    refresh_partitions(observed(spark, ("c", MAY, 7.0)), lake, NAME, ["year=2025/month=5"])
    refresh_partitions(observed(spark), lake, NAME, ["year=2024/month=6"], source=12)
    assert changed(1) == ["year=2024/month=6", "year=2025/month=5"] and changed(2) == ["year=2024/month=6"]
    log = commits.read_log(spark, lake.root, NAME)
    assert (log.version, log.source) == (3, 12)
    write_table(observed(spark, *ROWS), lake, NAME)
    assert changed(1) is None and changed(4) == []
    assert commits.read_log(spark, lake.root, "never written").changed_since(3) is None


def test_commits_list_files_bytes_and_rows(spark, lake):
    write_table(observed(spark, *ROWS, ("b", JUNE, 4.0)), lake, NAME)
    found = commits.read_commits(spark, lake.root, NAME).filter("partition is not null").collect()
    assert {row.partition: row.rows for row in found} == {
        "year=2025/month=5": 1, "year=2025/month=6": 2, "year=2024/month=6": 1,
    }
    assert all(row.files >= 1 and row.bytes > 500 for row in found)


@pytest.mark.parametrize("refreshed", [False, True])
def test_append(spark, lake, refreshed):
    write_table(observed(spark, *ROWS), lake, NAME)
    if refreshed:
        refresh_partitions(observed(spark, ("a", MAY, 5.0)), lake, NAME, ["year=2025/month=5"])
    write_table(observed(spark, ("c", MAY, 7.0), ("c", date(2025, 8, 1), 8.0)), lake, NAME, mode="append")
    expected = [("a", MAY, 5.0 if refreshed else 1.0), *ROWS[1:], ("c", MAY, 7.0), ("c", date(2025, 8, 1), 8.0)]
    assert stored(spark, lake) == sorted(expected)
    with pytest.raises(ValueError):
        write_table(observed(spark), lake, NAME, mode="ignore")


def test_appending_to_nothing_and_to_a_plain_folder(spark, lake):
    write_table(observed(spark, *ROWS), lake, NAME, mode="append")
    assert stored(spark, lake) == ROWS
    plain = "integrated_weather_data"
    schema = TABLES[plain].schema
    rows = observed(spark, *ROWS).select(*[F.col(f.name) if f.name in TABLES[NAME].schema.names else
                                           F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    rows.write.partitionBy("year", "month").parquet(lake.table(plain))
    assert stored(spark, lake, plain) == ROWS
    write_table(rows, lake, plain, mode="append")
    assert stored(spark, lake, plain) == sorted(ROWS * 2)
    write_table(rows.limit(1), lake, plain)
    assert len(stored(spark, lake, plain)) == 1


def test_rows_without_a_partition_value(spark, lake):
    name = "climate_events"
    schema = TABLES[name].schema
    rows = spark.createDataFrame(
        [(k, "S", "storm", None, "low", None, None, 1.0, 2, None, None, None, year) for k, year in ((1, None), (2, 2024))], schema
    )
    write_table(rows, lake, name)
    assert parts_of(rows, name) == ["year=2024", "year=__HIVE_DEFAULT_PARTITION__"]
    assert [row.event_id for row in only_parts(read_table(spark, lake, name), name, ["year=__HIVE_DEFAULT_PARTITION__"]).collect()] == [1]
    refresh_partitions(rows.filter("false"), lake, name, ["year=__HIVE_DEFAULT_PARTITION__"])
    assert [row.event_id for row in read_table(spark, lake, name).collect()] == [2]


def test_a_refresh_reads_and_prunes_partitions(spark, lake, plan):
    write_table(observed(spark, *ROWS), lake, NAME)
    parts = ["year=2025/month=5", "year=2024/month=6", "year=2025/month=__HIVE_DEFAULT_PARTITION__"]
    chosen = only_parts(read_table(spark, lake, NAME), NAME, parts)
    assert sorted(row.date for row in chosen.collect()) == [LAST, MAY]
    assert "month" in plan(chosen).split("PartitionFilters")[1].split("]")[0]
    assert only_parts(read_table(spark, lake, NAME), NAME, []).count() == 0


def test_folders_that_nothing_reads_expire(spark, lake, tmp_path):
    for high in (1.0, 2.0, 3.0, 4.0):
        write_table(observed(spark, ("a", MAY, high), ("a", JUNE, high)), lake, NAME)
    refresh_partitions(observed(spark, ("a", MAY, 5.0)), lake, NAME, ["year=2025/month=5"])
    folder = tmp_path / "lake/trusted/weather_data"
    assert len(list(folder.glob("v=*"))) == 5
    assert len(expire_versions(spark, lake, NAME, keep=1)) == 3
    assert len(list(folder.glob("v=*"))) == 2
    assert stored(spark, lake) == [("a", MAY, 5.0), ("a", JUNE, 4.0)]
    assert expire_versions(spark, lake, "weather_stations") == []


def test_the_catalog_follows_the_commits(spark, lake):
    name, database = "annual_weather_summary", "lake_commits"
    schema = TABLES[name].schema

    def years(*pairs):
        return spark.createDataFrame([(city, year, 1, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, "cold") for city, year in pairs], schema)

    def shown():
        return sorted(((row.city_name, row.year) for row in spark.table(f"{database}.{name}").collect()), key=repr)

    write_table(years(("a", 2023), ("a", 2024)), lake, name)
    catalog.register_tables(spark, lake, database)
    assert catalog.sync_partitions(spark, lake, database, name) == {"added": 2, "moved": 0, "dropped": 0}
    assert shown() == [("a", 2023), ("a", 2024)]
    refresh_partitions(years(("b", 2024), ("b", 2025)), lake, name, ["year=2023", "year=2024", "year=2025"])
    assert catalog.sync_partitions(spark, lake, database, name) == {"added": 1, "moved": 1, "dropped": 1}
    assert shown() == [("b", 2024), ("b", 2025)]
    assert catalog.sync_partitions(spark, lake, database, name) == {"added": 0, "moved": 0, "dropped": 0}
    write_table(years(("c", 2025), ("c", None)), lake, name)
    assert catalog.sync_partitions(spark, lake, database, name) == {"added": 1, "moved": 1, "dropped": 1}
    assert shown() == [("c", 2025), ("c", None)]
    refresh_partitions(years(("d", None)), lake, name, ["year=__HIVE_DEFAULT_PARTITION__"])
    assert catalog.sync_partitions(spark, lake, database, name) == {"added": 0, "moved": 1, "dropped": 0}
    assert shown() == [("c", 2025), ("d", None)]


def test_an_unpartitioned_catalog_table_moves(spark, lake):
    name, database = "ml_model_metrics", "lake_moves"
    rows = spark.createDataFrame([("m", "x", 1.0, "t", "a", 1)], TABLES[name].schema)
    write_table(rows, lake, name)
    catalog.register_tables(spark, lake, database)
    assert spark.table(f"{database}.{name}").count() == 1
    write_table(rows.union(rows), lake, name)
    catalog.register_tables(spark, lake, database)
    assert spark.table(f"{database}.{name}").count() == 2
