"""Extracts of the relational source, over any DataFrames of its three tables."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climate_lake.functions.joins import dimension_join
from climate_lake.schemas import RAW_STATIONS

# Columns of the source tables themselves; the place comes from the station.
EVENT_COLUMNS = [
    "event_id",
    "station_id",
    "event_type",
    "event_date",
    "severity",
    "description",
    "impact_area",
    "economic_impact",
    "people_affected",
]
THRESHOLD_COLUMNS = [
    "threshold_id",
    "station_id",
    "parameter_name",
    "min_value",
    "max_value",
    "alert_level",
    "notification_enabled",
]


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str | None = None,
    bounds: tuple[int, int] | None = None, partitions: int = 1, **options: str,
) -> DataFrame:
    """A table over JDBC, read in ``partitions`` ranges of a numeric ``key`` within ``bounds``."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partitions > 1:
        if not key or bounds is None or bounds[0] >= bounds[1]:
            raise ValueError("several partitions need a key and its lowest and highest value")
        reader = reader.options(
            partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def active_stations(stations: DataFrame) -> DataFrame:
    return stations.filter(F.col("status") == "active").select(*RAW_STATIONS.fieldNames())


def recent_events(
    events: DataFrame, stations: DataFrame, as_of: date | datetime, days_back: int = 30
) -> DataFrame:
    """Events of the last days with their station, newest first.

    Events carry dates, the window ends at a point in time: a date counts if
    its midnight lies inside. The event id makes the order total, so that one
    busy day can still be sorted by several tasks. The implied years let a
    partitioned table skip the others.
    """
    end = as_of if isinstance(as_of, datetime) else datetime.combine(as_of, time.min)
    start = end - timedelta(days=days_back)
    first_day = start.date() if start.time() == time.min else start.date() + timedelta(days=1)
    recent = events.filter(F.col("event_date").between(F.lit(first_day), F.lit(end.date())))
    if "year" in events.columns:
        recent = recent.filter(F.col("year").between(first_day.year, end.year))
    place = ["station_name", "city", "department"]
    joined = dimension_join(recent.select(*EVENT_COLUMNS), stations.select("station_id", *place), ["station_id"])
    return joined.select(*EVENT_COLUMNS, *place).orderBy(F.desc("event_date"), "event_id")


def enabled_thresholds(thresholds: DataFrame, stations: DataFrame) -> DataFrame:
    """Thresholds that notify, with their station."""
    enabled = thresholds.filter(F.col("notification_enabled").cast("boolean")).select(*THRESHOLD_COLUMNS)
    place = ["station_name", "city"]
    joined = dimension_join(enabled, stations.select("station_id", *place), ["station_id"])
    return joined.select(*THRESHOLD_COLUMNS, *place)
