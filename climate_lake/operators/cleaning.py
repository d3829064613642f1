"""Raw rows to the clean tables of the trusted zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climate_lake.functions.columns import all_present, daily_mean_temperature, to_date
from climate_lake.schemas import OBSERVATION, RAW_EVENTS, RAW_STATIONS, RAW_THRESHOLDS


def clean_observations(flat: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed observations with mean temperature and partition columns.

    Rows without city, readable date or maximum temperature are dropped. Columns named in ``keep`` are carried along.
    """
    dated = flat.withColumn("date", to_date("date")).filter(all_present("city_name", "date", "temp_max"))
    return dated.withColumns(
        {
            "temp_avg": daily_mean_temperature(),
            "year": F.year("date"),
            "month": F.month("date"),
        }
    ).select(*OBSERVATION.fieldNames(), *keep)


def latest_only(observations: DataFrame, keys: tuple[str, ...] = ("city_name", "date")) -> DataFrame:
    """Keep the most recently ingested row per key.

    A maximum over (timestamp, other columns) is combined before the shuffle,
    so a city fetched very often does not land in one task as a whole. Equal
    timestamps are settled by the other columns, in order.
    """
    rest = [name for name in observations.columns if name not in (*keys, "ingestion_timestamp")]
    newest = F.max(F.struct("ingestion_timestamp", *rest))
    return (
        observations.groupBy(*keys)
        .agg(newest.alias("newest"))
        .select(*keys, "newest.*")
        .select(*observations.columns)
    )


def clean_stations(stations: DataFrame) -> DataFrame:
    return stations.select(*RAW_STATIONS.fieldNames()).filter(all_present("station_id"))


def clean_events(events: DataFrame) -> DataFrame:
    """Events with an id; the date is parsed (NULL where unreadable) and gives the partition year."""
    return (
        events.select(*RAW_EVENTS.fieldNames())
        .filter(all_present("event_id"))
        .withColumn("event_date", to_date("event_date"))
        .withColumn("year", F.year("event_date"))
    )


def clean_thresholds(thresholds: DataFrame) -> DataFrame:
    """Thresholds with an id; a ``NaN`` limit of the raw JSON means no limit."""
    limits = {name: F.nanvl(F.col(name), F.lit(None).cast("double")) for name in ("min_value", "max_value")}
    return (
        thresholds.select(*RAW_THRESHOLDS.fieldNames())
        .filter(all_present("threshold_id"))
        .withColumns(limits)
    )
