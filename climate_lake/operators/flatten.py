"""Nested API documents to one row per city and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climate_lake.constants import DAILY_MEASURES, DAILY_TIME, DEFAULT_DATA_SOURCE, UNKNOWN_CITY
from climate_lake.functions.columns import all_present, midpoint, to_date

EXPORT_COLUMNS = [
    "city_name",
    "latitude",
    "longitude",
    "date",
    "temp_max",
    "temp_min",
    "temp_avg",
    "precipitation",
    "humidity",
    "wind_speed",
    "ingestion_timestamp",
    "data_source",
]


def _place(name: Column) -> list[Column]:
    return [
        name.alias("city_name"),
        F.col("city_info.lat").alias("latitude"),
        F.col("city_info.lon").alias("longitude"),
    ]


def _arrays(pad_missing: bool) -> list[Column]:
    """The parallel daily arrays under their observation names; ``pad_missing`` makes absent measures empty."""
    measures = [
        (F.coalesce(F.col(f"daily.{name}"), F.array().cast("array<double>")) if pad_missing else F.col(f"daily.{name}"))
        .alias(column)
        for name, column in DAILY_MEASURES.items()
    ]
    return [F.col(f"daily.{DAILY_TIME}").alias("date"), *measures]


def _zipped() -> Column:
    """Array of day entries; shorter arrays are padded with NULL."""
    return F.arrays_zip("date", *DAILY_MEASURES.values())


def flatten_daily(documents: DataFrame, lenient: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per position of the parallel daily arrays; ``date`` stays text.

    Shorter arrays are padded with NULL. A document with a NULL array gives no
    rows, unless ``lenient``, which treats a NULL measure array as empty. Rows
    without city or date are dropped. Columns named in ``keep`` are carried along.
    """
    place = _place(F.col("city_info.name"))
    arrays = documents.select(*place, *_arrays(lenient), "ingestion_timestamp", "data_source", *keep)
    days = arrays.select(
        "city_name", "latitude", "longitude", F.inline(_zipped()), "ingestion_timestamp", "data_source", *keep
    )
    return days.filter(all_present("city_name", "date"))


def flatten_for_export(documents: DataFrame) -> DataFrame:
    """Flat export rows: a day counts if the maximum temperature array reaches it.

    Other measures are looked up by position and are NULL beyond their array;
    an absent city or source gets its default name, and a day without readable
    date is dropped. ``temp_avg`` needs both extremes.
    """
    place = _place(F.coalesce("city_info.name", F.lit(UNKNOWN_CITY)))
    source = F.coalesce("data_source", F.lit(DEFAULT_DATA_SOURCE)).alias("data_source")
    arrays = documents.select(*place, *_arrays(pad_missing=True), "ingestion_timestamp", source)
    reached = F.least(F.size("date"), F.size("temp_max"))
    days = arrays.select(
        "city_name",
        "latitude",
        "longitude",
        F.inline(F.slice(_zipped(), F.lit(1), reached)),
        "ingestion_timestamp",
        "data_source",
    )
    dated = days.withColumn("date", to_date("date")).filter(F.col("date").isNotNull())
    return dated.withColumn("temp_avg", midpoint()).select(*EXPORT_COLUMNS)
