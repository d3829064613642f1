"""Monthly trends, extreme events and annual climate of the refined zone."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climate_lake.functions.columns import (
    ExtremeLimits,
    all_present,
    climate_category,
    event_label,
    require,
    with_optional,
)

MEASURES = {
    "temp_avg": "double",
    "temp_max": "double",
    "temp_min": "double",
    "precipitation": "double",
    "humidity": "double",
    "wind_speed": "double",
}


def monthly_trends(weather: DataFrame) -> DataFrame:
    """Per city and month; measures the input lacks give NULL columns."""
    require(weather, "city_name", "temp_avg")
    keys = ["city_name", "year", "month"]
    return (
        with_optional(weather, MEASURES)
        .filter(all_present("temp_avg", *keys))
        .groupBy(*keys)
        .agg(
            F.avg("temp_avg").alias("avg_temperature"),
            F.count("*").alias("data_points"),
            F.max("temp_max").alias("max_temperature"),
            F.min("temp_min").alias("min_temperature"),
            F.avg("precipitation").alias("avg_precipitation"),
            F.avg("humidity").alias("avg_humidity"),
        )
    )


def extreme_rows(weather: DataFrame, limits: ExtremeLimits = ExtremeLimits()) -> DataFrame:
    """Observations beyond any limit, with their ``event_type``."""
    rules = limits.rules(weather.columns)
    if not rules:
        raise ValueError("no measure with an extreme limit present")
    beyond_any = reduce(or_, [condition for _, condition in rules])
    return weather.filter(beyond_any).withColumn("event_type", event_label(weather.columns, limits))


def extreme_summary(weather: DataFrame, limits: ExtremeLimits = ExtremeLimits()) -> DataFrame:
    """Extreme observations per city, event type and year."""
    return (
        with_optional(extreme_rows(weather, limits), MEASURES)
        .groupBy("city_name", "event_type", "year")
        .agg(
            F.count("*").alias("event_count"),
            F.avg("temp_avg").alias("avg_temp_during_event"),
            F.max("precipitation").alias("max_precipitation"),
            F.max("wind_speed").alias("max_wind_speed"),
        )
    )


def annual_summary(weather: DataFrame) -> DataFrame:
    """Per city and year, with the climate category (``unknown`` without temperature or rain)."""
    keys = ["city_name", "year"]
    known = {"temp_avg", "precipitation"} <= set(weather.columns)
    return (
        with_optional(weather, MEASURES)
        .filter(all_present(*keys))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("total_measurements"),
            F.avg("temp_avg").alias("annual_avg_temp"),
            F.max("temp_avg").alias("annual_max_temp"),
            F.min("temp_avg").alias("annual_min_temp"),
            F.sum("precipitation").alias("annual_precipitation"),
            F.avg("humidity").alias("annual_avg_humidity"),
            F.avg("wind_speed").alias("annual_avg_wind"),
        )
        .withColumn("climate_category", climate_category() if known else F.lit("unknown"))
    )
