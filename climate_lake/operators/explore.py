"""Exploratory statistics over flat observations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climate_lake.functions.column_quantiles import column_quantiles
from climate_lake.functions.quantiles import exact_quantiles

NUMERIC = [
    "latitude",
    "longitude",
    "temp_max",
    "temp_min",
    "temp_avg",
    "precipitation",
    "humidity",
    "wind_speed",
]
QUARTILES = {0.25: "q1", 0.5: "median", 0.75: "q3"}


def quick_stats(weather: DataFrame) -> DataFrame:
    return weather.agg(
        F.avg("temp_avg").alias("avg_temp"),
        F.max("temp_max").alias("max_temp"),
        F.min("temp_min").alias("min_temp"),
        F.coalesce(F.sum("precipitation"), F.lit(0.0)).alias("total_precipitation"),
    )


def city_stats(weather: DataFrame) -> DataFrame:
    return weather.groupBy("city_name").agg(
        F.bround(F.avg("temp_avg"), 1).alias("temp_avg"),
        F.bround(F.coalesce(F.sum("precipitation"), F.lit(0.0)), 1).alias("precipitation"),
    )


def describe(weather: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per numeric column."""
    present = [name for name in NUMERIC if name in weather.columns]
    numbers = weather.select(*[F.col(name).cast("double").alias(name) for name in present])
    basics = numbers.agg(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(name).alias("count"),
                F.avg(name).alias("mean"),
                F.stddev_samp(name).alias("std"),
            ).alias(name)
            for name in present
        ]
    ).select(F.inline(F.array(*present)))
    spread = column_quantiles(numbers, present, {0.0: "min", **QUARTILES, 1.0: "max"})
    return basics.join(spread, "column_name", "left")


def city_count(weather: DataFrame) -> DataFrame:
    return weather.agg(F.countDistinct("city_name").alias("cities"))


def value_counts(weather: DataFrame) -> DataFrame:
    counts = weather.filter(F.col("city_name").isNotNull()).groupBy("city_name").count()
    return counts.orderBy(F.desc("count"), "city_name")


def city_points(weather: DataFrame) -> DataFrame:
    """Mean temperature and position per city; the position is constant, so any of it will do."""
    return weather.groupBy("city_name").agg(
        F.avg("temp_avg").alias("temp_avg"),
        F.min("latitude").alias("latitude"),
        F.min("longitude").alias("longitude"),
    )


def daily_mean(weather: DataFrame) -> DataFrame:
    return weather.groupBy("date").agg(F.avg("temp_avg").alias("temp_avg"))


def box_stats(weather: DataFrame) -> DataFrame:
    """Extremes and exact quartiles of the mean temperature per city."""
    return exact_quantiles(weather, ["city_name"], "temp_avg", {0.0: "low", **QUARTILES, 1.0: "high"})


def histogram(weather: DataFrame, column: str = "temp_avg", width: float = 1.0) -> DataFrame:
    start = (F.floor(F.col(column) / width) * width).cast("double")
    return (
        weather.filter(F.col(column).isNotNull())
        .groupBy(start.alias("bin_start"))
        .agg(F.count("*").alias("observations"))
    )


def scatter_points(weather: DataFrame) -> DataFrame:
    """Distinct (city, mean temperature, rain) points with their number."""
    return (
        weather.filter(F.col("temp_avg").isNotNull() & F.col("precipitation").isNotNull())
        .groupBy("city_name", "temp_avg", "precipitation")
        .agg(F.count("*").alias("observations"))
    )


def date_range(weather: DataFrame) -> DataFrame:
    return weather.agg(
        F.count("*").alias("total_records"),
        F.min("date").alias("start"),
        F.max("date").alias("end"),
    )


def export_metadata(weather: DataFrame, as_of: datetime, source: str) -> DataFrame:
    """Export description as (section, value) rows, one per city and per variable.

    Rows instead of one nested record: the list of cities is never gathered
    in a single task.
    """
    facts = date_range(weather)
    named = {
        "total_records": F.col("total_records").cast("string"),
        "date_range.start": F.col("start").cast("string"),
        "date_range.end": F.col("end").cast("string"),
        "export_timestamp": F.lit(as_of.isoformat()),
        "source": F.lit(source),
    }
    singles = [
        F.struct(F.lit(section).alias("section"), value.alias("value")) for section, value in named.items()
    ]
    variables = [
        F.struct(F.lit("variable").alias("section"), F.lit(name).alias("value")) for name in weather.columns
    ]
    summary = facts.select(F.inline(F.array(*singles, *variables)))
    cities = weather.select(F.lit("city").alias("section"), F.col("city_name").alias("value")).distinct()
    return summary.unionByName(cities)
