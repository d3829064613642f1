"""Parameterised reads of the refined tables. Values are literals, never spliced into SQL text."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta
from json import dumps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LATEST_DAYS = 7
LATEST_COLUMNS = ["city_name", "date", "temp_avg", "temp_max", "temp_min", "precipitation", "humidity"]
TREND_COLUMNS = [
    "city_name",
    "year",
    "month",
    "avg_temperature",
    "max_temperature",
    "min_temperature",
    "avg_precipitation",
    "avg_humidity",
]
EVENT_COLUMNS = [
    "city_name",
    "event_type",
    "year",
    "event_count",
    "avg_temp_during_event",
    "max_precipitation",
    "max_wind_speed",
]
SUMMARY_COLUMNS = [
    "city_name",
    "year",
    "annual_avg_temp",
    "annual_max_temp",
    "annual_min_temp",
    "annual_precipitation",
    "annual_avg_humidity",
    "climate_category",
]


def latest_observations(weather: DataFrame, as_of: date, city: str = "all", limit: int = 10) -> DataFrame:
    """Newest rows of the last seven days, of one city or all.

    The implied bound on year and month lets a partitioned table skip older ones.
    """
    since = as_of - timedelta(days=LATEST_DAYS)
    recent = weather.filter(F.col("date") >= F.lit(since))
    if {"year", "month"} <= set(weather.columns):
        recent = recent.filter(F.col("year") * 12 + F.col("month") >= since.year * 12 + since.month)
    if city != "all":
        recent = recent.filter(F.col("city_name") == city)
    rest = [name for name in LATEST_COLUMNS if name != "date"]
    return recent.select(*LATEST_COLUMNS).orderBy(F.desc("date"), *rest).limit(limit)


def _at_most(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.limit(limit)


def trends(monthly: DataFrame, city: str | None = None, year: int = 2024, limit: int | None = 100) -> DataFrame:
    """Months of one city, or the first ``limit`` city months (None: all)."""
    rows = monthly.filter(F.col("year") == year).select(*TREND_COLUMNS)
    if city:
        return rows.filter(F.col("city_name") == city).orderBy("month")
    return _at_most(rows.orderBy("city_name", "month"), limit)


def extreme_events(
    summary: DataFrame, event_type: str = "all", year: int = 2024, limit: int | None = 50
) -> DataFrame:
    """The ``limit`` largest event groups of a year (None: all)."""
    rows = summary.filter(F.col("year") == year)
    if event_type != "all":
        rows = rows.filter(F.col("event_type") == event_type)
    largest = rows.select(*EVENT_COLUMNS).orderBy(F.desc("event_count"), "city_name", "event_type")
    return _at_most(largest, limit)


def annual(
    summary: DataFrame, year: int = 2024, climate_category: str = "all", limit: int | None = 20
) -> DataFrame:
    """Warmest cities of a year: the first ``limit`` (None: all), or every city of one category."""
    rows = summary.filter(F.col("year") == year).select(*SUMMARY_COLUMNS)
    order = [F.desc("annual_avg_temp"), F.col("city_name")]
    if climate_category == "all":
        return _at_most(rows.orderBy(*order), limit)
    return rows.filter(F.col("climate_category") == climate_category).orderBy(*order)


def monthly_precipitation(monthly: DataFrame, year: int = 2025) -> DataFrame:
    rows = monthly.filter(F.col("year") == year)
    return rows.select("city_name", "month", "avg_precipitation").orderBy("city_name", "month")


def mean_temperature_by_city(weather: DataFrame) -> DataFrame:
    means = weather.groupBy("city_name").agg(F.avg("temp_avg").alias("avg_temp"))
    return means.orderBy(F.desc("avg_temp"), "city_name")


def total_extreme_events(summary: DataFrame) -> DataFrame:
    totals = summary.groupBy("city_name", "event_type").agg(F.sum("event_count").alias("total_events"))
    return totals.orderBy(F.desc("total_events"), "city_name", "event_type")


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("total"))


def json_rows(result: DataFrame) -> DataFrame:
    """Each row as a JSON object whose values are text, NULLs kept."""
    as_text = F.struct(*[F.col(name).cast("string").alias(name) for name in result.columns])
    return result.select(F.to_json(as_text, {"ignoreNullFields": "false"}).alias("json"))


def response_header(result: DataFrame, params: Mapping[str, str]) -> DataFrame:
    """The envelope around ``json_rows``: rows returned, after any limit of the read, and the query parameters."""
    return result.agg(F.count("*").alias("total_records")).withColumn(
        "query_params", F.lit(dumps(dict(params), ensure_ascii=False))
    )
