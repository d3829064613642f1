"""Mergeable partial aggregates per city and month, from which all trend tables follow without the observations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climate_lake.functions.columns import ExtremeLimits, all_present, climate_category, with_optional
from climate_lake.operators.trends import MEASURES, extreme_rows

KEYS = ["city_name", "year", "month"]
EXTREME_KEYS = ["city_name", "event_type", "year", "month"]

# How a column of two states is combined: names that begin so.
_MERGED = {"n_": F.sum, "sum_": F.sum, "max_": F.max, "min_": F.min}


def trend_state(weather: DataFrame) -> DataFrame:
    """Counts, sums and extremes per city and month. Columns ending in ``_measured`` are of rows with a mean temperature."""
    measured = {name: F.when(F.col("temp_avg").isNotNull(), F.col(name)) for name in MEASURES}
    return (
        with_optional(weather, MEASURES)
        .groupBy(*KEYS)
        .agg(
            F.count("*").alias("n_rows"),
            F.count("temp_avg").alias("n_temperature"),
            F.sum("temp_avg").alias("sum_temperature"),
            F.max("temp_avg").alias("max_temperature"),
            F.min("temp_avg").alias("min_temperature"),
            F.max(measured["temp_max"]).alias("max_high_measured"),
            F.min(measured["temp_min"]).alias("min_low_measured"),
            F.count(measured["precipitation"]).alias("n_precipitation_measured"),
            F.sum(measured["precipitation"]).alias("sum_precipitation_measured"),
            F.count(measured["humidity"]).alias("n_humidity_measured"),
            F.sum(measured["humidity"]).alias("sum_humidity_measured"),
            F.sum("precipitation").alias("sum_precipitation"),
            F.count("humidity").alias("n_humidity"),
            F.sum("humidity").alias("sum_humidity"),
            F.count("wind_speed").alias("n_wind"),
            F.sum("wind_speed").alias("sum_wind"),
        )
    )


def extreme_state(weather: DataFrame, limits: ExtremeLimits = ExtremeLimits()) -> DataFrame:
    """The same per city, type of extreme event and month, with the limits that were applied."""
    return (
        with_optional(extreme_rows(weather, limits), MEASURES)
        .groupBy(*EXTREME_KEYS)
        .agg(
            F.count("*").alias("n_events"),
            F.count("temp_avg").alias("n_temperature"),
            F.sum("temp_avg").alias("sum_temperature"),
            F.max("precipitation").alias("max_precipitation"),
            F.max("wind_speed").alias("max_wind_speed"),
        )
        .withColumn("limits", F.lit(limits_text(limits)))
    )


def limits_text(limits: ExtremeLimits) -> str:
    return f"heat {limits.heat}, cold {limits.cold}, rain {limits.rain}, wind {limits.wind}"


def _combined(name: str) -> Column:
    how = next((function for start, function in _MERGED.items() if name.startswith(start)), None)
    return (how or F.max)(name).alias(name)


def merge(*states: DataFrame) -> DataFrame:
    """One state of all rows that the given ones, of disjoint rows, were made from."""
    union = reduce(DataFrame.unionByName, states)
    keys = [name for name in EXTREME_KEYS if name in union.columns]
    return union.groupBy(*keys).agg(*[_combined(name) for name in union.columns if name not in keys])


def _mean(total: str, count: str) -> Column:
    return F.try_divide(F.col(total), F.col(count))


def monthly_trends(state: DataFrame) -> DataFrame:
    """The monthly trends of the observations behind a state with one row per city and month."""
    return state.filter(all_present(*KEYS) & (F.col("n_temperature") > 0)).select(
        *KEYS,
        _mean("sum_temperature", "n_temperature").alias("avg_temperature"),
        F.col("n_temperature").alias("data_points"),
        F.col("max_high_measured").alias("max_temperature"),
        F.col("min_low_measured").alias("min_temperature"),
        _mean("sum_precipitation_measured", "n_precipitation_measured").alias("avg_precipitation"),
        _mean("sum_humidity_measured", "n_humidity_measured").alias("avg_humidity"),
    )


def annual_summary(state: DataFrame) -> DataFrame:
    """The annual summary, from the months of each year."""
    keys = ["city_name", "year"]
    years = state.filter(all_present(*keys)).groupBy(*keys).agg(*[_combined(x) for x in state.columns if x not in KEYS])
    return years.select(
        *keys,
        F.col("n_rows").alias("total_measurements"),
        _mean("sum_temperature", "n_temperature").alias("annual_avg_temp"),
        F.col("max_temperature").alias("annual_max_temp"),
        F.col("min_temperature").alias("annual_min_temp"),
        F.col("sum_precipitation").alias("annual_precipitation"),
        _mean("sum_humidity", "n_humidity").alias("annual_avg_humidity"),
        _mean("sum_wind", "n_wind").alias("annual_avg_wind"),
    ).withColumn("climate_category", climate_category())


def extreme_summary(state: DataFrame) -> DataFrame:
    """Extreme observations per city, event type and year, from the months of each year."""
    keys = ["city_name", "event_type", "year"]
    years = state.groupBy(*keys).agg(*[_combined(x) for x in state.columns if x not in EXTREME_KEYS])
    return years.select(
        *keys,
        F.col("n_events").alias("event_count"),
        _mean("sum_temperature", "n_temperature").alias("avg_temp_during_event"),
        "max_precipitation",
        "max_wind_speed",
    )
