"""Historical averages and the forecasts drawn from them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climate_lake import constants as C
from climate_lake.functions.columns import all_present, midpoint, require, season_code

FEATURE_COLUMNS = ["temp_avg", "precipitation", "humidity", "wind_speed", "elevation", "year", "month"]


def features(weather: DataFrame) -> DataFrame:
    """City, date and the available measures, plus day of year, month and season.

    Rows without city or date, and rows without mean temperature where that
    can be known, are dropped.
    """
    require(weather, "city_name", "date")
    if "temp_avg" not in weather.columns and {"temp_max", "temp_min"} <= set(weather.columns):
        weather = weather.withColumn("temp_avg", midpoint())
    kept = [name for name in FEATURE_COLUMNS if name in weather.columns]
    needed = ["city_name", "date"] + (["temp_avg"] if "temp_avg" in kept else [])
    result = weather.select("city_name", "date", *kept).filter(all_present(*needed))
    result = result.withColumn("day_of_year", F.dayofyear("date"))
    if "month" not in kept:
        result = result.withColumn("month", F.month("date"))
    return result.withColumn("season", season_code())


@dataclass(frozen=True)
class Measure:
    """One measure with monthly statistics: its model name and the mean that stands in for a forecast."""

    column: str
    model: str
    mean: str


TEMPERATURE = Measure("temp_avg", C.TEMPERATURE_MODEL, "historical_avg_temp")
PRECIPITATION = Measure("precipitation", C.PRECIPITATION_MODEL, "historical_avg_precip")


def month_stats(feature_rows: DataFrame) -> DataFrame:
    """Statistics per city and month with at least five rows, of the measures present.

    Temperature and rain share one aggregation; a reader of one measure has the
    other's aggregates pruned away.
    """
    statistics = {
        TEMPERATURE: [
            F.avg("temp_avg").alias("historical_avg_temp"),
            F.max("temp_avg").alias("historical_max_temp"),
            F.min("temp_avg").alias("historical_min_temp"),
            F.stddev_samp("temp_avg").alias("temp_std"),
        ],
        PRECIPITATION: [
            F.avg("precipitation").alias("historical_avg_precip"),
            F.max("precipitation").alias("historical_max_precip"),
            F.sum("precipitation").alias("historical_total_precip"),
        ],
    }
    present = [columns for measure, columns in statistics.items() if measure.column in feature_rows.columns]
    return (
        feature_rows.groupBy("city_name", "month")
        .agg(*[column for columns in present for column in columns], F.count("*").alias("data_points"))
        .filter(F.col("data_points") >= C.MIN_MONTH_POINTS)
    )


def temperature_stats(feature_rows: DataFrame) -> DataFrame:
    return month_stats(feature_rows).select(
        "city_name",
        "month",
        "historical_avg_temp",
        "historical_max_temp",
        "historical_min_temp",
        "temp_std",
        "data_points",
    )


def precipitation_stats(feature_rows: DataFrame) -> DataFrame:
    return month_stats(feature_rows).select(
        "city_name",
        "month",
        "historical_avg_precip",
        "historical_max_precip",
        "historical_total_precip",
        "data_points",
    )


def model_metrics(stats: DataFrame, as_of: datetime) -> DataFrame:
    """Metric rows of every measure in the monthly statistics, from one pass over them."""
    metrics = [
        F.struct(
            F.lit(measure.model).alias("model_name"),
            F.lit(C.BASIC_METRIC).alias("metric_name"),
            F.col(measure.mean).alias("metric_value"),
            F.lit(as_of.isoformat()).alias("evaluation_date"),
        )
        for measure in (TEMPERATURE, PRECIPITATION)
        if measure.mean in stats.columns
    ]
    return stats.select(F.inline(F.array(*metrics)), "city_name", "month")


def predictions(stats: DataFrame, measure: Measure) -> DataFrame:
    """The monthly mean of a measure as its prediction."""
    require(stats, measure.mean)
    return stats.select(
        "city_name",
        F.lit(None).cast("date").alias("date"),
        F.col(measure.mean).alias(measure.column),
        F.col(measure.mean).alias("prediction"),
        F.lit(0.0).alias("error"),
        "month",
    )


def climatology(feature_rows: DataFrame, count_years: bool = False) -> DataFrame:
    """Averages per city and day of year, for days with at least two entries.

    ``years_of_data`` counts rows, or distinct years with ``count_years``.
    """
    averages = {
        "temp_avg": "historical_avg_temp",
        "precipitation": "historical_avg_precip",
        "humidity": "historical_avg_humidity",
    }
    entries = F.countDistinct(F.year("date")) if count_years else F.count("*")
    return (
        feature_rows.groupBy("city_name", "day_of_year")
        .agg(
            entries.alias("years_of_data"),
            *[F.avg(name).alias(alias) for name, alias in averages.items() if name in feature_rows.columns],
        )
        .filter(F.col("years_of_data") >= C.MIN_DAY_POINTS)
    )


def calendar_days(as_of: date, corrected: bool = False) -> list[tuple[int, str]]:
    """(day of year, forecast date) of the next 30 days.

    Plain form: day numbers run on modulo 366 and every row is dated ``as_of``.
    Corrected form: real following dates and their day of year.
    """
    steps = range(1, C.FORECAST_DAYS + 1)
    if corrected:
        ahead = [as_of + timedelta(days=step) for step in steps]
        return [(day.timetuple().tm_yday, day.isoformat()) for day in ahead]
    today = as_of.timetuple().tm_yday
    return [((today + step) % 366 or 366, as_of.isoformat()) for step in steps]


def _months(days: list[int]) -> list[int]:
    """Months the day numbers fall in, in common or leap years."""
    starts = [date(year, 1, 1) for year in (2023, 2024)]
    return sorted({(start + timedelta(days=day - 1)).month for start in starts for day in days})


def forecasts(feature_rows: DataFrame, as_of: date, corrected: bool = False) -> DataFrame:
    """Historical averages of the next 30 days.

    The 30 day numbers are also a filter below the aggregation, so only the
    matching twelfth of the history is shuffled, and their months (``month`` is
    that of the date) skip the other partitions of a stored table.
    """
    calendar = calendar_days(as_of, corrected)
    days = [day for day, _ in calendar]
    relevant = feature_rows.filter(F.col("day_of_year").isin(days) & F.col("month").isin(_months(days)))
    ahead = feature_rows.sparkSession.createDataFrame(calendar, "day_of_year int, forecast_date string")
    # The calendar always has 30 rows.
    return (
        climatology(relevant, count_years=corrected)
        .join(F.broadcast(ahead), "day_of_year")
        .withColumn("forecast_type", F.lit(C.FORECAST_TYPE))
    )
