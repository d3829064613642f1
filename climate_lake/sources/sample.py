"""Generated observations for a lake without data."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climate_lake.constants import SAMPLE_CITIES, SAMPLE_SOURCE
from climate_lake.operators.flatten import EXPORT_COLUMNS


def sample_observations(
    spark: SparkSession,
    as_of: datetime,
    start: date = date(2025, 5, 20),
    days: int = 10,
    seed: int = 42,
) -> DataFrame:
    """Plausible noise around a base temperature: one row per city and day."""
    cities = spark.createDataFrame(SAMPLE_CITIES, "city_name string, latitude double, longitude double, base double")
    dated = cities.withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(days - 1)))).select(
        "*", F.date_add(F.lit(start), F.col("offset")).alias("date")
    )
    noise = iter(range(seed, seed + 10))

    def normal(mean: float, deviation: float) -> Column:
        return F.randn(next(noise)) * deviation + mean

    rain = -F.log(1 - F.rand(next(noise))) * 5
    values = {
        "temp_max": F.col("base") + normal(8, 3),
        "temp_min": F.col("base") + normal(-2, 2),
        "temp_avg": F.col("base") + normal(3, 2),
        "precipitation": F.greatest(F.lit(0.0), rain),
        "humidity": normal(75, 15),
        "wind_speed": F.greatest(F.lit(0.0), normal(10, 5)),
        "ingestion_timestamp": F.lit(as_of.isoformat()),
        "data_source": F.lit(SAMPLE_SOURCE),
    }
    return dated.withColumns(values).select(*EXPORT_COLUMNS)
