"""Column rules shared by several operators."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climate_lake import constants as C


def with_optional(df: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """Add each absent column as a NULL of its type."""
    missing = {name: F.lit(None).cast(kind) for name, kind in wanted.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def require(df: DataFrame, *names: str) -> None:
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")


def all_present(*names: str) -> Column:
    """True where none of the columns is NULL."""
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).isNotNull()
    return condition


def midpoint(high: str = "temp_max", low: str = "temp_min") -> Column:
    """Mean of the two daily extremes; NULL if either is NULL."""
    return (F.col(high) + F.col(low)) / 2


def daily_mean_temperature() -> Column:
    """Midpoint of the extremes, or the maximum where there is no midpoint."""
    return F.coalesce(midpoint(), F.col("temp_max"))


def to_date(name: str) -> Column:
    """Date of a text or timestamp; NULL where it cannot be read."""
    return F.col(name).try_cast("date")


@dataclass(frozen=True)
class ExtremeLimits:
    heat: float = C.HEAT_LIMIT
    cold: float = C.COLD_LIMIT
    rain: float = C.RAIN_LIMIT
    wind: float = C.WIND_LIMIT

    def rules(self, columns: list[str]) -> list[tuple[str, Column]]:
        """(label, condition) in order of precedence, for the measures present."""
        by_measure = [
            ("wind_speed", "strong_winds", F.col("wind_speed") > self.wind),
            ("precipitation", "heavy_rain", F.col("precipitation") > self.rain),
            ("temp_min", "extreme_cold", F.col("temp_min") < self.cold),
            ("temp_max", "extreme_heat", F.col("temp_max") > self.heat),
        ]
        return [(label, condition) for measure, label, condition in by_measure if measure in columns]


def event_label(columns: list[str], limits: ExtremeLimits = ExtremeLimits()) -> Column:
    """First extreme rule that holds, else ``other``."""
    hits = [F.when(condition, F.lit(label)) for label, condition in limits.rules(columns)]
    return F.coalesce(*hits, F.lit("other"))


def climate_category() -> Column:
    """Category of one year from its mean temperature and total rain."""
    temp, rain = F.col("annual_avg_temp"), F.col("annual_precipitation")
    return (
        F.when((temp > C.TROPICAL_MIN_TEMP) & (rain > C.TROPICAL_MIN_RAIN), "tropical")
        .when((temp > C.ARID_MIN_TEMP) & (rain < C.ARID_MAX_RAIN), "arid")
        .when(temp < C.COLD_MAX_TEMP, "cold")
        .otherwise("temperate")
    )


def season_code() -> Column:
    """1 for December to February, 2 to May, 3 to August, 4 to November and for anything that is no month."""
    month = F.col("month")
    return (
        F.when(month.isin(12, 1, 2), 1).when(month.between(3, 5), 2).when(month.between(6, 8), 3).otherwise(4).cast("int")
    )
