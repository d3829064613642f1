"""One explicit schema per lake table, plus the partition layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from climate_lake.constants import DAILY_MEASURES, DAILY_TIME


TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema of ``name type, ...``; unlike a DDL string it needs no session at import."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# Only the fields that are used downstream: the JSON reader skips the rest.
RAW_DOCUMENT = T.StructType(
    [
        T.StructField("city_info", _struct("name string, lat double, lon double")),
        T.StructField(
            "daily",
            T.StructType(
                [T.StructField(DAILY_TIME, T.ArrayType(T.StringType()))]
                + [T.StructField(name, T.ArrayType(T.DoubleType())) for name in DAILY_MEASURES]
            ),
        ),
        T.StructField("ingestion_timestamp", T.StringType()),
        T.StructField("data_source", T.StringType()),
    ]
)

RAW_STATIONS = _struct(
    "station_id string, station_name string, latitude double, longitude double, elevation bigint, "
    "city string, department string, country string, installation_date string, station_type string, status string"
)
RAW_EVENTS = _struct(
    "event_id bigint, station_id string, event_type string, event_date string, severity string, "
    "description string, impact_area string, economic_impact double, people_affected bigint, "
    "station_name string, city string, department string"
)
RAW_THRESHOLDS = _struct(
    "threshold_id bigint, station_id string, parameter_name string, min_value double, max_value double, "
    "alert_level string, notification_enabled bigint, station_name string, city string"
)

OBSERVATION = _struct(
    "city_name string, latitude double, longitude double, date date, temp_max double, temp_min double, "
    "precipitation double, wind_speed double, humidity double, ingestion_timestamp string, data_source string, "
    "temp_avg double, year int, month int"
)

STATION_ATTRIBUTES = {
    "station_id": "string",
    "station_name": "string",
    "elevation": "bigint",
    "station_type": "string",
}


@dataclass(frozen=True)
class Table:
    name: str
    zone: str
    schema: T.StructType
    partitions: tuple[str, ...] = ()
    # Order inside each file, so that row-group statistics help point reads.
    sort: tuple[str, ...] = ()
    in_catalog: bool = False


def _extend(schema: T.StructType, columns: str) -> T.StructType:
    return T.StructType(schema.fields + _struct(columns).fields)


TABLES = {
    table.name: table
    for table in [
        Table("weather_data", "trusted", OBSERVATION, ("year", "month"), ("city_name", "date")),
        Table("weather_stations", "trusted", RAW_STATIONS),
        Table(
            "climate_events",
            "trusted",
            _struct(
                "event_id bigint, station_id string, event_type string, event_date date, severity string, "
                "description string, impact_area string, economic_impact double, people_affected bigint, "
                "station_name string, city string, department string, year int"
            ),
            ("year",),
            ("event_date",),
        ),
        Table("weather_thresholds", "trusted", RAW_THRESHOLDS),
        Table(
            "integrated_weather_data",
            "trusted",
            _extend(OBSERVATION, ", ".join(f"{name} {kind}" for name, kind in STATION_ATTRIBUTES.items())),
            ("year", "month"),
            ("city_name", "date"),
            in_catalog=True,
        ),
        Table(
            "temperature_trends_monthly",
            "refined",
            _struct(
                "city_name string, year int, month int, avg_temperature double, data_points bigint, "
                "max_temperature double, min_temperature double, avg_precipitation double, avg_humidity double"
            ),
            ("year",),
            ("city_name", "month"),
            in_catalog=True,
        ),
        Table(
            "extreme_weather_events",
            "refined",
            _struct(
                "city_name string, event_type string, year int, event_count bigint, "
                "avg_temp_during_event double, max_precipitation double, max_wind_speed double"
            ),
            ("year",),
            in_catalog=True,
        ),
        Table(
            "annual_weather_summary",
            "refined",
            _struct(
                "city_name string, year int, total_measurements bigint, annual_avg_temp double, "
                "annual_max_temp double, annual_min_temp double, annual_precipitation double, "
                "annual_avg_humidity double, annual_avg_wind double, climate_category string"
            ),
            ("year",),
            in_catalog=True,
        ),
        # Partial aggregates that the three tables above are made from.
        Table(
            "trend_state",
            "refined",
            _struct(
                "city_name string, year int, month int, n_rows bigint, n_temperature bigint, sum_temperature double, "
                "max_temperature double, min_temperature double, max_high_measured double, min_low_measured double, "
                "n_precipitation_measured bigint, sum_precipitation_measured double, n_humidity_measured bigint, "
                "sum_humidity_measured double, sum_precipitation double, n_humidity bigint, sum_humidity double, "
                "n_wind bigint, sum_wind double"
            ),
            ("year", "month"),
            ("city_name",),
        ),
        Table(
            "extreme_state",
            "refined",
            _struct(
                "city_name string, event_type string, year int, month int, n_events bigint, n_temperature bigint, "
                "sum_temperature double, max_precipitation double, max_wind_speed double, limits string"
            ),
            ("year", "month"),
            ("city_name",),
        ),
        Table(
            "ml_model_metrics",
            "refined",
            _struct(
                "model_name string, metric_name string, metric_value double, evaluation_date string, "
                "city_name string, month int"
            ),
            in_catalog=True,
        ),
        Table(
            "temperature_predictions",
            "refined",
            _struct(
                "city_name string, date date, temp_avg double, prediction double, error double, month int"
            ),
            in_catalog=True,
        ),
        Table(
            "precipitation_predictions",
            "refined",
            _struct(
                "city_name string, date date, precipitation double, prediction double, error double, month int"
            ),
        ),
        Table(
            "weather_forecasts",
            "refined",
            _struct(
                "day_of_year int, city_name string, years_of_data bigint, historical_avg_temp double, "
                "historical_avg_precip double, historical_avg_humidity double, forecast_date string, "
                "forecast_type string"
            ),
            in_catalog=True,
        ),
    ]
}
