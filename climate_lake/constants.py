"""Names, limits and lookup entries that results depend on."""

# Landing names of the daily arrays in an API document and the observation
# column each one becomes.
DAILY_TIME = "time"
DAILY_MEASURES = {
    "temperature_2m_max": "temp_max",
    "temperature_2m_min": "temp_min",
    "precipitation_sum": "precipitation",
    "windspeed_10m_max": "wind_speed",
    "relative_humidity_2m_mean": "humidity",
}

# Defaults used by the flat export when a document lacks the field.
UNKNOWN_CITY = "Unknown"
DEFAULT_DATA_SOURCE = "openmeteo_api"

# Extreme-weather limits (all strict comparisons).
HEAT_LIMIT = 35.0
COLD_LIMIT = 5.0
RAIN_LIMIT = 50.0
WIND_LIMIT = 60.0

# Climate category limits.
TROPICAL_MIN_TEMP = 25.0
TROPICAL_MIN_RAIN = 1000.0
ARID_MIN_TEMP = 20.0
ARID_MAX_RAIN = 500.0
COLD_MAX_TEMP = 15.0

# Station matching tolerance in degrees (strict).
COORDINATE_TOLERANCE = 0.1

# Climatology.
MIN_MONTH_POINTS = 5
MIN_DAY_POINTS = 2
FORECAST_DAYS = 30
TEMPERATURE_MODEL = "temperature_statistics"
PRECIPITATION_MODEL = "precipitation_statistics"
BASIC_METRIC = "basic_stats"
FORECAST_TYPE = "historical_average"

# Plausibility rules.
VALID_TEMPERATURE = (-50.0, 60.0)
VALID_LATITUDE = (-5.0, 15.0)
VALID_LONGITUDE = (-85.0, -65.0)

# Allowed values of the relational source.
STATION_STATUS = ["active", "inactive", "maintenance"]
EVENT_TYPES = ["storm", "drought", "flood", "heatwave", "coldwave"]
EVENT_SEVERITY = ["low", "medium", "high", "extreme"]
ALERT_LEVELS = ["info", "warning", "critical"]

# Cities of the sample generator: name, latitude, longitude, base temperature.
SAMPLE_CITIES = [
    ("Bogotá", 4.6097, -74.0817, 14.0),
    ("Medellín", 6.2518, -75.5636, 22.0),
    ("Cali", 3.4516, -76.5320, 24.0),
    ("Cartagena", 10.3910, -75.4794, 28.0),
    ("Barranquilla", 10.9639, -74.7964, 29.0),
]
SAMPLE_SOURCE = "sample_data"

# Folders every healthy lake has, per zone.
EXPECTED_FOLDERS = {
    "raw": ["weather-api", "database/weather_stations", "database/weather_thresholds"],
    "trusted": ["weather_data", "weather_stations"],
    "refined": ["temperature_trends_monthly"],
}
