"""SQL counterpart of each query, for the oracle engine."""

from __future__ import annotations

from climate_lake.plans import views as V

TABLES = {name: name for name in ("lineitem", "nation", "events", "part", "orders")}

CLEAN = """
select city_name, latitude, longitude, date, temp_max, temp_min, precipitation, wind_speed, humidity,
       ingestion_timestamp, data_source,
       case when temp_max is not null and temp_min is not null then (temp_max + temp_min) / 2 else temp_max end
         as temp_avg,
       cast(year(date) as int) as year, cast(month(date) as int) as month
from {source} where city_name is not null and date is not null and temp_max is not null
"""

# The daily entries of the documents, one row per position.
DAYS = """
select case when l.l_orderkey % 211 = 0 then null else n.n_name end as city_name,
       cast(n.n_nationkey as double) as latitude, cast(-n.n_nationkey as double) as longitude,
       u.i as pos,
       case when (l.l_orderkey + u.i) % 503 = 0 then 'n/a'
            else cast(cast(l.l_shipdate as date) + cast(u.i as int) as varchar) end as day,
       case when l.l_linenumber = 6 or (l.l_partkey + u.i) % 97 = 0 then null
            else l.l_quantity * 0.5 + n.n_nationkey + u.i * 0.5 end as temp_max,
       case when l.l_linenumber = 7 and u.i > 0 then null
            else l.l_quantity * 0.5 + n.n_nationkey - 2 * l.l_linenumber + u.i * 0.25 end as temp_min,
       case when l.l_partkey % 89 = 0 then null else l.l_discount * 1000 + u.i end as precipitation,
       l.l_tax * 1000 + u.i as wind_speed,
       cast(l.l_partkey % 101 as double) as humidity,
       case when l.l_orderkey % 307 = 0 then null
            else concat(cast(cast(l.l_shipdate as date) as varchar), 'T0', cast(l.l_linenumber as varchar), ':00:00')
       end as ingestion_timestamp,
       case when l.l_quantity = 13 then null else l.l_returnflag end as data_source,
       l.l_linenumber = 6 as no_temp_max,
       l.l_partkey % 89 = 0 as no_precipitation,
       1 + l.l_linenumber % 3 as days_of_data
from lineitem l join nation n on l.l_suppkey % 25 = n.n_nationkey, unnest(range(0, 1 + l.l_linenumber % 3)) as u(i)
"""

FLAT = """
select city_name, latitude, longitude, day as date, temp_max, temp_min, precipitation, wind_speed, humidity,
       ingestion_timestamp, data_source
from days where city_name is not null and not no_precipitation
"""

EXPORT = """
select coalesce(city_name, 'Unknown') as city_name, latitude, longitude, try_cast(day as date) as date,
       temp_max, temp_min, (temp_max + temp_min) / 2 as temp_avg, precipitation, humidity, wind_speed,
       ingestion_timestamp, coalesce(data_source, 'openmeteo_api') as data_source
from days where not no_temp_max and try_cast(day as date) is not null
"""

CLEAN_EVENTS = """
select event_id, station_id, event_type, try_cast(event_date as date) as event_date, severity, description,
       impact_area, economic_impact, people_affected, station_name, city, department,
       cast(year(try_cast(event_date as date)) as int) as year
from raw_events where event_id is not null
"""

CLEAN_THRESHOLDS = """
select threshold_id, station_id, parameter_name, case when isnan(min_value) then null else min_value end as min_value,
       case when isnan(max_value) then null else max_value end as max_value, alert_level, notification_enabled,
       station_name, city
from raw_thresholds where threshold_id is not null
"""

INTEGRATED = """
select w.*, s.station_id, s.station_name, s.elevation, s.station_type
from weather w left join stations s
  on w.city_name = s.city or (abs(w.latitude - s.latitude) < 0.1 and abs(w.longitude - s.longitude) < 0.1)
"""

MONTHLY = """
select city_name, year, month, avg(temp_avg) as avg_temperature, count(*) as data_points,
       max(temp_max) as max_temperature, min(temp_min) as min_temperature,
       avg(precipitation) as avg_precipitation, avg(humidity) as avg_humidity
from {source} group by city_name, year, month
"""

LABELLED = """
select *, case when wind_speed > 60 then 'strong_winds' when precipitation > 50 then 'heavy_rain'
               when temp_min < {cold} then 'extreme_cold' when temp_max > 35 then 'extreme_heat' end as event_type
from weather
where temp_max > 35 or temp_min < {cold} or precipitation > 50 or wind_speed > 60
"""

EXTREMES = """
select city_name, event_type, year, count(*) as event_count, avg(temp_avg) as avg_temp_during_event,
       max(precipitation) as max_precipitation, max(wind_speed) as max_wind_speed
from labelled group by city_name, event_type, year
"""

ANNUAL_SUMS = """
select city_name, year, count(*) as total_measurements, avg(temp_avg) as annual_avg_temp,
       max(temp_avg) as annual_max_temp, min(temp_avg) as annual_min_temp,
       sum(precipitation) as annual_precipitation, avg(humidity) as annual_avg_humidity,
       avg(wind_speed) as annual_avg_wind
from weather group by city_name, year
"""

ANNUAL = """
select *, case when annual_avg_temp > 25 and annual_precipitation > 1000 then 'tropical'
               when annual_avg_temp > 20 and annual_precipitation < 500 then 'arid'
               when annual_avg_temp < 15 then 'cold' else 'temperate' end as climate_category
from annual_sums
"""

FEATURES = """
select city_name, date, temp_avg, precipitation, humidity, wind_speed, {elevation} year, month,
       cast(dayofyear(date) as int) as day_of_year,
       case when month in (12, 1, 2) then 1 when month in (3, 4, 5) then 2
            when month in (6, 7, 8) then 3 else 4 end as season
from {source} where temp_avg is not null
"""

MONTH_STATS = """
select city_name, month, avg(temp_avg) as historical_avg_temp, max(temp_avg) as historical_max_temp,
       min(temp_avg) as historical_min_temp, stddev_samp(temp_avg) as temp_std,
       avg(precipitation) as historical_avg_precip, max(precipitation) as historical_max_precip,
       sum(precipitation) as historical_total_precip, count(*) as data_points
from features group by city_name, month having count(*) >= 5
"""

CLIMATOLOGY = """
select city_name, day_of_year, {entries} as years_of_data, avg(temp_avg) as historical_avg_temp,
       avg(precipitation) as historical_avg_precip, avg(humidity) as historical_avg_humidity
from features group by city_name, day_of_year having {entries} >= 2
"""

LOADS = """
select *, case when coalesce(records, 0) = 0 then 'no_data_or_error' when has_local and has_lake then 'success'
               when has_local then 'partial_success_local' when has_lake then 'partial_success_s3'
               else 'save_failed' end as status
from manifest
"""

NAMED = {
    "obs": V.OBSERVATIONS.format(**TABLES),
    "weather": CLEAN.format(source="obs"),
    "days": DAYS,
    "flat": FLAT,
    "flat_dated": "select * replace (try_cast(date as date) as date) from flat",
    "flat_weather": CLEAN.format(source="flat_dated"),
    "export": EXPORT,
    "raw_stations": V.STATIONS.format(**TABLES),
    "stations": "select * from raw_stations where station_id is not null",
    "raw_events": V.EVENTS.format(**TABLES),
    "clean_events": CLEAN_EVENTS,
    "raw_thresholds": V.THRESHOLDS.format(**TABLES),
    "thresholds": CLEAN_THRESHOLDS,
    "integrated": INTEGRATED,
    "monthly": MONTHLY.format(source="weather"),
    "flat_monthly": MONTHLY.format(source="flat_weather"),
    "labelled": LABELLED.format(cold=5),
    "labelled_zero": LABELLED.format(cold=0),
    "extremes": EXTREMES,
    "annual_sums": ANNUAL_SUMS,
    "annual": ANNUAL,
    "features": FEATURES.format(source="weather", elevation=""),
    "station_features": FEATURES.format(source="integrated", elevation="elevation,"),
    "month_stats": MONTH_STATS,
    "climatology": CLIMATOLOGY.format(entries="count(*)"),
    "climatology_years": CLIMATOLOGY.format(entries="count(distinct year(date))"),
    "manifest": V.MANIFEST.format(**TABLES),
    "loads": LOADS,
    "steps": V.STEPS.format(**TABLES),
}

WEATHER = ["obs", "weather"]
STATIONS = ["raw_stations", "stations"]
INTEGRATED_PARTS = [*WEATHER, *STATIONS, "integrated"]
MONTHLY_PARTS = [*WEATHER, "monthly"]
EXTREME_PARTS = [*WEATHER, "labelled", "extremes"]
ANNUAL_PARTS = [*WEATHER, "annual_sums", "annual"]
FEATURE_PARTS = [*WEATHER, "features"]
STATS_PARTS = [*FEATURE_PARTS, "month_stats"]
EVENT_PARTS = ["raw_events", "clean_events"]
THRESHOLD_PARTS = ["raw_thresholds", "thresholds"]
LOAD_PARTS = ["manifest", "loads"]


def _sql(parts: list[str], body: str, **other: str) -> str:
    """``body`` over the named parts; ``other`` replaces the text of some."""
    texts = {**NAMED, **other}
    named = ",\n".join(f"{part} as ({texts[part].strip()})" for part in parts)
    return f"with {named}\n{body.strip()}"


def _rounded(*names: str) -> str:
    return ", ".join(f"round({name}, 6) as {name}" for name in names)


MONTHLY_COLUMNS = "city_name, year, month, data_points, " + _rounded(
    "avg_temperature", "max_temperature", "min_temperature", "avg_precipitation", "avg_humidity"
)
EXTREME_COLUMNS = "city_name, event_type, year, event_count, " + _rounded(
    "avg_temp_during_event", "max_precipitation", "max_wind_speed"
)
ANNUAL_MEASURES = [
    "annual_avg_temp",
    "annual_max_temp",
    "annual_min_temp",
    "annual_precipitation",
    "annual_avg_humidity",
]
ANNUAL_COLUMNS = (
    "city_name, year, total_measurements, climate_category, "
    + _rounded(*ANNUAL_MEASURES, "annual_avg_wind")
)
SUMMARY_COLUMNS = "city_name, year, climate_category, " + _rounded(*ANNUAL_MEASURES)
TREND_COLUMNS = MONTHLY_COLUMNS.replace("data_points, ", "")
CLIMATOLOGY_COLUMNS = "city_name, day_of_year, years_of_data, " + _rounded(
    "historical_avg_temp", "historical_avg_precip", "historical_avg_humidity"
)
LATEST = """
select city_name, date, temp_avg, temp_max, temp_min, precipitation, humidity from weather
where date >= date '2001-11-04' - interval 7 day {city}
order by date desc, city_name nulls first, temp_avg nulls first, temp_max nulls first, temp_min nulls first,
         precipitation nulls first, humidity nulls first
limit {limit}
"""
NEWEST_FIRST = ", ".join(
    f"{name} desc nulls last"
    for name in (
        "ingestion_timestamp latitude longitude temp_max temp_min precipitation wind_speed humidity data_source "
        "temp_avg year month"
    ).split()
)
NEWEST = f"""
select city_name, latitude, longitude, date, temp_max, temp_min, precipitation, wind_speed, humidity,
       ingestion_timestamp, data_source, temp_avg, year, month
from (select *, row_number() over (partition by city_name, date order by {NEWEST_FIRST}) as place from weather)
where place = 1
"""
QUARTILES = "quantile_cont({0}, 0.25) as q1, quantile_cont({0}, 0.5) as median, quantile_cont({0}, 0.75) as q3"
NUMERIC = ["latitude", "longitude", "temp_max", "temp_min", "temp_avg", "precipitation", "humidity", "wind_speed"]
DESCRIBED = " union all ".join(
    f"select '{name}' as column_name, count({name}) as count, round(avg({name}), 6) as mean, "
    f"round(stddev_samp({name}), 6) as std, round(min({name}), 6) as min, round(max({name}), 6) as max, "
    f"round(quantile_cont({name}, 0.25), 6) as q1, round(quantile_cont({name}, 0.5), 6) as median, "
    f"round(quantile_cont({name}, 0.75), 6) as q3 from weather"
    for name in NUMERIC
)
PREDICTION = (
    "select city_name, cast(null as date) as date, round({mean}, 6) as {measure}, round({mean}, 6) as prediction, "
    "cast(0.0 as double) as error, month from month_stats"
)
METRIC = (
    "select '{model}' as model_name, 'basic_stats' as metric_name, round({mean}, 6) as metric_value, "
    "'2001-11-04T06:30:00' as evaluation_date, city_name, month from month_stats"
)
METRICS = " union all ".join(
    METRIC.format(model=model, mean=mean)
    for model, mean in [
        ("temperature_statistics", "historical_avg_temp"),
        ("precipitation_statistics", "historical_avg_precip"),
    ]
)
# 2001-11-04 is day 308 of its year.
CALENDAR = """
select cast(case when (308 + i) % 366 = 0 then 366 else (308 + i) % 366 end as int) as day_of_year,
       '2001-11-04' as forecast_date from range(1, 31) as r(i)
"""
CALENDAR_CORRECTED = """
select cast(dayofyear(date '2001-11-04' + cast(i as int)) as int) as day_of_year,
       cast(date '2001-11-04' + cast(i as int) as varchar) as forecast_date from range(1, 31) as r(i)
"""


def _forecast(climatology: str, calendar: str) -> str:
    return _sql(
        [*FEATURE_PARTS, climatology],
        f"select {CLIMATOLOGY_COLUMNS}, forecast_date, 'historical_average' as forecast_type "
        f"from {climatology} join ({calendar}) using (day_of_year)",
    )


SCORE = """
select count(*) as total_checks, count(*) filter (where {passed}) as passed_checks,
       round(count(*) filter (where {passed}) * 100.0 / count(*), 6) as success_rate, '{form}' as form
from checks
"""
CHECKS = """
checks as (select case status when 'success' then 'OK' when 'no_data_or_error' then 'EMPTY_FILES'
                              else 'ISSUES' end as status from loads)
"""
LABELS = """
select total_checks, passed_checks, success_rate, form, success_rate >= 70 as pass,
       case when form = 'improved' then
              case when success_rate >= 80 then 'excellent' when success_rate >= 60 then 'good'
                   when success_rate >= 40 then 'functional' else 'attention' end
            else case when success_rate >= 80 then 'validated' when success_rate >= 50 then 'partial'
                      else 'attention' end end as label
from ({improved} union all {basic})
"""


def _score() -> str:
    improved = SCORE.format(passed="status = 'OK'", form="improved")
    basic = SCORE.format(passed="status in ('OK', 'EMPTY_FILES')", form="basic")
    return _sql(LOAD_PARTS, f", {CHECKS} " + LABELS.format(improved=improved, basic=basic))


MODEL_ROWS = f"""
select city_name, date, temp_avg, lag(temp_avg, 1) over w as temp_lag1, lag(temp_avg, 2) over w as temp_lag2,
       cast(dayofyear(date) as int) as day_of_year, cast(month(date) % 12 // 3 + 1 as int) as season,
       date < (select min(date) + cast(floor((max(date) - min(date)) * 8 / 10) as int) from weather) as training
from ({NEWEST}) window w as (partition by city_name order by date)
"""


def _model_features() -> str:
    """Inputs of the model rows, absent ones as 0 beside an indicator, over their deviation in the training rows."""
    inputs = ["temp_lag1", "temp_lag2", "precipitation", "humidity", "wind_speed", "elevation", "day_of_year", "season"]
    rows = MODEL_ROWS.replace(
        "cast(dayofyear", "precipitation, humidity, wind_speed, cast(null as bigint) as elevation, cast(dayofyear", 1
    )
    filled = ", ".join(f"coalesce(cast({x} as double), 0) as {x}, cast({x} is null as double) as {x}_absent" for x in inputs)
    places = [*inputs, *[f"{x}_absent" for x in inputs]]
    deviations = ", ".join(f"stddev_samp({x}) as d_{x}" for x in places)
    scaled = ", ".join(f"round(case when d_{x} > 0 then {x} / d_{x} else 0 end, 6) as scaled_{x}" for x in places)
    return _sql(
        WEATHER,
        f", filled as (select city_name, date, training, {filled} from ({rows}) where temp_avg is not null), "
        f"deviations as (select {deviations} from filled where training) "
        f"select city_name, date, {scaled} from filled, deviations",
    )


def _inventory() -> dict[str, str]:
    """The queries over the file inventory."""
    parts = (
        f"with inventory as ({V.INVENTORY.format(orders='orders')}), zones as (select w.zone, w.folder, "
        "count(i.path) as total_files, count(i.path) filter (where i.length > 0) as non_empty_files, "
        "cast(coalesce(sum(i.length), 0) as bigint) as total_size "
        "from (values ('raw', 'weather-api'), ('raw', 'database/weather_stations'), "
        "('raw', 'database/weather_thresholds'), ('trusted', 'weather_data'), ('trusted', 'weather_stations'), "
        "('refined', 'temperature_trends_monthly')) as w(zone, folder) left join inventory i "
        f"on starts_with(i.path, '{V.INVENTORY_ROOT}/' || w.zone || '/' || w.folder || '/') group by all), "
        "status as (select zone, cast(sum(total_files) as bigint) as total_files, "
        "cast(sum(non_empty_files) as bigint) as non_empty_files, "
        "case when sum(non_empty_files) > 0 then 'OK' when sum(total_files) > 0 then 'EMPTY_FILES' "
        "else 'NO_FILES' end as status from zones group by zone), "
        "snapshots as (select split_part(path, '/', 8) as \"table\", count(*) as files from inventory "
        f"where length > 0 and starts_with(path, '{V.INVENTORY_ROOT}/raw/database/') group by 1), "
        "ready as (select count(*) as trusted_files, case when count(*) > 0 then 'READY_FOR_ETL' "
        f"else 'NEEDS_ETL' end as status from inventory where starts_with(path, '{V.INVENTORY_ROOT}/trusted/')) "
    )
    documents = (
        "select 'api_data_structure', case when count(*) = 0 then 'NO_API_DATA' "
        "when count(*) filter (where l_orderkey % 307 = 0) > 0 then 'ISSUES' else 'OK' end "
        "from lineitem join nation on l_suppkey % 25 = n_nationkey"
    )
    checks = (
        'select zone as "check", status from status union all ' + documents + " union all select 'database_data', "
        "case when count(*) > 0 then 'OK' else 'NO_DB_DATA' end from snapshots "
        "union all select 'readiness', status from ready"
    )
    return {
        "zone_report": parts + "select * from zones",
        "zone_status": parts + "select * from status",
        "snapshot_files": parts + "select * from snapshots",
        "readiness": parts + "select * from ready",
        "quality_report": parts + checks,
    }


LAKE_PARTS = ["days", "flat", "flat_dated", "weather", *STATIONS, "integrated"]


def _lake(body: str, *parts: str) -> str:
    """``body`` over the tables that the jobs derive from the documents and the station snapshot."""
    return _sql(
        [*LAKE_PARTS, *parts],
        body,
        weather=CLEAN.format(source="flat_dated"),
        monthly=MONTHLY.format(source="integrated"),
        labelled=LABELLED.format(cold=5).replace("from weather", "from integrated"),
        annual_sums=ANNUAL_SUMS.replace("from weather", "from integrated"),
        features=FEATURES.format(source="integrated", elevation=""),
    )


def _lake_tables() -> dict[str, str]:
    """The tables of a lake after its jobs."""
    measures = ", ".join(
        f"round({name}, 6) as {name}"
        for name in ("latitude", "longitude", "temp_max", "temp_min", "temp_avg", "precipitation", "wind_speed", "humidity")
    )
    forecast = (
        f"select {CLIMATOLOGY_COLUMNS}, forecast_date, 'historical_average' as forecast_type "
        f"from climatology join ({CALENDAR}) using (day_of_year)"
    )
    stats = ("features", "month_stats")
    counts = " union all ".join(
        f"select '{name}' as \"table\", {rows} as record_count, '{status}' as status"
        for name, rows, status in [
            ("weather_data", "(select count(*) from weather)", "OK"),
            ("integrated_weather_data", "(select count(*) from weather)", "OK"),
            ("weather_stations", "0", "EMPTY"),
            ("climate_events", "0", "ERROR"),
            ("weather_thresholds", "0", "ERROR"),
        ]
    )
    return {
        "lake_weather_data": _lake(f"select * replace ({measures}) from weather"),
        "lake_weather_stations": _sql(STATIONS, "select * replace (round(latitude, 6) as latitude) from stations"),
        "lake_climate_events": _sql(
            EVENT_PARTS, "select * replace (round(economic_impact, 6) as economic_impact) from clean_events"
        ),
        "lake_weather_thresholds": _sql(
            THRESHOLD_PARTS,
            "select * replace (round(min_value, 6) as min_value, round(max_value, 6) as max_value) from thresholds",
        ),
        "lake_integrated_weather_data": _lake(f"select * replace ({measures}) from integrated"),
        "lake_temperature_trends_monthly": _lake(f"select {MONTHLY_COLUMNS} from monthly", "monthly"),
        "lake_extreme_weather_events": _lake(f"select {EXTREME_COLUMNS} from extremes", "labelled", "extremes"),
        "lake_ml_model_metrics": _lake(METRICS, *stats),
        "lake_temperature_predictions": _lake(
            PREDICTION.format(mean="historical_avg_temp", measure="temp_avg"), *stats
        ),
        "lake_precipitation_predictions": _lake(
            PREDICTION.format(mean="historical_avg_precip", measure="precipitation"), *stats
        ),
        "lake_weather_forecasts": _lake(forecast, "features", "climatology"),
        "lake_fallback": _sql(WEATHER, "select * from weather"),
        "lake_without_snapshots": _lake(counts),
    }


BATCH = (
    "case when coalesce(ingestion_timestamp, '0') < '1995' then 1 when ingestion_timestamp < '1998' then 2 else 3 end"
)


def _incremental() -> dict[str, str]:
    """What incremental runs come to, over all documents at once."""
    measures = ", ".join(
        f"round({name}, 6) as {name}"
        for name in ("latitude", "longitude", "temp_max", "temp_min", "temp_avg", "precipitation", "wind_speed", "humidity")
    )

    def rows(table: str, source: str, key: str, count: str, *names: str) -> str:
        values = ", ".join(f"round({name}, 6) as measure_{k}" for k, name in enumerate(names))
        return (
            f"select '{table}' as \"table\", city_name, year, cast({key} as varchar) as key, {count} as count, {values} "
            f"from {source}"
        )

    tables = [
        rows("temperature_trends_monthly", "monthly", "month", "data_points", "avg_temperature", "max_temperature",
             "avg_humidity"),
        rows("extreme_weather_events", "extremes", "event_type", "event_count", "avg_temp_during_event",
             "max_precipitation", "max_wind_speed"),
        rows("annual_weather_summary", "annual", "climate_category", "total_measurements", "annual_avg_temp",
             "annual_precipitation", "annual_avg_wind"),
    ]
    newest = NEWEST.replace("from weather)", f"from (select * replace ({measures}) from weather))")
    return {
        "lake_incremental": _lake(f"select * replace ({measures}) from weather"),
        "lake_incremental_latest": _lake(newest),
        "lake_incremental_runs": _lake(
            f"select cast({BATCH} as int) as run, count(*) as rows_new, count(distinct (year, month)) as partitions_changed, "
            "cast(0 as bigint) as files_gone, cast(0 as bigint) as files_read_again from weather group by 1"
        ),
        "lake_incremental_trends": _lake(" union all ".join(tables), "monthly", "labelled", "extremes", "annual_sums", "annual"),
        "lake_replaced_files": _lake(
            f"select * replace ({measures}) from weather where {BATCH} < 3 or city_name not in ('NATION_3', 'NATION_4') "
            "or data_source = 'R'"
        ),
    }


def _damaged(body: str) -> str:
    """``body`` over one row per document, of which some lack a part."""
    flags = (
        "select case when kind <> 1 then city_name end as city_name, kind <> 1 as has_city_info, "
        "kind <> 2 as has_daily_data, ingestion_timestamp is not null as has_timestamp, "
        "kind not in (2, 3) as has_temperature, kind <> 2 and not no_precipitation as has_precipitation, "
        "case when kind = 2 then 0 else days_of_data end as days_of_data, "
        "case when kind in (0, 4) and ingestion_timestamp is not null then 'OK' else 'ISSUES' end as status "
        "from (select *, cast(latitude as int) % 5 as kind from days where pos = 0)"
    )
    return _sql(["days", "flags"], body, flags=flags)


def oracle_sql() -> dict[str, str]:
    flat_all = "select * from {0}"
    events = _sql(EVENT_PARTS, flat_all.format("clean_events"))
    integrated = _sql(INTEGRATED_PARTS, flat_all.format("integrated"))
    export = _sql(["days", "export"], flat_all.format("export"))
    metrics = _sql(STATS_PARTS, METRICS)
    extreme = "select {0} from extremes where year = 1999 {1} order by event_count desc, city_name, event_type limit 50"
    summary = f"select {SUMMARY_COLUMNS} from annual where year = 1999 "
    return {
        "flatten_daily": _sql(["days", "flat"], flat_all.format("flat")),
        "flatten_daily_lenient": _sql(
            ["days"], FLAT.replace(" and not no_precipitation", "")
        ),
        "flatten_daily_export": export,
        "clean_observations": _sql(WEATHER, flat_all.format("weather")),
        "latest_only": _sql(WEATHER, NEWEST),
        "stations_clean": _sql(STATIONS, flat_all.format("stations")),
        "events_clean": events,
        "thresholds_clean": _sql(THRESHOLD_PARTS, flat_all.format("thresholds")),
        "integrate_stations": integrated,
        "integrate_stations_large": integrated,
        "integrate_no_stations": _sql(
            WEATHER,
            "select *, cast(null as varchar) as station_id, cast(null as varchar) as station_name, "
            "cast(null as bigint) as elevation, cast(null as varchar) as station_type from weather",
        ),
        "active_stations": _sql(STATIONS, "select * from stations where status = 'active'"),
        "recent_events": _sql(
            [*EVENT_PARTS, *STATIONS],
            "select e.event_id, e.station_id, e.event_type, e.event_date, e.severity, e.description, e.impact_area, "
            "e.economic_impact, e.people_affected, s.station_name, s.city, s.department "
            "from clean_events e join stations s on e.station_id = s.station_id "
            "where e.event_date between date '2024-01-10' and date '2024-01-31'",
        ),
        "enabled_thresholds": _sql(
            [*THRESHOLD_PARTS, *STATIONS],
            "select t.threshold_id, t.station_id, t.parameter_name, t.min_value, t.max_value, t.alert_level, "
            "t.notification_enabled, s.station_name, s.city "
            "from thresholds t join stations s on t.station_id = s.station_id where t.notification_enabled = 1",
        ),
        "etl_to_trends": _sql(
            ["days", "flat", "flat_dated", "flat_weather", "flat_monthly"],
            f"select {MONTHLY_COLUMNS} from flat_monthly",
        ),
        "monthly_trends": _sql(MONTHLY_PARTS, f"select {MONTHLY_COLUMNS} from monthly"),
        "monthly_trends_missing_cols": _sql(
            MONTHLY_PARTS,
            "select city_name, year, month, data_points, "
            + _rounded("avg_temperature", "max_temperature", "avg_precipitation")
            + ", cast(null as double) as min_temperature, cast(null as double) as avg_humidity from monthly",
        ),
        "extreme_events_rows": _sql([*WEATHER, "labelled"], flat_all.format("labelled")),
        "extreme_summary": _sql(EXTREME_PARTS, f"select {EXTREME_COLUMNS} from extremes"),
        "extreme_summary_cold_zero": _sql(
            [*WEATHER, "labelled_zero"],
            f"select {EXTREME_COLUMNS} from ({EXTREMES.replace('from labelled', 'from labelled_zero')})",
        ),
        "annual_summary": _sql(ANNUAL_PARTS, f"select {ANNUAL_COLUMNS} from annual"),
        "annual_summary_unknown": _sql(
            [*WEATHER, "annual_sums"],
            "select city_name, year, total_measurements, 'unknown' as climate_category, "
            + _rounded(*[name for name in ANNUAL_MEASURES if name != "annual_precipitation"], "annual_avg_wind")
            + ", cast(null as double) as annual_precipitation from annual_sums",
        ),
        "features": _sql([*INTEGRATED_PARTS, "station_features"], flat_all.format("station_features")),
        "features_derived": _sql(
            WEATHER,
            "select city_name, date, (temp_max + temp_min) / 2 as temp_avg, precipitation, humidity, wind_speed, "
            "cast(dayofyear(date) as int) as day_of_year, month, "
            "cast(floor((month % 12) / 3) + 1 as int) as season from weather where temp_min is not null",
        ),
        "temperature_stats": _sql(
            STATS_PARTS,
            "select city_name, month, data_points, "
            + _rounded("historical_avg_temp", "historical_max_temp", "historical_min_temp", "temp_std")
            + " from month_stats",
        ),
        "precipitation_stats": _sql(
            STATS_PARTS,
            "select city_name, month, data_points, "
            + _rounded("historical_avg_precip", "historical_max_precip", "historical_total_precip")
            + " from month_stats",
        ),
        "model_metrics": metrics,
        "temperature_predictions": _sql(
            STATS_PARTS, PREDICTION.format(mean="historical_avg_temp", measure="temp_avg")
        ),
        "precipitation_predictions": _sql(
            STATS_PARTS, PREDICTION.format(mean="historical_avg_precip", measure="precipitation")
        ),
        "climatology": _sql([*FEATURE_PARTS, "climatology"], f"select {CLIMATOLOGY_COLUMNS} from climatology"),
        "climatology_years": _sql(
            [*FEATURE_PARTS, "climatology_years"], f"select {CLIMATOLOGY_COLUMNS} from climatology_years"
        ),
        "forecasts": _forecast("climatology", CALENDAR),
        "forecasts_corrected": _forecast("climatology_years", CALENDAR_CORRECTED),
        "latest": _sql(WEATHER, LATEST.format(city="", limit=10)),
        "latest_city": _sql(WEATHER, LATEST.format(city="and city_name = 'NATION_3'", limit=5)),
        "trends_city": _sql(
            MONTHLY_PARTS, f"select {TREND_COLUMNS} from monthly where city_name = 'NATION_3' and year = 1999"
        ),
        "trends_all": _sql(
            MONTHLY_PARTS,
            f"select {TREND_COLUMNS} from monthly where year = 1999 order by monthly.city_name, monthly.month limit 100",
        ),
        "extreme_top": _sql(EXTREME_PARTS, extreme.format(EXTREME_COLUMNS, "")),
        "extreme_top_type": _sql(
            EXTREME_PARTS, extreme.format(EXTREME_COLUMNS, "and event_type = 'strong_winds'")
        ),
        "summary_top": _sql(ANNUAL_PARTS, summary + "order by annual.annual_avg_temp desc, city_name limit 20"),
        "summary_category": _sql(ANNUAL_PARTS, summary + "and climate_category = 'cold'"),
        "monthly_precip": _sql(
            MONTHLY_PARTS,
            "select city_name, month, round(avg_precipitation, 6) as avg_precipitation from monthly where year = 1999",
        ),
        "avg_temp_by_city": _sql(
            WEATHER, "select city_name, round(avg(temp_avg), 6) as avg_temp from weather group by city_name"
        ),
        "total_extreme_events": _sql(
            EXTREME_PARTS,
            "select city_name, event_type, cast(sum(event_count) as bigint) as total_events "
            "from extremes group by city_name, event_type",
        ),
        "row_count": _sql(INTEGRATED_PARTS, "select count(*) as total from integrated"),
        "json_rows": _sql(
            EXTREME_PARTS,
            "select concat('{\"city_name\":\"', city_name, '\",\"event_type\":\"', event_type, "
            "'\",\"total_events\":\"', cast(sum(event_count) as varchar), '\"}') as json "
            "from extremes group by city_name, event_type",
        ),
        "response_header": _sql(
            MONTHLY_PARTS,
            "select least(count(*), 100) as total_records, '{\"year\": \"1999\"}' as query_params "
            "from monthly where year = 1999",
        ),
        "quick_stats": _sql(
            WEATHER,
            "select round(avg(temp_avg), 6) as avg_temp, round(max(temp_max), 6) as max_temp, "
            "round(min(temp_min), 6) as min_temp, round(sum(precipitation), 6) as total_precipitation from weather",
        ),
        "city_stats": _sql(
            WEATHER,
            "select city_name, round_even(avg(temp_avg), 1) as temp_avg, "
            "round_even(sum(precipitation), 1) as precipitation from weather group by city_name",
        ),
        "describe_observations": _sql(WEATHER, DESCRIBED),
        "city_count": _sql(WEATHER, "select count(distinct city_name) as cities from weather"),
        "value_counts": _sql(WEATHER, "select city_name, count(*) as count from weather group by city_name"),
        "city_points": _sql(
            WEATHER,
            "select city_name, round(avg(temp_avg), 6) as temp_avg, round(min(latitude), 6) as latitude, "
            "round(min(longitude), 6) as longitude from weather group by city_name",
        ),
        "daily_mean": _sql(
            WEATHER, "select date, round(avg(temp_avg), 6) as temp_avg from weather group by date"
        ),
        "box_stats": _sql(
            WEATHER,
            "select city_name, round(low, 6) as low, round(high, 6) as high, round(q1, 6) as q1, "
            "round(median, 6) as median, round(q3, 6) as q3 from (select city_name, min(temp_avg) as low, "
            f"max(temp_avg) as high, {QUARTILES.format('temp_avg')} from weather group by city_name)",
        ),
        "histogram": _sql(
            WEATHER,
            "select cast(floor(temp_avg) as double) as bin_start, count(*) as observations "
            "from weather where temp_avg is not null group by 1",
        ),
        "scatter_points": _sql(
            WEATHER,
            "select city_name, temp_avg, precipitation, count(*) as observations from weather "
            "where temp_avg is not null and precipitation is not null group by all",
        ),
        "date_range": _sql(
            WEATHER, 'select count(*) as total_records, min(date) as start, max(date) as "end" from weather'
        ),
        "export_metadata": _sql(
            WEATHER,
            "select 'total_records' as section, cast(count(*) as varchar) as value from weather "
            "union all select 'date_range.start', cast(min(date) as varchar) from weather "
            "union all select 'date_range.end', cast(max(date) as varchar) from weather "
            "union all select 'export_timestamp', '2001-11-04T06:30:00' "
            "union all select 'source', 'observations' "
            "union all select 'variable', unnest(['city_name', 'latitude', 'longitude', 'date', 'temp_max', "
            "'temp_min', 'precipitation', 'wind_speed', 'humidity', 'ingestion_timestamp', 'data_source', "
            "'temp_avg', 'year', 'month']) "
            "union all select distinct 'city', city_name from weather",
        ),
        "range_violations": _sql(
            WEATHER,
            "select * from (select * replace (temp_max * 2 as temp_max) from weather) "
            "where not (temp_max between -50 and 60) or not (temp_min between -50 and 60)",
        ),
        "bbox_violations": _sql(
            WEATHER,
            "select * from (select * replace (longitude - 65 as longitude) from weather) "
            "where not (latitude between -5 and 15 and longitude between -85 and -65)",
        ),
        "domain_violations": _sql(
            [*EVENT_PARTS, *THRESHOLD_PARTS],
            "select 'severity' as column_name, severity as value, count(*) as violations from clean_events "
            "where severity = 'extreme' group by severity union all "
            "select 'alert_level', alert_level, count(*) from thresholds where alert_level = 'critical' "
            "group by alert_level",
        ),
        "domain_violations_met": _sql(
            [*EVENT_PARTS, *STATIONS, *THRESHOLD_PARTS],
            "select 'event_type' as column_name, 'tornado' as value, count(*) as violations from clean_events "
            "where event_id % 7 = 0 having count(*) > 0 union all "
            "select 'severity', 'mild', count(*) from clean_events where event_id % 5 = 0 having count(*) > 0 "
            "union all select 'status', 'retired', count(*) from stations where elevation % 300 = 0 "
            "having count(*) > 0 union all "
            "select 'alert_level', 'panic', count(*) from thresholds where threshold_id % 10 = 0 having count(*) > 0",
        ),
        "raw_structure_parts": _damaged("select *, count(*) as documents from flags group by all"),
        "raw_structure_parts_summary": _damaged(
            "select count(*) as files_found, count(distinct city_name) as cities_covered, "
            "count(*) filter (where status = 'OK') as documents_ok, "
            "count(*) filter (where has_precipitation) as with_precipitation, min(days_of_data) as min_days, "
            "max(days_of_data) as max_days, "
            "case when count(*) filter (where status = 'OK') = count(*) then 'OK' else 'ISSUES' end as status from flags"
        ),
        "raw_structure": _sql(
            ["days"],
            "select city_name, case when ingestion_timestamp is null then 'ISSUES' else 'OK' end as status, "
            "days_of_data, count(*) as documents from days where pos = 0 group by all",
        ),
        "raw_structure_summary": _sql(
            ["days"],
            "select count(*) as files_found, count(distinct city_name) as cities_covered, "
            "count(ingestion_timestamp) as documents_ok, "
            "count(*) filter (where not no_precipitation) as with_precipitation, min(days_of_data) as min_days, "
            "max(days_of_data) as max_days, "
            "case when count(ingestion_timestamp) = count(*) then 'OK' else 'ISSUES' end as status "
            "from days where pos = 0",
        ),
        "table_counts": _sql(
            [*INTEGRATED_PARTS, "monthly", "labelled", "extremes", "annual_sums", "annual"],
            'select \'integrated_weather_data\' as "table", count(*) as record_count, \'OK\' as status from integrated '
            "union all select 'temperature_trends_monthly', count(*), 'OK' from monthly "
            "union all select 'extreme_weather_events', count(*), 'OK' from extremes "
            "union all select 'annual_weather_summary', count(*), 'OK' from annual "
            "union all select 'not_registered', 0, 'ERROR'",
        ),
        "load_status": _sql(LOAD_PARTS, flat_all.format("loads")),
        "load_status_fetched": _sql(
            LOAD_PARTS,
            "select * replace (case when load_id % 9 = 0 then 'fetch_failed' else status end as status), "
            "load_id % 9 <> 0 as fetched from loads",
        ),
        "ingest_rollup": _sql(
            LOAD_PARTS,
            "select count(*) as total, count(*) filter (where status = 'success') as successful, "
            "count(*) filter (where status <> 'success') as failed, cast(sum(records) as bigint) as total_records "
            "from loads",
        ),
        "step_rollup": _sql(
            ["steps"],
            "select run, count(*) filter (where status in ('completed', 'COMPLETED')) as completed_steps, "
            "count(*) as total_steps from steps group by run",
        ),
        "quality_score": _score(),
        "sink_partitioned": _sql(WEATHER, flat_all.format("weather")),
        "sink_recovered": _sql(WEATHER, flat_all.format("weather")),
        "sink_refreshed": _sql(
            WEATHER,
            "select * replace (case when year = 1997 then temp_max + 1 else temp_max end as temp_max) from weather "
            "where year <> 1998 or month <> 2",
        ),
        "sink_guarded": events,
        "sink_append": metrics,
        "sink_csv": export,
        "sink_json": export,
        "landed_documents": _sql(["days", "flat"], flat_all.format("flat")),
        "landed_events": events,
        "landed_thresholds": _sql(THRESHOLD_PARTS, flat_all.format("thresholds")),
        "catalog_tables": _sql(
            MONTHLY_PARTS,
            "select year, count(*) as months, round(max(max_temperature), 6) as max_temperature "
            "from monthly group by year",
        ),
        "catalog_synced": _sql(
            MONTHLY_PARTS,
            "select year, count(*) as months from monthly where year not in (1996, 1997, 1999) "
            "or (year <> 1999 and month <= 6) group by year",
        ),
        "lake_end_to_end": _sql(
            ["days", "flat", "flat_dated", *WEATHER[1:], *STATIONS, "integrated", "annual_sums", "annual"],
            f"select {ANNUAL_COLUMNS} from annual",
            weather=CLEAN.format(source="flat_dated"),
            annual_sums=ANNUAL_SUMS.replace("from weather", "from integrated"),
        ),
        **_inventory(),
        **_lake_tables(),
        **_incremental(),
        "trend_state_monthly": _sql(MONTHLY_PARTS, f"select {MONTHLY_COLUMNS} from monthly"),
        "trend_state_annual": _sql(ANNUAL_PARTS, f"select {ANNUAL_COLUMNS} from annual"),
        "trend_state_extremes": _sql(EXTREME_PARTS, f"select {EXTREME_COLUMNS} from extremes"),
        "landed_twice": _sql(["days", "flat"], flat_all.format("flat")),
        "many_hot_keys": "select l_partkey as part, count(*) as items, cast(sum(p_size) as bigint) as sizes "
        "from lineitem left join part on l_partkey = p_partkey group by l_partkey",
        "model_rows": _sql(WEATHER, f"select * from ({MODEL_ROWS})"),
        "model_features": _model_features(),
        "persistence_rmse": _sql(
            WEATHER,
            'select count(*) as "rows", count(temp_avg - temp_lag1) as rows_used, '
            "round(sqrt(avg((temp_avg - temp_lag1) ** 2)), 6) as rmse "
            f"from ({MODEL_ROWS}) where not training",
        ),
        "lag_features": _sql(
            WEATHER,
            "select city_name, date, temp_avg, lag(temp_avg, 1) over w as temp_lag1, "
            f"lag(temp_avg, 2) over w as temp_lag2 from ({NEWEST}) window w as (partition by city_name order by date)",
        ),
    }
