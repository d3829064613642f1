"""The lake's inputs drawn from the star-schema test tables.

Each text is plain SQL that Spark and the oracle engine both read; table names
are placeholders. All of them are row-wise maps of their base table (the only
join is with ``nation``), so their size follows the given data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OBSERVATIONS = """
select n.n_name as city_name,
       cast(n.n_nationkey as double) as latitude,
       cast(-n.n_nationkey as double) as longitude,
       cast(l.l_shipdate as date) as date,
       case when l.l_partkey % 97 = 0 then null
            else l.l_quantity * 0.5 + n.n_nationkey end as temp_max,
       case when l.l_linenumber = 7 then null
            else l.l_quantity * 0.5 + n.n_nationkey - 2 * l.l_linenumber end as temp_min,
       case when l.l_linenumber = 1 and l.l_returnflag = 'A' then l.l_discount * 1000 else 0.0 end as precipitation,
       l.l_tax * 1000 as wind_speed,
       cast(l.l_partkey % 101 as double) as humidity,
       concat(cast(cast(l.l_shipdate as date) as string), 'T0', cast(l.l_linenumber as string), ':00:00')
         as ingestion_timestamp,
       l.l_returnflag as data_source
from {lineitem} l join {nation} n on l.l_suppkey % 25 = n.n_nationkey
"""

# Two stations per city: one near or far, under the city's name or another, and
# a distant backup that some cities find by name. Cities match none, one or two.
STATIONS = """
select case when n_nationkey = 11 then null else concat('ST', cast(n_nationkey as string)) end as station_id,
       concat('Station ', n_name) as station_name,
       cast(n_nationkey as double)
         + cast(case when n_nationkey % 4 = 1 or n_nationkey % 5 = 4 then 1.05 else 0.05 end as double) as latitude,
       cast(-n_nationkey as double) as longitude,
       cast(n_nationkey * 100 as bigint) as elevation,
       case when n_nationkey % 3 = 0 and n_nationkey % 5 <> 4 then n_name else concat('X', n_name) end as city,
       concat('Department ', cast(n_regionkey as string)) as department,
       'Colombia' as country,
       '2020-01-15' as installation_date,
       case when n_nationkey % 2 = 0 then 'urban' else 'coastal' end as station_type,
       case when n_nationkey = 7 then 'inactive' else 'active' end as status
from {nation}
union all
select concat('SU', cast(n_nationkey as string)), concat('Backup ', n_name), cast(50 + n_nationkey as double), 50.0,
       cast(1 as bigint), case when n_nationkey % 6 = 0 then n_name else concat('Y', n_name) end,
       'Department X', 'Colombia', '2021-06-30', 'urban', 'active'
from {nation}
"""

EVENTS = """
select case when event_id % 1009 = 0 then null else event_id end as event_id,
       concat('ST', cast(user_id % 25 as string)) as station_id,
       case event_type when 'view' then 'storm' when 'click' then 'flood' when 'signup' then 'drought'
                       when 'purchase' then 'heatwave' else 'coldwave' end as event_type,
       case when event_id % 997 = 0 then 'unknown' else cast(cast(ts as date) as string) end as event_date,
       case when value < 5 then 'low' when value < 20 then 'medium' when value < 60 then 'high'
            else 'extreme' end as severity,
       concat('event ', cast(event_id as string)) as description,
       concat('area ', cast(user_id as string)) as impact_area,
       value * 1000 as economic_impact,
       user_id * 10 as people_affected,
       cast(null as string) as station_name,
       cast(null as string) as city,
       cast(null as string) as department
from {events}
"""

THRESHOLDS = """
select p_partkey as threshold_id,
       concat('ST', cast(p_partkey % 25 as string)) as station_id,
       case when p_partkey % 3 = 0 then 'temperature' when p_partkey % 3 = 1 then 'precipitation'
            else 'wind_speed' end as parameter_name,
       case when p_partkey % 7 = 0 then cast('NaN' as double) else cast(p_size as double) end as min_value,
       case when p_partkey % 11 = 0 then cast('NaN' as double) else p_retailprice end as max_value,
       case when p_size < 15 then 'info' when p_size < 35 then 'warning' else 'critical' end as alert_level,
       cast(case when p_partkey % 4 <> 0 then 1 else 0 end as bigint) as notification_enabled,
       cast(null as string) as station_name,
       cast(null as string) as city
from {part}
"""

# Outcome of one load per order: rows delivered and the places that got them.
MANIFEST = """
select o_orderkey as load_id,
       o_orderpriority as source,
       case when o_orderstatus = 'P' and o_custkey % 3 = 0 then 0 else o_custkey % 50 end as records,
       o_orderkey % 5 <> 0 as has_local,
       o_orderkey % 7 <> 0 as has_lake
from {orders}
"""

# A store's inventory, a file per order, of a lake whose root itself lies below a folder named like a zone.
# Another lake beside it, empty files and an unexpected folder are mixed in.
INVENTORY_ROOT = "s3a://store/trusted/climate"
INVENTORY = """
select concat('s3a://store/trusted/',
         case o_orderkey % 8 when 0 then 'other/raw/weather-api' when 1 then 'climate/raw/weather-api'
           when 2 then 'climate/raw/database/weather_stations' when 3 then 'climate/raw/database/climate_events'
           when 4 then 'climate/raw/database/weather_thresholds' when 5 then 'climate/trusted/weather_data'
           when 6 then 'climate/trusted/integrated_weather_data' else 'climate/refined/temperature_trends_monthly' end,
         '/2025/06/01/', cast(o_orderkey as string), '.json') as path,
       case when o_orderkey % 8 = 7 or o_custkey % 3 = 0 then 0 else cast(o_custkey as bigint) end as length
from {orders}
"""

# One pipeline step per event; a run is one user.
STEPS = """
select user_id as run,
       event_type as step,
       case when event_type = 'error' then 'FAILED' when event_type = 'view' then 'completed'
            else 'COMPLETED' end as status
from {events}
"""



def _daily(element: str, days: str = "1 + l.l_linenumber % 3") -> str:
    """SQL array of ``element`` for the days 0 to 2 (written ``#``), cut to the number of ``days``."""
    return f"slice(array({', '.join(element.replace('#', str(day)) for day in range(3))}), 1, {days})"


# One API document per line item: one to three days, with short arrays, NULL
# elements, absent arrays, names and timestamps and unreadable dates mixed in.
_TIME = _daily(
    "case when (l.l_orderkey + #) % 503 = 0 then 'n/a' "
    "else cast(date_add(cast(l.l_shipdate as date), #) as string) end"
)
_MAX = _daily(
    "case when (l.l_partkey + #) % 97 = 0 then null else l.l_quantity * 0.5 + n.n_nationkey + # * 0.5 end",
    "case when l.l_linenumber = 6 then 0 else 1 + l.l_linenumber % 3 end",
)
_MIN = _daily(
    "l.l_quantity * 0.5 + n.n_nationkey - 2 * l.l_linenumber + # * 0.25",
    "case when l.l_linenumber = 7 then 1 else 1 + l.l_linenumber % 3 end",
)
DOCUMENTS = f"""
select named_struct(
         'name', case when l.l_orderkey % 211 = 0 then null else n.n_name end,
         'lat', cast(n.n_nationkey as double),
         'lon', cast(-n.n_nationkey as double)) as city_info,
       named_struct(
         'time', {_TIME},
         'temperature_2m_max', {_MAX},
         'temperature_2m_min', {_MIN},
         'precipitation_sum', case when l.l_partkey % 89 = 0 then null else {_daily("l.l_discount * 1000 + #")} end,
         'windspeed_10m_max', {_daily("l.l_tax * 1000 + #")},
         'relative_humidity_2m_mean', {_daily("cast(l.l_partkey % 101 as double)")}) as daily,
       case when l.l_orderkey % 307 = 0 then null
            else concat(cast(cast(l.l_shipdate as date) as string), 'T0', cast(l.l_linenumber as string), ':00:00')
       end as ingestion_timestamp,
       case when l.l_quantity = 13 then null else l.l_returnflag end as data_source
from {{lineitem}} l join {{nation}} n on l.l_suppkey % 25 = n.n_nationkey
"""


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The view over the tables below ``sf_dir``."""
    names = ["lineitem", "nation", "events", "part", "orders"]
    used = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names if f"{{{name}}}" in text
    }
    return spark.sql(text, **used)
