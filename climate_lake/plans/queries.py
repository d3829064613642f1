"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable, Collection
from datetime import date, datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climate_lake.constants import ALERT_LEVELS, EVENT_SEVERITY, EVENT_TYPES, STATION_STATUS
from climate_lake.functions.columns import ExtremeLimits
from climate_lake.operators import cleaning, climatology, explore, model, quality, serving, trend_state, trends
from climate_lake.operators.flatten import flatten_daily, flatten_for_export
from climate_lake.operators.integrate import integrate_stations, without_stations
from climate_lake.functions.joins import salted_join
from climate_lake.plans import incremental, pipeline, report
from climate_lake.plans import views as V
from climate_lake.session import materialise, work_path
from climate_lake.sinks import catalog
from climate_lake.sinks.tables import (
    land_documents,
    land_table,
    only_parts,
    refresh_partitions,
    write_csv,
    write_json,
    write_table,
    write_table_if_any,
)
from climate_lake.sources import relational
from climate_lake.sources.raw import read_documents, read_snapshots
from climate_lake.sources.tables import LakePaths, read_table, read_table_if_present, read_weather

Query = Callable[[SparkSession, str], DataFrame]

# Points in time the queries refer to: the end of the test data.
OBSERVED_UNTIL = date(2001, 11, 4)
EVENTS_UNTIL = date(2024, 1, 31)
EVALUATED_AT = datetime(2001, 11, 4, 6, 30)
DIGITS = 6

# Tables that the jobs write; ``lake_end_to_end`` reads the annual one.
TRUSTED_TABLES = [
    "weather_data",
    "weather_stations",
    "climate_events",
    "weather_thresholds",
    "integrated_weather_data",
]
REFINED_TABLES = [
    "temperature_trends_monthly",
    "extreme_weather_events",
    "ml_model_metrics",
    "temperature_predictions",
    "precipitation_predictions",
    "weather_forecasts",
]


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show in a comparison."""
    doubles = {name: F.round(name, digits) for name, kind in df.dtypes if kind == "double"}
    return df.withColumns(doubles) if doubles else df


# -- inputs ------------------------------------------------------------------


def observations(spark: SparkSession, sf: str) -> DataFrame:
    return V.view(spark, sf, V.OBSERVATIONS)


def weather(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_observations(observations(spark, sf))


def stations(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_stations(V.view(spark, sf, V.STATIONS))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_events(V.view(spark, sf, V.EVENTS))


def thresholds(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_thresholds(V.view(spark, sf, V.THRESHOLDS))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return V.view(spark, sf, V.DOCUMENTS)


def integrated(spark: SparkSession, sf: str) -> DataFrame:
    return integrate_stations(weather(spark, sf), stations(spark, sf))


def features(spark: SparkSession, sf: str) -> DataFrame:
    return climatology.features(weather(spark, sf))


def month_stats(spark: SparkSession, sf: str) -> DataFrame:
    return climatology.month_stats(features(spark, sf))


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return trends.monthly_trends(weather(spark, sf))


def extremes(spark: SparkSession, sf: str) -> DataFrame:
    return trends.extreme_summary(weather(spark, sf))


def annual(spark: SparkSession, sf: str) -> DataFrame:
    return trends.annual_summary(weather(spark, sf))


def loads(spark: SparkSession, sf: str) -> DataFrame:
    return quality.load_status(V.view(spark, sf, V.MANIFEST))


# -- queries with more than one line -----------------------------------------------


def _lake(spark: SparkSession, label: str) -> LakePaths:
    return LakePaths(work_path(spark, label))


def etl_to_trends(spark: SparkSession, sf: str) -> DataFrame:
    """Nested documents to monthly trends."""
    clean = cleaning.clean_observations(flatten_daily(documents(spark, sf)))
    return rounded(trends.monthly_trends(clean))


def monthly_missing_measures(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(trends.monthly_trends(weather(spark, sf).drop("temp_min", "humidity")))


def annual_without_rain(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(trends.annual_summary(weather(spark, sf).drop("precipitation")))


def extreme_summary_cold_zero(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(trends.extreme_summary(weather(spark, sf), ExtremeLimits(cold=0.0)))


def features_derived(spark: SparkSession, sf: str) -> DataFrame:
    """Mean temperature and month come from the date and the extremes."""
    return climatology.features(weather(spark, sf).drop("temp_avg", "year", "month"))


def recent_events(spark: SparkSession, sf: str) -> DataFrame:
    return relational.recent_events(events(spark, sf), stations(spark, sf), EVENTS_UNTIL, days_back=21)


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        "integrated_weather_data": integrated(spark, sf),
        "temperature_trends_monthly": monthly(spark, sf),
        "extreme_weather_events": extremes(spark, sf),
        "annual_weather_summary": annual(spark, sf),
        "not_registered": None,
    }
    return quality.table_counts(spark, tables)


def domain_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Severity and alert level against domains that lack their last entry."""
    seen = quality.domain_violations(events(spark, sf), {"severity": EVENT_SEVERITY[:-1]})
    return seen.unionByName(quality.domain_violations(thresholds(spark, sf), {"alert_level": ALERT_LEVELS[:-1]}))


def domain_violations_met(spark: SparkSession, sf: str) -> DataFrame:
    """The four domains as they are, against tables where a value outside each was mixed in."""

    def with_other(table: DataFrame, column: str, other: str, where: Column) -> DataFrame:
        return table.withColumn(column, F.when(where, other).otherwise(F.col(column)))

    seen = with_other(events(spark, sf), "event_type", "tornado", F.col("event_id") % 7 == 0)
    seen = with_other(seen, "severity", "mild", F.col("event_id") % 5 == 0)
    places = with_other(stations(spark, sf), "status", "retired", F.col("elevation") % 300 == 0)
    limits = with_other(thresholds(spark, sf), "alert_level", "panic", F.col("threshold_id") % 10 == 0)
    found = quality.domain_violations(seen, {"event_type": EVENT_TYPES, "severity": EVENT_SEVERITY})
    found = found.unionByName(quality.domain_violations(places, {"status": STATION_STATUS}))
    return found.unionByName(quality.domain_violations(limits, {"alert_level": ALERT_LEVELS}))


def damaged_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that lack the city, the daily part or the temperatures, each for a fifth of the cities."""
    kind = F.col("city_info.lat").cast("int") % 5
    bare = F.col("daily").withField("temperature_2m_max", F.lit(None).cast("array<double>"))
    return documents(spark, sf).select(
        F.when(kind != 1, F.col("city_info")).alias("city_info"),
        F.when(kind == 3, bare).when(kind != 2, F.col("daily")).alias("daily"),
        "ingestion_timestamp",
        "data_source",
    )


def load_status_fetched(spark: SparkSession, sf: str) -> DataFrame:
    """Loads of which a ninth got no answer."""
    return quality.load_status(V.view(spark, sf, V.MANIFEST).withColumn("fetched", F.col("load_id") % 9 != 0))


def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    """One check per load, scored both ways."""
    checks = loads(spark, sf).select(
        F.col("source").alias("check"),
        F.when(F.col("status") == "success", "OK")
        .when(F.col("status") == "no_data_or_error", "EMPTY_FILES")
        .otherwise("ISSUES")
        .alias("status"),
    )
    forms = [
        quality.score(checks, improved).withColumn("form", F.lit("improved" if improved else "basic"))
        for improved in (True, False)
    ]
    return rounded(forms[0].unionByName(forms[1]))


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return V.view(spark, sf, V.INVENTORY)


def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """All checks of one lake: its inventory and its documents."""
    return report.checks_of(inventory(spark, sf), documents(spark, sf), V.INVENTORY_ROOT)


def partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Observations written by year and month and read back."""
    lake = _lake(spark, "partitioned")
    write_table(weather(spark, sf), lake, "weather_data")
    return read_table(spark, lake, "weather_data")


def recovered_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Observations written, then an overwrite that dies after some of its rows: the table is as before."""
    lake, rows = _lake(spark, "recovered"), weather(spark, sf)
    write_table(rows, lake, "weather_data")
    dies = F.when(F.col("month") < 12, F.col("temp_max") + 1).otherwise(F.raise_error(F.lit("the job dies")).cast("double"))
    try:
        write_table(rows.withColumn("temp_max", dies), lake, "weather_data")
    except PySparkException:
        return read_table(spark, lake, "weather_data")
    raise RuntimeError("the second write was to fail")


def refreshed_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Observations of which one year is replaced from the table itself, and a month of another year emptied."""
    lake = _lake(spark, "refreshed")
    write_table(weather(spark, sf), lake, "weather_data")
    stored, year = read_table(spark, lake, "weather_data"), [f"year=1997/month={month}" for month in range(1, 13)]
    warmer = only_parts(stored, "weather_data", year).withColumn("temp_max", F.col("temp_max") + 1)
    refresh_partitions(warmer, lake, "weather_data", [*year, "year=1998/month=2"])
    return read_table(spark, lake, "weather_data")


def synced_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly trends behind an external table whose partitions follow two later writes."""
    lake, name = _lake(spark, "synced"), "temperature_trends_monthly"
    write_table(monthly(spark, sf), lake, name)
    database = "climate_" + lake.root.rsplit("-", 1)[-1]
    catalog.register_tables(spark, lake, database)
    catalog.repair_partitions(spark, lake, database)
    half = only_parts(read_table(spark, lake, name), name, ["year=1996", "year=1997"]).filter("month <= 6")
    refresh_partitions(half, lake, name, ["year=1996", "year=1997", "year=1999"])
    catalog.sync_partitions(spark, lake, database, name)
    return spark.sql(f"select year, count(*) as months from {database}.{name} group by year")


def guarded_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Events written, then an empty extract that must leave them alone."""
    lake = _lake(spark, "guarded")
    clean = events(spark, sf)
    write_table_if_any(clean, lake, "climate_events")
    write_table_if_any(clean.filter(F.col("event_id").isNull()), lake, "climate_events")
    return read_table(spark, lake, "climate_events")


def append_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of one measure written, those of the other appended."""
    lake = _lake(spark, "appended")
    metrics = climatology.model_metrics(month_stats(spark, sf), EVALUATED_AT)
    is_temperature = F.col("model_name") == climatology.TEMPERATURE.model
    write_table(metrics.filter(is_temperature), lake, "ml_model_metrics")
    write_table(metrics.filter(~is_temperature), lake, "ml_model_metrics", mode="append")
    return rounded(read_table(spark, lake, "ml_model_metrics"))


def export_roundtrip(spark: SparkSession, sf: str, as_json: bool) -> DataFrame:
    path = work_path(spark, "export")
    flat = flatten_for_export(documents(spark, sf))
    if as_json:
        write_json(flat, path)
        return spark.read.schema(flat.schema).json(path)
    write_csv(flat, path)
    return spark.read.schema(flat.schema).option("header", True).csv(path)


def landed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents landed in the raw zone, then read and flattened."""
    raw = work_path(spark, "raw")
    land_documents(documents(spark, sf), raw, EVALUATED_AT)
    return flatten_daily(read_documents(spark, raw))


def landed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Two event snapshots landed; the newest one read and cleaned."""
    raw = work_path(spark, "raw")
    extract = V.view(spark, sf, V.EVENTS)
    land_table(extract.filter(F.col("severity") == "low"), raw, "climate_events", datetime(2024, 1, 30, 22))
    land_table(extract, raw, "climate_events", datetime(2024, 1, 31, 5))
    return cleaning.clean_events(read_snapshots(spark, raw, "climate_events", latest=True))


def landed_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """Two threshold snapshots landed; the newest one read and cleaned."""
    raw = work_path(spark, "raw")
    extract = V.view(spark, sf, V.THRESHOLDS)
    land_table(extract.filter(F.col("alert_level") == "info"), raw, "weather_thresholds", datetime(2024, 1, 30, 22))
    land_table(extract, raw, "weather_thresholds", datetime(2024, 1, 31, 5))
    return cleaning.clean_thresholds(read_snapshots(spark, raw, "weather_thresholds", latest=True))


def catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Partitioned trends behind an external table, queried with SQL after partition repair."""
    lake = _lake(spark, "catalog")
    write_table(monthly(spark, sf), lake, "temperature_trends_monthly")
    database = "climate_" + lake.root.rsplit("-", 1)[-1]
    catalog.register_tables(spark, lake, database)
    catalog.repair_partitions(spark, lake, database)
    return spark.sql(
        f"select year, count(*) as months, round(max(max_temperature), 6) as max_temperature "
        f"from {database}.temperature_trends_monthly group by year"
    )


def landed_lake(spark: SparkSession, sf: str, tables: Collection[str] = TRUSTED_TABLES) -> LakePaths:
    """A lake with raw documents and one snapshot of each relational table, where they are landed for one of ``tables``."""
    lake = _lake(spark, "lake")
    if "weather_data" in tables:
        land_documents(documents(spark, sf), lake.raw, EVALUATED_AT)
    for name, text in [
        ("weather_stations", V.STATIONS),
        ("climate_events", V.EVENTS),
        ("weather_thresholds", V.THRESHOLDS),
    ]:
        if name in tables:
            land_table(V.view(spark, sf, text), lake.raw, name, EVALUATED_AT)
    return lake


def lake_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Raw documents and snapshots landed, all jobs run, the annual table read back."""
    lake = landed_lake(spark, sf)
    pipeline.run(spark, lake, EVALUATED_AT)
    return rounded(read_table(spark, lake, "annual_weather_summary"))


def input_files(spark: SparkSession, sf: str) -> tuple:
    """Path, time and size of the files that a lake's inputs are drawn from: tells whether a kept lake is still theirs."""
    paths = [f"{sf}/{name}.parquet" for name in ("lineitem", "nation", "events", "part")]
    files = spark.read.format("binaryFile").load(paths).select("path", "modificationTime", "length")
    return tuple(sorted(map(tuple, files.collect())))


def lake_of(spark: SparkSession, sf: str, name: str) -> LakePaths:
    """A new lake with one table and all that it is made from, landed and run: whoever asks, and whenever, pays the same."""
    lake = landed_lake(spark, sf, pipeline.needed_for(name))
    pipeline.run(spark, lake, EVALUATED_AT, only=[name])
    return lake


def lake_table(name: str) -> Query:
    """One table of a lake, from the inputs on."""
    return lambda spark, sf: rounded(read_table(spark, lake_of(spark, sf, name), name))


def fetched_parts(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The documents in three parts, by their time; those without one came first."""
    docs, time = documents(spark, sf), F.coalesce("ingestion_timestamp", F.lit("0"))
    return [docs.filter(time < "1995"), docs.filter((time >= "1995") & (time < "1998")), docs.filter(time >= "1998")]


def incremental_lake(spark: SparkSession, sf: str, latest: bool = False) -> tuple[LakePaths, list[DataFrame]]:
    """A lake that three parts of the documents reach one after the other, with a run after each; their reports."""
    lake, reports = _lake(spark, "incremental"), []
    land_table(V.view(spark, sf, V.STATIONS), lake.raw, "weather_stations", EVALUATED_AT)
    for hour, part in enumerate(fetched_parts(spark, sf)):
        land_documents(part, lake.raw, EVALUATED_AT.replace(hour=hour))
        reports.append(incremental.run(spark, lake, latest).withColumn("run", F.lit(hour + 1)))
    return lake, reports


def lake_incremental(spark: SparkSession, sf: str, latest: bool = False) -> DataFrame:
    """Observations after three runs, each of which read the newly landed files only."""
    return rounded(read_table(spark, incremental_lake(spark, sf, latest)[0], "weather_data"))


def lake_incremental_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that each run read, and partitions that it wrote."""
    _, reports = incremental_lake(spark, sf)
    runs = reports[0].unionByName(reports[1]).unionByName(reports[2])
    return runs.select("run", "rows_new", "partitions_changed", "files_gone", "files_read_again")


def lake_incremental_trends(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of the three trend tables after three runs, with their counts and means."""
    lake, _ = incremental_lake(spark, sf)

    def rows(name: str, key: str, count: str, *measures: str) -> DataFrame:
        values = [F.col(measure).alias(f"measure_{k}") for k, measure in enumerate(measures)]
        table = read_table(spark, lake, name)
        return table.select(F.lit(name).alias("table"), "city_name", "year", F.col(key).cast("string").alias("key"),
                            F.col(count).alias("count"), *values)

    months = rows("temperature_trends_monthly", "month", "data_points", "avg_temperature", "max_temperature", "avg_humidity")
    events = rows("extreme_weather_events", "event_type", "event_count", "avg_temp_during_event", "max_precipitation",
                  "max_wind_speed")
    years = rows("annual_weather_summary", "climate_category", "total_measurements", "annual_avg_temp",
                 "annual_precipitation", "annual_avg_wind")
    return rounded(months.unionByName(events).unionByName(years))


def lake_replaced_files(spark: SparkSession, sf: str) -> DataFrame:
    """Observations after two runs, between which the last fetch of two cities was landed once more, with fewer documents."""
    lake, parts = _lake(spark, "replaced"), fetched_parts(spark, sf)
    for hour, part in enumerate(parts):
        land_documents(part, lake.raw, EVALUATED_AT.replace(hour=hour))
    incremental.refresh_weather(spark, lake)
    again = parts[-1].filter(F.col("city_info.name").isin("NATION_3", "NATION_4") & (F.col("data_source") == "R"))
    land_documents(again, lake.raw, EVALUATED_AT.replace(hour=len(parts) - 1))
    incremental.refresh_weather(spark, lake)
    return rounded(read_table(spark, lake, "weather_data"))


def merged_states(spark: SparkSession, sf: str, extreme: bool = False) -> DataFrame:
    """Partial aggregates of three parts of the observations, whose cities and months overlap, merged."""
    rows = weather(spark, sf)
    part = F.pmod(F.xxhash64("date", "ingestion_timestamp", "temp_max"), F.lit(3))
    made = trend_state.extreme_state if extreme else trend_state.trend_state
    return trend_state.merge(*[made(rows.filter(part == k)) for k in range(3)])


def lake_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Observations where the integrated table is there, but empty."""
    lake = _lake(spark, "fallback")
    write_table(integrated(spark, sf).filter(F.lit(False)), lake, "integrated_weather_data")
    write_table(weather(spark, sf), lake, "weather_data")
    return read_weather(spark, lake)


def lake_without_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per trusted table where only documents were landed: no stations is an empty table, no events none."""
    lake = _lake(spark, "documents")
    land_documents(documents(spark, sf), lake.raw, EVALUATED_AT)
    pipeline.run_etl(spark, lake)
    tables = {name: read_table_if_present(spark, lake, name) for name in TRUSTED_TABLES}
    return quality.table_counts(spark, tables, empty_status="EMPTY")


def landed_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Two sets of cities landed in the same hour, then one city once more."""
    raw = work_path(spark, "raw")
    docs = documents(spark, sf).filter("city_info.name is not null")
    first = F.col("city_info.name") < "NATION_2"
    for part in (first, ~first, F.col("city_info.name") == "NATION_3"):
        land_documents(docs.filter(part), raw, EVALUATED_AT)
    return flatten_daily(read_documents(spark, raw))


def many_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Line items joined to their parts with every key of over two rows split, however many they are."""
    items = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", F.col("l_partkey").alias("part"))
    parts = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("part"), "p_size")
    joined = salted_join(items, parts, ["part"], "left", rows_per_split=2, max_marks=10)
    return joined.groupBy("part").agg(F.count("*").alias("items"), F.sum("p_size").alias("sizes"))


def split_model_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = model.with_part(model.model_rows(weather(spark, sf)))
    return rows.select(
        "city_name", "date", "temp_avg", "temp_lag1", "temp_lag2", "day_of_year", "season", "training"
    )


def persistence_rmse(spark: SparkSession, sf: str) -> DataFrame:
    """Error of yesterday's value as a prediction, on the test days of the models."""
    _, test = model.split(model.model_rows(weather(spark, sf)))
    return rounded(model.persistence_error(test))


def forest_rmse(spark: SparkSession, sf: str) -> DataFrame:
    """Root mean square error of both models on the last days, with all rows and the rows that have a label."""
    rows = materialise(model.model_rows(integrated(spark, sf)), "model-rows")
    training, test = model.split(rows)
    errors = []
    for target in (model.TEMPERATURE, model.PRECIPITATION):
        counts = rows.agg(F.count("*").alias("all"), F.count(target.label).alias("used")).first()
        stored = materialise(model.predicted(model.train(training, target), test, target), "predictions")
        error = model.prediction_errors(stored).first()
        errors.append((target.name, counts["all"], counts["used"], error["rmse"] if error else None))
    return spark.createDataFrame(errors, "model string, rows bigint, rows_used bigint, rmse double")


def forest_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of the temperature model by city and month, from its stored predictions for the last days."""
    training, test = model.split(materialise(model.model_rows(integrated(spark, sf)), "model-rows"))
    stored = materialise(model.predicted(model.train(training), test), "predictions")
    return rounded(model.prediction_errors(stored, "model", "city_name", "month"))


def model_features(spark: SparkSession, sf: str) -> DataFrame:
    """The scaled feature vectors of the temperature model, of which elevations are unknown here."""
    rows = materialise(model.model_rows(without_stations(weather(spark, sf))), "model-rows")
    return rounded(model.scaled_features(model.split(rows)[0], rows))


def queries() -> dict[str, Query]:
    return {
        # raw to trusted
        "flatten_daily": lambda s, sf: flatten_daily(documents(s, sf)),
        "flatten_daily_lenient": lambda s, sf: flatten_daily(documents(s, sf), lenient=True),
        "flatten_daily_export": lambda s, sf: flatten_for_export(documents(s, sf)),
        "clean_observations": weather,
        "latest_only": lambda s, sf: cleaning.latest_only(weather(s, sf)),
        "stations_clean": stations,
        "events_clean": events,
        "thresholds_clean": thresholds,
        "integrate_stations": integrated,
        "integrate_stations_large": lambda s, sf: integrate_stations(
            weather(s, sf), stations(s, sf), broadcast_rows=0, rows_per_split=10_000
        ),
        "integrate_no_stations": lambda s, sf: without_stations(weather(s, sf)),
        "many_hot_keys": many_hot_keys,
        # relational extracts
        "active_stations": lambda s, sf: relational.active_stations(stations(s, sf)),
        "recent_events": recent_events,
        "enabled_thresholds": lambda s, sf: relational.enabled_thresholds(thresholds(s, sf), stations(s, sf)),
        # refined: trends
        "etl_to_trends": etl_to_trends,
        "monthly_trends": lambda s, sf: rounded(monthly(s, sf)),
        "monthly_trends_missing_cols": monthly_missing_measures,
        "extreme_events_rows": lambda s, sf: trends.extreme_rows(weather(s, sf)),
        "extreme_summary": lambda s, sf: rounded(extremes(s, sf)),
        "extreme_summary_cold_zero": extreme_summary_cold_zero,
        "annual_summary": lambda s, sf: rounded(annual(s, sf)),
        "annual_summary_unknown": annual_without_rain,
        "trend_state_monthly": lambda s, sf: rounded(trend_state.monthly_trends(merged_states(s, sf))),
        "trend_state_annual": lambda s, sf: rounded(trend_state.annual_summary(merged_states(s, sf))),
        "trend_state_extremes": lambda s, sf: rounded(trend_state.extreme_summary(merged_states(s, sf, extreme=True))),
        # refined: climatology
        "features": lambda s, sf: climatology.features(integrated(s, sf)),
        "features_derived": features_derived,
        "temperature_stats": lambda s, sf: rounded(climatology.temperature_stats(features(s, sf))),
        "precipitation_stats": lambda s, sf: rounded(climatology.precipitation_stats(features(s, sf))),
        "model_metrics": lambda s, sf: rounded(climatology.model_metrics(month_stats(s, sf), EVALUATED_AT)),
        "temperature_predictions": lambda s, sf: rounded(
            climatology.predictions(month_stats(s, sf), climatology.TEMPERATURE)
        ),
        "precipitation_predictions": lambda s, sf: rounded(
            climatology.predictions(month_stats(s, sf), climatology.PRECIPITATION)
        ),
        "climatology": lambda s, sf: rounded(climatology.climatology(features(s, sf))),
        "climatology_years": lambda s, sf: rounded(climatology.climatology(features(s, sf), count_years=True)),
        "forecasts": lambda s, sf: rounded(climatology.forecasts(features(s, sf), OBSERVED_UNTIL)),
        "forecasts_corrected": lambda s, sf: rounded(
            climatology.forecasts(features(s, sf), OBSERVED_UNTIL, corrected=True)
        ),
        # reads
        "latest": lambda s, sf: serving.latest_observations(weather(s, sf), OBSERVED_UNTIL),
        "latest_city": lambda s, sf: serving.latest_observations(
            weather(s, sf), OBSERVED_UNTIL, city="NATION_3", limit=5
        ),
        "trends_city": lambda s, sf: rounded(serving.trends(monthly(s, sf), city="NATION_3", year=1999)),
        "trends_all": lambda s, sf: rounded(serving.trends(monthly(s, sf), year=1999)),
        "extreme_top": lambda s, sf: rounded(serving.extreme_events(extremes(s, sf), year=1999)),
        "extreme_top_type": lambda s, sf: rounded(
            serving.extreme_events(extremes(s, sf), "strong_winds", year=1999)
        ),
        "summary_top": lambda s, sf: rounded(serving.annual(annual(s, sf), year=1999)),
        "summary_category": lambda s, sf: rounded(serving.annual(annual(s, sf), 1999, "cold")),
        "monthly_precip": lambda s, sf: rounded(serving.monthly_precipitation(monthly(s, sf), year=1999)),
        "avg_temp_by_city": lambda s, sf: rounded(serving.mean_temperature_by_city(weather(s, sf))),
        "total_extreme_events": lambda s, sf: serving.total_extreme_events(extremes(s, sf)),
        "row_count": lambda s, sf: serving.row_count(integrated(s, sf)),
        "json_rows": lambda s, sf: serving.json_rows(serving.total_extreme_events(extremes(s, sf))),
        "response_header": lambda s, sf: serving.response_header(
            serving.trends(monthly(s, sf), year=1999), {"year": "1999"}
        ),
        # exploration
        "quick_stats": lambda s, sf: rounded(explore.quick_stats(weather(s, sf))),
        "city_stats": lambda s, sf: explore.city_stats(weather(s, sf)),
        "describe_observations": lambda s, sf: rounded(explore.describe(weather(s, sf))),
        "city_count": lambda s, sf: explore.city_count(weather(s, sf)),
        "value_counts": lambda s, sf: explore.value_counts(weather(s, sf)),
        "city_points": lambda s, sf: rounded(explore.city_points(weather(s, sf))),
        "daily_mean": lambda s, sf: rounded(explore.daily_mean(weather(s, sf))),
        "box_stats": lambda s, sf: rounded(explore.box_stats(weather(s, sf))),
        "histogram": lambda s, sf: explore.histogram(weather(s, sf)),
        "scatter_points": lambda s, sf: explore.scatter_points(weather(s, sf)),
        "date_range": lambda s, sf: explore.date_range(weather(s, sf)),
        "export_metadata": lambda s, sf: explore.export_metadata(weather(s, sf), EVALUATED_AT, "observations"),
        # quality
        "range_violations": lambda s, sf: quality.temperature_violations(
            weather(s, sf).withColumn("temp_max", F.col("temp_max") * 2)
        ),
        "bbox_violations": lambda s, sf: quality.position_violations(
            weather(s, sf).withColumn("longitude", F.col("longitude") - 65)
        ),
        "domain_violations": domain_violations,
        "domain_violations_met": domain_violations_met,
        "raw_structure": lambda s, sf: quality.document_checks(documents(s, sf))
        .groupBy("city_name", "status", "days_of_data")
        .agg(F.count("*").alias("documents")),
        "raw_structure_parts": lambda s, sf: quality.document_checks(damaged_documents(s, sf))
        .groupBy("city_name", "has_city_info", "has_daily_data", "has_timestamp", "has_temperature",
                 "has_precipitation", "days_of_data", "status")
        .agg(F.count("*").alias("documents")),
        "raw_structure_parts_summary": lambda s, sf: quality.document_summary(damaged_documents(s, sf)),
        "raw_structure_summary": lambda s, sf: quality.document_summary(documents(s, sf)),
        "table_counts": table_counts,
        "load_status": loads,
        "load_status_fetched": load_status_fetched,
        "ingest_rollup": lambda s, sf: quality.load_rollup(loads(s, sf)),
        "step_rollup": lambda s, sf: quality.step_rollup(V.view(s, sf, V.STEPS), "run"),
        "quality_score": quality_score,
        "zone_report": lambda s, sf: quality.zone_report(inventory(s, sf), V.INVENTORY_ROOT),
        "zone_status": lambda s, sf: quality.zone_status(quality.zone_report(inventory(s, sf), V.INVENTORY_ROOT)),
        "snapshot_files": lambda s, sf: quality.snapshot_files(inventory(s, sf), V.INVENTORY_ROOT),
        "readiness": lambda s, sf: quality.readiness(inventory(s, sf), V.INVENTORY_ROOT),
        "quality_report": quality_report,
        # sinks and catalog
        "sink_partitioned": partitioned_roundtrip,
        "sink_recovered": recovered_overwrite,
        "sink_refreshed": refreshed_partitions,
        "sink_guarded": guarded_roundtrip,
        "sink_append": append_roundtrip,
        "sink_csv": lambda s, sf: export_roundtrip(s, sf, as_json=False),
        "sink_json": lambda s, sf: export_roundtrip(s, sf, as_json=True),
        "landed_documents": landed_documents,
        "landed_twice": landed_twice,
        "landed_events": landed_events,
        "landed_thresholds": landed_thresholds,
        "catalog_tables": catalog_tables,
        "catalog_synced": synced_catalog,
        "lake_end_to_end": lake_end_to_end,
        **{f"lake_{name}": lake_table(name) for name in (*TRUSTED_TABLES, *REFINED_TABLES)},
        "lake_incremental": lake_incremental,
        "lake_incremental_latest": lambda s, sf: lake_incremental(s, sf, latest=True),
        "lake_incremental_runs": lake_incremental_runs,
        "lake_incremental_trends": lake_incremental_trends,
        "lake_replaced_files": lake_replaced_files,
        "lake_fallback": lake_fallback,
        "lake_without_snapshots": lake_without_snapshots,
        # model
        "lag_features": lambda s, sf: model.lag_features(weather(s, sf)).select(
            "city_name", "date", "temp_avg", "temp_lag1", "temp_lag2"
        ),
        "model_rows": split_model_rows,
        "persistence_rmse": persistence_rmse,
        "model_features": model_features,
        "rf_rmse": forest_rmse,
        "rf_errors": forest_errors,
    }
