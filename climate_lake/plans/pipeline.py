"""The jobs of the lake, in order, and their outcome as a table."""

from __future__ import annotations

from collections.abc import Callable, Collection
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from climate_lake.functions.columns import ExtremeLimits
from climate_lake.operators import cleaning, climatology, trend_state
from climate_lake.operators.flatten import flatten_daily
from climate_lake.operators.integrate import integrate_in_place
from climate_lake.session import materialise
from climate_lake.sinks.tables import write_table, write_table_if_any
from climate_lake.sources.raw import read_documents, read_snapshots
from climate_lake.sources.tables import LakePaths, read_table, read_table_if_present, read_weather

STEP = "step string, status string, error string, finished string"

# The tables that each job writes, and the tables that a table is made from, where there are any.
ETL = ("weather_data", "weather_stations", "climate_events", "weather_thresholds", "integrated_weather_data")
ANALYTICS = (
    "trend_state", "extreme_state", "temperature_trends_monthly", "extreme_weather_events", "annual_weather_summary",
)
FROM_STATS = ("ml_model_metrics", "temperature_predictions", "precipitation_predictions")
CLIMATOLOGY = (*FROM_STATS, "weather_forecasts")
MADE_FROM = {
    "integrated_weather_data": ("weather_data", "weather_stations"),
    **dict.fromkeys(("trend_state", "extreme_state", *CLIMATOLOGY), ("weather_data", "integrated_weather_data")),
    "temperature_trends_monthly": ("trend_state",),
    "annual_weather_summary": ("trend_state",),
    "extreme_weather_events": ("extreme_state",),
}


def needed_for(*names: str) -> set[str]:
    """These tables and all that they are made from."""
    found: set[str] = set()
    left = list(names)
    while left:
        name = left.pop()
        if name not in (*ETL, *ANALYTICS, *CLIMATOLOGY):
            raise ValueError(f"no job writes {name}")
        if name not in found:
            found.add(name)
            left += MADE_FROM.get(name, ())
    return found


def run_etl(
    spark: SparkSession,
    paths: LakePaths,
    latest: bool = False,
    all_stations: bool = False,
    only: Collection[str] = ETL,
) -> None:
    """Raw to trusted. ``latest`` keeps one row per city and date and the newest snapshots only.

    Stations come from their newest snapshot; with ``all_stations`` from every
    one, which repeats each matched observation once per snapshot. Of the
    tables, those in ``only`` are written.
    """
    if "weather_data" in only:
        observations = cleaning.clean_observations(flatten_daily(read_documents(spark, paths.raw)))
        write_table(cleaning.latest_only(observations) if latest else observations, paths, "weather_data")

    def snapshot(name: str, newest: bool = latest) -> DataFrame:
        return read_snapshots(spark, paths.raw, name, newest)

    if "weather_stations" in only:
        stations = snapshot("weather_stations", latest or not all_stations)
        write_table(cleaning.clean_stations(stations), paths, "weather_stations")
    if "climate_events" in only:
        write_table_if_any(cleaning.clean_events(snapshot("climate_events")), paths, "climate_events")
    if "weather_thresholds" in only:
        write_table_if_any(cleaning.clean_thresholds(snapshot("weather_thresholds")), paths, "weather_thresholds")
    if "integrated_weather_data" in only:
        # Both tables have the same partitions.
        integrated, in_place = integrate_in_place(
            read_table(spark, paths, "weather_data"), read_table_if_present(spark, paths, "weather_stations")
        )
        write_table(integrated, paths, "integrated_weather_data", in_place=in_place)


def run_analytics(
    spark: SparkSession, paths: LakePaths, limits: ExtremeLimits = ExtremeLimits(), only: Collection[str] = ANALYTICS
) -> None:
    """Trusted to the trend tables, by way of partial aggregates per city and month: observations are read twice.

    Of the tables, those in ``only`` are written.
    """
    weather = read_weather(spark, paths)
    tables = {
        "trend_state": lambda: trend_state.trend_state(weather),
        "extreme_state": lambda: trend_state.extreme_state(weather, limits),
        "temperature_trends_monthly": lambda: trend_state.monthly_trends(read_table(spark, paths, "trend_state")),
        "extreme_weather_events": lambda: trend_state.extreme_summary(read_table(spark, paths, "extreme_state")),
        "annual_weather_summary": lambda: trend_state.annual_summary(read_table(spark, paths, "trend_state")),
    }
    for name, rows in tables.items():
        if name in only:
            write_table(rows(), paths, name)


def run_climatology(
    spark: SparkSession,
    paths: LakePaths,
    as_of: datetime,
    corrected: bool = False,
    only: Collection[str] = CLIMATOLOGY,
) -> None:
    """Trusted to the metric, prediction and forecast tables, of which those in ``only`` are written.

    The monthly statistics feed three tables; they are written once and read back.
    """
    rows = climatology.features(read_weather(spark, paths))
    if set(FROM_STATS) & set(only):
        stats = materialise(climatology.month_stats(rows), "month-stats")
        tables = {
            "ml_model_metrics": lambda: climatology.model_metrics(stats, as_of),
            "temperature_predictions": lambda: climatology.predictions(stats, climatology.TEMPERATURE),
            "precipitation_predictions": lambda: climatology.predictions(stats, climatology.PRECIPITATION),
        }
        for name, made in tables.items():
            if name in only:
                write_table(made(), paths, name)
    if "weather_forecasts" in only:
        write_table(climatology.forecasts(rows, as_of.date(), corrected), paths, "weather_forecasts")


def run(
    spark: SparkSession,
    paths: LakePaths,
    as_of: datetime,
    latest: bool = False,
    corrected: bool = False,
    keep_going: bool = False,
    all_stations: bool = False,
    only: Collection[str] = (*ETL, *ANALYTICS, *CLIMATOLOGY),
) -> DataFrame:
    """Run all jobs; one row per job with its status.

    A failing job raises, or with ``keep_going`` is reported and the next one runs. With ``only``, these tables and those
    that they are made from are written, and a job that writes none of them is left out.
    """
    needed = needed_for(*only)
    jobs: dict[str, tuple[tuple[str, ...], Callable[[], None]]] = {
        "etl": (ETL, lambda: run_etl(spark, paths, latest, all_stations, needed)),
        "analytics": (ANALYTICS, lambda: run_analytics(spark, paths, ExtremeLimits(), needed)),
        "climatology": (CLIMATOLOGY, lambda: run_climatology(spark, paths, as_of, corrected, needed)),
    }
    outcomes = []
    for name, (written, job) in jobs.items():
        if not needed & set(written):
            continue
        try:
            job()
        except Exception as error:
            if not keep_going:
                raise
            outcomes.append((name, "FAILED", str(error), datetime.now().isoformat()))
        else:
            outcomes.append((name, "COMPLETED", None, datetime.now().isoformat()))
    return spark.createDataFrame(outcomes, STEP)
