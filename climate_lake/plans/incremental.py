"""Incremental runs: new raw files, then only the partitions that they change, down to the trend tables.

A table of consumed files says which files the rows of ``weather_data`` came from and which months each of them reaches.
A run lists the raw zone and reads the files it has not consumed; a file that is gone or was replaced has its months
computed again from the files that reach them. Every later table asks the commits of the one it is made from which
partitions have changed since its own last commit, so a run that died is taken up where it stopped, and a run that finds
nothing new writes nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from climate_lake.functions.columns import ExtremeLimits
from climate_lake.operators import cleaning, trend_state
from climate_lake.operators.flatten import flatten_daily
from climate_lake.operators.integrate import integrate_in_place, integrate_stations
from climate_lake.schemas import TABLES
from climate_lake.session import materialise
from climate_lake.sinks.tables import (
    new_folder,
    only_parts,
    refresh_partitions,
    write_table,
    write_table_if_any,
)
from climate_lake.sources import commits
from climate_lake.sources.raw import FILE, list_documents, read_document_files, read_snapshots
from climate_lake.sources.tables import LakePaths, read_table, read_table_if_present

WEATHER, INTEGRATED = "weather_data", "integrated_weather_data"
# ``parts`` are the partitions of weather_data that the file has rows in. A row without file stands for each run.
CONSUMED = "folder string, _file string, _length bigint, _modified timestamp, parts array<string>, gone boolean"
REPORT = (
    "files_listed bigint, files_new bigint, files_gone bigint, files_read_again bigint, rows_new bigint, "
    "partitions_changed bigint"
)


def _consumed_path(paths: LakePaths) -> str:
    return commits.commits_path(paths.root, "consumed_files")


def consumed_files(spark: SparkSession, paths: LakePaths) -> DataFrame | None:
    """``FILE`` and ``parts`` of every file behind ``weather_data``; None if the table wasn't made by these runs."""
    since = {row["folder"]: row["version"] for row in commits.read_log(spark, paths.root, WEATHER).since_overwrite}
    try:
        rows = spark.read.schema(CONSUMED).parquet(_consumed_path(paths))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # Files of runs that didn't come to their commit don't count; a commit without files is none of these runs.
    own = rows.join(F.broadcast(spark.createDataFrame(list(since.items()), "of string, version bigint")), F.col("folder") == F.col("of"))
    marks = {row["folder"] for row in own.filter(F.col("_file").isNull()).select("folder").collect()}
    if not since or marks != since.keys():
        return None
    newest = F.max("version").over(Window.partitionBy("_file"))
    files = own.filter(F.col("_file").isNotNull()).withColumn("newest", newest)
    return files.filter("version = newest and not gone").select(*FILE, "parts")


def _observations(spark: SparkSession, paths: LakePaths, files: DataFrame | None) -> DataFrame:
    """Clean observations of raw files, with ``FILE``; computed once."""
    rows = cleaning.clean_observations(flatten_daily(read_document_files(spark, paths.raw, files), keep=FILE), keep=FILE)
    return materialise(rows, "observations")


def _part() -> Column:
    return F.concat(F.lit("year="), "year", F.lit("/month="), "month")


def _file_months(found: DataFrame) -> DataFrame:
    """``rows`` of each file and month: read once, both the partitions' counts and the files' partitions follow from it."""
    return materialise(found.groupBy(*FILE, "year", "month").agg(F.count("*").alias("rows")), "file-months")


def _rows_by_part(counted: DataFrame) -> dict[str, int]:
    found = counted.groupBy(_part().alias("part")).agg(F.sum("rows").alias("rows"))
    return {row["part"]: row["rows"] for row in found.collect()}


def refresh_weather(spark: SparkSession, paths: LakePaths, latest: bool = False) -> DataFrame:
    """Bring ``weather_data`` up to the raw files; one row of counts, of files and rows.

    ``latest`` keeps one row per city and date, in every run of a lake. A table that was written otherwise is made anew.
    """
    listed, known, folder = list_documents(spark, paths.raw), consumed_files(spark, paths), new_folder()
    if known is None:
        files = materialise(listed, "files")
        count = files.count()
        found = _observations(spark, paths, None if count else files)
        counted = _file_months(found)
        per_part = _rows_by_part(counted)
        _note(spark, paths, folder, files, counted, None)
        rows = found.drop(*FILE)
        write_table(cleaning.latest_only(rows) if latest else rows, paths, WEATHER, folder=folder)
        return _report(spark, count, count, 0, 0, sum(per_part.values()), len(per_part))

    here, before = listed.withColumn("here", F.lit(True)), known.withColumn("before", F.lit(True))
    files = materialise(here.join(before, list(FILE), "full"), "files")
    is_new, is_gone = F.col("before").isNull(), F.col("here").isNull()
    count, n_new, n_gone = files.agg(F.count("here"), F.count_if(is_new), F.count_if(is_gone)).first()
    if not n_new and not n_gone:
        return _report(spark, count, 0, 0, 0, 0, 0)
    new, gone, again = files.filter(is_new), files.filter(is_gone), 0
    found = _observations(spark, paths, new)
    counted = _file_months(found)
    per_part = _rows_by_part(counted)
    rows = found.drop(*FILE)
    # At most as many as the table's partitions.
    lost = sorted(row["part"] for row in gone.select(F.explode("parts").alias("part")).distinct().collect()) if n_gone else []
    if lost:
        reaching = files.filter(~is_new & ~is_gone & F.arrays_overlap("parts", F.array(*map(F.lit, lost))))
        again = reaching.count()
        rows = rows.unionByName(only_parts(_observations(spark, paths, reaching).drop(*FILE), WEATHER, lost))
    kept = sorted(per_part.keys() - set(lost))
    if kept:
        rows = rows.unionByName(only_parts(read_table(spark, paths, WEATHER), WEATHER, kept))
    changed = sorted({*per_part, *lost})
    _note(spark, paths, folder, new, counted, gone)
    refresh_partitions(cleaning.latest_only(rows) if latest else rows, paths, WEATHER, changed, folder=folder)
    return _report(spark, count, n_new, n_gone, again, sum(per_part.values()), len(changed))


def _note(
    spark: SparkSession, paths: LakePaths, folder: str, files: DataFrame, counted: DataFrame, gone: DataFrame | None
) -> None:
    """Add the files of a run. They count once the folder is committed."""
    held = counted.groupBy(*FILE).agg(F.collect_set(_part()).alias("parts"))
    # What was read is as the scan saw it, should a file have come or changed since the listing; others gave no row.
    others = files.join(held, list(FILE), "left_anti").select(*FILE, F.lit(None).cast("array<string>").alias("parts"))
    rows = held.unionByName(others).withColumn("gone", F.lit(False))
    if gone is not None:
        dropped = gone.join(rows, "_file", "left_anti").select(*FILE, "parts", F.lit(True).alias("gone"))
        rows = rows.unionByName(dropped)
    mark = spark.range(1).select(
        *[F.lit(None).cast(rows.schema[name].dataType).alias(name) for name in (*FILE, "parts")], F.lit(False).alias("gone")
    )
    noted = rows.unionByName(mark).select(
        F.lit(folder).alias("folder"), *FILE, F.coalesce("parts", F.array().cast("array<string>")).alias("parts"), "gone"
    )
    noted.write.mode("append").parquet(_consumed_path(paths))


def _report(spark: SparkSession, *counts: int) -> DataFrame:
    return spark.createDataFrame([counts], REPORT)


def refresh_integrated(spark: SparkSession, paths: LakePaths, stations: DataFrame | None, everything: bool = False) -> None:
    """Match the changed partitions of ``weather_data``, or all of them."""
    upstream, own = (commits.read_log(spark, paths.root, name) for name in (WEATHER, INTEGRATED))
    parts = None if everything else upstream.changed_since(own.source)
    if parts is None:
        rows, in_place = integrate_in_place(read_table(spark, paths, WEATHER), stations)
        write_table(rows, paths, INTEGRATED, source=upstream.version, in_place=in_place)
    elif parts:
        rows = integrate_stations(only_parts(read_table(spark, paths, WEATHER), WEATHER, parts), stations)
        refresh_partitions(rows, paths, INTEGRATED, parts, source=upstream.version)


def refresh_trends(spark: SparkSession, paths: LakePaths, limits: ExtremeLimits = ExtremeLimits()) -> None:
    """Bring the partial aggregates and the trend tables up to ``integrated_weather_data``.

    The aggregates of changed months are computed from the observations of these months, the trend tables of their years
    from the aggregates. Other limits than those of the stored aggregates make all extreme events anew.
    """
    states = {
        "trend_state": trend_state.trend_state,
        "extreme_state": lambda weather: trend_state.extreme_state(weather, limits),
    }
    upstream = commits.read_log(spark, paths.root, INTEGRATED)
    for name, made in states.items():
        parts = upstream.changed_since(commits.read_log(spark, paths.root, name).source)
        if name == "extreme_state" and parts is not None:
            stored = read_table(spark, paths, name).filter(F.col("limits") != trend_state.limits_text(limits))
            parts = parts if stored.isEmpty() else None
        if parts is None:
            write_table(made(read_table(spark, paths, INTEGRATED)), paths, name, source=upstream.version)
        elif parts:
            rows = made(only_parts(read_table(spark, paths, INTEGRATED), INTEGRATED, parts))
            refresh_partitions(rows, paths, name, parts, source=upstream.version)
    tables = {
        "temperature_trends_monthly": ("trend_state", trend_state.monthly_trends),
        "extreme_weather_events": ("extreme_state", trend_state.extreme_summary),
        "annual_weather_summary": ("trend_state", trend_state.annual_summary),
    }
    for name, (state, made) in tables.items():
        upstream = commits.read_log(spark, paths.root, state)
        parts = upstream.changed_since(commits.read_log(spark, paths.root, name).source)
        if parts is None:
            write_table(made(read_table(spark, paths, state)), paths, name, source=upstream.version)
        elif parts:
            years = sorted({part.split("/")[0] for part in parts})
            rows = made(only_parts(read_table(spark, paths, state), state, years))
            refresh_partitions(rows, paths, name, years, source=upstream.version)


def _digest(df: DataFrame) -> tuple:
    """Number and sum of the hashes of the rows, whatever their order."""
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first())


def run(
    spark: SparkSession,
    paths: LakePaths,
    latest: bool = False,
    all_stations: bool = False,
    limits: ExtremeLimits = ExtremeLimits(),
) -> DataFrame:
    """Raw to trusted to the trend tables, as ``pipeline.run_etl`` and ``run_analytics``, for what has changed.

    The relational snapshots are small and read whole; when the stations differ, all observations are matched again.
    """
    report = refresh_weather(spark, paths, latest)
    snapshot = lambda name, newest: read_snapshots(spark, paths.raw, name, newest)
    stations = materialise(cleaning.clean_stations(snapshot("weather_stations", latest or not all_stations)), "stations")
    stored = read_table_if_present(spark, paths, "weather_stations")
    other = stored is None or _digest(stored) != _digest(stations)
    refresh_integrated(spark, paths, stations, everything=other)
    if other:
        # After the table that is made from them: a run that dies in between does both again.
        write_table(stations, paths, "weather_stations")
    write_table_if_any(cleaning.clean_events(snapshot("climate_events", latest)), paths, "climate_events")
    write_table_if_any(cleaning.clean_thresholds(snapshot("weather_thresholds", latest)), paths, "weather_thresholds")
    refresh_trends(spark, paths, limits)
    return report


def stored_tables(spark: SparkSession, paths: LakePaths) -> list[str]:
    """Names of the tables that have commits."""
    return [name for name in TABLES if commits.read_commits(spark, paths.root, name) is not None]
