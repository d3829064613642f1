"""Checks over files, documents, tables and load logs, and the score drawn from them."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from climate_lake import constants as C


# -- files -----------------------------------------------------------------


# Scheme and host of a path.
_STORE = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def below(root: str) -> Column:
    """The part of ``path`` below the lake's (absolute) root, NULL elsewhere; either may lack scheme and host."""
    start = re.sub(_STORE, "", root.rstrip("/")) + "/"
    plain = F.regexp_replace("path", _STORE, "")
    return F.when(plain.startswith(start), F.substr(plain, F.lit(len(start) + 1)))


def zone_report(
    files: DataFrame, root: str, expected: Mapping[str, list[str]] = C.EXPECTED_FOLDERS
) -> DataFrame:
    """Per expected folder: files, files with content, bytes. ``files`` has ``path`` and ``length``."""
    folders = [(zone, folder) for zone, names in expected.items() for folder in names]
    # One row per expected folder, a fixed list.
    wanted = files.sparkSession.createDataFrame(folders, "zone string, folder string")
    place = F.coalesce(
        *[
            F.when(below(root).startswith(f"{zone}/{folder}/"), F.lit(f"{zone}/{folder}"))
            for zone, folder in folders
        ]
    )
    found = (
        files.groupBy(place.alias("place"))
        .agg(
            F.count("*").alias("total_files"),
            F.count_if(F.col("length") > 0).alias("non_empty_files"),
            F.sum("length").alias("total_size"),
        )
        .filter(F.col("place").isNotNull())
    )
    return (
        wanted.join(found, F.concat_ws("/", "zone", "folder") == F.col("place"), "left")
        .drop("place")
        .na.fill(0, ["total_files", "non_empty_files", "total_size"])
    )


def zone_status(report: DataFrame) -> DataFrame:
    """OK with at least one file that has content, EMPTY_FILES, or NO_FILES."""
    status = (
        F.when(F.col("non_empty_files") > 0, "OK")
        .when(F.col("total_files") > 0, "EMPTY_FILES")
        .otherwise("NO_FILES")
    )
    return (
        report.groupBy("zone")
        .agg(F.sum("total_files").alias("total_files"), F.sum("non_empty_files").alias("non_empty_files"))
        .withColumn("status", status)
    )


def zone_presence(files: DataFrame, root: str, folders: Mapping[str, str]) -> DataFrame:
    """Short form: files of one folder per zone, OK or EMPTY."""
    report = zone_report(files, root, {zone: [folder] for zone, folder in folders.items()})
    return report.select(
        "zone",
        F.col("total_files").alias("files_count"),
        F.when(F.col("total_files") > 0, "OK").otherwise("EMPTY").alias("status"),
    )


def snapshot_files(files: DataFrame, root: str) -> DataFrame:
    """Files with content per table of the database snapshots."""
    table = F.regexp_extract(below(root), r"^raw/database/([^/]+)/", 1)
    tables = files.filter(F.col("length") > 0).groupBy(table.alias("table")).agg(F.count("*").alias("files"))
    return tables.filter(F.col("table") != "")


def snapshot_status(files: DataFrame, root: str) -> DataFrame:
    """One row over all snapshot tables: OK with any file that has content."""
    total = snapshot_files(files, root).agg(F.coalesce(F.sum("files"), F.lit(0)).alias("total_files"))
    return total.withColumn("status", F.when(F.col("total_files") > 0, "OK").otherwise("NO_DB_DATA"))


def readiness(files: DataFrame, root: str) -> DataFrame:
    """Whether the trusted zone holds any file, empty ones and unexpected folders included."""
    trusted = files.agg(F.count_if(below(root).startswith("trusted/")).alias("trusted_files"))
    status = F.when(F.col("trusted_files") > 0, "READY_FOR_ETL").otherwise("NEEDS_ETL")
    return trusted.withColumn("status", status)


# -- documents ---------------------------------------------------------------


def document_checks(documents: DataFrame, need_temperature: bool = True) -> DataFrame:
    """Structure flags of every raw document; the basic form does without temperatures."""
    flags = documents.select(
        F.col("city_info.name").alias("city_name"),
        F.col("city_info").isNotNull().alias("has_city_info"),
        F.col("daily").isNotNull().alias("has_daily_data"),
        F.col("ingestion_timestamp").isNotNull().alias("has_timestamp"),
        F.col("daily.temperature_2m_max").isNotNull().alias("has_temperature"),
        F.col("daily.precipitation_sum").isNotNull().alias("has_precipitation"),
        F.coalesce(F.size("daily.time"), F.lit(0)).alias("days_of_data"),
    )
    complete = F.col("has_city_info") & F.col("has_daily_data") & F.col("has_timestamp")
    if need_temperature:
        complete = complete & F.col("has_temperature")
    return flags.withColumn("status", F.when(complete, "OK").otherwise("ISSUES"))


def document_summary(documents: DataFrame, need_temperature: bool = True) -> DataFrame:
    """One row over all documents: OK if every one is complete."""
    passed = F.col("documents_ok") == F.col("files_found")
    return (
        document_checks(documents, need_temperature)
        .agg(
            F.count("*").alias("files_found"),
            F.countDistinct("city_name").alias("cities_covered"),
            F.count_if(F.col("status") == "OK").alias("documents_ok"),
            F.count_if("has_precipitation").alias("with_precipitation"),
            F.min("days_of_data").alias("min_days"),
            F.max("days_of_data").alias("max_days"),
        )
        .withColumn(
            "status",
            F.when(F.col("files_found") == 0, "NO_API_DATA").when(passed, "OK").otherwise("ISSUES"),
        )
    )


# -- tables and values -------------------------------------------------------


def table_counts(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], empty_status: str = "OK"
) -> DataFrame:
    """Row count per table. A table that answered is OK (``empty_status`` if without rows), None is ERROR."""
    status = F.when(F.col("record_count") > 0, "OK").otherwise(empty_status)
    reports = [
        table.agg(F.count("*").alias("record_count")).select(
            F.lit(name).alias("table"), "record_count", status.alias("status")
        )
        for name, table in tables.items()
        if table is not None
    ]
    absent = [(name, 0, "ERROR") for name, table in tables.items() if table is None]
    report = spark.createDataFrame(absent, "table string, record_count bigint, status string")
    for counted in reports:
        report = report.unionByName(counted)
    return report


def temperature_violations(weather: DataFrame, columns: tuple[str, ...] = ("temp_max", "temp_min")) -> DataFrame:
    """Rows with an implausible temperature in any of ``columns``."""
    implausible = F.lit(False)
    for name in columns:
        implausible = implausible | ~F.coalesce(F.col(name).between(*C.VALID_TEMPERATURE), F.lit(True))
    return weather.filter(implausible)


def position_violations(places: DataFrame) -> DataFrame:
    """Rows outside the bounding box of the monitored country."""
    inside = F.col("latitude").between(*C.VALID_LATITUDE) & F.col("longitude").between(*C.VALID_LONGITUDE)
    return places.filter(~inside)


def domain_violations(table: DataFrame, allowed: Mapping[str, list[str]]) -> DataFrame:
    """Rows per unexpected value of the given columns; NULL is not a value."""
    names = list(allowed)
    values = table.select(*names).unpivot([], names, "column_name", "value")
    unexpected = F.lit(False)
    for name, domain in allowed.items():
        unexpected = unexpected | ((F.col("column_name") == name) & ~F.col("value").isin(domain))
    return (
        values.filter(F.col("value").isNotNull() & unexpected)
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("violations"))
    )


# -- load logs -----------------------------------------------------------------


def load_status(manifest: DataFrame, nothing: str = "no_data_or_error") -> DataFrame:
    """Outcome of each load from ``records``, ``has_local`` and ``has_lake``.

    With a column ``fetched``, a load that got no answer at all is ``fetch_failed``, whatever else is set.
    """
    answered = F.coalesce(F.col("fetched"), F.lit(False)) if "fetched" in manifest.columns else F.lit(True)
    outcome = (
        F.when(~answered, "fetch_failed")
        .when(F.coalesce(F.col("records"), F.lit(0)) == 0, nothing)
        .when(F.col("has_local") & F.col("has_lake"), "success")
        .when(F.col("has_local"), "partial_success_local")
        .when(F.col("has_lake"), "partial_success_s3")
        .otherwise("save_failed")
    )
    return manifest.withColumn("status", outcome)


def load_rollup(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(~F.col("status").eqNullSafe("success")).alias("failed"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
    )


def step_rollup(steps: DataFrame, *by: str) -> DataFrame:
    done = F.count_if(F.col("status").isin("completed", "COMPLETED"))
    return steps.groupBy(*by).agg(done.alias("completed_steps"), F.count("*").alias("total_steps"))


# -- score -----------------------------------------------------------------------


def score(checks: DataFrame, improved: bool = True) -> DataFrame:
    """Share of passed checks with its label.

    Improved form: OK or a READY status passes. Basic form: any status with OK
    or EMPTY in it passes.
    """
    status = F.coalesce(F.col("status"), F.lit(""))
    if improved:
        passed = (status == "OK") | F.contains(status, F.lit("READY"))
        labels = [(80, "excellent"), (60, "good"), (40, "functional")]
    else:
        passed = F.contains(status, F.lit("OK")) | F.contains(status, F.lit("EMPTY"))
        labels = [(80, "validated"), (50, "partial")]
    rate = F.when(
        F.col("total_checks") > 0, F.col("passed_checks") / F.col("total_checks") * 100
    ).otherwise(0.0)
    label = F.coalesce(*[F.when(F.col("success_rate") >= at, name) for at, name in labels], F.lit("attention"))
    return (
        checks.agg(F.count("*").alias("total_checks"), F.count_if(passed).alias("passed_checks"))
        .withColumn("success_rate", rate)
        .withColumns({"label": label, "pass": F.col("success_rate") >= 70})
    )
