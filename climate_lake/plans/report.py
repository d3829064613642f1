"""Lake reports: one row per check, and the score over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climate_lake.constants import EXPECTED_FOLDERS
from climate_lake.operators import quality
from climate_lake.sinks.tables import write_json
from climate_lake.sources.files import list_files
from climate_lake.sources.raw import read_documents
from climate_lake.sources.tables import LakePaths, read_table_if_present

SERVED_TABLES = [
    "integrated_weather_data",
    "temperature_trends_monthly",
    "extreme_weather_events",
    "annual_weather_summary",
]


def _files(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Files of the three zones. Earlier reports lie in the refined zone, but in no expected folder."""
    return list_files(spark, *[paths.zone(zone) for zone in EXPECTED_FOLDERS])


def _check(report: DataFrame, name: str) -> DataFrame:
    return report.select(F.lit(name).alias("check"), "status")


def checks_of(files: DataFrame, documents: DataFrame, root: str) -> DataFrame:
    """Zones with content, document structure, database snapshots, readiness, from a file inventory."""
    checks = [
        quality.zone_status(quality.zone_report(files, root)).select(F.col("zone").alias("check"), "status"),
        _check(quality.document_summary(documents), "api_data_structure"),
        _check(quality.snapshot_status(files, root), "database_data"),
        _check(quality.readiness(files, root), "readiness"),
    ]
    return reduce(DataFrame.unionByName, checks)


def improved_checks(spark: SparkSession, paths: LakePaths, files: DataFrame | None = None) -> DataFrame:
    """``checks_of`` a lake; its files are listed unless an inventory (``path``, ``length``) is given."""
    listed = _files(spark, paths) if files is None else files
    return checks_of(listed, read_documents(spark, paths.raw), paths.root)


def basic_checks(spark: SparkSession, paths: LakePaths, files: DataFrame | None = None) -> DataFrame:
    """Files per zone, rows per served table, document structure."""
    listed = _files(spark, paths) if files is None else files
    main_folders = {zone: names[0] for zone, names in EXPECTED_FOLDERS.items()}
    tables = {name: read_table_if_present(spark, paths, name) for name in SERVED_TABLES}
    documents = quality.document_summary(read_documents(spark, paths.raw), need_temperature=False)
    checks = [
        quality.zone_presence(listed, paths.root, main_folders).select(F.col("zone").alias("check"), "status"),
        quality.table_counts(spark, tables).select(F.col("table").alias("check"), "status"),
        _check(documents, "data_structure"),
    ]
    return reduce(DataFrame.unionByName, checks)


def save_report(
    spark: SparkSession, paths: LakePaths, label: str, improved: bool = True, files: DataFrame | None = None
) -> DataFrame:
    """Write checks and score below the refined zone; the score is returned."""
    checks = (improved_checks if improved else basic_checks)(spark, paths, files)
    folder = f"{paths.zone('refined')}/validation_reports/{label}"
    write_json(checks, f"{folder}/checks")
    stored = spark.read.schema(checks.schema).json(f"{folder}/checks")
    score = quality.score(stored, improved)
    write_json(score, f"{folder}/score")
    return score
