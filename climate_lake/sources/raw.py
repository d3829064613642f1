"""Readers of the raw zone: named documents and landed part files alike."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from climate_lake.schemas import RAW_DOCUMENT, RAW_EVENTS, RAW_STATIONS, RAW_THRESHOLDS
from climate_lake.sources.files import list_files, plain_path

SNAPSHOT_SCHEMAS = {
    "weather_stations": RAW_STATIONS,
    "climate_events": RAW_EVENTS,
    "weather_thresholds": RAW_THRESHOLDS,
}
SNAPSHOT = "_snapshot"
# Endings of raw files, as they are or compressed: for a file filter, and for a regular expression.
JSON, JSON_END = ".json{,.gz}", r"\.json(\.gz)?$"

# Columns that say which file a document is from.
FILE = ("_file", "_length", "_modified")
# Files that are read by their names; more are read with their folder, from which the others are then left out.
MOST_NAMED = 50_000


def _read_json(spark: SparkSession, path: str, schema: StructType, name: str) -> DataFrame:
    """Rows of all ``name*.json`` (one document or array each) and ``part-*.json`` (JSON lines) below ``path``.

    Files that end in ``.json.gz`` are read alike. An absent path is an empty table; any other failure is raised.
    """
    def read(pattern: str, whole_file: bool) -> DataFrame:
        return (
            spark.read.schema(schema)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .option("multiLine", whole_file)
            .json(path)
            .select("*", F.col("_metadata.file_path").alias("_file"))
        )

    try:
        return read(f"{name}*{JSON}", True).unionByName(read(f"part-*{JSON}", False))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).withColumn("_file", F.lit(None).cast("string"))


def read_documents(spark: SparkSession, raw: str) -> DataFrame:
    """API documents below ``raw/weather-api``, whatever the depth of their folders."""
    return _read_json(spark, f"{raw}/weather-api", RAW_DOCUMENT, "weather_data").drop("_file")


def list_documents(spark: SparkSession, raw: str) -> DataFrame:
    """The files that ``read_documents`` reads: ``_file, _length, _modified``. Their contents are not read."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{raw}/weather-api")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "_file string, _length bigint, _modified timestamp")
    wanted = F.regexp_extract("path", r"([^/]*)$", 1).rlike(rf"^(weather_data|part-).*{JSON_END}")
    return files.filter(wanted).select(
        F.col("path").alias("_file"), F.col("length").alias("_length"), F.col("modificationTime").alias("_modified")
    )


def read_document_files(spark: SparkSession, raw: str, files: DataFrame | None = None) -> DataFrame:
    """Documents with the columns ``FILE``: of the files named in ``_file`` and of no other, or of all files."""

    def read(paths: str | list[str], whole_file: bool, **options: str) -> DataFrame:
        rows = spark.read.schema(RAW_DOCUMENT).option("multiLine", whole_file).options(**options).json(paths)
        return rows.select(
            "*",
            plain_path(F.col("_metadata.file_path")).alias("_file"),
            F.col("_metadata.file_size").alias("_length"),
            F.col("_metadata.file_modification_time").alias("_modified"),
        )

    kinds = {f"weather_data*{JSON}": True, f"part-*{JSON}": False}
    named = None if files is None else files.select("_file").distinct()
    names = [] if named is None else [row["_file"] for row in named.limit(MOST_NAMED + 1).collect()]
    if named is None or len(names) > MOST_NAMED:
        found = [
            read(f"{raw}/weather-api", whole, recursiveFileLookup="true", pathGlobFilter=kind) for kind, whole in kinds.items()
        ]
        rows = found[0].unionByName(found[1])
        return rows if named is None else rows.join(named, "_file", "left_semi").select(*rows.columns)
    parts = []
    for kind, whole in kinds.items():
        # A name is not a pattern.
        start, special = kind.split("*")[0], re.compile(r"([\[\]{}*?\\])")
        own = [special.sub(r"\\\1", name) for name in names if name.rsplit("/", 1)[-1].startswith(start)]
        if own:
            parts.append(read(own, whole))
    if not parts:
        return spark.createDataFrame([], RAW_DOCUMENT).withColumns(
            {name: F.lit(None).cast(kind) for name, kind in zip(FILE, ("string", "bigint", "timestamp"))}
        )
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_snapshots(spark: SparkSession, raw: str, table: str, latest: bool = False) -> DataFrame:
    """Rows of every snapshot of a relational table, or only of the ``latest`` one."""
    folder = f"{raw}/database/{table}"
    if latest:
        folder = newest_folder(list_files(spark, folder), f"{table}_data") or folder
    rows = _read_json(spark, folder, SNAPSHOT_SCHEMAS[table], f"{table}_data")
    return (latest_snapshot(rows) if latest else rows).drop("_file")


def newest_folder(files: DataFrame, name: str) -> str | None:
    """Folder of the newest snapshot file with content, from a listing: no other folder need be read."""
    base = F.regexp_extract("path", r"([^/]*)$", 1)
    found = files.filter((F.col("length") > 0) & base.rlike(rf"^({name}|part-).*{JSON_END}"))
    newest = found.agg(F.max_by("path", _taken(F.col("path"))).alias("path")).first()["path"]
    return newest and newest.rsplit("/", 1)[0]


def _taken(path: Column) -> Column:
    """Time of a snapshot as text that sorts, from the folder and file names."""
    day = F.regexp_extract(path, r"/(\d{4}/\d{2}/\d{2})/", 1)
    hour = F.regexp_extract(path, r"/\d{4}/\d{2}/\d{2}/(\d{2})/", 1)
    second = F.regexp_extract(path, rf"_data_(\d{{6}}){JSON_END}", 1)
    return F.concat(day, F.lit("/"), F.when(second != "", second).otherwise(F.rpad(hour, 6, "0")))


def latest_snapshot(rows: DataFrame) -> DataFrame:
    """Rows of the newest snapshot, dated by the folder and file names in ``_file``."""
    dated = rows.withColumn(SNAPSHOT, _taken(F.col("_file")))
    newest = dated.agg(F.max(SNAPSHOT).alias(SNAPSHOT))
    # One row.
    return dated.join(F.broadcast(newest), SNAPSHOT).drop(SNAPSHOT)
