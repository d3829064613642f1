"""Lake layout and readers of the trusted and refined zones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from climate_lake.schemas import TABLES
from climate_lake.sources import commits


@dataclass(frozen=True)
class LakePaths:
    """A lake is one folder (any URI Spark can reach) with a folder per zone."""

    root: str

    def zone(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw(self) -> str:
        return self.zone("raw")

    def table(self, name: str) -> str:
        return f"{self.zone(TABLES[name].zone)}/{name}"


def stored_schema(name: str) -> T.StructType:
    """Schema of a table's files, with the folder of the write they belong to."""
    return T.StructType([*TABLES[name].schema.fields, T.StructField(commits.VERSION, T.StringType())])


def read_table(spark: SparkSession, paths: LakePaths, name: str) -> DataFrame:
    """A zone table in the column order of its schema: what its commits list, or its whole folder if it has none."""
    schema, folder = TABLES[name].schema, paths.table(name)
    now = commits.read_log(spark, paths.root, name)
    if now.version is None:
        return spark.read.schema(schema).parquet(folder).select(*schema.fieldNames())
    if not now.folders:
        return empty_table(spark, name)
    stored = spark.read.schema(stored_schema(name)).option("basePath", folder).parquet(*now.paths(folder))
    return stored.select(*schema.fieldNames())


def read_table_if_present(spark: SparkSession, paths: LakePaths, name: str) -> DataFrame | None:
    """The table, or None where its folder does not exist."""
    try:
        return read_table(spark, paths, name)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name].schema)


def first_non_empty(preferred: DataFrame, fallback: DataFrame) -> DataFrame:
    return fallback if preferred.isEmpty() else preferred


def read_weather(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Integrated observations, or the basic ones where there are none."""
    integrated = read_table_if_present(spark, paths, "integrated_weather_data")
    basic = read_table_if_present(spark, paths, "weather_data")
    if integrated is None or basic is None:
        present = integrated if integrated is not None else basic
        return present if present is not None else empty_table(spark, "weather_data")
    return first_non_empty(integrated, basic)
