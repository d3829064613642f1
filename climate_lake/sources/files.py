"""File listings as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = "path string, length bigint"


def plain_path(uri: Column) -> Column:
    """The plain path of a file whose URI the scan's metadata or its index gives."""
    # Most names need no decoding, and scans ask for them row by row.
    coded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    plain = F.when(uri.contains("%"), coded).otherwise(uri)
    rest = F.ltrim(F.substr(plain, F.lit(len("file:") + 1)), F.lit("/"))
    return F.when(plain.startswith("file:/"), F.concat(F.lit("file:/"), rest)).otherwise(plain)


def stored_bytes(spark: SparkSession, *folders: str) -> int:
    """Bytes below the folders, summed up by the tasks of a scan that reads no contents; absent folders have none."""
    total = 0
    for folder in folders:
        try:
            found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        total += found.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return total


def list_files(spark: SparkSession, *folders: str) -> DataFrame:
    """Path and length of every file below the folders; contents are not read, absent folders are empty.

    A scan passes over files of length zero. Those are the names in the
    scan's own file index that it gave no row for. For a store with very many
    files, give the reports its inventory instead (``path`` and ``length``).
    """
    def one(folder: str) -> DataFrame:
        try:
            found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], FILE)
        filled = found.select("path", "length")
        # The index names files as encoded URIs, the scan as plain paths.
        names = spark.createDataFrame([(name,) for name in found.inputFiles()], "uri string")
        indexed = names.select(plain_path(F.col("uri")).alias("path"))
        empty = indexed.join(filled, "path", "left_anti").select("path", F.lit(0).cast("bigint").alias("length"))
        return filled.unionByName(empty)

    return reduce(DataFrame.unionByName, [one(folder) for folder in folders])
