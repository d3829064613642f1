"""Writers of the zone tables, exports and raw snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climate_lake.schemas import TABLES
from climate_lake.sources import commits
from climate_lake.sources.tables import LakePaths, read_table, read_table_if_present, stored_schema


# Partitions that one task writes at a time where rows are not sorted by them. Rows of further ones are sorted.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
MOST_WRITERS = 32


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes that don't sort the rows of their tasks, for its duration."""
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, str(MOST_WRITERS))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(WRITERS)
        else:
            spark.conf.set(WRITERS, before)


def _write(df: DataFrame, path: str, name: str, mode: str = "errorifexists", in_place: bool = False) -> None:
    """Write rows in a table's partition layout.

    A partitioned table is rebalanced on its partition columns first: adaptive
    execution merges small partitions and cuts large ones, so a month that
    holds most of the data is written by many tasks and a small one gives a
    single file. Rows are ordered inside each file, which also makes the
    narrow row-group statistics that point reads skip by. Rows that are read,
    unshuffled, from a table with the same partitions may stay ``in_place``:
    their tasks hold a few whole files or pieces of a large one each, in the
    order of the files. Such a task is as large as a scan allows, which is many
    times its memory: its rows are not sorted again.
    """
    table = TABLES[name]
    rows = df.select(*table.schema.fieldNames())
    if table.partitions and not in_place:
        rows = rows.hint("rebalance", *table.partitions).sortWithinPartitions(*table.partitions, *table.sort)
    writer = rows.write.mode(mode)
    if table.partitions:
        writer = writer.partitionBy(*table.partitions)
    with _unsorted(df.sparkSession) if in_place else nullcontext():
        writer.parquet(path)


def _commit(
    spark: SparkSession, paths: LakePaths, name: str, kind: str, folder: str, parts: list[str] | None, source: int | None
) -> None:
    """Add the commit of a finished folder: its partitions with their files, bytes and rows, and ``parts`` left without."""
    table = paths.table(name)
    written = spark.read.schema(stored_schema(name)).option("basePath", table).parquet(f"{table}/{folder}")
    first = F.col("_metadata.row_index") == 0
    # By the partition columns, which Spark takes from the folders: no path is taken apart for each row.
    counted = written.groupBy(*TABLES[name].partitions).agg(
        F.count_if(first).alias("files"),
        F.sum(F.when(first, F.col("_metadata.file_size"))).alias("bytes"),
        F.count("*").alias("rows"),
    )
    found = counted.filter("files > 0").select(_part(name).alias("partition"), "files", "bytes", "rows")
    # A row for the commit as such, and one for each partition that may have got no rows.
    marks = F.array(F.lit(None).cast("string"), *map(F.lit, parts or []))
    nothing = [F.lit(0).cast("bigint").alias(column) for column in ("files", "bytes", "rows")]
    rows = found.unionByName(spark.range(1).select(F.explode(marks).alias("partition"), *nothing))
    version = (commits.read_log(spark, paths.root, name).version or 0) + 1
    made = rows.select(
        F.lit(version).cast("bigint").alias("version"),
        F.lit(kind).alias("kind"),
        F.lit(folder).alias("folder"),
        "partition",
        "files",
        "bytes",
        "rows",
        F.lit(source).cast("bigint").alias("source"),
        F.current_timestamp().alias("written"),
    )
    # One file: it is there as a whole or not at all.
    made.coalesce(1).write.mode("append").parquet(commits.commits_path(paths.root, name))


def new_folder() -> str:
    return f"{commits.VERSION}=w{uuid.uuid4().hex}"


def write_table(
    df: DataFrame,
    paths: LakePaths,
    name: str,
    mode: str = "overwrite",
    source: int | None = None,
    folder: str | None = None,
    in_place: bool = False,
) -> None:
    """Overwrite a zone table or append to it. Until the whole write is done, and if it fails, readers see the old rows.

    The new rows may be computed from the table itself. The folders of earlier writes stay until ``expire_versions``.
    An overwrite ``in_place`` neither shuffles nor sorts rows that lie as the table's partitions do.
    """
    spark = df.sparkSession
    if mode == "append":
        _append(df, paths, name)
        return
    if mode != "overwrite":
        raise ValueError("mode is overwrite or append")
    folder = folder or new_folder()
    _write(df, f"{paths.table(name)}/{folder}", name, in_place=in_place)
    _commit(spark, paths, name, commits.OVERWRITE, folder, None, source)


def _append(df: DataFrame, paths: LakePaths, name: str) -> None:
    spark, table = df.sparkSession, paths.table(name)
    now = commits.read_log(spark, paths.root, name)
    if now.version is None:
        if read_table_if_present(spark, paths, name) is None:
            write_table(df, paths, name)
        else:
            _write(df, table, name, "append")
        return
    folders = set(now.folders.values())
    if len(folders) > 1 and TABLES[name].partitions:
        parts = parts_of(df, name)
        refresh_partitions(df.unionByName(only_parts(read_table(spark, paths, name), name, parts)), paths, name, parts)
        return
    folder = folders.pop() if folders else new_folder()
    _write(df, f"{table}/{folder}", name, "append")
    _commit(spark, paths, name, commits.APPEND, folder, None, None)


def _part(name: str):
    """Path of a row's partition below its folder, as Spark names it (partition columns are whole numbers)."""
    default = F.lit("__HIVE_DEFAULT_PARTITION__")
    return F.concat_ws(
        "/", *[F.concat(F.lit(f"{column}="), F.coalesce(F.col(column).cast("string"), default)) for column in TABLES[name].partitions]
    )


def count_parts(df: DataFrame, name: str) -> dict[str, int]:
    """Rows of ``df`` in each partition."""
    return {row["part"]: row["count"] for row in df.groupBy(_part(name).alias("part")).count().collect()}


def parts_of(df: DataFrame, name: str) -> list[str]:
    """Partitions that ``df`` has rows in."""
    return sorted(count_parts(df, name))


def only_parts(df: DataFrame, name: str, parts: list[str]) -> DataFrame:
    """Rows of these partitions, by a condition on the partition columns that prunes the scan."""
    chosen = F.lit(False)
    for first, rest in _by_first(parts).items():
        one = F.col(TABLES[name].partitions[0]).eqNullSafe(_value(first))
        if rest:
            column = F.col(TABLES[name].partitions[1])
            known = [_value(value) for value in rest if not value.startswith("__")]
            inner = column.isin(known) if known else F.lit(False)
            one = one & (F.coalesce(inner, F.lit(False)) | (column.isNull() if len(known) < len(rest) else F.lit(False)))
        chosen = chosen | one
    return df.filter(chosen)


def _value(text: str):
    return F.lit(None if text.startswith("__") else int(text)).cast("int")


def _by_first(parts: list[str]) -> dict[str, list[str]]:
    """Second values by first value of partition paths."""
    found: dict[str, list[str]] = {}
    for part in parts:
        values = [step.split("=", 1)[1] for step in part.split("/")]
        found.setdefault(values[0], []).extend(values[1:])
    return found


def refresh_partitions(
    df: DataFrame, paths: LakePaths, name: str, parts: list[str], source: int | None = None, folder: str | None = None
) -> None:
    """Replace these partitions by the rows of ``df``, all of which lie in them; other partitions aren't touched.

    A partition of the list without rows is empty afterwards. All of them change at once, when the write is committed.
    """
    folder = folder or new_folder()
    _write(df, f"{paths.table(name)}/{folder}", name)
    _commit(df.sparkSession, paths, name, commits.REFRESH, folder, parts, source)


def expire_versions(spark: SparkSession, paths: LakePaths, name: str, keep: int = 2) -> list[str]:
    """Delete the folders of commits before the newest ``keep`` that no partition is read from any more."""
    log = commits.read_log(spark, paths.root, name)
    newest = {row["folder"]: row["version"] for row in sorted(log.rows, key=lambda row: row["version"])}
    unused = sorted(
        folder for folder, version in newest.items() if version <= log.version - keep and folder not in log.folders.values()
    )
    jvm = spark.sparkContext._jvm
    for folder in unused:
        path = jvm.org.apache.hadoop.fs.Path(f"{paths.table(name)}/{folder}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return unused


def write_table_if_any(df: DataFrame, paths: LakePaths, name: str) -> bool:
    """Write only if there are rows; otherwise the stored table stays as it is."""
    if df.isEmpty():
        return False
    write_table(df, paths, name)
    return True


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


# JSON repeats its field names in every row: compressed, less than a tenth of it is written. A file is one task's to read;
# those that are landed come from partitions of bounded size.
JSON_CODEC = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_json(df: DataFrame, path: str) -> None:
    """Compressed JSON lines with ISO dates, NULL fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).options(**JSON_CODEC).json(path)


def _hour_folder(as_of: datetime) -> str:
    return as_of.strftime("%Y/%m/%d/%H")


def land_table(df: DataFrame, raw: str, table: str, as_of: datetime) -> str:
    """Land a relational extract as one snapshot of the raw zone."""
    path = f"{raw}/database/{table}/{_hour_folder(as_of)}"
    write_json(df, path)
    return path


def land_documents(documents: DataFrame, raw: str, as_of: datetime) -> str:
    """Land API documents of one fetch, a folder per city.

    Only the folders of the cities in this fetch are replaced: another landing in the same hour adds its cities.
    """
    path = f"{raw}/weather-api/{_hour_folder(as_of)}"
    by_city = documents.withColumn("city", F.col("city_info.name"))
    by_city.hint("rebalance", "city").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).options(**JSON_CODEC).partitionBy("city").json(path)
    return path
