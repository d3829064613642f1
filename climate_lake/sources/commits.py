"""What was written to a zone table, and which of it counts.

Every write goes to a folder of its own (``v=<id>`` below the table's folder). Only after Spark has finished it, one row per
written partition is added, in one file, to the table's commits. Readers take for each partition the folder of the newest
commit that lists it, not older than the last overwrite of the whole table: a write that died is never seen, and the
rows before it stay. A table has one writer at a time.

The rows of a table's commits, one per written partition, are few beside its files and are read to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

# ``partition`` is the path of one below the folder ('' for a table without), NULL in the row that every commit has.
# ``source`` is the newest commit of the table that the rows were made from.
COMMIT = (
    "version bigint, kind string, folder string, partition string, files bigint, bytes bigint, rows bigint, "
    "source bigint, written timestamp"
)
OVERWRITE, REFRESH, APPEND = "overwrite", "refresh", "append"
VERSION = "v"


def commits_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/commits/{name}"


def read_commits(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The commits of a table, or None if there is none."""
    try:
        return spark.read.schema(COMMIT).parquet(commits_path(root, name))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class Log:
    """The commits of one table at one time."""

    rows: list[Row]

    @cached_property
    def last(self) -> Row | None:
        """A row of the newest commit, with its version and its source."""
        return max(self.rows, key=lambda row: row["version"], default=None)

    @property
    def version(self) -> int | None:
        return self.last and self.last["version"]

    @property
    def source(self) -> int | None:
        return self.last and self.last["source"]

    @cached_property
    def since_overwrite(self) -> list[Row]:
        base = max((row["version"] for row in self.rows if row["kind"] == OVERWRITE), default=0)
        return [row for row in self.rows if row["version"] >= base]

    @cached_property
    def folders(self) -> dict[str, str]:
        """The folder of each partition that has rows."""
        newest: dict[str, Row] = {}
        # Of one commit, the row with files comes last.
        for row in sorted(self.since_overwrite, key=lambda row: (row["version"], row["files"])):
            if row["partition"] is not None:
                newest[row["partition"]] = row
        return {part: row["folder"] for part, row in newest.items() if row["files"]}

    def paths(self, table: str) -> list[str]:
        """What to read: folders of which no partition was replaced as a whole, others partition by partition."""
        replaced = {
            row["folder"] for row in self.since_overwrite if row["files"] and self.folders.get(row["partition"]) != row["folder"]
        }
        whole = {f"{table}/{folder}" for folder in self.folders.values() if folder not in replaced}
        return sorted(whole) + sorted(f"{table}/{folder}/{part}" for part, folder in self.folders.items() if folder in replaced)

    def changed_since(self, version: int | None) -> list[str] | None:
        """Partitions that later commits replaced; None stands for the whole table."""
        later = [row for row in self.rows if version is not None and row["version"] > version]
        if version is None or not self.rows or any(row["kind"] == OVERWRITE for row in later):
            return None
        return sorted({row["partition"] for row in later if row["partition"] is not None})


def read_log(spark: SparkSession, root: str, name: str) -> Log:
    """The commits of a table; none if it has none."""
    found = read_commits(spark, root, name)
    return Log([] if found is None else found.select("version", "kind", "folder", "partition", "files", "source").collect())
