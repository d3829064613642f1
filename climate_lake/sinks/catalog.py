"""External tables over the zone folders."""

from __future__ import annotations

from pyspark.sql import SparkSession

from climate_lake.schemas import TABLES, Table
from climate_lake.sources import commits
from climate_lake.sources.tables import LakePaths, read_table_if_present


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def table_ddl(table: Table, database: str, location: str) -> str:
    columns = ", ".join(f"{_quoted(field.name)} {field.dataType.simpleString()}" for field in table.schema)
    partitioned = f" PARTITIONED BY ({', '.join(map(_quoted, table.partitions))})" if table.partitions else ""
    path = location.replace("'", "\\'")
    return (
        f"CREATE TABLE IF NOT EXISTS {_quoted(database)}.{_quoted(table.name)} ({columns}) "
        f"USING parquet{partitioned} LOCATION '{path}'"
    )


def register_tables(spark: SparkSession, paths: LakePaths, database: str = "climate") -> list[str]:
    """Create the database and its external tables.

    A table without partitions points at the folder of its newest commit, and is moved there if it exists; partitioned
    ones find theirs by ``sync_partitions``.
    """
    home = f"{paths.root.rstrip('/')}/catalog".replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION '{home}'")
    names = [table.name for table in TABLES.values() if table.in_catalog]
    for name in names:
        table, now = TABLES[name], commits.read_log(spark, paths.root, name)
        whole = paths.table(name) if table.partitions or not now.folders else now.paths(paths.table(name))[0].rstrip("/")
        spark.sql(table_ddl(table, database, whole))
        if not table.partitions and now.folders:
            _move(spark, _name(database, name), whole)
    return names


def _name(database: str, table: str) -> str:
    return f"{_quoted(database)}.{_quoted(table)}"


def _move(spark: SparkSession, name: str, location: str) -> None:
    path = location.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


# The commit that a catalog table's partitions were last brought up to, and partitions in one statement.
SYNCED = "climate_lake.version"
STATEMENT_PARTS = 200


def _spec(part: str) -> str:
    values = [step.split("=", 1) for step in part.split("/")]
    return ", ".join(f"{_quoted(key)} = {'null' if value.startswith('__') else value}" for key, value in values)


def _in_batches(spark: SparkSession, start: str, clauses: list[str], between: str) -> None:
    for k in range(0, len(clauses), STATEMENT_PARTS):
        spark.sql(f"{start} {between.join(clauses[k : k + STATEMENT_PARTS])}")


def sync_partitions(spark: SparkSession, paths: LakePaths, database: str, name: str) -> dict[str, int]:
    """Bring a registered table's partitions up to its commits: added, moved and dropped ones.

    Only partitions that commits after the last call list are touched; no folder is listed. Returns their numbers.
    """
    counts = {"added": 0, "moved": 0, "dropped": 0}
    table, now = _name(database, name), commits.read_log(spark, paths.root, name)
    if now.version is None:
        return counts
    properties = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    synced = int(properties[SYNCED]) if SYNCED in properties else None
    if synced == now.version:
        return counts
    changed = now.changed_since(synced)
    shown = {row["partition"] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    known = {part.replace("=null", "=__HIVE_DEFAULT_PARTITION__") for part in shown}
    wanted = now.folders if changed is None else {part: now.folders[part] for part in changed if part in now.folders}
    gone = sorted(known - now.folders.keys())

    def place(part: str) -> str:
        path = f"{paths.table(name)}/{wanted[part]}/{part}".replace("'", "\\'")
        return f"LOCATION '{path}'"

    new = sorted(wanted.keys() - known)
    _in_batches(spark, f"ALTER TABLE {table} ADD IF NOT EXISTS", [f"PARTITION ({_spec(part)}) {place(part)}" for part in new], " ")
    for part in sorted(wanted.keys() & known):
        spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(part)}) SET {place(part)}")
    _in_batches(spark, f"ALTER TABLE {table} DROP IF EXISTS", [f"PARTITION ({_spec(part)})" for part in gone], ", ")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{SYNCED}' = '{now.version}')")
    spark.catalog.refreshTable(table)
    return {"added": len(new), "moved": len(wanted) - len(new), "dropped": len(gone)}


def repair_partitions(spark: SparkSession, paths: LakePaths, database: str = "climate") -> list[str]:
    """Make the partitions of the tables known to the catalog; tables not written yet are passed over.

    A table with commits takes them from there; one that was only written as a plain folder has that folder listed.
    """
    names = [
        table.name
        for table in TABLES.values()
        if table.in_catalog and table.partitions and read_table_if_present(spark, paths, table.name) is not None
    ]
    for name in names:
        if commits.read_commits(spark, paths.root, name) is None:
            spark.sql(f"MSCK REPAIR TABLE {_name(database, name)}")
        else:
            sync_partitions(spark, paths, database, name)
    return names
