"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

# Input of one task, and shuffle data of one reducer, that fit executor memory well.
SCAN_TASK_BYTES = 256 * 1024 * 1024
SHUFFLE_TASK_BYTES = 128 * 1024 * 1024
# The raw zone holds one small file per fetch: about a thousand of them make a task.
SMALL_FILE_BYTES = 256 * 1024


def settings_for(input_bytes: int) -> dict[str, str]:
    """Partition sizes for a run over ``input_bytes``; adaptive execution merges partitions that stay small."""
    partitions = max(200, -(-input_bytes // SHUFFLE_TASK_BYTES))
    return {
        "spark.sql.files.maxPartitionBytes": str(SCAN_TASK_BYTES),
        "spark.sql.files.openCostInBytes": str(SMALL_FILE_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_TASK_BYTES),
    }


def get_session(app_name: str = "climate_lake", **overrides: str) -> SparkSession:
    """A session with adaptive execution on; master and sizes come from the submitter."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    master, where driver and executors are one process, may fall back to a
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="climate-lake-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: computed once, size known to the planner."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
