"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# What the contracts count as white space: blank and the five ASCII controls, the set bytes.split() uses.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

# One Arrow batch handed to Python holds at most this much; a longer text is a batch of its own.
BATCH_BYTES = 16 * 1024 * 1024


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(batches: Iterable[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose ``column`` holds about ``most`` bytes, so that Python lists of it stay small."""
    for batch in batches:
        rows = batch.num_rows
        size = batch.column(column).nbytes
        step = rows if size <= most else max(1, int(rows * most / size))
        for start in range(0, rows, step or 1):
            yield batch.slice(start, step)


def map_batches(df: DataFrame, function, schema: str, **arguments) -> DataFrame:
    """``mapInArrow`` of a module-level function with bound keyword arguments."""
    return df.mapInArrow(partial(function, **arguments), schema)
