from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from climate_lake.functions import joins


@pytest.fixture
def hot_pair(spark):
    """A third of the left rows share one key, many of them identical; the right side has its own hot key."""
    left = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))
        ).alias("key"),
        (F.col("id") % 7).alias("value"),
    )
    right = spark.range(0, 60, numPartitions=3).select(
        F.when(F.col("id") < 5, "hot").when(F.col("id") < 25, "k1").when(F.col("id") == 25, None).otherwise(
            F.concat(F.lit("k"), F.col("id").cast("string"))
        ).alias("key"),
        F.col("id").alias("attribute"),
    )
    return left, right


def expected(left, right, how, null_safe):
    by_key = {}
    for row in right.collect():
        by_key.setdefault(row.key, []).append(row.attribute)
    out = Counter()
    for row in left.collect():
        matches = by_key.get(row.key, []) if row.key is not None or null_safe else []
        for attribute in matches or ([None] if how == "left" else []):
            out[(row.key, row.value, attribute)] += 1
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("rows_per_split", [3, 100, 10_000])
@pytest.mark.parametrize("max_marks", [0, 1_000])
def test_salted_join_equals_plain_join(hot_pair, how, null_safe, rows_per_split, max_marks):
    left, right = hot_pair
    joined = joins.salted_join(left, right, ["key"], how, null_safe, rows_per_split, max_marks)
    assert joined.columns == ["key", "value", "attribute"]
    assert Counter(tuple(row) for row in joined.collect()) == expected(left, right, how, null_safe)


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_dimension_join_forms_agree(hot_pair, max_rows):
    left, right = hot_pair
    joined = joins.dimension_join(left, right, ["key"], "left", True, max_rows, rows_per_split=50)
    assert Counter(tuple(row) for row in joined.collect()) == expected(left, right, "left", True)


def test_every_hot_key_is_split(spark, hot_pair):
    left, _ = hot_pair
    marks = {row.key: row.splits for row in joins.hot_keys(left, ["key"], 100).collect()}
    assert marks["hot"] == 10
    assert all(splits > 1 for splits in marks.values())
    many = spark.range(4500).select((F.col("id") % 1500).alias("key"))
    assert joins.hot_keys(many, ["key"], 2).count() == 1500


def test_hot_key_reaches_several_tasks(spark, hot_pair):
    left, right = hot_pair
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.salted_join(left, right, ["key"], rows_per_split=100).filter("key = 'hot'")
        tasks = joined.select(F.spark_partition_id().alias("task")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 1


def test_fits_broadcast_measures_rows_and_bytes(spark):
    frame = spark.range(100).withColumn("text", F.repeat(F.lit("x"), 100))
    assert joins.fits_broadcast(frame, 100)
    assert not joins.fits_broadcast(frame, 99)
    assert not joins.fits_broadcast(frame, 100, max_bytes=5_000)
    assert joins.fits_broadcast(frame.filter("id < 0"), 10)
    assert not joins.fits_broadcast(frame, 0)


def test_only_inner_and_left(hot_pair):
    with pytest.raises(ValueError):
        joins.salted_join(*hot_pair, ["key"], "full")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_copies_of_many_hot_keys_are_not_broadcast(spark, plan, tmp_path, how):
    """The files of both sides are small, the copies made of them are not."""
    spark.range(20_000).select((F.col("id") % 4000).alias("key"), "id").write.parquet(str(tmp_path / "left"))
    spark.range(4000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("size")).write.parquet(str(tmp_path / "right"))
    left, right = (spark.read.parquet(str(tmp_path / side)) for side in ("left", "right"))
    joined = joins.salted_join(left, right, ["key"], how, rows_per_split=1, max_marks=10)
    assert "Broadcast" not in plan(joined)
    assert (joined.count(), joined.agg(F.sum("size")).first()[0]) == (20_000, 5 * 3999 * 4000)
