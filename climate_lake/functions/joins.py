"""Fact-to-dimension joins that hold up when the dimension is large or a key is hot."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climate_lake.session import materialise

# A frame may be broadcast only if it was counted and stays below both bounds.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows of one key that a single join task may read before the key is split.
ROWS_PER_SPLIT = 2_000_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df``: row count and text size, added up in each task before the shuffle."""
    if max_rows <= 0:
        return False
    size = df.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes"),
    ).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` of each key, combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows"))


def _splits(rows: Column, rows_per_split: int) -> Column:
    """Tasks that a key of so many rows needs; NULL for one."""
    splits = F.ceil(rows / rows_per_split).cast("int")
    return F.when(splits > 1, splits)


def hot_keys(df: DataFrame, keys: list[str], rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Every key that needs more than one task, with the number of ``splits``."""
    counted = key_counts(df, keys).select(*keys, _splits(F.col("rows"), rows_per_split).alias("splits"))
    return counted.filter(F.col("splits").isNotNull())


def hot_key_pairs(left: DataFrame, right: DataFrame, keys: list[str], rows_per_split: int) -> DataFrame:
    """Keys that need more than one task on either side, from the ``key_counts`` of both: ``_left_n`` and ``_right_n``.

    Each of these keys has more than ``rows_per_split`` rows, so the list is short against the rows, but it does grow
    with them: measure it before it is broadcast.
    """
    none = F.lit(0).cast("bigint")
    both = left.select(*keys, F.col("rows").alias("a"), none.alias("b")).unionByName(
        right.select(*keys, none.alias("a"), F.col("rows").alias("b"))
    )
    counted = both.filter((F.col("a") > rows_per_split) | (F.col("b") > rows_per_split)).groupBy(*keys)
    return counted.agg(
        _splits(F.sum("a"), rows_per_split).alias("_left_n"), _splits(F.sum("b"), rows_per_split).alias("_right_n")
    )


def _equal(keys: list[str], prefix: str, null_safe: bool) -> Column:
    pairs = [(F.col(key), F.col(prefix + key)) for key in keys]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _prefixed(keys: list[str], prefix: str) -> list[Column]:
    return [F.col(key).alias(prefix + key) for key in keys]


def _with_splits(df: DataFrame, keys: list[str], marks: DataFrame, widest: int) -> DataFrame:
    """``df`` with ``_left_n`` and ``_right_n`` of its key, NULL for keys that are not hot.

    A list beyond the broadcast bound is joined by shuffle. Every key is then
    spread over ``widest`` salts, with the list copied to each of them, so that
    finding the hot keys does not itself gather one of them in a task. The copies
    are far larger than the files they are made from, by whose size Spark would
    broadcast them: the hint keeps the join a shuffle.
    """
    listed = marks.select(*_prefixed(keys, "_hot_"), "_left_n", "_right_n")
    same = _equal(keys, "_hot_", True)
    if not widest:
        return df.join(F.broadcast(listed), same, "left").select(*df.columns, "_left_n", "_right_n")
    salt = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(widest)).cast("int")
    copied = listed.withColumn("_hot_salt", F.explode(F.sequence(F.lit(0), F.lit(widest - 1))))
    salted = df.withColumn("_salt", salt)
    matched = salted.join(copied.hint("merge"), same & (F.col("_salt") == F.col("_hot_salt")), "left")
    return matched.select(*df.columns, "_left_n", "_right_n")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    null_safe: bool = False,
    rows_per_split: int = ROWS_PER_SPLIT,
    max_marks: int = BROADCAST_ROWS,
    left_counts: DataFrame | None = None,
) -> DataFrame:
    """Inner or left join on same-named ``keys`` that splits hot keys over several tasks.

    A hot key of one side has its rows spread over salts and the other side's
    rows copied once per salt. Keys that are not hot get salt 0 and one copy.
    In a left join, a left row whose key is hot on the right surely matches, so
    its copies that met no row in their salt are dropped. Without any hot key,
    it is a plain join.

    ``left_counts`` are the ``key_counts`` of the left side where the caller has
    them from a pass of its own; else they are counted here.

    The salt hashes the row together with its partition number: a task that is
    run again gives every row the same salt whatever order its input arrives
    in, and identical rows of different partitions still part.
    Result: all left columns, then the right columns that are not keys.
    """
    if how not in ("inner", "left"):
        raise ValueError("salting supports inner and left joins")
    payload = [name for name in right.columns if name not in keys]
    # NULL keys match nothing in a plain join: right rows with one need no split.
    matching = right if null_safe else right.dropna("any", subset=keys)
    counts = key_counts(left, keys) if left_counts is None else left_counts
    marks = materialise(hot_key_pairs(counts, key_counts(matching, keys), keys, rows_per_split), "hot-keys")
    hot = marks.agg(F.count("*").alias("rows"), F.max(F.greatest("_left_n", "_right_n")).alias("widest")).first()
    if not hot["rows"]:
        named = right.select(*_prefixed(keys, "_right_"), *payload)
        return left.join(named, _equal(keys, "_right_", null_safe), how).select(*left.columns, *payload)
    # The rows of this list are short: keys and two numbers.
    widest = 0 if hot["rows"] <= max_marks and fits_broadcast(marks, max_marks) else hot["widest"]

    def tagged(df: DataFrame) -> DataFrame:
        return _with_splits(df, keys, marks, widest)

    def one_of(splits: str, columns: list[str]) -> Column:
        row_hash = F.xxhash64(*columns, F.spark_partition_id())
        return F.when(F.col(splits).isNull(), 0).otherwise(F.pmod(row_hash, F.col(splits))).cast("int")

    def each_of(splits: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(splits), F.lit(1)) - 1))

    salted = (
        tagged(left)
        .withColumn("_a", one_of("_left_n", left.columns))
        .select(*left.columns, "_right_n", "_a", each_of("_right_n").alias("_b"))
    )
    copied = (
        tagged(right)
        .withColumn("_right__b", one_of("_right_n", right.columns))
        .select(*_prefixed(keys, "_right_"), "_right__b", each_of("_left_n").alias("_right__a"), *payload)
        .withColumn("_met", F.lit(True))
    )
    match = _equal(keys, "_right_", null_safe) & _equal(["_a", "_b"], "_right_", False)
    # As in ``_with_splits``: copies are not to be broadcast by the size of their source.
    joined = salted.join(copied.hint("merge"), match, how)
    if how == "left":
        joined = joined.filter(F.col("_right_n").isNull() | F.col("_met"))
    return joined.select(*left.columns, *payload)


def lookup_join(
    fact: DataFrame, dimension: DataFrame, keys: list[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Join to a broadcast dimension, which the caller has measured with ``fits_broadcast``.

    Result: all fact columns, then the dimension columns that are not keys.
    """
    payload = [name for name in dimension.columns if name not in keys]
    lookup = F.broadcast(dimension.select(*_prefixed(keys, "_right_"), *payload))
    return fact.join(lookup, _equal(keys, "_right_", null_safe), how).select(*fact.columns, *payload)


def dimension_join(
    fact: DataFrame,
    dimension: DataFrame,
    keys: list[str],
    how: str = "inner",
    null_safe: bool = False,
    max_rows: int = BROADCAST_ROWS,
    rows_per_split: int = ROWS_PER_SPLIT,
    fact_counts: DataFrame | None = None,
) -> DataFrame:
    """Join a fact to a dimension: broadcast if the measured size allows it, else a salted shuffle."""
    if fits_broadcast(dimension, max_rows):
        return lookup_join(fact, dimension, keys, how, null_safe)
    return salted_join(fact, dimension, keys, how, null_safe, rows_per_split, left_counts=fact_counts)
