"""Sharding of documents by a minimax contiguous partition.

Rows with equal texts are one group, which no shard boundary parts; groups are ordered by a hash of their text. The shards
are contiguous ranges of that order, cut so that the largest shard is as small as any such cut allows: a binary search for
the smallest capacity at which filling shards greedily, one after the other, takes no more than the given number of them.
A group larger than an even share of what is left (there are fewer of them than shards) has a shard of its own.

The groups stay a table. The driver holds a bounded number of blocks of the order with their sizes. A greedy step that
ends inside a block is bracketed by that block's borders, so two searches, with blocks taken as divisible and as solid,
bracket the capacity; blocks a step may end in are then cut finer by one aggregation over them, until both agree. The cuts
are placed near even shares, as far as the capacity lets them: at or after the place from which filling greedily from
the end still takes all.

The shards are written as files; a row's slot is its place in the files of its shard.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climate_lake.functions.joins import fits_broadcast
from climate_lake.session import materialise, work_path

SHARDS = 40
# Added to the bytes of every text.
ROW_BYTES = 16
LAW = "bytes"

# Blocks the driver starts with, and those one of them is cut into, as powers of two.
BLOCK_BITS, FINER_BITS = 14, 6
# Blocks that hold a cut are cut finer until they are this share of a shard.
NEAR_EVEN = 1024


def text_key() -> Column:
    """Order of groups; texts that share a key (equal ones, or 64 bits alike) stay together. Null is an empty text."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def row_size() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long")


class Blocks:
    """Consecutive runs of groups: first and last key, size, and the key bits they were cut by."""

    def __init__(self, first: np.ndarray, last: np.ndarray, size: np.ndarray, shift: np.ndarray):
        order = np.argsort(first, kind="stable")
        self.first, self.last, self.size, self.shift = first[order], last[order], size[order], shift[order]
        self.ends = np.cumsum(self.size)
        self.starts = self.ends - self.size
        self.total = int(self.ends[-1]) if len(self.ends) else 0
        self.solid = self.first == self.last

    def _border(self, place: int) -> int:
        """Block that ``place`` lies strictly inside of, or -1."""
        k = int(np.searchsorted(self.ends, place))
        return k if k < len(self.ends) and self.starts[k] < place < self.ends[k] else -1

    def before(self, place: int, divisible: bool) -> int:
        """Last border between groups at or before ``place``; ``place`` itself where a divisible block may have one."""
        k = self._border(min(place, self.total))
        if k < 0 or (divisible and not self.solid[k]):
            return min(place, self.total)
        return int(self.starts[k])

    def after(self, place: int, divisible: bool) -> int:
        """First border at or after ``place``."""
        k = self._border(max(place, 0))
        if k < 0 or (divisible and not self.solid[k]):
            return max(place, 0)
        return int(self.ends[k])

    def filled(self, capacity: int, shards: int, divisible: bool) -> list[int]:
        """Ends of the shards when each takes all that fits."""
        ends, place = [], 0
        for _ in range(shards):
            place = self.before(place + capacity, divisible)
            ends.append(place)
        return ends

    def filled_from_end(self, capacity: int, shards: int, divisible: bool) -> list[int]:
        """Starts of the shards when each, from the last one on, takes all that fits."""
        starts, place = [], self.total
        for _ in range(shards):
            place = self.after(place - capacity, divisible)
            starts.append(place)
        return starts[::-1]

    def least_capacity(self, shards: int, divisible: bool) -> int:
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.filled(middle, shards, divisible)[-1] == self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def inside(self, ranges: list[tuple[int, int]]) -> np.ndarray:
        """Divisible blocks with a place strictly inside that lies in one of the ranges (ends included)."""
        chosen = np.zeros(len(self.size), bool)
        for low, high in ranges:
            chosen[np.searchsorted(self.ends, low, "right") : np.searchsorted(self.starts, high, "left")] = True
        return np.flatnonzero(chosen & ~self.solid)

    def last_key(self, place: int) -> int:
        """Largest key before the border ``place``."""
        k = int(np.searchsorted(self.ends, place, "right")) - 1
        return int(self.last[k]) if k >= 0 else int(self.first[0]) - 1


def cut_places(blocks: Blocks, shards: int, refine: Callable[[Blocks, np.ndarray], Blocks]) -> tuple[Blocks, int, list[int]]:
    """The smallest capacity and the inner cuts, as places in the order; ``refine`` cuts the given blocks finer."""
    while True:
        # No block much larger than others, so that brackets stay narrow.
        todo = np.flatnonzero(~blocks.solid & (blocks.size > 2 * blocks.total >> BLOCK_BITS))
        if not len(todo):
            low, capacity = (blocks.least_capacity(shards, divisible) for divisible in (True, False))
            todo = blocks.inside(list(zip(blocks.filled(low, shards, False), blocks.filled(capacity, shards, True))))
            if low == capacity:
                known, possible = (blocks.filled_from_end(capacity, shards, divisible) for divisible in (False, True))
                todo = blocks.inside([(a, b) for a, b in zip(possible, known) if a < b])
                if not len(todo):
                    even = blocks.inside([(blocks.total * k // shards,) * 2 for k in range(1, shards)])
                    todo = even[blocks.size[even] * NEAR_EVEN * shards > blocks.total]
        if not len(todo):
            break
        blocks = refine(blocks, todo)
    cuts, place, needed = [], 0, blocks.filled_from_end(capacity, shards, False)
    for k in range(1, shards):
        target = blocks.total * k // shards
        below, above = blocks.before(target, False), blocks.after(target, False)
        near = below if target - below <= above - target else above
        place = min(max(near, needed[k], place), blocks.before(place + capacity, False))
        cuts.append(place)
    return blocks, capacity, cuts


def _read_blocks(groups: DataFrame, shift: int) -> Blocks:
    key = F.shiftright("h", shift)
    found = groups.groupBy(key.alias("block")).agg(F.min("h").alias("a"), F.max("h").alias("b"), F.sum("bytes").alias("n"))
    table = found.select("a", "b", "n").toArrow()
    columns = [table.column(name).to_numpy().astype(np.int64) for name in ("a", "b", "n")]
    return Blocks(*columns, np.full(table.num_rows, shift))


def _finer(groups: DataFrame, blocks: Blocks, todo: np.ndarray) -> Blocks:
    """``blocks`` with those of ``todo`` (a number bounded by blocks and shards) cut finer by their keys' next bits."""
    rest = np.setdiff1d(np.arange(len(blocks.size)), todo)
    parts = [[own[rest] for own in (blocks.first, blocks.last, blocks.size, blocks.shift)]]
    for shift in np.unique(blocks.shift[todo]).tolist():
        names = (blocks.first[todo][blocks.shift[todo] == shift] >> shift).tolist()
        wanted = F.broadcast(groups.sparkSession.createDataFrame([(name,) for name in names], "wanted long"))
        own = groups.join(wanted, F.shiftright("h", shift) == F.col("wanted"), "left_semi")
        made = _read_blocks(own, max(0, shift - FINER_BITS))
        parts.append([made.first, made.last, made.size, made.shift])
    return Blocks(*[np.concatenate(columns) for columns in zip(*parts)])


class Plan:
    """Where each key goes: ``cuts`` are the last keys of the first shards, ``alone`` the keys with a shard of their own."""

    def __init__(self, cuts: list[int], alone: list[int], capacity: int):
        self.cuts, self.alone, self.capacity = cuts, alone, capacity

    def shard(self, key: Column) -> Column:
        ranged = F.lit(0)
        for cut in self.cuts:
            ranged = ranged + (key > F.lit(cut).cast("long")).cast("int")
        for k, own in enumerate(self.alone):
            ranged = F.when(key == F.lit(own).cast("long"), F.lit(len(self.cuts) + 1 + k)).otherwise(ranged)
        return ranged.cast("int")


def plan_shards(groups: DataFrame, shards: int) -> Plan:
    """Cuts for a written table ``h, bytes`` of groups."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    largest = groups.orderBy(F.desc("bytes"), "h").limit(shards).collect()
    alone: list[int] = []
    for row in largest[: shards - 1]:
        if row["bytes"] * (shards - len(alone)) <= total:
            break
        alone.append(row["h"])
        total -= row["bytes"]
    others = groups.filter(~F.col("h").isin(alone)) if alone else groups
    left = shards - len(alone)
    blocks = _read_blocks(others, 64 - BLOCK_BITS)
    if not blocks.total:
        return Plan([0] * (left - 1), alone, 0)
    blocks, capacity, cuts = cut_places(blocks, left, lambda now, todo: _finer(others, now, todo))
    return Plan([max(-(1 << 63), blocks.last_key(cut)) for cut in cuts], alone, capacity)


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS) -> Plan:
    """Write all rows and columns of ``documents`` (with ``text``) below ``path``, a folder ``shard=<n>`` for each shard.

    A column named ``shard`` is replaced. A null text weighs and groups as an empty one. A shard with much data is written
    by several tasks as several files, whatever the size of its groups. With fewer groups than shards, some are empty.
    """
    sizes = documents.select(text_key().alias("h"), row_size().alias("size"))
    groups = materialise(sizes.groupBy("h").agg(F.sum("size").alias("bytes")), "shard_groups")
    plan = plan_shards(groups, shards)
    rows = documents.drop("shard").withColumn("shard", plan.shard(text_key()))
    rows.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
    return plan


def read_shards(spark, path: str, schema: T.StructType) -> DataFrame:
    """The rows of ``write_shards`` in the columns of ``schema``, with a struct ``place`` of ``shard`` and ``slot``.

    Slots count from 0 without gap through the files of a shard, in the order of their names. Only the number of rows
    of each file is gathered; that list is broadcast if it is measured to be small.
    """
    fields = [field for field in schema if field.name.lower() not in ("shard", "place")]
    stored = spark.read.schema(T.StructType([*fields, T.StructField("shard", T.IntegerType())])).parquet(path)
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    counted = materialise(stored.groupBy("shard", file.alias("file")).agg(F.count("*").alias("n")), "shard_files")
    before = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = counted.select(F.col("file").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    files = F.broadcast(files) if fits_broadcast(counted) else files
    rows = stored.select(F.struct(*[field.name for field in fields]).alias("row"), "shard", file.alias("file"), row.alias("nth"))
    placed = rows.join(files, F.col("file") == F.col("of"))
    place = F.struct("shard", (F.col("first") + F.col("nth")).alias("slot"))
    return placed.select("row", place.alias("place")).select("row.*", "place")


def shard_documents(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Write ``documents`` as shard files in the shared work folder and read them back, with their ``place``."""
    spark = documents.sparkSession
    path = work_path(spark, "shards")
    write_shards(documents, path, shards)
    return read_shards(spark, path, documents.schema)


def digests(placed: DataFrame) -> DataFrame:
    """Per row of ``shard_documents``: size, checksum and place. Under this law no shard is added: ``grown_shard`` is null."""
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return placed.select(
        "doc_id",
        row_size().alias("size"),
        crc.alias("text_crc32"),
        F.lit(LAW).alias("law"),
        F.col("place.shard").alias("shard"),
        F.col("place.slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
