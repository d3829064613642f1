"""Packing documents into token sequences by bounded-space online best fit.

Pieces arrive in scan order. A task keeps at most ``open_bins`` open sequences, in a bitset with one bit per possible
free space: the lowest set bit at or above a piece's length is the tightest fit. If nothing fits and all bins are taken,
the fullest open sequence closes. A sequence is closed for good when it is full.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climate_lake.llm import mixing
from climate_lake.llm.common import map_batches, small_batches
from climate_lake.llm.tokens import encoder
from climate_lake.session import materialise

CAPACITY = 2048
OPEN_BINS = 4096
SEPARATOR = 0
# Tokens one packing task takes: enough that the sequences it leaves open at its end weigh little.
TASK_TOKENS = 1 << 25

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


class OpenBins:
    """The open sequences of one task."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free = 0  # bit f is set if an open sequence has f free places
        self.bins: dict[int, list[int]] = defaultdict(list)
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        own = self.bins[free]
        one = own.pop()
        if not own:
            self.free ^= 1 << free
        self.open -= 1
        return one

    def place(self, length: int) -> tuple[int, int]:
        """The sequence a piece goes to, and its offset there."""
        fitting = self.free >> length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1 + length
            one = self._take(free)
        else:
            free, one = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if self.open == self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            self.bins[left].append(one)
            self.free |= 1 << left
            self.open += 1
        return one, self.capacity - free


def _pieces(batches, path: str, capacity: int, separator: int) -> Iterator[pa.RecordBatch]:
    end, size = np.array([separator], "<u4").tobytes(), 4 * capacity
    for batch in small_batches(batches, "text", 2 << 20):
        names, pieces, starts, ids = [], [], [], []
        for name, one in zip(batch.column("doc_id").to_pylist(), encoder(path)(batch.column("text").to_pylist())):
            one += end
            for k in range(0, len(one), size):
                names.append(name)
                pieces.append(k // size)
                starts.append(k // 4)
                ids.append(one[k : k + size])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.int64()),
                pa.array(pieces, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
        )


def cut_pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """Token pieces of ``doc_id, text``: ids as little-endian unsigned 32-bit integers, the separator at the end, and their crc32.

    A null or empty text is the separator alone. Only documents longer than ``capacity`` are cut. Repeated rows and
    null doc_ids are documents like any other; further columns are ignored.
    """
    rows = documents.select("doc_id", "text")
    return map_batches(rows, _pieces, PIECES, path=tokenizer, capacity=capacity, separator=separator)


def _pack(batches, capacity: int, most: int) -> Iterator[pa.RecordBatch]:
    bins, first = OpenBins(capacity, most), TaskContext.get().partitionId() << 40
    largest = lambda whole: "ids" if "ids" in whole.schema.names else "length"
    for batch in (part for whole in batches for part in small_batches([whole], largest(whole), 8 << 20)):
        placed = [bins.place(length) for length in batch.column("length").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array([first + one for one, _ in placed], pa.int64()),
                pa.array([offset for _, offset in placed], pa.int64()),
            ],
            names=[*batch.schema.names, "sequence_id", "offset"],
        )


def pack_pieces(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    task_tokens: int = TASK_TOKENS,
    with_ids: bool = True,
) -> DataFrame:
    """``sequence_id`` and a gapless ``offset`` for each row of a written table of ``cut_pieces``.

    Tasks read neighbouring files (no shuffle) until each has about ``task_tokens`` tokens. Without ids, only places
    are given, and the ids are neither read nor carried.
    """
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-tokens // task_tokens))
    schema = PIECES if with_ids else PIECES.removesuffix(", ids binary")
    rows = pieces.select([field.split()[0] for field in schema.split(", ")]).coalesce(tasks)
    return map_batches(rows, _pack, schema + ", sequence_id long, offset long", capacity=capacity, most=open_bins)


def pack_documents(documents: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Cut, write the pieces to the shared work folder, pack them, and write and reread the sequences with their ids.

    ``ids_crc32`` is that of the ids as they were reread.
    """
    packed = materialise(pack_pieces(materialise(cut_pieces(documents, tokenizer), "pieces"), **options), "sequences")
    return packed.withColumn("ids_crc32", F.crc32("ids")) if "ids" in packed.columns else packed


def _narrow(ids: bytes) -> bytes:
    """The ids in 16 bits each, if all of them fit."""
    wide = np.frombuffer(ids, "<u4")
    return wide.astype("<u2").tobytes() if wide.max(initial=0) < 1 << 16 else ids


def _widened(batches, capacity: int, most: int) -> Iterator[pa.RecordBatch]:
    """``_pack`` of pieces with narrow ids, which become wide again."""
    for batch in _pack(batches, capacity, most):
        lengths, narrow = batch.column("length").to_pylist(), batch.column("ids").to_pylist()
        ids = [
            np.frombuffer(one, "<u2").astype("<u4").tobytes() if len(one) == 2 * n else one for n, one in zip(lengths, narrow)
        ]
        place = batch.schema.get_field_index("ids")
        yield batch.set_column(place, "ids", pa.array(ids, pa.binary()))


def _sourced_pieces(batches, path: str, capacity: int, separator: int) -> Iterator[pa.RecordBatch]:
    """Pieces with a number ``doc`` of their own for each document row, and its source; ids as ``_narrow`` has them."""
    sources, done = deque(), TaskContext.get().partitionId() << 40

    def noted() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources.extend(batch.column("source").to_pylist())
            yield batch

    source = None
    for batch in _pieces(noted(), path, capacity, separator):
        docs, own = [], []
        for piece in batch.column("piece").to_pylist():
            if not piece:
                source, done = sources.popleft(), done + 1
            docs.append(done)
            own.append(source)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:-1],
                pa.array([_narrow(one) for one in batch.column("ids").to_pylist()], pa.binary()),
                pa.array(docs, pa.int64()),
                pa.array(own, pa.string()),
            ],
            names=[*batch.schema.names, "doc", "source"],
        )


def pack_mixed(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    separator: int = SEPARATOR,
    task_tokens: int = TASK_TOKENS,
    **options,
) -> DataFrame:
    """The pieces of ``doc_id, text, source`` packed in the order of the mix.

    ``mixing.mix`` with the given ``options`` places the document rows; packing tasks take successive ranges of slots, and
    pieces come in the order of slot, rank and place in the document, however the documents lie in files. Sequences are
    numbered in the order of the tasks. Ids are shuffled to the place of their sequence, 16 bits each where they fit; texts
    are not.
    """
    rows = documents.select("doc_id", "text", F.col("source").cast("string").alias("source"))
    schema = PIECES + ", doc long, source string"
    cut = map_batches(rows, _sourced_pieces, schema, path=tokenizer, capacity=capacity, separator=separator)
    pieces = materialise(cut, "mixed_pieces")
    mixed = mixing.mix(pieces.filter("piece = 0").select("doc", "doc_id", "source"), **options)
    places = mixed.select(F.col("doc").alias("of"), F.col("mix.slot").alias("slot"), F.col("mix.rank").alias("rank"))
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-tokens // task_tokens))
    placed = pieces.join(places, F.col("doc") == F.col("of")).select(*[x.split()[0] for x in PIECES.split(", ")], "slot", "rank")
    ordered = placed.repartitionByRange(tasks, "slot", "rank").sortWithinPartitions("slot", "rank", "piece").drop("slot", "rank")
    packed = map_batches(ordered, _widened, PIECES + ", sequence_id long, offset long", capacity=capacity, most=open_bins)
    return packed.withColumn("ids_crc32", F.crc32("ids"))
