"""Token ids as patched frame-of-reference files.

A segment holds about ``SEGMENT_IDS`` ids of whole documents. Its ids are cut into blocks of 128: each block subtracts
its minimum and packs the differences at the width that a given share of them fits (``percentile``); the high bits of
the others go to an exception list. An index gives the place where each block starts, so that any block can be read
alone. Segments are rows of a Parquet dataset, ``shard`` and ``segment`` in document order: Spark's own writer commits
them, and a lost executor costs the segments of its tasks.

Layout of a segment, little-endian: ``PFR1``, n_docs u32, n_ids u64; doc_ids i64 and a null flag u8 per document, ids
per document u32; then per block: minimum u32, width u8, exceptions u8, start u32; then the blocks: packed bits, most
significant first, exception places u8, exception high bits u32.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climate_lake.llm.common import map_batches, small_batches
from climate_lake.llm.tokens import encoder
from climate_lake.session import work_path

MAGIC = b"PFR1"
BLOCK = 128
SEGMENT_IDS = 1 << 20
END_ID = 2

# Bit lengths of all 16-bit numbers.
_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)

INDEX = np.dtype([("minimum", "<u4"), ("width", "u1"), ("exceptions", "u1"), ("start", "<u4")])
SEGMENTS = "shard int, segment int, n_docs long, n_tokens long, data binary"
DOCUMENTS = "shard int, segment int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """0 for 0, else the place of the highest bit."""
    if values.max(initial=0) < len(_BITS):
        return _BITS[values]
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _word(width: int) -> int:
    """Bytes of the smallest word that holds ``width`` bits."""
    return 1 if width <= 8 else 2 if width <= 16 else 4


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` numbers as bytes, ``width`` bits of each."""
    size = _word(width)
    words = values.astype(f">u{size}")
    if width == 8 * size:
        return words.view(np.uint8).reshape(len(values), -1)
    bits = np.unpackbits(words.view(np.uint8).reshape(len(values), BLOCK, size), axis=2)
    return np.packbits(bits[:, :, 8 * size - width :].reshape(len(values), -1), axis=1)


def _unpacked(data: np.ndarray, width: int) -> np.ndarray:
    """Inverse of ``_packed``."""
    size = _word(width)
    if width < 8 * size:
        bits = np.zeros((len(data), BLOCK, 8 * size), np.uint8)
        bits[:, :, 8 * size - width :] = np.unpackbits(data, axis=1).reshape(len(data), BLOCK, width)
        data = np.packbits(bits.reshape(len(data), -1), axis=1)
    return np.ascontiguousarray(data).view(f">u{size}").astype(np.uint32)


def pack_ids(ids: np.ndarray, percentile: float = 90.0) -> bytes:
    """Block index and blocks of ``ids`` (unsigned, 32 bits)."""
    n_blocks = -(-len(ids) // BLOCK)
    if not n_blocks:
        return b""
    padded = np.empty(n_blocks * BLOCK, np.uint32)
    padded[: len(ids)] = ids
    padded[len(ids) :] = ids[-1]
    values = padded.reshape(n_blocks, BLOCK)
    minimum = values.min(axis=1)
    rest = values - minimum[:, None]
    bits = _bit_lengths(rest)
    place = min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)) - 1)
    width = np.partition(bits, place, axis=1)[:, place]
    rows, columns = np.nonzero(bits > width[:, None])
    exceptions = np.bincount(rows, minlength=n_blocks)
    packed = BLOCK // 8 * width.astype(np.int64)
    size = packed + 5 * exceptions
    starts = np.cumsum(size) - size
    body = np.empty(int(size.sum()), np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        for part in np.array_split(own, -(-len(own) // 512)):
            low = rest[part] & np.uint32((1 << w) - 1)
            body[starts[part][:, None] + np.arange(BLOCK // 8 * w)] = _packed(low, w)
    first = starts + packed
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    body[first[rows] + nth] = columns
    high = (rest[rows, columns] >> width[rows]).astype("<u4")
    body[(first + exceptions)[rows][:, None] + 4 * nth[:, None] + np.arange(4)] = high.view(np.uint8).reshape(-1, 4)
    index = np.zeros(n_blocks, INDEX)
    index["minimum"], index["width"], index["exceptions"], index["start"] = minimum, width, exceptions, starts
    return index.tobytes() + body.tobytes()


def unpack_ids(data: bytes, n_ids: int) -> np.ndarray:
    """Inverse of ``pack_ids``."""
    n_blocks = -(-n_ids // BLOCK)
    index = np.frombuffer(data, INDEX, n_blocks)
    body = np.frombuffer(data, np.uint8, offset=n_blocks * INDEX.itemsize)
    values = np.zeros((n_blocks, BLOCK), np.uint32)
    starts = index["start"].astype(np.int64)
    for w in np.unique(index["width"][index["width"] > 0]).tolist():
        own = np.flatnonzero(index["width"] == w)
        for part in np.array_split(own, -(-len(own) // 512)):
            values[part] = _unpacked(body[starts[part][:, None] + np.arange(BLOCK // 8 * w)], w)
    count = index["exceptions"].astype(np.int64)
    if count.any():
        block = np.repeat(np.arange(n_blocks), count)
        nth = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
        place = (starts + BLOCK // 8 * index["width"].astype(np.int64))[block]
        at = place + count[block] + 4 * nth
        high = np.ascontiguousarray(body[at[:, None] + np.arange(4)]).view("<u4")[:, 0]
        values[block, body[place + nth]] += high << index["width"][block]
    return (values + index["minimum"][:, None]).reshape(-1)[:n_ids]


def pack_segment(doc_ids: list[int | None], ids: list[bytes], percentile: float = 90.0) -> bytes:
    lengths = np.array([len(one) // 4 for one in ids], "<u4")
    head = struct.pack("<4sIQ", MAGIC, len(ids), int(lengths.sum(dtype=np.int64)))
    names = np.array([0 if one is None else one for one in doc_ids], "<i8").tobytes()
    nulls = np.array([one is None for one in doc_ids], np.uint8).tobytes()
    return head + names + nulls + lengths.tobytes() + pack_ids(np.frombuffer(b"".join(ids), "<u4"), percentile)


def unpack_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, ids per document, and all ids of a segment."""
    magic, n_docs, n_ids = struct.unpack_from("<4sIQ", data)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    at = struct.calcsize("<4sIQ")
    names = np.frombuffer(data, "<i8", n_docs, at).tolist()
    nulls = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs).tolist()
    lengths = np.frombuffer(data, "<u4", n_docs, at + 9 * n_docs).astype(np.int64)
    ids = unpack_ids(data[at + 13 * n_docs :], n_ids)
    return [None if null else name for name, null in zip(names, nulls)], lengths, ids


def _segments(batches, path: str, end_id: int, percentile: float, segment_ids: int) -> Iterator[pa.RecordBatch]:
    shard, segment, names, ids, held = TaskContext.get().partitionId(), 0, [], [], 0
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("data", pa.binary())])

    def row() -> pa.RecordBatch:
        data = pack_segment(names, ids, percentile)
        return pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip((shard, segment, len(names), held, data), schema.types)], schema=schema
        )

    for batch in small_batches(batches, "text", 4 << 20):
        encoded = encoder(path)(batch.column("text").to_pylist())
        for name, one in zip(batch.column("doc_id").to_pylist(), encoded):
            names.append(name)
            ids.append(one + end)
            held += len(one) // 4 + 1
            if held >= segment_ids:
                yield row()
                names, ids, held, segment = [], [], 0, segment + 1
    if names:
        yield row()


def write_tokens(
    documents: DataFrame,
    tokenizer: str,
    path: str,
    end_id: int = END_ID,
    percentile: float = 90.0,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode ``doc_id, text`` and write segments below ``path``, in ascending order of doc_id.

    A null or empty text is the end id alone. Null doc_ids come first; rows with equal doc_id are ordered by a hash of
    their text. Other columns are ignored. An empty table writes no segment.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = documents.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    made = map_batches(
        rows, _segments, SEGMENTS, path=tokenizer, end_id=end_id, percentile=percentile, segment_ids=segment_ids
    )
    made.write.parquet(path)


def _documents(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            shard, segment = batch.column("shard")[k].as_py(), batch.column("segment")[k].as_py()
            names, lengths, ids = unpack_segment(batch.column("data")[k].as_py())
            ends = np.cumsum(lengths)
            data = memoryview(ids.astype("<u4").tobytes())
            starts = ends - lengths
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard] * len(names), pa.int32()),
                    pa.array([segment] * len(names), pa.int32()),
                    pa.array(names, pa.int64()),
                    pa.array(starts),
                    pa.array(lengths),
                    pa.array(sums, pa.int64()),
                ],
                names=["shard", "segment", "doc_id", "local_start", "n_tokens", "ids_crc32"],
            )


def read_documents(spark, path: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32`` with ``start`` over all files.

    Starts are sums at three levels: documents in a segment, segments in a shard, shards. Only the last, one row per
    writing task, is a sum over a whole table.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    sizes = segments.select("shard", "segment", "n_tokens")
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("held"))
    shards = shards.select("shard", F.coalesce(F.sum("held").over(before().orderBy("shard")), F.lit(0)).alias("shard_start"))
    inner = F.coalesce(F.sum("n_tokens").over(before("shard").orderBy("segment")), F.lit(0))
    places = sizes.select("shard", "segment", inner.alias("inner_start")).join(shards, "shard")
    found = map_batches(segments.select("shard", "segment", "data"), _documents, DOCUMENTS)
    start = F.col("shard_start") + F.col("inner_start") + F.col("local_start")
    return found.join(places, ["shard", "segment"]).select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def encode_documents(documents: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the token files of ``documents`` to the shared work folder and read them back."""
    spark = documents.sparkSession
    path = work_path(spark, "token_files")
    write_tokens(documents, tokenizer, path, **options)
    return read_documents(spark, path)
