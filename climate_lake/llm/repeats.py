"""Removing every byte covered by a long string that also starts earlier, by merging Burrows-Wheeler transforms.

A repeat is a string of ``LENGTH`` bytes within one document that also starts earlier, in a smaller doc_id or before in
the same document. All are found, in three steps whose groups depend on content alone.

1. Sharding. Every string of LENGTH bytes belongs to its minimiser: the 32-byte window of smallest hash in it (the first
   of equal ones). Neighbouring strings with the same minimiser make one stretch. Equal strings have equal minimisers at
   the same place, so they meet in the minimiser's group, and a stretch equal to an earlier one is a repeat as a whole.
   Stretches of a minimiser that occurs once, or always in the same stretch, are settled here: only hashes move.
2. Merging. The distinct stretches of a group are cut into shards, and each shard gets its Burrows-Wheeler transform.
   The transforms are merged by refining their interleave: stable passes by symbol bring the merged order from depth k
   to deeper ones, without comparing suffixes again. Intervals that still hold two rows at depth k have a common prefix
   of k; those left at LENGTH are the repeated strings, and all their starts but the earliest are repeats.
3. Removal. The ranges of repeated starts go back to their documents, where the covered bytes are cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climate_lake.llm.common import map_batches, small_batches
from climate_lake.session import materialise

LENGTH = 100
KEY = 32
# Text whose stretches one bucket of step 1 gathers, and suffixes merged at a time and per shard.
BUCKET_BYTES = 32 * 1024 * 1024
UNIT_SUFFIXES = 150_000
SHARD_SUFFIXES = 30_000
# Distinct stretches of one minimiser beyond which its strings are grouped by nearly all their bytes instead.
HOT_STRETCHES = 20_000
HOT_SPAN = 4
# Starts of a long text that are looked at together.
PART = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)
RANGE = np.dtype([("doc", "<i8"), ("start", "<i4"), ("n", "<i4")])
STRETCH = np.dtype([("key", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("start", "<i4"), ("n", "<u2")])


def _scale(size: int) -> np.uint64:
    return np.uint64(pow(_MULTIPLIER, size, 1 << 64))


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of ``size`` bytes, by doubling."""
    now, width, whole, done = _BYTES[data], 1, None, 0
    while True:
        if size & width:
            if whole is None:
                whole = now
            else:
                n = len(now) - done
                whole = whole[:n] * _scale(width) + now[done:]
            done += width
        if done == size:
            whole = whole ^ (whole >> np.uint64(32))
            whole = whole * np.uint64(0xD6E8FEB86659FD93)
            return whole ^ (whole >> np.uint64(32))
        now = now[:-width] * _scale(width) + now[width:]
        width *= 2


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` gives the hash of any span."""
    powers = np.cumprod(np.full(len(data), _MULTIPLIER, np.uint64))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * powers)])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    step, now = 1, values
    while 2 * step <= width:
        now = np.minimum(now[:-step], now[step:])
        step *= 2
    return now if step == width else np.minimum(now[: len(now) - (width - step)], now[width - step :])


def stretches(text: bytes, length: int = LENGTH, key: int = KEY) -> tuple[np.ndarray, ...]:
    """Minimiser's hash and place, first start and number of starts of each stretch of a text, part by part."""
    whole, width = np.frombuffer(text, np.uint8), length - key + 1
    found = []
    for begin in range(0, len(whole) - length + 1, PART):
        hashes = window_hashes(whole[begin : begin + PART + length - 1], key)
        # The high bits of the hash, then the place: the smallest is the first of the windows that tie.
        packed = (hashes & ~np.uint64(2 * PART - 1)) | np.arange(len(hashes), dtype=np.uint64)
        place = (_smallest(packed, width) & np.uint64(2 * PART - 1)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        found.append((hashes[place[first]], place[first] + begin, first + begin, np.diff(np.append(first, len(place)))))
    return tuple(np.concatenate(one) for one in zip(*found))


def _found(batches, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Stretches of whole texts as arrays per bucket; of equal stretches of a batch only the first, the others as done."""
    for batch in small_batches(batches, "text", 8 << 20):
        parts = []
        for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
            if text is None or len(text) < length:
                continue
            keys, _, first, n = stretches(text, length)
            rows = np.empty(len(keys), STRETCH)
            rows["key"], rows["doc"], rows["start"], rows["n"] = keys, doc, first, n
            sums = prefix_hashes(np.frombuffer(text, np.uint8))
            # A span's sum carries the power of its place; the inverse power takes it out.
            span = (sums[first + n + length - 1] - sums[first]) * _inverse(first)
            rows["content"] = span ^ (span >> np.uint64(31)) ^ n.astype(np.uint64)
            parts.append(rows)
        if not parts:
            continue
        rows = np.concatenate(parts)
        rows, done = _settle(rows)
        bucket = ((rows["key"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((rows["start"], rows["doc"], bucket))
        rows, bucket = rows[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
        names = [int(bucket[a]) for a in cuts[:-1]]
        blobs = [_dump(rows[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        if len(done):
            names.append(int(done["key"][0] % np.uint64(buckets)))
            blobs.append(b"d" + _dump(done[np.lexsort((done["start"], done["doc"]))]))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "data"])


_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def _inverse(places: np.ndarray) -> np.ndarray:
    """Inverse of the multiplier to the power of each place, by squaring."""
    found, factor, left = np.ones(len(places), np.uint64), _INVERSE, places.astype(np.uint64)
    while left.any():
        found = np.where(left & np.uint64(1), found * np.uint64(factor), found)
        factor, left = factor * factor % (1 << 64), left >> np.uint64(1)
    return found


def _dump(rows: np.ndarray) -> bytes:
    """Column by column, which compresses well."""
    return b"".join([np.ascontiguousarray(rows[name]).tobytes() for name in STRETCH.names])


def _load(data: bytes, offset: int = 0) -> np.ndarray:
    rows = np.empty((len(data) - offset) // STRETCH.itemsize, STRETCH)
    for name in STRETCH.names:
        rows[name] = np.frombuffer(data, STRETCH[name], len(rows), offset)
        offset += len(rows) * STRETCH[name].itemsize
    return rows


def _settle(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest of each set of equal stretches, and the others; the same stretch met again is no other."""
    rows = rows[np.lexsort((rows["start"], rows["doc"], rows["content"], rows["key"]))]
    again, same = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
    again[1:] = (rows["key"][1:] == rows["key"][:-1]) & (rows["content"][1:] == rows["content"][:-1])
    same[1:] = again[1:] & (rows["doc"][1:] == rows["doc"][:-1]) & (rows["start"][1:] == rows["start"][:-1])
    return rows[~again], rows[again & ~same]


SPANS = "doc long, start int, n int, group long, hot boolean"


def _span_batch(rows: np.ndarray, group: np.ndarray | None = None, hot: np.ndarray | None = None) -> pa.RecordBatch:
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.ascontiguousarray(rows["doc"])),
            pa.array(np.ascontiguousarray(rows["start"])),
            pa.array(rows["n"].astype(np.int32)),
            pa.nulls(n, pa.int64()) if group is None else pa.array(group.view(np.int64)),
            pa.nulls(n, pa.bool_()) if hot is None else pa.array(hot),
        ],
        names=["doc", "start", "n", "group", "hot"],
    )


def _settled(batches, hot: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: repeated stretches (no group), and those to be merged with others (with their group)."""
    at, held = None, []

    def closed() -> Iterator[pa.RecordBatch]:
        rows, done = _settle(np.concatenate(held))
        yield _span_batch(done)
        new = np.ones(len(rows), bool)
        new[1:] = rows["key"][1:] != rows["key"][:-1]
        which = np.cumsum(new) - 1
        size = np.bincount(which)[which]
        some = size > 1
        yield _span_batch(rows[some], np.ascontiguousarray(rows["key"][some]), size[some] > hot)

    for batch in batches:
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist()):
            if len(data) % STRETCH.itemsize:
                yield _span_batch(_load(data, 1))
                continue
            if bucket != at and held:
                yield from closed()
                held = []
            at = bucket
            held.append(_load(data))
            if len(held) >= 64 and sum(map(len, held)) > 4_000_000:
                # Copies are settled as they come, so that only distinct stretches are kept.
                rows, done = _settle(np.concatenate(held))
                yield _span_batch(done)
                held = [rows]
    if held:
        yield from closed()


def _hot_pieces(batches, length: int, span: int) -> Iterator[pa.RecordBatch]:
    """Spans of hot stretches cut by the place of their minimiser, with a group and a hash of the bytes of each."""
    for batch in small_batches(batches, "text", 8 << 20):
        out: tuple[list, ...] = ([], [], [], [], [])
        for doc, text, asked in zip(*[batch.column(c).to_pylist() for c in ("doc", "text", "asked")]):
            for one in asked:
                start, end = one["start"], one["start"] + one["n"]
                # Strings whose place to the minimiser falls into the same span share all bytes but span - 1.
                place = start + int(stretches(text[start : start + length], length)[1][0])
                low = start - (start - place) % span
                for a in range(low, end, span):
                    first, b = max(a, start), min(a + span, end)
                    core = text[a + span - 1 : a + length]
                    group = _digest(core + bytes([(place - a) % 251]))
                    for column, value in zip(out, (doc, first, b - first, group, _digest(text[first : b + length - 1]))):
                        column.append(value)
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        names = ["doc", "start", "n", "group", "content"]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names=names)


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _asked(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc, text, asked`` with all spans of each document."""
    asked = spans.groupBy(F.col("doc").alias("_of")).agg(F.collect_list(F.struct("start", "n", "group")).alias("asked"))
    return texts.join(asked, F.col("doc") == F.col("_of")).select("doc", "text", "asked")


def settle_hot(texts: DataFrame, spans: DataFrame, length: int = LENGTH, span: int = HOT_SPAN) -> DataFrame:
    """Hot stretches ``spans`` in pieces, settled as in step 1: ``doc, start, n, group``.

    Of equal pieces of a group only the earliest keeps the group, if there are others to merge it with; later ones are
    repeats as a whole and have none. So a merge doesn't grow with the documents that share a passage.
    """
    schema = "doc long, start int, n int, group long, content long"
    pieces = materialise(map_batches(_asked(texts, spans), _hot_pieces, schema, length=length, span=span), "hot_pieces")
    # Combined before the shuffle: one row per task and different piece.
    first = pieces.groupBy("group", "content").agg(F.min(F.struct("doc", "start", "n")).alias("first"))
    first = materialise(first, "hot_firsts")
    several = first.groupBy("group").count().filter("count > 1").select("group")
    merged = first.join(several, "group", "left_semi").select("first.doc", "first.start", "first.n", "group")
    # A document given twice is no repeat of itself.
    later = pieces.join(first, ["group", "content"]).filter("doc != first.doc or start != first.start")
    return later.select("doc", "start", "n", F.lit(None).cast("long").alias("group")).unionByName(merged)


def _texts(batches, length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches to be merged, with their group."""
    for batch in small_batches(batches, "text", 8 << 20):
        out: tuple[list, ...] = ([], [], [], [])
        for doc, text, asked in zip(*[batch.column(c).to_pylist() for c in ("doc", "text", "asked")]):
            for one in asked:
                start, end = one["start"], one["start"] + one["n"]
                for column, value in zip(out, (one["group"], doc, start, text[start : end + length - 1])):
                    column.append(value)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names=["group", "doc", "start", "data"])


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of a shard: rotations of its strings, each with an end mark, in sorted order.

    Gives the transform's symbols, and the string and place of each row.
    """
    sizes = np.array([len(x) + 1 for x in strings])
    symbols = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    begin = np.cumsum(sizes) - sizes
    string = np.repeat(np.arange(len(strings)), sizes)
    own, size = begin[string], sizes[string]
    place = np.arange(len(symbols)) - own
    # Ranks by the first seven symbols, then by twice as many in each round.
    rank, step = np.zeros(len(symbols), np.int64), 7
    for k in range(step):
        rank = rank << 8 | symbols[own + (place + k) % size]
    values, rank = np.unique(rank, return_inverse=True)
    while step < sizes.max() and len(values) < len(symbols):
        ahead = own + (place + step) % size
        values, rank = np.unique(rank * len(symbols) + rank[ahead], return_inverse=True)
        step *= 2
    rows = np.argsort(rank, kind="stable")
    before = own + (place - 1) % size
    return symbols[before[rows]], string[rows], place[rows]


def merge(transforms: list[np.ndarray], rows: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the merged transforms that share ``depth`` symbols with others, in order, and their interval.

    The interleave starts as one shard after the other, each in its own order: one interval with common prefix 0. A
    pass reads the two symbols before each row and deals the rows two places before out by them, keeping their order:
    intervals of common prefix k split into intervals of common prefix k + 2. A row left alone in its interval shares
    no more, nor do the rows before it, so it is dropped. ``rows`` are those to start from, by their place in the
    concatenated transforms; ``depth`` symbols must lie before each.
    """
    symbols = np.concatenate(transforms)
    back = np.empty(len(symbols), np.int32)  # the row before a row, by the transform's own property
    base = 0
    for one in transforms:
        back[base + np.argsort(one, kind="stable")] = np.arange(base, base + len(one), dtype=np.int32)
        base += len(one)
    twice = back[back]
    both = symbols[back].astype(np.uint16) << 8 | symbols
    block = np.zeros(len(rows), np.int32)
    for k in range(0, depth, 2):
        read, before = (both, twice) if k + 1 < depth else (symbols, back)
        symbol = read[rows]
        order = np.argsort(symbol, kind="stable")
        symbol, source = symbol[order], block[order]
        edge = np.ones(len(rows) + 1, bool)
        edge[1:-1] = (symbol[1:] != symbol[:-1]) | (source[1:] != source[:-1])
        shared = ~(edge[:-1] & edge[1:])
        block = np.cumsum(edge[:-1], dtype=np.int32)[shared]
        rows = before[rows[order[shared]]]
        if not len(rows):
            break
    return rows, block


def repeated_starts(strings: list[bytes], docs: np.ndarray, starts: np.ndarray, length: int = LENGTH, shard: int = SHARD_SUFFIXES):
    """Document and place of each start, in the given stretches, of a string that also starts earlier in them."""
    sizes = np.array([len(x) + 1 for x in strings])
    which = (np.cumsum(sizes) - sizes) // shard
    cuts = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(strings)]
    made = [transform(strings[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    string = np.concatenate([x[1] + a for x, a in zip(made, cuts)])
    place = np.concatenate([x[2] for x in made])
    rows, interval = merge([x[0] for x in made], np.flatnonzero(place >= length), length)
    doc, at = docs[string[rows]], starts[string[rows]] + place[rows]
    order = np.lexsort((at, doc, interval))
    doc, at, interval = doc[order], at[order], interval[order]
    # All but the earliest; a document given twice is no repeat of itself.
    first = np.flatnonzero(np.diff(interval, prepend=-1))
    lead = np.repeat(first, np.diff(np.append(first, len(doc))))
    again = (doc != doc[lead]) | (at != at[lead])
    return doc[again], at[again]


def _merged(batches, length: int, unit: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group: whole groups are merged together until they make a unit."""
    at, held, size = None, [], 0

    def found(rows: list) -> pa.RecordBatch:
        docs, starts = repeated_starts(
            [x[2] for x in rows], np.array([x[0] for x in rows], np.int64), np.array([x[1] for x in rows], np.int64), length
        )
        order = np.lexsort((starts, docs))
        docs, starts = docs[order], starts[order]
        edge = np.ones(len(docs) + 1, bool)
        edge[1:-1] = (docs[1:] != docs[:-1]) | (starts[1:] > starts[:-1] + 1)
        first, last = np.flatnonzero(edge[:-1]), np.flatnonzero(edge[1:])
        out = np.empty(len(first), RANGE)
        out["doc"], out["start"], out["n"] = docs[first], starts[first], starts[last] - starts[first] + 1
        return _span_batch(out)

    for batch in batches:
        for group, *row in zip(*[batch.column(c).to_pylist() for c in ("group", "doc", "start", "data")]):
            if group != at:
                at = group
                if size >= unit:
                    yield found(held)
                    held, size = [], 0
            held.append(row)
            size += len(row[2]) + 1
    if held:
        yield found(held)


def _cut(batches, length: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "_bytes", 8 << 20):
        at = batch.schema.get_field_index("_bytes")
        kept, size, gone, spans = [], [], [], []
        for text, ranges in zip(batch.column("_bytes").to_pylist(), batch.column("_ranges").to_pylist()):
            text = text or b""
            size.append(len(text))
            if not ranges:
                kept.append(text)
                gone.append(0)
                spans.append(0)
                continue
            steps = np.zeros(len(text) + 1, np.int32)
            np.add.at(steps, [x["start"] for x in ranges], 1)
            np.add.at(steps, [x["start"] + x["n"] - 1 + length for x in ranges], -1)
            covered = np.cumsum(steps)[:-1] > 0
            kept.append(np.frombuffer(text, np.uint8)[~covered].tobytes())
            gone.append(int(covered.sum()))
            spans.append(int((np.diff(covered.astype(np.int8), prepend=0) == 1).sum()))
        names = [name for name in batch.schema.names if name not in ("_bytes", "_ranges")]
        columns = [batch.column(name) for name in names]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(kept, pa.binary()), *[pa.array(x, pa.int64()) for x in (size, gone, spans)]],
            names=[*names, "kept", "n_bytes", "n_removed", "n_spans"],
        )


def _numbered(documents: DataFrame) -> DataFrame:
    """``documents`` with ``_doc``, a number in document order that tells all different documents apart.

    That is the doc_id, unless some are null or occur twice: then ranks of (doc_id, hash of the text), nulls first.
    """
    ids = documents.select("doc_id")
    odd = ids.groupBy("doc_id").count().filter("doc_id is null or count > 1").limit(1).count()
    if not odd:
        return documents.withColumn("_doc", F.col("doc_id"))
    order = [F.col("o_id").asc_nulls_first(), F.col("o_hash")]
    keys = documents.select(F.col("doc_id").alias("o_id"), F.xxhash64("text").alias("o_hash")).distinct()
    ranged = keys.repartitionByRange(*order).withColumn("o_part", F.spark_partition_id())
    ranks = materialise(ranged.withColumn("o_rank", F.row_number().over(Window.partitionBy("o_part").orderBy(*order))), "order")
    ranks = ranks.select("o_id", "o_hash", (F.shiftleft(F.col("o_part").cast("long"), 40) + F.col("o_rank")).alias("_doc"))
    # The input's columns may have any name.
    rows = documents.select(F.struct(*documents.columns).alias("row"))
    match = F.col("row.doc_id").eqNullSafe(F.col("o_id")) & (F.xxhash64("row.text") == F.col("o_hash"))
    return rows.join(ranks, match).select("row.*", "_doc")


def remove_repeats(documents: DataFrame, length: int = LENGTH, hot: int = HOT_STRETCHES) -> DataFrame:
    """``documents`` without ``text``, and with ``kept`` (remaining bytes), ``n_bytes``, ``n_removed``, ``n_spans``.

    Null texts are empty. Rows that share a doc_id are ordered by a hash of their text; identical rows are one document
    and all lose the same bytes. Input columns named like the added ones are replaced. An empty table gives no row.
    """
    added = ("kept", "n_bytes", "n_removed", "n_spans", "_doc", "_bytes", "_ranges", "_of")
    columns = [name for name in documents.columns if name not in (*added, "text")]
    rows = _numbered(documents.select(*columns, "text"))
    texts = rows.select(F.col("_doc").alias("doc"), F.col("text").cast("binary").alias("text"))
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-total // BUCKET_BYTES))
    found = map_batches(texts.filter(F.length("text") >= length), _found, "bucket int, data binary", length=length, buckets=buckets)
    by_bucket = found.repartition("bucket").sortWithinPartitions("bucket")
    spans = materialise(map_batches(by_bucket, _settled, SPANS, hot=hot), "spans")

    plain = spans.filter(~F.coalesce("hot", F.lit(False))).select("doc", "start", "n", "group")
    if spans.filter("hot").limit(1).count():
        plain = plain.unionByName(materialise(settle_hot(texts, spans.filter("hot"), length), "hot_spans"))
    wanted = _asked(texts, plain.filter("group is not null"))
    pieces = map_batches(wanted, _texts, "group long, doc long, start int, data binary", length=length)
    by_group = pieces.repartition("group").sortWithinPartitions("group")
    merged = materialise(map_batches(by_group, _merged, SPANS, length=length, unit=UNIT_SUFFIXES), "merged_spans")

    repeated = plain.filter("group is null").select("doc", "start", "n").union(merged.select("doc", "start", "n"))
    ranges = repeated.groupBy(F.col("doc").alias("_of"))
    ranges = ranges.agg(F.collect_list(F.struct("start", "n")).alias("_ranges"))
    joined = rows.join(ranges, F.col("_doc") == F.col("_of"), "left")
    joined = joined.select(*columns, F.col("text").cast("binary").alias("_bytes"), "_ranges")
    fields = "".join(f"`{name}` {kind}, " for name, kind in documents.select(columns).dtypes)
    return map_batches(joined, _cut, f"{fields}kept binary, n_bytes long, n_removed long, n_spans long", length=length)
