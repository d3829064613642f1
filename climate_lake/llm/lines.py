"""Line deduplication that can be undone: sharded cuckoo filters backed by exact reference counts.

``LineStore`` keeps, below one folder, three versioned tables: ``refs`` (which document holds which line key, +1 when it
is inserted, -1 when it is deleted), ``frequent`` (exact document count and largest doc_id of every key at or over the
limit), and ``filters`` (a cuckoo filter of the frequent keys per shard). Inserting or deleting documents recounts the
keys they touch and adds to or deletes from the filters of their shards only. Removal probes a document's keys against
the filter of their shard; what passes is confirmed by the exact counts, so that false positives have no effect.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climate_lake.llm.common import map_batches, small_batches
from climate_lake.session import materialise, work_path

MIN_CHARS = 40
MIN_DOCS = 5
# Keys of one shard, so that a shard's filter and changes fit a task.
SHARD_KEYS = 1_000_000
SLOTS = 4
KICKS = 500

REFS = "shard int, k1 long, k2 long, doc_id long, n int"
FREQUENT = "shard int, k1 long, k2 long, n_docs long, max_doc long"
FILTERS = "shard int, data binary"


class CuckooFilter:
    """Buckets of four 16-bit prints (0: free); a key may sit in two buckets, each found from the other."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.table = [[] for _ in range(buckets)]
        self.held = 0

    @classmethod
    def for_keys(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(2, int(np.ceil(np.log2(max(1, keys) / SLOTS / 0.8)))))

    def _places(self, k1: int, k2: int) -> tuple[int, int, int]:
        mark = (k2 & 0xFFFF) or 1
        first = k1 & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & (self.buckets - 1))

    def __contains__(self, key: tuple[int, int]) -> bool:
        mark, first, second = self._places(*key)
        return mark in self.table[first] or mark in self.table[second]

    def insert(self, key: tuple[int, int]) -> bool:
        """False if there is no room: the filter must be rebuilt larger, from the exact table."""
        mark, first, second = self._places(*key)
        for bucket in (first, second):
            if len(self.table[bucket]) < SLOTS:
                self.table[bucket].append(mark)
                self.held += 1
                return True
        bucket = first
        for kick in range(KICKS):
            own = self.table[bucket]
            own[kick % SLOTS], mark = mark, own[kick % SLOTS]
            bucket = self._other(bucket, mark)
            if len(self.table[bucket]) < SLOTS:
                self.table[bucket].append(mark)
                self.held += 1
                return True
        return False

    def delete(self, key: tuple[int, int]) -> None:
        """Only for keys that were inserted."""
        mark, first, second = self._places(*key)
        self.table[first if mark in self.table[first] else second].remove(mark)
        self.held -= 1

    def probe(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        table = np.zeros((self.buckets, SLOTS), np.uint16)
        for bucket, own in enumerate(self.table):
            table[bucket, : len(own)] = own
        mask = np.uint64(self.buckets - 1)
        mark = np.maximum(k2.view(np.uint64) & np.uint64(0xFFFF), np.uint64(1))
        first = k1.view(np.uint64) & mask
        second = first ^ (mark * np.uint64(0x5BD1E995) & mask)
        marks = mark.astype(np.uint16)[:, None]
        return (table[first.astype(np.intp)] == marks).any(axis=1) | (table[second.astype(np.intp)] == marks).any(axis=1)

    def dump(self) -> bytes:
        table = np.zeros((self.buckets, SLOTS), "<u2")
        for bucket, own in enumerate(self.table):
            table[bucket, : len(own)] = own
        return struct.pack("<Q", self.buckets) + table.tobytes()

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        one = cls(struct.unpack_from("<Q", data)[0])
        rows = np.frombuffer(data, "<u2", offset=8).reshape(-1, SLOTS)
        one.table = [[x for x in row if x] for row in rows.tolist()]
        one.held = int((rows > 0).sum())
        return one


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit key of a stripped line, A-Z in lower case; None for a line that is too short."""
    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _keys(batches, min_chars: int, shards: int, sign: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        names, found = [], []
        for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            if name is None or not text or len(text) < min_chars:
                continue
            own = {line_key(line, min_chars) for line in text.split(b"\n")} - {None}
            names += [name] * len(own)
            found += own
        keys = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(((keys[:, 0].view(np.uint64) >> np.uint64(40)) % np.uint64(shards)).astype(np.int32)),
                pa.array(np.ascontiguousarray(keys[:, 0])),
                pa.array(np.ascontiguousarray(keys[:, 1])),
                pa.array(names, pa.int64()),
                pa.array(np.full(len(names), sign, np.int32)),
            ],
            names=["shard", "k1", "k2", "doc_id", "n"],
        )


def _change(key, old: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter with keys added (n > 0) and deleted; empty data if it must be rebuilt."""
    added, gone = changes[changes.n > 0], changes[changes.n < 0]
    one = CuckooFilter.load(old.data.iloc[0]) if len(old) else CuckooFilter.for_keys(2 * len(added))
    for k in zip(gone.k1.tolist(), gone.k2.tolist()):
        one.delete(k)
    room = all(one.insert(k) for k in zip(added.k1.tolist(), added.k2.tolist()))
    return pd.DataFrame({"shard": [key[0]], "data": [one.dump() if room else b""]})


def _rebuild(key, frequent: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter from the exact table, larger until all keys fit."""
    keys, size = list(zip(frequent.k1.tolist(), frequent.k2.tolist())), 2 * len(frequent)
    while True:
        one = CuckooFilter.for_keys(size)
        if all(one.insert(k) for k in keys):
            return pd.DataFrame({"shard": [key[0]], "data": [one.dump()]})
        size *= 2


def _probe(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, each shard's filter first: the references whose key the filter holds."""
    at, one = None, None
    for batch in batches:
        shards = batch.column("shard").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(a, b - a)
            if not len(part):
                continue
            if shards[a] != at:
                at, one = shards[a], None
            if part.column("data")[0].as_py() is not None:
                one, part = CuckooFilter.load(part.column("data")[0].as_py()), part.slice(1)
            if one is None or not len(part):
                continue
            k1, k2 = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("k1", "k2"))
            yield part.select(["k1", "k2", "doc_id"]).filter(pa.array(one.probe(k1, k2)))


def _dropped(batches, min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        at = batch.schema.get_field_index("text")
        texts, lines, gone = [], [], []
        for text, keys in zip(batch.column(at).cast(pa.binary()).to_pylist(), batch.column("_drop").to_pylist()):
            own = (text or b"").split(b"\n")
            drop = {struct.pack("<qq", x["k1"], x["k2"]) for x in keys or ()}
            kept = [line for line in own if line_key(line, min_chars) not in drop] if drop else own
            texts.append(text if len(kept) == len(own) else b"\n".join(kept))
            lines.append(len(own))
            gone.append(len(own) - len(kept))
        columns = [
            pa.array(texts, pa.binary()).cast(pa.string()) if k == at else batch.column(k)
            for k, name in enumerate(batch.schema.names)
            if name != "_drop"
        ]
        names = [name for name in batch.schema.names if name != "_drop"]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(lines, pa.int64()), pa.array(gone, pa.int64())], names=[*names, "n_lines", "n_dropped"]
        )


class LineStore:
    """Line keys of a growing and shrinking set of documents; ``version`` counts the changes."""

    def __init__(
        self,
        spark: SparkSession,
        path: str | None = None,
        min_docs: int = MIN_DOCS,
        min_chars: int = MIN_CHARS,
        shards: int = 64,
        version: int = 0,
    ):
        self.spark, self.path = spark, path or work_path(spark, "line_store")
        self.min_docs, self.min_chars, self.shards, self.version = min_docs, min_chars, shards, version

    def _at(self, table: str, version: int) -> str:
        return f"{self.path}/{table}/v={version}"

    def _read(self, table: str, schema: str, version: int) -> DataFrame:
        if not version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._at(table, version))

    def refs(self) -> DataFrame:
        """All references with their sign, of every change so far."""
        if not self.version:
            return self.spark.createDataFrame([], REFS)
        return self.spark.read.schema(REFS).parquet(*[self._at("refs", v + 1) for v in range(self.version)])

    def frequent(self) -> DataFrame:
        return self._read("frequent", FREQUENT, self.version)

    def filters(self) -> DataFrame:
        return self._read("filters", FILTERS, self.version)

    def keys(self, documents: DataFrame, sign: int = 1) -> DataFrame:
        rows = documents.select("doc_id", "text")
        return map_batches(rows, _keys, REFS, min_chars=self.min_chars, shards=self.shards, sign=sign)

    def insert(self, documents: DataFrame) -> DataFrame:
        """Add documents (each doc_id once at a time); gives their references."""
        return self._apply(documents, 1)

    def delete(self, documents: DataFrame) -> DataFrame:
        """Take documents out that were inserted with these texts."""
        return self._apply(documents, -1)

    def _apply(self, documents: DataFrame, sign: int) -> DataFrame:
        old, new = self.version, self.version + 1
        self.keys(documents, sign).write.parquet(self._at("refs", new))
        batch = self.spark.read.schema(REFS).parquet(self._at("refs", new))
        before = self.frequent()
        self.version = new
        refs, untouched = self.refs(), before.limit(0)
        if old:
            touched = batch.select("k1", "k2").distinct()
            refs = refs.join(touched, ["k1", "k2"], "left_semi").select("shard", "k1", "k2", "doc_id", "n")
            untouched = before.join(touched, ["k1", "k2"], "left_anti").select(before.columns)
            # A document counts while its references add up to more than none; repeated rows count once.
            refs = refs.groupBy("shard", "k1", "k2", "doc_id").agg(F.sum("n").alias("n")).filter("n > 0")
            count = F.count("*")
        else:
            refs = refs.filter("n > 0")
            count = F.countDistinct("doc_id") if self._repeats(documents) else F.count("*")
        counted = refs.groupBy("shard", "k1", "k2").agg(count.alias("n_docs"), F.max("doc_id").alias("max_doc"))
        counted.filter(F.col("n_docs") >= self.min_docs).unionByName(untouched).write.parquet(self._at("frequent", new))
        self._update_filters(old, before, self.frequent())
        return batch

    def _repeats(self, documents: DataFrame) -> bool:
        return bool(documents.groupBy("doc_id").count().filter("doc_id is not null and count > 1").limit(1).count())

    def _update_filters(self, old: int, before: DataFrame, now: DataFrame) -> None:
        added = now.join(before, ["k1", "k2"], "left_anti").select("shard", "k1", "k2", F.lit(1).alias("n"))
        gone = before.join(now, ["k1", "k2"], "left_anti").select("shard", "k1", "k2", F.lit(-1).alias("n"))
        filters = self._read("filters", FILTERS, old)
        changes = added.unionByName(gone)
        changed = filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(_changed, FILTERS)
        changed = materialise(changed, "filters")
        full = changed.filter(F.length("data") == 0).select("shard")
        rebuilt = now.join(full, "shard", "left_semi").groupBy("shard").applyInPandas(_rebuild, FILTERS)
        changed.filter(F.length("data") > 0).unionByName(rebuilt).write.parquet(self._at("filters", self.version))

    def dropped(self, refs: DataFrame) -> DataFrame:
        """``doc_id, k1, k2`` of the references whose lines go: frequent keys, but in the largest doc_id."""
        none = F.lit(None)
        filters = self.filters().select("shard", none.cast("long").alias("k1"), none.cast("long").alias("k2"),
                                        none.cast("long").alias("doc_id"), "data")
        rows = refs.select("shard", "k1", "k2", "doc_id", none.cast("binary").alias("data")).unionByName(filters)
        ordered = rows.repartition("shard").sortWithinPartitions("shard", F.col("data").isNull())
        passed = map_batches(ordered, _probe, "k1 long, k2 long, doc_id long")
        exact = self.frequent().select(F.col("k1").alias("f1"), F.col("k2").alias("f2"), "max_doc")
        joined = passed.join(exact, (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2")))
        return joined.filter("doc_id < max_doc").select("doc_id", "k1", "k2")

    def clean(self, documents: DataFrame, refs: DataFrame | None = None) -> DataFrame:
        """``documents`` with the lines dropped from ``text``, and ``n_lines`` (before), ``n_dropped`` added.

        ``refs`` are the references of these documents if they are at hand. Null texts stay null and have one empty
        line; documents without doc_id hold no keys and stay whole; input columns named like added ones are replaced.
        """
        columns = [name for name in documents.columns if name not in ("n_lines", "n_dropped", "_drop")]
        drops = self.dropped(self.keys(documents) if refs is None else refs)
        lists = drops.groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2")).alias("_drop"))
        rows = documents.select(columns).join(lists, "doc_id", "left").select(*columns, "_drop")
        fields = ", ".join(f"`{name}` {kind}" for name, kind in documents.select(columns).dtypes)
        return map_batches(rows, _dropped, f"{fields}, n_lines long, n_dropped long", min_chars=self.min_chars)


def _changed(key, old: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    return old[["shard", "data"]] if not len(changes) else _change(key, old, changes)


def drop_repeated_lines(documents: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One run over a whole table: insert all documents into a new store, then clean them."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(16, -(-size // min_chars // SHARD_KEYS))
    store = LineStore(documents.sparkSession, min_docs=min_docs, min_chars=min_chars, shards=shards)
    return store.clean(documents, store.insert(documents))
