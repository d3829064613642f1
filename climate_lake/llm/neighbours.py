"""Approximate nearest neighbours by cosine, with one vantage-point tree per shard.

Vectors are scaled to length one, where nearness by cosine is nearness by distance, a metric. A node holds a vantage
point and the median distance of its vectors to it: the nearer half goes inside, the others outside. A search keeps the
k nearest so far; by the triangle inequality the other side of a node can't help if the query is farther from the
border than the k-th distance. ``factor`` relaxes this: the other side is skipped once ``factor`` times the distance to
the border is over the k-th distance. Factor one is exact search.

Every shard is searched for every query, in blocks; a task holds one shard's tree and one block of queries.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climate_lake.llm.common import map_batches

SHARD_VECTORS = 8192
LEAF = 128
BLOCK_QUERIES = 1024
NEAREST = 5
FACTOR = 1.15


class Tree:
    """A vantage-point tree in arrays; ``names`` and ``vectors`` are ordered so that each node is a range."""

    def __init__(self, names: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.argsort(names, kind="stable")
        self.names, self.vectors = names[order], vectors[order].astype(np.float64)
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))
        self.unit = self.vectors / self.norms[:, None]
        self.leaf = leaf
        self.nodes: dict[tuple[int, int], tuple[int, float]] = {}
        place = np.arange(len(names))
        self._build(place, 0, len(names))
        for name in ("names", "vectors", "norms", "unit"):
            setattr(self, name, getattr(self, name)[place])

    def _build(self, place: np.ndarray, start: int, end: int) -> None:
        todo = [(start, end)]
        while todo:
            start, end = todo.pop()
            if end - start <= self.leaf:
                continue
            own = place[start:end]
            # The vector farthest from the first one lies at the edge, where borders cut best.
            vantage = int(np.argmax(_distances(self.unit[own], self.unit[own[0]][None, :])[:, 0]))
            own[[0, vantage]] = own[[vantage, 0]]
            away = _distances(self.unit[own[1:]], self.unit[own[0]][None, :])[:, 0]
            order = np.argsort(away, kind="stable")
            own[1:] = own[1:][order]
            middle = len(away) // 2
            self.nodes[start, end] = start + 1 + middle, float(away[order[middle]])
            todo += [(start + 1, start + 1 + middle), (start + 1 + middle, end)]

    def search(self, names: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of each query's ``k`` best, -1 where there are fewer; never the query's own name."""
        queries = queries.astype(np.float64)
        norms = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        unit = queries / norms[:, None]
        best = np.full((len(queries), k), np.inf)
        found = np.full((len(queries), k), -1)

        def offer(who: np.ndarray, start: int, end: int) -> np.ndarray:
            away = _distances(unit[who], self.unit[start:end])
            scored = np.where(names[who][:, None] == self.names[None, start:end], np.inf, away)
            both = np.concatenate([best[who], scored], axis=1)
            places = np.concatenate([found[who], np.broadcast_to(np.arange(start, end), scored.shape)], axis=1)
            # Equal distances go to the smaller name; rounding is left to the exact scores below.
            named = np.where(places >= 0, self.names[places], np.iinfo(np.int64).max)
            order = np.lexsort((named, both), axis=1)[:, :k] if both.shape[1] <= 4 * k else _first(both, named, k)
            best[who] = np.take_along_axis(both, order, axis=1)
            found[who] = np.where(np.isinf(best[who]), -1, np.take_along_axis(places, order, axis=1))
            return away

        def visit(who: np.ndarray, start: int, end: int) -> None:
            if not len(who) or start >= end:
                return
            if (start, end) not in self.nodes:
                offer(who, start, end)
                return
            middle, border = self.nodes[start, end]
            away = offer(who, start, start + 1)[:, 0]
            inside, gap = away < border, np.abs(away - border)
            for near, (first, second) in (
                (inside, ((start + 1, middle), (middle, end))),
                (~inside, ((middle, end), (start + 1, middle))),
            ):
                visit(who[near], *first)
                rest = who[near]
                visit(rest[factor * gap[near] <= best[rest, -1] + 1e-9], *second)

        visit(np.arange(len(queries)), 0, len(self.names))
        own = self.vectors[found]
        scores = np.einsum("qkd,qd->qk", own, queries) / (self.norms[found] * norms[:, None])
        return found, scores


def _first(away: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest by (distance, name), per row."""
    edge = np.partition(away, k - 1, axis=1)[:, k - 1][:, None]
    small = np.where(away <= edge, away, np.inf)
    return np.lexsort((names, small), axis=1)[:, :k]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def _blocks(batches, shards: int, every: int, block: int) -> Iterator[pa.RecordBatch]:
    """Vectors as packed blocks: one stream of index blocks by shard, one of query blocks for every shard."""
    held: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
    schema = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])

    def pack(rows: list[tuple[int, np.ndarray]]) -> bytes:
        return struct.pack("<q", len(rows)) + np.array([x for x, _ in rows], "<i8").tobytes() + np.concatenate([v for _, v in rows]).tobytes()

    def emit(key: tuple[int, int]) -> pa.RecordBatch:
        data, (dim, shard) = pack(held.pop(key)), key
        where = range(shards) if shard < 0 else [shard]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([dim] * len(where), pa.int32()),
                pa.array(where, pa.int32()),
                pa.array([int(shard < 0)] * len(where), pa.int32()),
                pa.array([data] * len(where), pa.binary()),
            ],
            schema=schema,
        )

    for batch in batches:
        for name, shard, vector in zip(*[batch.column(c).to_pylist() for c in ("vec_id", "shard", "vector")]):
            one = np.array(vector, "<f8")
            for key in [(len(one), shard), *([(len(one), -1)] if name % every == 0 else [])]:
                held.setdefault(key, []).append((name, one))
                if len(held[key]) >= block:
                    yield emit(key)
    for key in list(held):
        yield emit(key)


def _unpack(data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    n = struct.unpack_from("<q", data)[0]
    return np.frombuffer(data, "<i8", n, 8), np.frombuffer(data, "<f8", n * dim, 8 + 8 * n).reshape(n, dim)


def _search(batches, k: int, factor: float, leaf: int) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by dimension, shard and kind: the shard's vectors come first, then all query blocks."""
    at, index, tree = None, [], None
    for batch in batches:
        for dim, shard, kind, data in zip(*[batch.column(c).to_pylist() for c in ("dim", "shard", "kind", "data")]):
            if at != (dim, shard):
                at, index, tree = (dim, shard), [], None
            if kind == 0:
                index.append(_unpack(data, dim))
                continue
            if tree is None and index:
                names, vectors = (np.concatenate(x) for x in zip(*index))
                tree, index = Tree(names, vectors, leaf), []
            if tree is None:
                continue
            names, queries = _unpack(data, dim)
            found, scores = tree.search(names, queries, k, factor)
            hit = found >= 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.broadcast_to(names[:, None], found.shape)[hit]),
                    pa.array(tree.names[found][hit]),
                    pa.array(scores[hit]),
                ],
                names=["query_id", "vec_id", "score"],
            )


def nearest(
    vectors: DataFrame,
    column: str = "embedding",
    every: int = 50,
    k: int = NEAREST,
    factor: float = FACTOR,
    shard_vectors: int = SHARD_VECTORS,
    leaf: int = LEAF,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each vec_id divisible by ``every``.

    Vectors that are null, empty, zero or hold null or non-finite components, and null vec_ids, take no part. Vectors
    meet those of their own length only. Nearest first, equal cosines by the smaller vec_id. Repeated rows of a vec_id
    count once, the first by its components. An empty table gives no row.
    """
    value = F.transform(F.col(column), lambda x: x.cast("double"))
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select("vec_id", value.alias("vector")).filter("vec_id is not null and size(vector) > 0")
    rows = rows.filter(finite & F.exists("vector", lambda x: x != 0))
    rows = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    shards = max(1, -(-vectors.count() // shard_vectors))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    blocks = map_batches(
        rows.select("vec_id", shard.alias("shard"), "vector"),
        _blocks,
        "dim int, shard int, kind int, data binary",
        shards=shards,
        every=every,
        block=block_queries,
    )
    by_shard = blocks.repartition(shards, "dim", "shard").sortWithinPartitions("dim", "shard", "kind")
    found = map_batches(by_shard, _search, "query_id long, vec_id long, score double", k=k, factor=factor, leaf=leaf)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
