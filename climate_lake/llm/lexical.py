"""Ranked lexical search by dense blocked products: tiles of the items' terms times tiles of the documents' impacts.

A term's impact in a document is a whole number, and an item's score for the document the sum over its terms, so all
scores of a tile of items and a tile of documents are one matrix product: item rows of ones and zeros over the tile's own
compact vocabulary, times impacts. Products are taken in float64 over as many terms at a time as keep every partial sum
below 2^53, where float64 is exact, and added up as 64-bit integers.

Documents are read once: a first job writes each one's number of terms and its frequencies of the items' terms. The
statistics are aggregates of that table, and a second job multiplies. A task keeps the best of what it has seen for
each item, ties included until they are settled by doc_id; the tasks' lists are merged in two steps.

Items are searched in groups of bounded text, each with a vocabulary that fits every worker; more items take more
groups, each a pass over the documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climate_lake.llm.common import map_batches, small_batches
from climate_lake.session import materialise

TOP = 10
# Text of the items in one group, and items and documents of a tile.
GROUP_BYTES = 1 << 20
ITEM_TILE, DOCUMENT_TILE = 64, 1024
# Terms a product is taken over at most, so that a tile of impacts stays small.
TERM_TILE = 4096
EXACT = (1 << 53) - 1
# Tasks whose lists the first merge brings together.
MERGED_TASKS = 64

MATCHED = "doc_id long, n long, terms binary, counts binary"
RANKED = "item int, doc_id long, score long, task int"

# Bytes of a term keep their place, A-Z in lower case; all others part terms. Every byte above 0x7F belongs to a term.
_KEEP = set(range(0x30, 0x3A)) | set(range(0x41, 0x5B)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TABLE = bytes(code if code in _KEEP else 0x20 for code in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """All terms of a text, in order, with repeats."""
    return (text or b"").translate(_TABLE).split()


def _matched(batches, vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    known = vocabulary.keys()
    for batch in small_batches(batches, "text", 4 << 20):
        names, sizes, found, counts = [], [], [], []
        for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            words = terms(text)
            if not words:
                continue
            held = Counter(words)
            own = [word for word in held if word in known]
            names.append(name)
            sizes.append(len(words))
            found.append(np.array([vocabulary[word] for word in own], "<u4").tobytes())
            counts.append(np.array([held[word] for word in own], "<u4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary()), pa.array(counts, pa.binary())],
            names=["doc_id", "n", "terms", "counts"],
        )


def _frequencies(batches, n_terms: int) -> Iterator[pa.RecordBatch]:
    """Per task: documents that hold each term."""
    held = np.zeros(n_terms, np.int64)
    for batch in batches:
        found = np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<u4")
        held += np.bincount(found, minlength=n_terms)
    own = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(held[own])], names=["term", "df"])


@dataclass
class Tile:
    """Some items over their own terms: ``columns`` gives a term's column, ``rows`` the items as ones and zeros."""

    items: np.ndarray
    own: np.ndarray
    n_terms: int
    incidence: np.ndarray

    @property
    def columns(self) -> np.ndarray:
        columns = np.full(self.n_terms, -1, np.int32)
        columns[self.own] = np.arange(len(self.own))
        return columns


def item_tiles(item_terms: list[list[int]], n_terms: int) -> list[Tile]:
    tiles = []
    for start in range(0, len(item_terms), ITEM_TILE):
        part = item_terms[start : start + ITEM_TILE]
        own = np.unique(np.concatenate([np.array(one, np.int64) for one in part] or [np.zeros(0, np.int64)]))
        incidence = np.zeros((len(part), len(own)), bool)
        for k, one in enumerate(part):
            incidence[k, np.searchsorted(own, one)] = True
        tiles.append(Tile(np.arange(start, start + len(part), dtype=np.int32), own, n_terms, incidence))
    return tiles


def weights_of(frequency: np.ndarray, n_documents: int) -> np.ndarray:
    """Weight of each term; terms in no document never score."""
    return np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)


def tile_scores(
    incidence: np.ndarray, row: np.ndarray, column: np.ndarray, impact: np.ndarray, n_documents: int, largest: int
) -> np.ndarray:
    """Items x documents: whole-number scores from a float64 ``incidence`` and the impacts at (document row, term column).

    No impact is above ``largest``; a negative column is none. Some columns at a time are spread out as a dense tile.
    """
    wide = max(1, min(TERM_TILE, EXACT // max(1, largest)))
    scores = np.zeros((len(incidence), n_documents), np.int64)
    for k in range(0, incidence.shape[1], wide):
        part = incidence[:, k : k + wide]
        own = (column >= k) & (column < k + wide)
        impacts = np.zeros((n_documents, part.shape[1]))
        impacts[row[own], column[own] - k] = impact[own]
        scores += (part @ impacts.T).astype(np.int64)
    return scores


class Best:
    """The best documents of each item of a tile so far: highest scores, ties by ascending doc_id, null ids last."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.least = np.ones(n_items, np.int64)
        nothing = np.zeros(0, np.int64)
        self.item, self.score, self.missing, self.doc_id = nothing, nothing, nothing.astype(bool), nothing

    def add(self, scores: np.ndarray, doc_ids: np.ndarray, missing: np.ndarray) -> None:
        if scores.shape[1] > self.top:
            # Every document that equals an item's last place stays until the ids decide.
            last = np.partition(scores, scores.shape[1] - self.top, axis=1)[:, scores.shape[1] - self.top]
            self.least = np.maximum(self.least, last)
        item, column = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        self.item = np.concatenate([self.item, item])
        self.score = np.concatenate([self.score, scores[item, column]])
        self.missing = np.concatenate([self.missing, missing[column]])
        self.doc_id = np.concatenate([self.doc_id, doc_ids[column]])
        order = np.lexsort((self.doc_id, self.missing, -self.score, self.item))
        self.item = self.item[order]
        place = np.arange(len(order)) - np.searchsorted(self.item, self.item)
        order = order[place < self.top]
        self.item = self.item[place < self.top]
        self.score, self.missing, self.doc_id = self.score[order], self.missing[order], self.doc_id[order]
        full = np.flatnonzero(place[place < self.top] == self.top - 1)
        self.least[self.item[full]] = np.maximum(self.least[self.item[full]], self.score[full])


def _ranked(batches, tiles: list[Tile], weights: np.ndarray, n_documents: int, n_all_terms: int, top: int) -> Iterator[pa.RecordBatch]:
    best = [Best(len(tile.items), top) for tile in tiles]
    columns = [tile.columns for tile in tiles]
    incidences = [tile.incidence.astype(np.float64) for tile in tiles]
    largest = int(weights.max(initial=0)) * 1_000_000
    for whole in batches:
        for start in range(0, whole.num_rows, DOCUMENT_TILE):
            batch = whole.slice(start, DOCUMENT_TILE)
            missing = np.array(batch.column("doc_id").is_null())
            doc_ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            parts = batch.column("terms").to_pylist()
            found = np.frombuffer(b"".join(parts), "<u4").astype(np.int64)
            tf = np.frombuffer(b"".join(batch.column("counts").to_pylist()), "<u4").astype(np.int64)
            row = np.repeat(np.arange(len(parts)), [len(part) // 4 for part in parts])
            # In whole numbers of any size: 90 * n * N may pass 64 bits for very long texts in very large tables.
            m = np.array([10 + 90 * n * n_documents // n_all_terms for n in batch.column("n").to_pylist()], np.int64)
            impact = weights[found] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
            for column, incidence, own in zip(columns, incidences, best):
                own.add(tile_scores(incidence, row, column[found], impact, len(parts), largest), doc_ids, missing)
    task = TaskContext.get().partitionId()
    for tile, own in zip(tiles, best):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(tile.items[own.item], pa.int32()),
                pa.array(own.doc_id, pa.int64(), mask=own.missing),
                pa.array(own.score, pa.int64()),
                pa.array(np.full(len(own.item), task, np.int32)),
            ],
            names=["item", "doc_id", "score", "task"],
        )


def _best_of(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= top)


def _search_group(documents: DataFrame, items: list, top: int) -> DataFrame:
    """Ranks for the given rows ``item_id, text``, a number of them that fits the driver and every worker."""
    spark = documents.sparkSession
    vocabulary: dict[bytes, int] = {}
    item_terms = [
        sorted({vocabulary.setdefault(word, len(vocabulary)) for word in terms((row["text"] or "").encode())}) for row in items
    ]
    matched = map_batches(documents.select("doc_id", "text"), _matched, MATCHED, vocabulary=vocabulary)
    matched = materialise(matched, "lexical_matched")
    sums = matched.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("all")).first()
    frequency = np.zeros(len(vocabulary), np.int64)
    held = map_batches(matched.select("terms"), _frequencies, "term int, df long", n_terms=len(vocabulary))
    for row in held.groupBy("term").agg(F.sum("df").alias("df")).collect():
        frequency[row["term"]] = row["df"]
    made = map_batches(
        matched, _ranked, RANKED, tiles=item_tiles(item_terms, len(vocabulary)), weights=weights_of(frequency, sums["n"]),
        n_documents=sums["n"], n_all_terms=sums["all"], top=top,
    )
    near = _best_of(made.withColumn("task", F.floor(F.col("task") / MERGED_TASKS)), ["item", "task"], top)
    ranked = _best_of(near.select("item", "doc_id", "score"), ["item"], top)
    names = spark.createDataFrame([(k, row["item_id"]) for k, row in enumerate(items)], "of int, item_id long")
    return ranked.join(F.broadcast(names), F.col("item") == F.col("of")).select("item_id", "rank", "doc_id", "score")


def search(documents: DataFrame, items: DataFrame, top: int = TOP, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's ``top`` highest-scoring documents with a score above 0.

    ``documents`` has ``doc_id, text``, ``items`` has ``item_id, text``; further columns are ignored. Terms are runs of
    ASCII letters and digits and all characters beyond ASCII, A-Z in lower case. Equal scores rank by ascending doc_id, a
    null id last. A document row without terms counts nowhere; rows with equal ids are documents of their own. Equal
    item rows are one item; different texts under one item_id are ranked each on its own, under that id. Items without
    terms, and empty tables, give no rows.
    """
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    wanted = materialise(wanted, "lexical_items")
    size = wanted.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    found = []
    for group in range(groups):
        own = wanted.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group).orderBy("item_id", "text")
        found.append(_search_group(documents, own.collect(), top))
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out
