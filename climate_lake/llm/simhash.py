"""SimHash near-duplicates by anchor-point covering.

Anchors are a covering code of 64-bit words: nine blocks of seven bits, each a word of the perfect Hamming code, and one
free bit. Every block is within one bit of exactly one code word, so every word has exactly one anchor in its covering
radius, and finding it takes nine table look-ups. Two fingerprints within the threshold t share a word within t / 2
(rounded up) bits of both; that word's anchor is in covering radius plus t / 2 of both. So each fingerprint is replicated
to the anchors of all words within t / 2 bits of it (26 or so for t = 2, of 2^37): the part of the ball of covering
radius plus threshold that a pair needs to meet. Fingerprints are compared per anchor, exactly. No link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climate_lake.llm.common import map_batches, small_batches
from climate_lake.llm.components import components
from climate_lake.session import materialise

SHINGLE = 3
SEED = 42
MAX_BITS = 2
# Fingerprints of one anchor compared directly; beyond, links are found through shared words, in linear work.
DIRECT = 8192


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of unsigned 64-bit hashes, as a signed integer; 0 without any."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text, as a signed integer; 0 for a text without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        spans = zip(starts[k : min(n, k + (1 << 16))].tolist(), last[k : k + (1 << 16)].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(batches, shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        prints = pa.array([fingerprint(text, shingle) for text in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints], names=["doc_id", "fp"])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` for each row; null texts have no words."""
    return map_batches(documents.select("doc_id", "text"), _fingerprints, "doc_id long, fp long", shingle=shingle)


def _hamming_decoder() -> np.ndarray:
    """The code word within one bit of each seven-bit word, by the syndrome of positions 1 to 7."""
    decoded = np.zeros(128, np.uint64)
    for word in range(128):
        syndrome = 0
        for bit in range(7):
            if word >> bit & 1:
                syndrome ^= bit + 1
        decoded[word] = word ^ (1 << syndrome - 1) if syndrome else word
    return decoded


_DECODED = _hamming_decoder()


def anchors(words: np.ndarray) -> np.ndarray:
    """The anchor in whose covering radius each word lies."""
    found = words & np.uint64(1 << 63)
    for block in range(9):
        shift = np.uint64(7 * block)
        found |= _DECODED[((words >> shift) & np.uint64(127)).astype(np.intp)] << shift
    return found


def ball(radius: int) -> np.ndarray:
    """All words with at most ``radius`` bits."""
    bits = [sum(1 << place for place in own) for n in range(radius + 1) for own in combinations(range(64), n)]
    return np.array(bits, np.uint64)


def _replicas(batches, radius: int) -> Iterator[pa.RecordBatch]:
    masks = ball(radius)
    for batch in batches:
        prints = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        for part in np.array_split(prints, max(1, len(prints) * len(masks) // 1_000_000)):
            found = np.sort(anchors(part.view(np.uint64)[:, None] ^ masks), axis=1)
            new = np.ones(found.shape, bool)
            new[:, 1:] = found[:, 1:] != found[:, :-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[new].view(np.int64)), pa.array(np.repeat(part, new.sum(axis=1)))], names=["anchor", "fp"]
            )


def _star_edges(prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of at most ``most`` bits that connect what all such links connect, one per fingerprint that isn't a smallest."""
    words, left = prints.view(np.uint64), np.arange(len(prints))
    first: list[np.ndarray] = []
    other: list[np.ndarray] = []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near, linked = np.zeros(len(left), bool), np.zeros(len(left), np.int64)
            for one in front:
                new = (np.bitwise_count(words[left] ^ words[one]) <= most) & ~near
                linked[new] = prints[one]
                near |= new
            first.append(linked[near])
            front, left = left[near], left[~near]
            other.append(prints[front])
    return _concatenated(first), _concatenated(other)


def _shared_word_edges(prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges between neighbours among the fingerprints that share a word within half the threshold, in linear work."""
    masks = ball(-(-most // 2))
    first: list[np.ndarray] = []
    other: list[np.ndarray] = []
    words = (prints.view(np.uint64)[:, None] ^ masks).reshape(-1)
    who = np.repeat(np.arange(len(prints)), len(masks))
    order = np.argsort(words, kind="stable")
    words, who = words[order], who[order]
    same = np.flatnonzero(words[1:] == words[:-1])
    close = np.bitwise_count((prints[who[same]] ^ prints[who[same + 1]]).view(np.uint64)) <= most
    first.append(prints[who[same]][close])
    other.append(prints[who[same + 1]][close])
    return _concatenated(first), _concatenated(other)


def _concatenated(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([*parts, np.zeros(0, np.int64)])


def _links(batches, most: int, direct: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor: edges among the fingerprints of each."""
    at, held = None, []

    def compared(groups: list[np.ndarray]) -> pa.RecordBatch:
        edges = [(np.zeros(0, np.int64),) * 2]
        for prints in groups:
            # With an odd threshold, fingerprints that share a word may lie farther apart: compared directly.
            few = len(prints) <= direct or most % 2
            edges.append(_star_edges(prints, most) if few else _shared_word_edges(prints, most))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(one)) for one in zip(*edges)], names=["u", "v"])

    for batch in batches:
        spots = batch.column("anchor").to_numpy(zero_copy_only=False)
        prints = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = [0, *(np.flatnonzero(spots[1:] != spots[:-1]) + 1).tolist(), len(spots)]
        groups: list[np.ndarray] = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b and spots[a] != at:
                if sum(map(len, held)) > 1:
                    groups.append(np.concatenate(held))
                at, held = spots[a], []
            held.append(prints[a:b])
        yield compared(groups)
    if sum(map(len, held)) > 1:
        yield compared([np.concatenate(held)])


def near_fingerprints(prints: DataFrame, most: int = MAX_BITS, direct: int = DIRECT) -> DataFrame:
    """``u, v``: links of at most ``most`` bits between distinct fingerprints ``fp`` that connect what all such links connect."""
    replicas = map_batches(prints.select("fp"), _replicas, "anchor long, fp long", radius=-(-most // 2))
    by_anchor = replicas.repartition("anchor").sortWithinPartitions("anchor", "fp")
    return map_batches(by_anchor, _links, "u long, v long", most=most, direct=direct)


def link_fingerprints(prints: DataFrame, most: int = MAX_BITS, direct: int = DIRECT) -> DataFrame:
    """``node, root`` of distinct fingerprints ``fp`` that chains of links of at most ``most`` bits connect."""
    return components(near_fingerprints(prints, most, direct))


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``documents``.

    The component is the smallest doc_id reachable by links (null if all its doc_ids are null). Texts without words,
    null and empty ones included, have fingerprint zero and are linked like any other. Repeated rows stay repeated.
    """
    rows = materialise(fingerprints(documents, shingle), "fingerprints")
    groups = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint_groups")
    roots = materialise(link_fingerprints(groups, most), "fingerprint_roots")
    rooted = groups.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("fp").alias("of"), "component_id")
    return rows.join(named, F.col("fp") == F.col("of")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
