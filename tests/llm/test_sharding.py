"""Shards against a plain search over all groups."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from climate_lake.llm import queries, sharding


def fits(sizes, capacity, shards):
    used, room = 0, 0
    for size in sizes:
        if size > capacity:
            return False
        if size > room:
            used, room = used + 1, capacity
        room -= size
    return used <= shards


def least(sizes, shards):
    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(sizes, middle, shards) else (middle + 1, high)
    return low


def refine_from(keys, sizes):
    """What one aggregation over the groups gives, on arrays."""

    def blocks_of(chosen, shift):
        names = keys[chosen] >> shift
        rows = [(keys[chosen][names == name], sizes[chosen][names == name]) for name in np.unique(names)]
        return [np.array(x) for x in zip(*[(own.min(), own.max(), size.sum(), shift) for own, size in rows])]

    def refine(blocks, todo):
        parts = [[own[np.setdiff1d(np.arange(len(blocks.size)), todo)] for own in (blocks.first, blocks.last, blocks.size, blocks.shift)]]
        for k in todo:
            chosen = (keys >= blocks.first[k]) & (keys <= blocks.last[k])
            parts.append(blocks_of(chosen, max(0, int(blocks.shift[k]) - sharding.FINER_BITS)))
        return sharding.Blocks(*[np.concatenate(x) for x in zip(*parts)])

    return sharding.Blocks(*blocks_of(np.ones(len(keys), bool), 64 - sharding.BLOCK_BITS)), refine


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(1, 12), st.integers(0, 2**32), st.sampled_from([2, 5, 14]))
def test_capacity_is_the_least_and_cuts_keep_it(n, shards, seed, bits):
    rng = random.Random(seed)
    keys = np.array(sorted({rng.randint(-(1 << 63), (1 << 63) - 1) for _ in range(n)}), np.int64)
    sizes = np.array([rng.choice([1, 3, 10, 200, rng.randint(1, 1000)]) for _ in keys], np.int64)
    before, sharding.BLOCK_BITS = sharding.BLOCK_BITS, bits
    try:
        blocks, capacity, cuts = sharding.cut_places(*[f for f in (refine_from(keys, sizes)[0], shards)], refine_from(keys, sizes)[1])
    finally:
        sharding.BLOCK_BITS = before
    assert capacity == least(sizes.tolist(), shards)
    borders = {0, *np.cumsum(sizes).tolist()}
    places = [0, *cuts, int(sizes.sum())]
    assert set(places) <= borders
    assert all(0 <= b - a <= capacity for a, b in zip(places, places[1:]))
    assert [blocks.last_key(cut) for cut in cuts] == [keys[np.searchsorted(np.cumsum(sizes), cut)] if cut else keys[0] - 1 for cut in cuts]


def test_only_few_blocks_are_cut_finer():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(-(1 << 63), (1 << 63) - 1, 200_000))
    sizes = rng.integers(16, 5000, len(keys))
    blocks, refine = refine_from(keys, sizes)
    counted = []

    def counting(now, todo):
        counted.append(len(todo))
        return refine(now, todo)

    _, capacity, cuts = sharding.cut_places(blocks, 40, counting)
    assert capacity == least(sizes.tolist(), 40)
    assert sum(counted) < 4000
    shares = np.diff([0, *cuts, int(sizes.sum())])
    assert shares.max() - shares.min() < 0.02 * shares.mean()


def check(rows, found, shards=40):
    """Whole rows, gapless slots, groups kept together, and sizes as even as groups allow."""
    expected = Counter((one, len((text or "").encode()) + 16, zlib.crc32((text or "").encode())) for one, text in rows)
    assert Counter((row["doc_id"], row["size"], row["text_crc32"]) for row in found) == expected
    slots, sizes = defaultdict(list), Counter()
    for row in found:
        assert 0 <= row["shard"] < shards and row["law"] == "bytes" and row["grown_shard"] is None
        slots[row["shard"]].append(row["slot"])
        sizes[row["shard"]] += row["size"]
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    return sizes


def test_table(spark, sf_dir):
    rows = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op12_minimax_shards(spark, sf_dir).collect()
    check(rows, found)
    places = {row["doc_id"]: row["shard"] for row in found}
    of_text = defaultdict(set)
    for one, text in rows:
        of_text[text].add(places[one])
    assert all(len(own) == 1 for own in of_text.values())


@pytest.mark.parametrize("copies", [1, 400])
def test_sizes_are_even_and_a_large_group_is_alone(spark, documents, copies):
    rng = random.Random(1)
    rows = [(k, "x" * rng.randint(1, 60) + str(k)) for k in range(2000)]
    rows += [(5000 + k, "a text with many copies, " * 8) for k in range(copies)]
    found = sharding.digests(sharding.shard_documents(documents(*rows), 8)).collect()
    sizes = check(rows, found, 8)
    hot = {row["shard"] for row in found if row["doc_id"] >= 5000}
    assert len(hot) == 1
    others = [size for shard, size in sizes.items() if copies == 1 or shard not in hot]
    assert len(others) == (8 if copies == 1 else 7)
    assert max(others) - min(others) <= 300
    if copies > 1:
        assert sizes[hot.pop()] == 216 * copies


def test_odd_rows(spark, odd_documents, empty_documents):
    frame, rows = odd_documents
    frame = frame.withColumnRenamed("h", "shard").withColumnRenamed("fp", "place")
    made = sharding.shard_documents(frame)
    assert sorted(made.columns) == sorted({*frame.columns} - {"shard"})
    found = made.collect()
    assert {(row["start"], row["slot"]) for row in found} == {("own start", "own slot")}
    check([row[:2] for row in rows], sharding.digests(made).collect())
    empty = {row["place"]["shard"] for row in found if not row["text"]}
    assert len(empty) == 1
    assert sharding.shard_documents(empty_documents).count() == 0
