"""Fingerprints, anchors, links and components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from climate_lake.llm import simhash
from climate_lake.llm.components import components
from climate_lake.llm.queries import op7_simhash

WORD = st.integers(0, 2**64 - 1)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(one, 42) for one in shingles]
    return sum(1 << bit for bit in range(64) if hashes and 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, most=2):
    """Smallest position each position is linked to, by chains of at most ``most`` differing bits."""
    words, root = np.array(prints, np.uint64), list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k in range(len(words)):
        for other in np.flatnonzero(np.bitwise_count(words[k + 1 :] ^ words[k]) <= most) + k + 1:
            a, b = find(k), find(int(other))
            root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(words))]


def expected(rows):
    prints = [plain_fingerprint(row[1]) for row in rows]
    found = plain_components(prints)
    least = {}
    for row, k in zip(rows, found):
        if row[0] is not None:
            least[k] = min(row[0], least.get(k, row[0]))
    return sorted([(row[0], f"{p:016x}", least.get(k)) for row, p, k in zip(rows, prints, found)], key=repr)


def test_table(spark, sample, sf_dir):
    _, rows = sample
    got = [tuple(row) for row in op7_simhash(spark, sf_dir).collect()]
    assert sorted(got, key=repr) == expected(rows)
    assert any(row[0] != row[2] for row in got)


def test_odd_rows(odd_documents, empty_documents):
    frame, rows = odd_documents
    got = simhash.near_duplicates(frame).collect()
    assert sorted([tuple(row) for row in got], key=repr) == expected(rows)
    assert simhash.near_duplicates(empty_documents).count() == 0


@settings(max_examples=200, deadline=None)
@given(WORD, st.sets(st.integers(0, 63), max_size=2))
def test_words_within_the_threshold_share_an_anchor(word, bits):
    other = word
    for bit in bits:
        other ^= 1 << bit
    own = [set(simhash.anchors(np.array([x], np.uint64)[:, None] ^ simhash.ball(1)).ravel().tolist()) for x in (word, other)]
    assert own[0] & own[1]


@settings(max_examples=100, deadline=None)
@given(WORD)
def test_an_anchor_is_within_the_covering_radius(word):
    anchor = int(simhash.anchors(np.array([word], np.uint64))[0])
    differing = anchor ^ word
    assert not differing >> 63 and all((differing >> 7 * block & 127).bit_count() <= 1 for block in range(9))


@pytest.mark.parametrize("direct", [simhash.DIRECT, 1])
@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_links_of_clusters(spark, direct, most):
    rng = random.Random(most)
    prints = set()
    for _ in range(12):
        word = rng.getrandbits(64)
        for _ in range(30):
            prints.add(word)
            for _ in range(rng.randint(1, 3)):
                word ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    linked = simhash.link_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long"), most, direct).collect()
    root = {row["node"]: row["root"] for row in linked}
    groups = {}
    for k, one in enumerate(plain_components(prints, most)):
        groups.setdefault(one, set()).add(signed[k])
    for own in groups.values():
        assert {root.get(x, x) for x in own} == {min(own)}


def test_components_of_a_long_chain(spark):
    rng = random.Random(2)
    names = list(range(300))
    rng.shuffle(names)
    edges = [(a, b) for a, b in zip(names, names[1:])] + [(1000, 1001), (1001, 1002), (5000, 5000)]
    found = {tuple(row) for row in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {(k, 0) for k in range(1, 300)} | {(1001, 1000), (1002, 1000)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_long_text_in_parts():
    text = " ".join(f"w{k * k % 7919}" for k in range(70_000))
    assert simhash.fingerprint(text.encode()) % 2**64 == plain_fingerprint(text)
