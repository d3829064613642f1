"""Ranks against a search that scores every document for every item."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from climate_lake.llm import lexical, queries
from tests import compare

PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {code: code + 32 for code in range(65, 91)}


def plain_terms(text):
    return PATTERN.findall((text or "").translate(LOWER))


def plain(rows, items, top=10):
    documents = [(row[0], Counter(plain_terms(row[1]))) for row in rows]
    documents = [(one, held, sum(held.values())) for one, held in documents if held]
    n, everything = len(documents), sum(size for *_, size in documents)
    df = Counter(word for _, held, _ in documents for word in held)
    found = []
    for item_id, text in sorted(set(items), key=repr):
        scores = []
        for one, held, size in documents:
            m = 100 - 90 + (90 * size * n) // everything
            score = 0
            for word in set(plain_terms(text)) & held.keys():
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[word] + 1)))
                score += weight * ((1000000000 * held[word]) // (1000 * held[word] + 8 * m))
            if score > 0:
                scores.append((-score, one is None, one or 0, one))
        found += [(item_id, k + 1, one, -score) for k, (score, *_, one) in enumerate(sorted(scores)[:top])]
    return sorted(found, key=repr)


def ordered(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_terms(text):
    assert [one.decode() for one in lexical.terms(text.encode("utf-8", "ignore"))] == plain_terms(text.encode("utf-8", "ignore").decode())


def test_table(spark, sf_dir, sample, duck):
    _, rows = sample
    items = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    found = queries.op13_ranked_search(spark, sf_dir)
    assert ordered(found) == plain(rows, items)
    for name in ("documents", "benchmark"):
        duck.sql(f"create or replace view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    assert compare.difference(found, duck, queries.oracle_sql()["op13_ranked_search"]) is None


@pytest.mark.parametrize("tiles", [(64, 1024, 4096), (2, 3, 2)])
@pytest.mark.parametrize("group_bytes", [lexical.GROUP_BYTES, 60])
def test_odd_rows(spark, odd_documents, empty_documents, monkeypatch, tiles, group_bytes):
    for name, size in zip(("ITEM_TILE", "DOCUMENT_TILE", "TERM_TILE"), tiles):
        monkeypatch.setattr(lexical, name, size)
    frame, rows = odd_documents
    items = [(1, "word7 WORD9 wörd9"), (2, "same line there"), (2, "licensed"), (3, None), (4, "?!"), (1, "word7 WORD9 wörd9"),
             (None, "id no there"), (5, "nowhere"), (6, " ".join(f"word{k}" for k in range(400)))]
    table = spark.createDataFrame([(*item, "own") for item in items], "item_id long, text string, score string")
    got = ordered(lexical.search(frame, table, group_bytes=group_bytes))
    assert got == plain(rows, [(item, text or "") for item, text in items])
    assert lexical.search(empty_documents, table).count() == 0
    assert lexical.search(frame, table.limit(0)).count() == 0


def test_ties_go_to_small_ids_across_tiles_and_tasks(documents, spark, monkeypatch):
    monkeypatch.setattr(lexical, "DOCUMENT_TILE", 7)
    rows = [(k * 7919 % 400, "apple pear") for k in range(400)] + [(None, "apple pear")] * 3 + [(900 + k, "plum") for k in range(900)]
    table = spark.createDataFrame([(1, "apple"), (2, "plum pear")], "item_id long, text string")
    assert ordered(lexical.search(documents(*rows).repartition(16), table)) == plain(rows, [(1, "apple"), (2, "plum pear")])


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([1, 7, 4096]))
def test_products_are_exact_near_the_bound(seed, wide):
    rng = np.random.default_rng(seed)
    largest = 43_000_000_000
    incidence, impacts = rng.integers(0, 2, (3, 40)), rng.integers(0, largest + 1, (5, 40))
    before, lexical.TERM_TILE = lexical.TERM_TILE, wide
    try:
        row, column = np.divmod(np.arange(200), 40)
        got = lexical.tile_scores(incidence.astype(float), row, column, impacts.ravel(), 5, largest)
    finally:
        lexical.TERM_TILE = before
    assert (got == incidence @ impacts.T).all()
    huge = (1 << 53) - 1
    got = lexical.tile_scores(np.ones((1, 3)), np.zeros(4, int), np.array([0, 1, 2, -1]), np.full(4, huge), 1, huge)
    assert got.tolist() == [[3 * huge]]
