"""Cuts, forms and round trips of the fill-in-middle transformation against a brute-force form."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from climate_lake.llm import fill_middle as fim
from climate_lake.llm import queries
from tests import compare

LETTERS = st.text(alphabet="abZ é日🙂\n\t1<P>", max_size=400)


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_table(spark, sf_dir, sample, duck):
    frame, rows = sample
    assert ordered(fim.fill_in_middle(frame).collect()) == ordered(plain(row[0], row[1]) for row in rows)
    duck.sql(f"create or replace view documents as select * from read_parquet('{sf_dir}/documents.parquet')")
    found = queries.op11_fill_middle(spark, sf_dir)
    assert compare.difference(found, duck, queries.oracle_sql()["op11_fill_middle"]) is None
    assert {row["form"] for row in found.collect()} == {"plain", "psm", "spm"}


def test_odd_rows(odd_documents, empty_documents):
    frame, rows = odd_documents
    made = fim.fill_in_middle(frame)
    assert ordered(made.collect()) == ordered(plain(row[0], row[1]) for row in rows)
    back = made.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert ordered(back) == ordered((row[0], row[1] or "") for row in rows)
    assert fim.fill_in_middle(empty_documents).count() == 0


def test_marks_in_pieces_come_back(documents):
    texts = ["a<P b<S c<M d", "<<<", "x<P" * 9, "P>S>M>" * 7, "<M", "a<P>b", "word<S>word"]
    rows = [(k, text) for k, text in enumerate(texts * 12)]
    made = fim.fill_in_middle(documents(*rows))
    back = made.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert ordered(back) == ordered(rows)
    assert {row["form"] for row in made.collect()} == {"plain", "psm", "spm"}


@settings(max_examples=300, deadline=None)
@given(st.lists(LETTERS, max_size=4), st.integers(1, 60))
def test_places_whatever_the_chunks(texts, most):
    texts = [text.encode() for text in texts]
    before, fim.MOST = fim.MOST, max(most, 4)
    try:
        ends = fim.chunk_ends(texts)
    finally:
        fim.MOST = before
    cache = fim.ChunkCache(200)
    for text, own in zip(texts, ends):
        assert own == sorted(set(own)) and (own[-1] if own else 0) == len(text)
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text.decode())
        counted = fim.Counted(text, own, cache)
        assert counted.n == len(units)
        for k in range(len(units) + 1):
            left = "".join(units[:k])
            assert counted.place(k) == (len(left.encode()), len(left))


def test_shared_passages_fall_into_the_same_chunks():
    passage = b" ".join(b"word%d" % (k * 7919 % 10007) for k in range(5000))
    one, other = b"first head " + passage, b"a quite different and longer head, " * 9 + passage
    chunks = []
    for text, ends in zip((one, other), fim.chunk_ends([one, other])):
        chunks.append({text[a:b] for a, b in zip([0, *ends], ends)})
    assert len(chunks[0] & chunks[1]) > 0.9 * len(chunks[0]) > 10
    assert fim.chunk_ends([one])[0] == fim.chunk_ends([other, one])[1]


def test_a_cached_summary_is_checked_by_content(monkeypatch):
    monkeypatch.setattr(fim.xxhash, "xxh3_64_intdigest", lambda chunk: 0)
    cache = fim.ChunkCache()
    assert cache.summary(b"one two") == (3, 7, True, True)
    assert cache.summary(b"1") == (1, 1, False, False)
    assert cache.summary(b"one two") == (3, 7, True, True)


@pytest.mark.parametrize("bound", [1, 10_000])
def test_cache_stays_bounded(bound):
    cache = fim.ChunkCache(bound)
    for k in range(2000):
        cache.summary(b"chunk %d" % k)
        assert cache.held <= bound + 20
