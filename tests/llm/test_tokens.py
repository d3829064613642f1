"""Encoder, token files and packing against the library and plain arithmetic."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from climate_lake.llm import packing, token_files
from climate_lake.llm.queries import op1_token_files, op2_best_fit_packing, tokenizer
from climate_lake.llm.tokens import Encoder, encoder

END, SEPARATOR = (np.array([one], "<u4").tobytes() for one in (2, 0))


def ids_of(rows):
    return dict(zip([row[0] for row in rows], encoder(tokenizer())._whole([row[1] or "" for row in rows])))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=5))
def test_memo_equals_the_library(texts):
    assert encoder(tokenizer())(texts) == encoder(tokenizer())._whole(texts)


@pytest.mark.parametrize(
    "text", ["<|endoftext|> A<|ENDOFTEXT|>", "it's we'LL 'sat", "x² ¼ y_z", "ΑΣ ΑΣ. İstanbul", "a\x1cb c\x85d\xa0e", "é ́x", "ñ_é__!"]
)
def test_odd_words(text):
    assert encoder(tokenizer())([text]) == encoder(tokenizer())._whole([text])


def test_full_memo_stays_right(monkeypatch):
    monkeypatch.setattr("climate_lake.llm.tokens.MEMO_WORDS", 20)
    own, texts = Encoder(tokenizer()), [f"word{k} of many{k % 7}" for k in range(100)]
    assert own(texts) == own._whole(texts)
    assert len(own.memo) <= 100


def test_closing_marks_are_words_of_their_own():
    own, texts = Encoder(tokenizer()), ["Arbre. arbre, arbre!\nárbol; árbol", None, " ", "x1: arbre.. 'arbre?", "日 arbre."]
    assert own(texts) == own._whole([text or "" for text in texts])
    assert set(own.memo) == {"arbre", "árbol", "x1", *".,!;:?", "arbre..", "'arbre", "日", "arbre."}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 50_000), max_size=700), st.sampled_from([50.0, 90.0, 100.0]))
def test_pack_round_trip(ids, percentile):
    values = np.array(ids, np.uint32)
    assert token_files.unpack_ids(token_files.pack_ids(values, percentile), len(ids)).tolist() == ids


def test_outliers_go_to_the_exception_list():
    values = np.arange(128, dtype=np.uint32)
    values[7] = 4_000_000_000
    data = token_files.pack_ids(values)
    index = np.frombuffer(data, token_files.INDEX, 1)[0]
    assert (index["width"], index["exceptions"]) == (7, 1)
    assert len(data) < 128 + 40


def test_token_files_of_the_table(spark, sample, sf_dir):
    _, rows = sample
    ids, start, expected = ids_of(rows), 0, []
    for name in sorted(ids):
        data = ids[name] + END
        expected.append((name, start, len(data) // 4, zlib.crc32(data)))
        start += len(data) // 4
    assert sorted(map(tuple, op1_token_files(spark, sf_dir).collect())) == expected


def test_small_segments_give_the_same(spark, sample):
    frame, _ = sample
    small = token_files.encode_documents(frame, tokenizer(), segment_ids=500, percentile=75)
    assert sorted(small.collect()) == sorted(token_files.encode_documents(frame, tokenizer()).collect())


def test_token_files_of_odd_rows(odd_documents, empty_documents):
    frame, rows = odd_documents
    found = token_files.encode_documents(frame, tokenizer()).orderBy("start").collect()
    assert len(found) == len(rows)
    assert [row["doc_id"] for row in found][:3] == [None, None, None]
    starts = np.cumsum([0, *[row["n_tokens"] for row in found]])[:-1]
    assert [row["start"] for row in found] == starts.tolist()
    assert {row["n_tokens"] for row in found if row["doc_id"] in (1, 2)} == {1}
    assert token_files.encode_documents(empty_documents, tokenizer()).count() == 0


def check_packing(found, rows, capacity=2048):
    places = defaultdict(list)
    for row in found:
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    expected = []
    for name, text, *_ in rows:
        data = encoder(tokenizer())([text])[0] + SEPARATOR
        for k in range(0, len(data), 4 * capacity):
            own = data[k : k + 4 * capacity]
            expected.append((name, k // (4 * capacity), k // 4, len(own) // 4, zlib.crc32(own)))
    plain = [tuple(row[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for row in found]
    if found and "ids" in found[0]:
        assert all(zlib.crc32(row["ids"]) == row["ids_crc32"] and len(row["ids"]) == 4 * row["length"] for row in found)
    assert sorted(plain, key=repr) == sorted(expected, key=repr)
    return len(places)


def test_packing_of_the_table(spark, sample, sf_dir):
    _, rows = sample
    found = op2_best_fit_packing(spark, sf_dir).collect()
    sequences = check_packing(found, rows)
    assert sequences <= 1.03 * -(-sum(row["length"] for row in found) // 2048) + 1


def test_packing_of_odd_rows(odd_documents, empty_documents):
    frame, rows = odd_documents
    found = packing.pack_documents(frame, tokenizer()).collect()
    check_packing(found, rows)
    assert "ids" in found[0]
    assert packing.pack_documents(empty_documents, tokenizer()).count() == 0


@pytest.mark.parametrize("most", [1, 3, 50])
def test_bins_follow_the_rules(most):
    """Against a list of open bins: tightest fit, else a new bin; if too many are open, the fullest closes."""
    rng, bins, opened, made = random.Random(most), packing.OpenBins(100, most), [], 0
    for _ in range(3000):
        length = rng.randint(1, 100)
        got = bins.place(length)
        fitting = [one for one in opened if one[0] >= length]
        if fitting:
            tightest = min(one[0] for one in fitting)
            assert got in [(name, 100 - tightest) for free, name in fitting if free == tightest]
            opened.remove((tightest, got[0]))
            left = tightest - length
        else:
            assert got == (made, 0)
            made, left = made + 1, 100 - length
        if left:
            if len(opened) == most:
                fullest = min(one[0] for one in opened)
                closed = [name for free, name in opened if free == fullest and name not in sum(bins.bins.values(), [])]
                opened.remove((fullest, closed[0]))
            opened.append((left, got[0]))
        assert sorted(sum(bins.bins.values(), [])) == sorted(name for _, name in opened)
