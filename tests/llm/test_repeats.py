"""Repeat removal against a plain set of all strings seen before."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from climate_lake.llm import repeats
from climate_lake.llm.queries import op4_repeated_strings


def plain(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, digest) per row, documents in the given order."""
    seen, out = set(), []
    for name, text, *_ in rows:
        data = (text or "").encode()
        covered = bytearray(len(data))
        for k in range(len(data) - length + 1):
            one = data[k : k + length]
            if one in seen:
                covered[k : k + length] = b"\1" * length
            seen.add(one)
        spans = sum(1 for k, x in enumerate(covered) if x and not (k and covered[k - 1]))
        left = bytes(c for c, x in zip(data, covered) if not x)
        out.append((name, len(data), sum(covered), spans, hashlib.sha256(left).hexdigest()))
    return out


def found(frame, **options):
    rows = repeats.remove_repeats(frame, **options).collect()
    return [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in rows]


def test_table(spark, sample, sf_dir):
    _, rows = sample
    got = sorted(tuple(row) for row in op4_repeated_strings(spark, sf_dir).collect())
    assert got == plain(sorted(rows))
    assert sum(row[2] for row in got) > 0


def shared_passages():
    rng = random.Random(5)
    base = ["".join(rng.choices("abcdefgh éß", k=700)) for _ in range(4)]
    rows = []
    for name in range(80):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(700)] = rng.choice("xyzü")
        cut = rng.randrange(300)
        rows.append((name, "".join(text[cut : cut + rng.randint(50, 600)])))
    rows += [(100, "ab" * 300), (101, "abc" * 200), (102, "ab" * 250 + "c" + "ab" * 100), (103, base[0]), (104, base[0])]
    return rows


@pytest.mark.parametrize("hot", [repeats.HOT_STRETCHES, 1])
def test_passages_periods_and_hot_groups(documents, hot):
    rows = shared_passages()
    assert sorted(found(documents(*rows), hot=hot)) == plain(rows)


def test_hot_groups_merge_different_pieces_only(spark, documents):
    rng = random.Random(6)
    passage, letters = "".join(rng.choices("abcdefgh", k=400)), "".join(rng.choices("ijklmnop", k=4000))
    rows = [(k, letters[k * 40 : k * 40 + 90] + passage + letters[-90 - k * 40 : -k * 40 or None]) for k in range(40)]
    assert sorted(found(documents(*rows), hot=1)) == plain(rows)
    texts = {name: text.encode() for name, text in rows}
    spans = []
    for name, text in texts.items():
        _, _, first, n = repeats.stretches(text)
        spans += [(name, int(a), int(b), 1) for a, b in zip(first, n)]
    frame = spark.createDataFrame(list(texts.items()), "doc long, text binary")
    settled = repeats.settle_hot(frame, spark.createDataFrame(spans, "doc long, start int, n int, group long")).collect()
    asked = [(row["group"], texts[row["doc"]][row["start"] : row["start"] + row["n"] + 99]) for row in settled if row["group"] is not None]
    repeated = [row for row in settled if row["group"] is None]
    assert len(set(asked)) == len(asked) < len(repeated)
    assert max(asked.count(one) for one in asked) == 1 and len(repeated) > 39 * (301 // 4 - 2)


def test_text_parts(documents, monkeypatch):
    monkeypatch.setattr(repeats, "PART", 256)
    rows = shared_passages()
    for name, text in rows:
        if len(text.encode()) >= 100:
            _, place, first, n = repeats.stretches(text.encode())
            assert first.tolist() == np.cumsum([0, *n])[:-1].tolist()
            assert n.sum() == len(text.encode()) - 99
            assert ((place >= first + n - 1) & (place <= first + 68)).all()


def test_odd_rows(odd_documents, empty_documents):
    frame, rows = odd_documents
    got = repeats.remove_repeats(frame)
    assert [name for name in got.columns if name in ("kept", "n_bytes", "start", "h", "slot")] == ["start", "h", "slot", "kept", "n_bytes"]
    got = got.collect()
    assert len(got) == len(rows)
    assert all(row["n_removed"] == 0 for row in got if row["doc_id"] != 9 and row["doc_id"] != 3)
    text = "Licensed " * 60
    assert [row["n_removed"] for row in got if row["doc_id"] == 9] == [plain([(9, text)])[0][2]]
    assert repeats.remove_repeats(empty_documents).count() == 0


def test_equal_ids_and_null_ids(documents):
    text = "".join(random.Random(1).choices("abcdefgh", k=300))
    twice = documents((1, text), (1, text), (None, text + "z"), (2, text[50:250]))
    got = sorted(((row["doc_id"] or 0, row["n_removed"]) for row in repeats.remove_repeats(twice).collect()))
    assert got == [(0, 0), (1, 300), (1, 300), (2, 200)]
    alone = documents((1, text), (1, text))
    assert {row["n_removed"] for row in repeats.remove_repeats(alone).collect()} == {0}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=6, max_size=30), min_size=1, max_size=12), st.integers(2, 6), st.sampled_from([10, 1000]))
def test_merge_of_transforms(strings, length, shard):
    data = [one.encode() for one in strings]
    docs, starts = np.arange(len(data)), np.zeros(len(data), int)
    got = sorted(zip(*(x.tolist() for x in repeats.repeated_starts(data, docs, starts, length, shard))))
    seen, expected = set(), []
    for name, one in enumerate(data):
        for k in range(len(one) - length + 1):
            if one[k : k + length] in seen:
                expected.append((name, k))
            seen.add(one[k : k + length])
    assert got == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=20).map(lambda x: x.replace(b"\xff", b"")), min_size=1, max_size=6))
def test_transform_is_sorted_rotations(strings):
    symbols, string, place = repeats.transform(strings)
    rotations = [(one + b"\xff")[k:] + (one + b"\xff")[:k] for one in strings for k in range(len(one) + 1)]
    got = [(strings[s] + b"\xff")[k:] + (strings[s] + b"\xff")[:k] for s, k in zip(string, place)]
    # Rotations of different lengths are compared as endless repetitions.
    depth = max(len(one) + 1 for one in strings)
    endless = lambda one: (one * depth)[:depth]
    assert [endless(one) for one in got] == sorted(map(endless, rotations)) and sorted(got) == sorted(rotations)
    assert bytes(symbols) == bytes(one[-1] for one in got)


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=40, max_size=90), st.sampled_from([1, 2, 7, 32]))
def test_window_hashes_depend_on_content_alone(data, size):
    twice = np.frombuffer(data + data, np.uint8)
    hashes = repeats.window_hashes(twice, size)
    n = len(data) - size + 1
    assert hashes[:n].tolist() == hashes[len(data) : len(data) + n].tolist()
    assert len(set(hashes.tolist())) == len({bytes(twice[k : k + size]) for k in range(len(twice) - size + 1)})
