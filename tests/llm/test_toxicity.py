"""Held-out accuracy, the label model's estimates, and odd input."""

from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from climate_lake.llm import toxicity
from climate_lake.llm.queries import op10_toxicity


def made(n=3000, seed=3):
    """Documents in which toxic ones hold words of a lexicon or with a common beginning."""
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        toxic = k % 8 == 0
        words = ["".join(rng.choices("aeioubdfg", k=rng.randint(2, 7))) for _ in range(rng.randint(20, 120))]
        if toxic and rng.random() < 0.7:
            words[rng.randrange(len(words))] = rng.choice(["vilest", "nastyish", "horridly"])
            words[rng.randrange(len(words))] = rng.choice(["vilest", "nastyish", "horridly"]).upper() + "!"
        elif toxic:
            words += ["zorch" + "".join(rng.choices("aeiou", k=3)) for _ in range(3)]
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return rows, labels


def test_held_out_documents(spark, documents):
    rows, labels = made()
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(documents(*rows), frame)
    found = {row["doc_id"]: row for row in toxicity.score_documents(documents(*rows), model).collect()}
    out = [(found[k], label) for k, label in labels if zlib.crc32(str(k).encode()) % 4 == 2]
    assert all(row["held_out"] for row, _ in out) and len(out) == sum(row["held_out"] for row in found.values())
    right = np.mean([row["predicted"] == label for row, label in out])
    assert right > 0.98
    assert any(one == "zorc*" or one.startswith("zorch") for one in model.weights) and "vilest" in model.weights


def test_labels_of_held_out_rows_are_never_used(spark, documents):
    rows, labels = made(800)
    turned = [(k, 1 - label if zlib.crc32(str(k).encode()) % 4 == 2 else label) for k, label in labels]
    scores = []
    for own in (labels, turned):
        model = toxicity.train(documents(*rows), spark.createDataFrame(own, "doc_id long, toxic int"))
        scores.append([tuple(row) for row in toxicity.score_documents(documents(*rows), model).orderBy("doc_id").collect()])
    assert scores[0] == scores[1]


def test_label_model_finds_accuracies_and_discounts_copies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    fires = np.array([0.8, 0.6, 0.5, 0.7])
    noise = np.array([0.05, 0.1, 0.02, 0.1])
    votes = (rng.random((20_000, 4)) < np.where(truth[:, None], fires, noise)).astype(np.float32)
    start = np.where(votes.sum(axis=1) >= 2, 0.8, 0.1)
    posterior, rates = toxicity.label_model(votes, start, rounds=100)
    assert np.abs(rates[1] - fires).max() < 0.05 and np.abs(rates[0] - noise).max() < 0.05
    copied = np.concatenate([votes, votes[:, 1:2], votes[:, 1:2], votes[:, 1:2]], axis=1)
    again, _ = toxicity.label_model(copied, start, rounds=100)
    assert np.mean((again > 0.5) == truth) > np.mean((posterior > 0.5) == truth) - 0.03


def test_marks_that_all_voters_contradict_are_overruled(spark, documents):
    rows, labels = made(4000)
    rng = random.Random(5)
    turned = {k for k, label in labels if rng.random() < 0.05}
    wrong = [(k, 1 - label if k in turned else label) for k, label in labels]
    frame = spark.createDataFrame(wrong, "doc_id long, toxic int")
    model = toxicity.train(documents(*rows), frame)
    assert model.overruled > 20
    found = {row["doc_id"]: row["predicted"] for row in toxicity.score_documents(documents(*rows), model).collect()}
    out = [k for k, _ in labels if zlib.crc32(str(k).encode()) % 4 == 2]
    assert np.mean([found[k] == dict(labels)[k] for k in out]) > 0.97


def test_one_mark_does_not_decide_alone():
    rng = np.random.default_rng(1)
    truth = rng.random(5000) < 0.2
    votes = (rng.random((5000, 6)) < np.where(truth[:, None], 0.7, 0.03)).astype(np.float32)
    marked = np.where(rng.random(5000) < 0.1, ~truth, truth).astype(float)
    plain, _ = toxicity.label_model(votes, 0.02 + 0.96 * marked, rounds=1)
    joined = toxicity.with_marks(plain, marked)
    assert np.mean((joined > 0.5) == truth) > 0.97 > np.mean(marked == truth)
    silent = (votes.sum(axis=1) == 0) & (marked == 1)
    assert silent.any() and (joined[silent] < 0.5).all()


def test_recall_on_held_out_rows(spark):
    """0.9 of the toxic documents, and nearly no clean one."""
    folder = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.train(documents, labels)
    scored = toxicity.score_documents(documents, model).filter("held_out").join(labels, "doc_id").filter("toxic is not null")
    counts = {(row["toxic"], row["predicted"]): row["count"] for row in scored.groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] >= 0.9 * (counts[1, 1] + counts[1, 0])
    assert counts.get((0, 1), 0) <= 0.01 * counts[0, 0]


def test_table(spark, sf_dir, sample):
    _, rows = sample
    found = op10_toxicity(spark, sf_dir).collect()
    assert sorted(row["doc_id"] for row in found) == sorted(row[0] for row in rows)
    for row in found:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.3)


def test_odd_rows(spark, odd_documents, empty_documents):
    frame, rows = odd_documents
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (4, 0), (9, 1)], "doc_id long, toxic int")
    found = toxicity.score_documents(frame, toxicity.train(frame, labels)).collect()
    assert len(found) == len(rows)
    assert len({row["score"] for row in found if row["doc_id"] in (1, 2)}) == 1
    assert not any(row["held_out"] for row in found if row["doc_id"] is None)
    none = labels.filter("doc_id = 4")
    assert {row["predicted"] for row in toxicity.score_documents(frame, toxicity.train(frame, none)).collect()} == {0}
    assert toxicity.score_documents(empty_documents, toxicity.train(empty_documents, labels)).count() == 0
    assert frame.select(toxicity.held_out(F.lit(None).cast("long")).alias("x")).first()["x"] is False
