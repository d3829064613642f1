"""Toxicity by weak supervision.

Voters are lexicon entries (words) and patterns (beginnings of words) that are much more frequent in documents marked
toxic. A generative label model estimates how often each voter fires on either class, with the annotators' marks as a
guide to the classes, and how votes are correlated within a class: voters that fire together share their evidence. Its
posterior comes from the votes alone; against it, the marks' own accuracy is estimated, and they join as one annotator
more, with the weight of that accuracy. So a mark that all voters contradict is overruled. The posterior labels train a
linear classifier on words and beginnings of words, which scores every text. Only labelled rows of the training part are
ever used to fit.

The fit is bounded by ``MAX_FIT_DOCS`` labelled rows. In these, every word and beginning that occurs in ``MIN_DOCS`` toxic
documents is judged by its gain; only then the ``MAX_FEATURES`` best are kept, and the ``MAX_VOTERS`` of widest reach vote.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climate_lake.llm.common import map_batches, small_batches
from climate_lake.session import materialise

THRESHOLD = 0.3
# Bounds of the fit: labelled training documents used at most (chosen by hash), features, and voters.
MAX_FIT_DOCS = 40_000
MAX_FEATURES = 20_000
MAX_VOTERS = 300
# Lengths of beginnings; a pattern is written with a star.
BEGINNINGS = (4, 5, 6)
MIN_DOCS = 4

_LETTERS = re.compile(r"[^\W\d_]+")


def text_features(text: str | None, known: frozenset[str] | None = None) -> set[str]:
    """Words of a text and beginnings of its words; with ``known`` first four letters, only of words that have them."""
    words = set(_LETTERS.findall((text or "").lower()))
    if known is not None:
        words = {word for word in words if word[:4] in known}
    found = set(words)
    for n in BEGINNINGS:
        found.update([word[:n] + "*" for word in words if len(word) >= n])
    return found


def held_out(doc_id: Column) -> Column:
    """Rows never used to learn: a remainder of a checksum of the doc_id (null: of an empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def _count_features(batches, only: frozenset[str] | None) -> Iterator[pa.RecordBatch]:
    """Documents with each feature, by label; counts are sent on whenever they get many."""
    known = None if only is None else frozenset(one.rstrip("*")[:4] for one in only)
    counts = Counter(), Counter()

    def emit() -> pa.RecordBatch:
        rows = [(one, label, n) for label in (0, 1) for one, n in counts[label].items()]
        for own in counts:
            own.clear()
        names, labels, numbers = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(labels, pa.int32()), pa.array(numbers, pa.int64())],
            names=["feature", "toxic", "n"],
        )

    for batch in small_batches(batches, "text"):
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            found = text_features(text, known)
            counts[int(toxic == 1)].update(found if only is None else found & only)
            if len(counts[0]) + len(counts[1]) > 500_000:
                yield emit()
    yield emit()


def _fired(batches, features: dict[str, int]) -> Iterator[pa.RecordBatch]:
    known, names = frozenset(one.rstrip("*")[:4] for one in features), features.keys()
    for batch in small_batches(batches, "text"):
        found = [sorted(features[x] for x in text_features(t, known) & names) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic").cast(pa.int32()), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "found"]
        )


@dataclass
class Model:
    """A linear classifier: a document's score is the logistic of the bias and the weights of its features."""

    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)
    voters: list[str] = field(default_factory=list)
    accuracies: np.ndarray | None = None
    known: frozenset[str] = frozenset()
    # Fitted rows whose label differs from their mark.
    overruled: int = 0

    def __post_init__(self):
        self.known = frozenset(one.rstrip("*")[:4] for one in self.weights)

    def score(self, text: str | None) -> float:
        total = self.bias + sum([self.weights.get(one, 0.0) for one in text_features(text, self.known)])
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 30, min_correlation: float = 0.2):
    """Posterior of class 1 per row, and firing rates per class, from 0/1 ``votes`` (rows x voters).

    ``start`` is a first guess of the posteriors. Given the class, a voter fires at an unknown rate. Correlated voters
    are not independent evidence: a voter's log likelihood ratio is divided by one plus the sum of its correlations
    within the classes, of those over ``min_correlation``.
    """
    posterior, n = start.astype(float), len(votes)
    rates = np.zeros((2, votes.shape[1]))
    for _ in range(rounds):
        share = np.clip(posterior.mean(), 1e-4, 1 - 1e-4)
        mass = np.stack([1 - posterior, posterior])
        rates = (mass @ votes + 0.01 * votes.mean(axis=0) + 1e-3) / (mass.sum(axis=1, keepdims=True) + 0.01 + 2e-3)
        rates = np.clip(rates, 1e-6, 1 - 1e-6)
        residual = votes - np.outer(posterior, rates[1]).astype(np.float32)
        residual -= np.outer(1 - posterior, rates[0]).astype(np.float32)
        spread = np.sqrt((residual**2).mean(axis=0)) + 1e-9
        correlation = np.abs(residual.T @ residual / n / np.outer(spread, spread))
        np.fill_diagonal(correlation, 0.0)
        weight = 1 / (1 + np.where(correlation > min_correlation, correlation, 0.0).sum(axis=1))
        fires = weight * (np.log(rates[1]) - np.log(rates[0]))
        silent = weight * (np.log1p(-rates[1]) - np.log1p(-rates[0]))
        logit = np.log(share / (1 - share)) + votes @ (fires - silent) + silent.sum()
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - posterior).max() < 1e-4:
            return new, rates
        posterior = new
    return posterior, rates


def with_marks(posterior: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """The voters' ``posterior`` with the marks as one annotator more, whose accuracy is estimated against it."""
    rates = [(mass @ marked + 1) / (mass.sum() + 2) for mass in (1 - posterior, posterior)]
    on, off = np.log(rates[1] / rates[0]), np.log((1 - rates[1]) / (1 - rates[0]))
    safe = np.clip(posterior, 1e-12, 1 - 1e-12)
    logit = np.log(safe / (1 - safe)) + np.where(marked > 0, on, off)
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def linear_fit(rows: list[np.ndarray], target: np.ndarray, n_features: int, rounds: int = 300, penalty: float = 1e-4):
    """Bias and weights of a logistic regression on 0/1 features with soft labels, by gradient steps (Adam)."""
    where = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    which = np.concatenate(rows) if len(where) else np.zeros(0, int)
    weights, bias = np.zeros(n_features), np.log((target.mean() + 1e-6) / (1 - target.mean() + 1e-6))
    first, second = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, rounds + 1):
        logit = bias + np.bincount(where, weights[which], len(rows))
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target) / len(rows)
        slope = np.concatenate([np.bincount(which, error[where], n_features) + penalty * weights, [error.sum()]])
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
        weights, bias = weights - move[:-1], bias - move[-1]
    return float(bias), weights


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labelled documents of the training part.

    A document with several labels is toxic if any says so; null labels are ignored. Without documents of both labels,
    the model scores every text 0.
    """
    marks = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).limit(MAX_FIT_DOCS)
    # At most MAX_FIT_DOCS short rows: sent to all tasks, so that no text is shuffled.
    fit = materialise(documents.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("text", "toxic"), "labelled")
    sizes = {row["toxic"]: row["count"] for row in fit.groupBy((F.col("toxic") == 1).cast("int").alias("toxic")).count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Model(bias=-30.0)

    # Features of the few toxic documents first; only those are looked for in the others.
    counted = map_batches(fit.filter("toxic = 1"), _count_features, "feature string, toxic int, n long", only=None)
    toxic = counted.groupBy("feature").agg(F.sum("n").alias("n1")).filter(F.col("n1") >= MIN_DOCS)
    in_toxic = {row["feature"]: row["n1"] for row in toxic.collect()}
    counted = map_batches(
        fit.filter("toxic != 1"), _count_features, "feature string, toxic int, n long", only=frozenset(in_toxic)
    )
    in_clean = {row["feature"]: row["n0"] for row in counted.groupBy("feature").agg(F.sum("n").alias("n0")).collect()}
    names = np.array(sorted(in_toxic), dtype=object)
    k1 = np.array([in_toxic[x] for x in names], float)
    k0 = np.array([in_clean.get(x, 0) for x in names], float)
    gain = np.log((k1 + 0.5) / (n1 + 1)) - np.log((k0 + 0.5) / (n0 + 1))
    noise = np.sqrt(1 / (k1 + 0.5) + 1 / (k0 + 0.5))
    order = np.lexsort((names.astype(str), -(gain - noise)))
    order = order[(gain - noise)[order] > 0.3][:MAX_FEATURES]
    if not len(order):
        return Model(bias=float(np.log(n1 / n0)))
    names, gain, k1 = names[order], gain[order], k1[order]

    features = {name: i for i, name in enumerate(names.tolist())}
    # A bounded number of rows: MAX_FIT_DOCS at most, each a short list of feature numbers.
    found = map_batches(fit, _fired, "toxic int, found array<int>", features=features).toPandas()
    rows = [np.asarray(x, np.int32) for x in found["found"]]
    marked = (found["toxic"].to_numpy() == 1).astype(float)
    del found

    # Voters: strong entries, widest reach first.
    strong = np.flatnonzero(gain > 2.0)
    voters = strong[np.argsort(-k1[strong], kind="stable")][:MAX_VOTERS]
    column = np.full(len(names), -1)
    column[voters] = np.arange(len(voters))
    votes = np.zeros((len(rows), len(voters)), np.float32)
    for i, own in enumerate(rows):
        hit = column[own]
        votes[i, hit[hit >= 0]] = 1
    posterior, rates = label_model(votes, 0.02 + 0.96 * marked, rounds=1)
    posterior = with_marks(posterior, marked)
    bias, weights = linear_fit(rows, posterior, len(names))
    kept = {name: float(w) for name, w in zip(names.tolist(), weights) if abs(w) > 1e-4}
    return Model(bias, kept, names[voters].tolist(), rates, overruled=int(((posterior > 0.5) != (marked > 0)).sum()))


def _scores(batches, model: Model) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        scores = pa.array([model.score(text) for text in batch.column("text").to_pylist()], pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])


def score_documents(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row; null texts are scored as empty ones."""
    rows = map_batches(documents.select("doc_id", "text"), _scores, "doc_id long, score double", model=model)
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
