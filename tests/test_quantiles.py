from __future__ import annotations

import math

import numpy as np
import pytest

from climate_lake.functions import quantiles
from climate_lake.functions.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.0001, 0.25, 0.5, 0.75, 0.9999, 1.0]


def groups():
    random = np.random.default_rng(7)
    return {
        "spread": random.normal(20, 8, 40_000),
        "repeated": np.round(random.normal(20, 2, 30_000), 0),
        "outliers": np.concatenate([random.normal(20, 0.001, 9_000), [1e12, -1e12, 5e300]]),
        "constant": np.full(5_000, 3.5),
        "pair": np.array([1.0, 2.0]),
        "single": np.array([42.0]),
    }


@pytest.fixture(scope="module")
def frame(spark):
    data = [(name, float(value)) for name, values in groups().items() for value in values]
    data += [("spread", None), ("spread", math.nan), ("empty", None)]
    return spark.createDataFrame(data, "name string, value double").repartition(8)


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
# With a small limit, the large groups are narrowed down once, or several times.
@pytest.mark.parametrize("small_group, max_ordered", [(100_000, 10**6), (2_000, 10**6), (2_000, 0.01)])
def test_equals_numpy(frame, small_group, max_ordered, broadcast_rows):
    result = exact_quantiles(
        frame,
        ["name"],
        "value",
        {probability: f"q{probability}" for probability in PROBABILITIES},
        small_group=small_group,
        max_ordered=max_ordered,
        broadcast_rows=broadcast_rows,
    )
    got = {row["name"]: row for row in result.collect()}
    assert got.keys() == groups().keys()
    for name, values in groups().items():
        for probability in PROBABILITIES:
            expected = pytest.approx(np.quantile(values, probability), rel=1e-9)
            assert got[name][f"q{probability}"] == expected, (name, probability)


def test_null_group_and_single_probability(spark):
    frame = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "name string, value double")
    got = {row["name"]: row["median"] for row in exact_quantiles(frame, ["name"], "value", {0.5: "median"}).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_empty_input(spark):
    frame = spark.createDataFrame([], "name string, value double")
    assert exact_quantiles(frame, ["name"], "value", {0.5: "median"}).count() == 0


def test_missed_bracket_is_widened(spark, monkeypatch):
    margins, bracket = [], quantiles._bracket

    def wrong_at_first(probability, rank, size, grid, low, high, small_group, margin):
        margins.append(margin)
        return (high, high) if margin == 1 else bracket(probability, rank, size, grid, low, high, small_group, margin)

    monkeypatch.setattr(quantiles, "_bracket", wrong_at_first)
    values = np.random.default_rng(3).normal(size=5_000)
    frame = spark.createDataFrame([("a", float(value)) for value in values], "name string, value double")
    names = {0.25: "low", 0.5: "median"}
    found = exact_quantiles(frame, ["name"], "value", names, small_group=10).first()
    assert tuple(found)[1:] == pytest.approx(tuple(np.quantile(values, [0.25, 0.5])), rel=1e-9)
    assert set(margins) == {1, 2}
