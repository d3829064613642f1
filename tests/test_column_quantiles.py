from __future__ import annotations

import math

import numpy as np
import pytest

from climate_lake.functions import column_quantiles as module
from climate_lake.functions.column_quantiles import column_quantiles

PROBABILITIES = [0.0, 0.0001, 0.25, 0.5, 0.75, 0.9999, 1.0]
NAMES = {probability: f"q{probability}" for probability in PROBABILITIES}


def columns():
    random = np.random.default_rng(7)
    return {
        "spread": random.normal(20, 8, 40_000),
        "repeated": np.round(random.normal(20, 2, 40_000), 0),
        "outliers": np.concatenate([random.normal(20, 0.001, 39_997), [1e12, -1e12, 5e300]]),
        "constant": np.full(40_000, 3.5),
        "sparse": np.where(np.arange(40_000) % 20_000 == 7, np.arange(40_000), np.nan),
        "nothing": np.full(40_000, np.nan),
    }


@pytest.fixture(scope="module")
def frame(spark):
    fields = ", ".join(f"{name} double" for name in columns())
    # NaN and NULL are both no value.
    rows = [tuple(None if math.isnan(x) and k % 2 else float(x) for x in row) for k, row in enumerate(zip(*columns().values()))]
    return spark.createDataFrame(rows, fields).repartition(8)


def check(result):
    got = {row["column_name"]: row for row in result.collect()}
    assert list(got) == list(columns())
    for name, values in columns().items():
        present = values[~np.isnan(values)]
        for probability in PROBABILITIES:
            expected = pytest.approx(np.quantile(present, probability), rel=1e-9) if len(present) else None
            assert got[name][f"q{probability}"] == expected, (name, probability)


# With a small limit, brackets are narrowed down once, or several times.
@pytest.mark.parametrize("small_group, max_ordered", [(100_000, 10**6), (2_000, 10**6), (2_000, 100), (2_000, 0.01)])
def test_equals_numpy(frame, small_group, max_ordered):
    check(column_quantiles(frame, frame.columns, NAMES, small_group, max_ordered))


def test_empty_input(spark):
    frame = spark.createDataFrame([], "a double, b int")
    assert [tuple(row) for row in column_quantiles(frame, ["a", "b"], {0.5: "median", 1.0: "max"}).collect()] == [
        ("a", None, None), ("b", None, None),
    ]


def test_missed_bracket_is_widened(frame, monkeypatch):
    margins, bracket = [], module._bracket

    def wrong_at_first(rank, size, grid, ends, small_group, margin):
        margins.append(margin)
        return (ends[1], ends[1]) if margin == 1 else bracket(rank, size, grid, ends, small_group, margin)

    monkeypatch.setattr(module, "_bracket", wrong_at_first)
    check(column_quantiles(frame, frame.columns, NAMES, 2_000))
    assert set(margins) == {1, 2}


def test_rows_are_read_twice(frame, plan, monkeypatch):
    read = []
    plain = module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, label: read.append(plan(df)) or plain(df, label))
    column_quantiles(frame, frame.columns, NAMES)
    assert len(read) == 1 and "Join" not in read[0]
