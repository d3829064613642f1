"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from climate_lake.plans import oracle as plan_oracle
from climate_lake.plans import queries as plan_queries
from tests import compare

QUERIES, ORACLES = plan_queries.queries(), plan_oracle.oracle_sql()
# These write files while the query is built; their reads are plain scans.
WRITING = {name for name in QUERIES if name.startswith(("sink_", "landed_", "catalog_", "lake_", "rf_"))}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, sf_dir, duck):
    assert compare.difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[:3] == ["city_name", "year", "month"]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_plan_has_no_nested_loop(name, spark, sf_dir, plan):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "NestedLoop" not in text
    assert "Python" not in text


def test_scan_reads_only_needed_columns(spark, sf_dir, plan):
    text = plan(QUERIES["city_count"](spark, sf_dir))
    assert "l_extendedprice" not in text
    assert "l_discount" not in text.split("ReadSchema")[1].splitlines()[0]


def test_a_rewritten_input_is_another_lake(spark, tmp_path):
    for name in ("lineitem", "nation", "events", "part"):
        spark.range(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = plan_queries.input_files(spark, str(tmp_path))
    assert before == plan_queries.input_files(spark, str(tmp_path)) and len(before) >= 4
    spark.range(4).write.mode("overwrite").parquet(str(tmp_path / "part.parquet"))
    assert before != plan_queries.input_files(spark, str(tmp_path))


def test_a_lake_table_costs_the_same_whoever_asked_before(spark, sf_dir, monkeypatch):
    landed, run = [], []
    monkeypatch.setattr(plan_queries, "land_documents", lambda *_: landed.append("documents"))
    monkeypatch.setattr(plan_queries, "land_table", lambda _, raw, name, at: landed.append(name))
    monkeypatch.setattr(plan_queries.pipeline, "run", lambda *_, only: run.extend(only))
    monkeypatch.setattr(plan_queries, "read_table", lambda *_: spark.range(1))
    # Each builds its own: the second does what the first has done.
    for _ in range(2):
        QUERIES["lake_weather_data"](spark, sf_dir)
    assert (landed, run) == (["documents"] * 2, ["weather_data"] * 2)
    QUERIES["lake_climate_events"](spark, sf_dir)
    QUERIES["lake_temperature_trends_monthly"](spark, sf_dir)
    assert landed[2:] == ["climate_events", "documents", "weather_stations"]
