"""Exact quantiles of several columns of a whole table, side by side."""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climate_lake.functions.quantiles import GRID, MAX_ORDERED, SKETCH_SIZE, SKETCH_TASKS, SMALL_GROUP
from climate_lake.session import materialise

# A quantile of a column: their indices.
Slot = tuple[int, int]


def _value(c: int) -> Column:
    return F.col(f"v{c}")


def _sketched(rows: DataFrame, sketches: dict[str, Column], sums: dict[str, Column], extremes: list[str]) -> dict:
    """One row: a grid of each sketch (None without values), sums, and ``low_`` and ``high_`` of columns.

    Combined in two steps, so that no task takes a sketch from every task of the scan.
    """
    partial = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_TASKS)).alias("_task")).agg(
        *[F.kll_sketch_agg_double(value, SKETCH_SIZE).alias(name) for name, value in sketches.items()],
        *[value.alias(name) for name, value in sums.items()],
        *[end(name).alias(f"{label}_{name}") for name in extremes for label, end in (("low", F.min), ("high", F.max))],
    )
    merged = partial.agg(
        *[F.kll_merge_agg_double(name, SKETCH_SIZE).alias(name) for name in sketches],
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums],
        *[end(f"{label}_{name}").alias(f"{label}_{name}") for name in extremes for label, end in (("low", F.min), ("high", F.max))],
    )
    steps = F.array(*[F.lit(step / GRID) for step in range(GRID + 1)])
    grids = {
        name: F.when(F.kll_sketch_get_n_double(name) > 0, F.kll_sketch_get_quantile_double(name, steps)) for name in sketches
    }
    return merged.withColumns(grids).first().asDict()


def _bracket(
    rank: float, size: int, grid: list[float] | None, ends: tuple[float, float], small_group: int, margin: int
) -> tuple[float, float]:
    """Start and end around ``rank`` of ``size`` values between ``ends``: grid values ``margin`` steps further out."""
    step = int(rank / max(size - 1, 1) * GRID)
    if size <= small_group or grid is None:
        return ends
    return (
        ends[0] if step < margin else grid[step - margin],
        ends[1] if step > GRID - 1 - margin else grid[step + 1 + margin],
    )


def _order_statistics(
    rows: DataFrame, brackets: dict[Slot, tuple[float, float]], ranks: dict[Slot, float], n_columns: int
) -> dict[Slot, tuple[float | None, float | None]]:
    """The values right below and above each rank, None where it lies outside its bracket.

    One scan. Every row gives an entry that counts it into the values below each bracket, and one for each of its
    values inside a bracket; equal entries are counted before the shuffle.
    """

    def below(slot: Slot) -> Column:
        return _value(slot[0]) < F.lit(brackets[slot][0])

    def entry(c: int) -> Column:
        inside = [_value(c).between(*map(F.lit, ends)) for (own, _), ends in brackets.items() if own == c]
        made = F.struct(F.lit(c).alias("c"), _value(c).alias("v"))
        return F.when(reduce(or_, inside, F.lit(False)), made)

    counting = F.struct(F.lit(-1).alias("c"), F.lit(None).cast("double").alias("v"))
    entries = F.array_compact(F.array(counting, *[entry(c) for c in range(n_columns)]))
    counts = F.col("c") == -1
    sums = [F.count_if(counts & below(slot)).alias(f"below_{slot[0]}_{slot[1]}") for slot in brackets]
    spread = rows.select("*", F.inline(entries)).groupBy("c", "v").agg(F.count("*").alias("n"), *sums)
    stored = materialise(spread, "column-quantiles")
    before = stored.filter(counts).first()
    wanted = [
        (*slot, *ends, before[f"below_{slot[0]}_{slot[1]}"], math.floor(ranks[slot]), math.ceil(ranks[slot]))
        for slot, ends in brackets.items()
    ]
    # One row per quantile.
    fields = "c int, i int, start double, end double, below bigint, lower bigint, upper bigint"
    listed = F.broadcast(rows.sparkSession.createDataFrame(wanted, fields))
    placed = stored.select("c", "v", "n").join(listed, "c").filter(F.col("v").between(F.col("start"), F.col("end")))
    upto = Window.partitionBy("c", "i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    reached = placed.withColumn("reached", F.col("below") + F.sum("n").over(upto))
    at = {
        name: F.min(F.when((F.col("reached") > F.col(name)) & (F.col("below") <= F.col(name)), F.col("v")))
        for name in ("lower", "upper")
    }
    found = reached.groupBy("c", "i").agg(*[value.alias(f"at_{name}") for name, value in at.items()]).collect()
    picked = {(row["c"], row["i"]): (row["at_lower"], row["at_upper"]) for row in found}
    return {slot: picked.get(slot, (None, None)) for slot in brackets}


def column_quantiles(
    df: DataFrame,
    columns: list[str],
    names: Mapping[float, str],
    small_group: int = SMALL_GROUP,
    max_ordered: int = MAX_ORDERED,
    margin: int = 1,
) -> DataFrame:
    """Linearly interpolated quantiles, a row per column: ``column_name`` and a column per probability in ``names``.

    One scan sketches all columns and brackets each quantile by two values. The brackets are a few numbers, so that they
    go into the expressions of the next scan, which counts the values below them and orders the distinct ones inside.
    Only brackets with more than ``max_ordered`` expected values take another scan, which narrows them. Nothing is
    unpivoted, joined to the rows or shuffled but sketches, counts and the values inside brackets.

    NULL and NaN are ignored; a column without values has NULL quantiles.
    """
    inner = [probability for probability in sorted(names) if 0 < probability < 1]
    every = range(len(columns))
    values = [F.col(name).cast("double") for name in columns]
    rows = df.select(*[F.when(~F.isnan(value), value).alias(f"v{c}") for c, value in enumerate(values)])
    found = _sketched(
        rows,
        {f"grid_{c}": _value(c) for c in every},
        {f"n_{c}": F.count(_value(c)) for c in every},
        [f"v{c}" for c in every],
    )
    size, ends = [found[f"n_{c}"] for c in every], [(found[f"low_v{c}"], found[f"high_v{c}"]) for c in every]
    ranks = {(c, i): probability * (size[c] - 1) for c in every if size[c] for i, probability in enumerate(inner)}
    brackets = {
        (c, i): _bracket(rank, size[c], found[f"grid_{c}"], ends[c], small_group, margin) for (c, i), rank in ranks.items()
    }
    share = (2 * margin + 1) / GRID
    expected = max(size, default=0) * share
    while brackets and expected > max_ordered and share < 1:
        inside = {slot: _value(slot[0]).between(*map(F.lit, bracket)) for slot, bracket in brackets.items()}
        names_of = {slot: f"{slot[0]}_{slot[1]}" for slot in brackets}
        found = _sketched(
            rows,
            {f"grid_{names_of[slot]}": F.when(own, _value(slot[0])) for slot, own in inside.items()},
            {f"n_{names_of[slot]}": F.count_if(own) for slot, own in inside.items()}
            | {f"below_{names_of[slot]}": F.count_if(_value(slot[0]) < F.lit(brackets[slot][0])) for slot in brackets},
            [],
        )
        brackets = {
            slot: _bracket(
                ranks[slot] - found[f"below_{name}"], found[f"n_{name}"], found[f"grid_{name}"], brackets[slot], small_group, margin
            )
            for slot, name in names_of.items()
        }
        expected *= share

    picked = _order_statistics(rows, brackets, ranks, len(columns)) if brackets else {}
    if any(None in pair for pair in picked.values()):
        if margin >= GRID:
            raise RuntimeError("the rows changed between two scans")
        return column_quantiles(df, columns, names, small_group, max_ordered, 2 * margin)

    def quantile(c: int, probability: float) -> float | None:
        if not size[c] or probability in (0, 1):
            return ends[c][int(probability)] if size[c] else None
        slot = c, inner.index(probability)
        lower, upper = picked[slot]
        return lower + (upper - lower) * (ranks[slot] - math.floor(ranks[slot]))

    table = [(name, *[quantile(c, probability) for probability in names]) for c, name in enumerate(columns)]
    fields = [T.StructField("column_name", T.StringType())] + [T.StructField(name, T.DoubleType()) for name in names.values()]
    return df.sparkSession.createDataFrame(table, T.StructType(fields))
