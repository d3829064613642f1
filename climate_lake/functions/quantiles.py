"""Exact quantiles per group without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from climate_lake.functions.joins import BROADCAST_ROWS, dimension_join
from climate_lake.session import materialise

# Quantiles drawn from a sketch: GRID equal steps through the rows.
GRID = 500
# A sketch of this size misplaces a value by about a third of a step; a larger error is found and widened.
SKETCH_SIZE = 8_192
# Each group's sketches meet in this many tasks before they meet in one.
SKETCH_TASKS = 64
# Groups up to this size are not narrowed down; above it a grid step is many rows wide.
SMALL_GROUP = 10_000
# Values of one bracket that may be ordered in one task.
MAX_ORDERED = 1_000_000


def _sketched(
    rows: DataFrame, keys: list[str], sketches: Mapping[str, Column], sums: Mapping[str, Column]
) -> DataFrame:
    """Per group: the grid of each of ``sketches``, the sums, and the least and largest ``v``.

    Combined in two steps, so that no task takes a group's sketch from every task of the scan.
    """
    task = F.pmod(F.spark_partition_id(), F.lit(SKETCH_TASKS)).alias("_task")
    partial = rows.groupBy(*keys, task).agg(
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        *[value.alias(name) for name, value in sums.items()],
        *[F.kll_sketch_agg_double(value, SKETCH_SIZE).alias(name) for name, value in sketches.items()],
    )
    combined = partial.groupBy(*keys).agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        *[F.sum(name).alias(name) for name in sums],
        *[F.kll_merge_agg_double(name, SKETCH_SIZE).alias(name) for name in sketches],
    )
    steps = F.array(*[F.lit(step / GRID) for step in range(GRID + 1)])
    grids = {
        name: F.when(F.kll_sketch_get_n_double(name) > 0, F.kll_sketch_get_quantile_double(name, steps))
        for name in sketches
    }
    return combined.withColumns(grids)


def _bracket(
    probability: float,
    rank: Column,
    size: Column,
    grid: Column,
    low: Column,
    high: Column,
    small_group: int,
    margin: int,
) -> tuple[Column, Column]:
    """Start and end around ``rank``: ``margin`` grid steps further out on each side than the rank lies."""
    if probability in (0, 1):
        return (low, low) if probability == 0 else (high, high)
    step = F.floor(rank / F.greatest(size - 1, F.lit(1)) * GRID).cast("int")
    whole = (size <= small_group) | grid.isNull()
    start = F.when(whole | (step < margin), low).otherwise(F.get(grid, step - margin))
    end = F.when(whole | (step > GRID - 1 - margin), high).otherwise(F.get(grid, step + 1 + margin))
    return start, end


def exact_quantiles(
    df: DataFrame,
    group: list[str],
    value: str,
    names: Mapping[float, str],
    small_group: int = SMALL_GROUP,
    max_ordered: int = MAX_ORDERED,
    broadcast_rows: int = BROADCAST_ROWS,
    margin: int = 1,
) -> DataFrame:
    """Linearly interpolated quantiles, one row per group, ``names`` giving a column per probability.

    A first pass counts each group and brackets every quantile between two
    values of a sketch, a few thousandths of a large group apart. Where that is
    still too much, brackets are narrowed again. The last pass replaces every
    value outside the brackets by the start of the next one above, and counts
    equal values before the shuffle, so that only the distinct values inside
    brackets are ordered in one task. Brackets, one row per group, are written
    out, so their size is known when they are joined.

    NULL and NaN are ignored; a group without values gives no row.
    """
    probabilities = sorted(names)
    indices = range(len(probabilities))
    rows = df.select(*group, F.col(value).cast("double").alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v")
    )

    def start(i: int) -> Column:
        return F.col(f"start_{i}")

    def end(i: int) -> Column:
        return F.col(f"end_{i}")

    def rank(i: int) -> Column:
        return F.lit(float(probabilities[i])) * (F.col("n") - 1)

    def inside(i: int) -> Column:
        return F.col("v").between(start(i), end(i))

    def with_brackets(brackets: DataFrame) -> DataFrame:
        return dimension_join(rows, brackets, group, null_safe=True, max_rows=broadcast_rows)

    groups = _sketched(rows, group, {"grid": F.col("v")}, {"n": F.count("*")})
    ends = {}
    for i in indices:
        ends[f"start_{i}"], ends[f"end_{i}"] = _bracket(
            probabilities[i], rank(i), F.col("n"), F.col("grid"), F.col("low"), F.col("high"), small_group, margin
        )
    columns = [*group, "n", *ends]
    brackets = materialise(groups.withColumns(ends).select(*columns), "brackets")

    # A bracket is up to this share of the rows it was drawn from; a margin of half the grid narrows nothing.
    share = (2 * margin + 1) / GRID
    expected = (brackets.agg(F.max("n")).first()[0] or 0) * share
    while expected > max_ordered and share < 1:
        counted = {f"below_{i}": F.count_if(F.col("v") < start(i)) for i in indices}
        counted |= {f"size_{i}": F.count_if(inside(i)) for i in indices}
        grids = {f"grid_{i}": F.when(inside(i), F.col("v")) for i in indices}
        measured = _sketched(with_brackets(brackets), columns, grids, counted)
        for i in indices:
            ends[f"start_{i}"], ends[f"end_{i}"] = _bracket(
                probabilities[i],
                rank(i) - F.col(f"below_{i}"),
                F.col(f"size_{i}"),
                F.col(f"grid_{i}"),
                start(i),
                end(i),
                small_group,
                margin,
            )
        brackets = materialise(measured.withColumns(ends).select(*columns), "brackets")
        expected *= share

    kept = F.lit(False)
    following = []
    for i in indices:
        kept = kept | inside(i)
        following.append(F.when(F.col("v") < start(i), start(i)))
    # least() passes over NULL; a value above all brackets becomes NULL and is dropped.
    outside = F.least(*following) if len(following) > 1 else following[0]
    placed = (
        with_brackets(brackets)
        .select(*group, "n", kept.alias("kept"), F.when(kept, F.col("v")).otherwise(outside).alias("v"))
        .filter(F.col("v").isNotNull())
        .groupBy(*group, "n", "v", "kept")
        .agg(F.count("*").alias("c"))
    )
    # Counts of the values outside come right before the bracket they precede.
    upto = Window.partitionBy(*group).orderBy("v", "kept").rowsBetween(Window.unboundedPreceding, 0)
    reached = placed.withColumn("reached", F.sum("c").over(upto))

    def order_statistic(at: Column) -> Column:
        """First value whose count reaches beyond ``at``; right only if ``kept``, inside a bracket."""
        return F.min(F.when(F.col("reached") > at, F.struct("v", "kept")))

    ranks = {f"lower_{i}": F.floor(rank(i)) for i in indices} | {f"upper_{i}": F.ceil(rank(i)) for i in indices}
    found = reached.groupBy(*group, "n").agg(*[order_statistic(at).alias(name) for name, at in ranks.items()])
    stored = materialise(found, "quantiles")
    missed = F.lit(False)
    for name in ranks:
        missed = missed | ~F.coalesce(F.col(name)["kept"], F.lit(False))
    if margin < GRID and not stored.filter(missed).isEmpty():
        return exact_quantiles(df, group, value, names, small_group, max_ordered, broadcast_rows, 2 * margin)
    picked = stored.withColumns({name: F.col(name)["v"] for name in ranks})
    return picked.select(
        *group,
        *[
            (
                F.col(f"lower_{i}")
                + (F.col(f"upper_{i}") - F.col(f"lower_{i}")) * (rank(i) - F.floor(rank(i)))
            ).alias(names[probabilities[i]])
            for i in indices
        ],
    )
