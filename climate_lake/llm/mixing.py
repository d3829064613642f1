"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Each source's rows are cut into blocks. In a round, source i contributes c_i blocks of Q in all, its target weight being
c_i / Q; its block j may start at slot floor(j Q / c_i) (release) and must be placed by ceil((j + 1) Q / c_i) (deadline).
Taking the released block with the earliest deadline in every slot meets all deadlines, so that after t slots each source
is less than one block away from t c_i / Q. Rounds repeat. A source with too few blocks left gives what it has, and the
round gets shorter: every row is placed exactly once, and the others keep their proportions to each other.

All rounds with the same contributions share one schedule. There are at most two kinds more than twice the sources, each
scheduled once over at most ``resolution`` slots, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from climate_lake.session import materialise

# Slots of a full round: target weights are multiples of 1 / RESOLUTION.
RESOLUTION = 1000
BLOCK_ROWS = 64
# Rows of a source that one task ranks.
CHUNK_ROWS = 5_000
TEMPERATURE = 0.5

PLAN = ("source", "block", "rank", "slot", "release", "deadline")


def tempered_weights(counts: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """``source, weight`` with weights that grow as a power of the rows: large sources count less than their share."""
    return counts.select("source", F.pow(F.col("n_rows").cast("double"), F.lit(temperature)).alias("weight"))


def _shares(weights: DataFrame, resolution: int) -> DataFrame:
    """Blocks of each source in a full round, at least one: largest remainders get what rounding down leaves."""
    everything = Window.partitionBy()
    exact = F.lit(resolution) * F.col("weight") / F.sum("weight").over(everything)
    cut = weights.select("source", F.floor(exact).alias("whole"), (exact - F.floor(exact)).alias("rest"))
    left = F.lit(resolution) - F.sum("whole").over(everything)
    order = Window.orderBy(F.desc("rest"), F.asc_nulls_first("source"))
    share = F.col("whole") + (F.row_number().over(order) <= left).cast("int")
    return cut.select("source", F.greatest(share, F.lit(1)).cast("int").alias("share"))


def _earliest_deadlines(kinds: DataFrame) -> DataFrame:
    """``kind, index, block, slot_in_round, release, deadline`` for each kind's array ``gives`` of blocks per source."""
    # Slot by slot, over the next block of every source: counts[i] blocks of source i are placed so far.
    kinds = kinds.withColumn("slots", F.aggregate("gives", F.lit(0), lambda a, x: a + x))

    def step(state: Column, slot: Column) -> Column:
        candidates = F.transform(
            F.arrays_zip(state["placed"], F.col("gives")),
            lambda x, i: F.when(
                (x["placed"] < x["gives"]) & (F.expr("slots") * x["placed"] < (slot + 1) * x["gives"]),
                F.struct(
                    F.ceil(F.expr("slots") * (x["placed"] + 1) / x["gives"]).cast("int").alias("deadline"),
                    i.alias("index"),
                    x["placed"].alias("block"),
                ),
            ),
        )
        best = F.array_min(candidates)
        return F.struct(
            F.transform(state["placed"], lambda n, i: n + (i == best["index"]).cast("int")).alias("placed"),
            F.array_append(state["order"], best).alias("order"),
        )

    start = F.struct(
        F.transform("gives", lambda x: F.lit(0)).alias("placed"),
        F.expr("cast(array() as array<struct<deadline:int,index:int,block:int>>)").alias("order"),
    )
    placed = F.aggregate(F.sequence(F.lit(0), F.col("slots") - 1), start, step, lambda state: state["order"])
    rows = kinds.filter("slots > 0").select("kind", "gives", "slots", F.posexplode(placed).alias("slot_in_round", "x"))
    share = F.get("gives", F.col("x.index"))
    return rows.select(
        "kind",
        F.col("x.index").alias("index"),
        F.col("x.block").alias("nth"),
        "slot_in_round",
        F.floor(F.col("slots") * F.col("x.block") / share).cast("int").alias("release"),
        F.col("x.deadline").alias("deadline"),
    )


def schedule(sources: DataFrame) -> DataFrame:
    """One row per source and kind of round, from ``source, blocks, share`` (blocks in all, blocks per full round).

    ``first_round .. last_round`` are the rounds of this kind, ``first_slot`` the slot the first of them begins with,
    ``slots`` the length of one; ``placed`` lists slot, release and deadline of the source's blocks within a round.
    The table has at most (2 sources + 1) x sources rows; it doesn't grow with the rows to mix.
    """
    indexed = sources.withColumn("index", F.row_number().over(Window.orderBy(F.asc_nulls_first("source"))) - 1)
    full = F.expr("blocks div share")
    edges = indexed.select(F.explode(F.array(F.lit(0).cast("long"), full, full + 1)).alias("first_round")).distinct()
    last = F.ceil(F.col("blocks") / F.col("share")).cast("long")
    rounds = indexed.agg(F.max(last).alias("rounds"))
    edges = edges.join(F.broadcast(rounds), F.col("first_round") < F.col("rounds"))
    following = F.lead("first_round").over(Window.orderBy("first_round"))
    kinds = edges.select("first_round", (F.coalesce(following, F.col("rounds")) - 1).alias("last_round"))
    listed = indexed.agg(F.array_sort(F.collect_list(F.struct("index", "blocks", "share"))).alias("sources"))
    gives = F.transform(
        "sources",
        lambda x: F.greatest(F.lit(0), F.least(x["share"], x["blocks"] - F.col("first_round") * x["share"])).cast("int"),
    )
    kinds = kinds.join(F.broadcast(listed), F.col("first_round") >= 0).select(
        F.col("first_round").alias("kind"), "first_round", "last_round", gives.alias("gives")
    )
    slots = F.aggregate("gives", F.lit(0), lambda a, x: a + x)
    length = slots * (F.col("last_round") - F.col("first_round") + 1)
    before = Window.orderBy("first_round").rowsBetween(Window.unboundedPreceding, -1)
    starts = kinds.select(
        "kind", "first_round", "last_round", slots.alias("slots"), F.coalesce(F.sum(length).over(before), F.lit(0)).alias("first_slot")
    )
    placed = _earliest_deadlines(kinds).groupBy("kind", "index").agg(
        F.array_sort(F.collect_list(F.struct("nth", "slot_in_round", "release", "deadline"))).alias("placed")
    )
    return (
        placed.join(starts, "kind")
        .join(indexed.select("index", "source", "share"), "index")
        .select("source", "share", "first_round", "last_round", "first_slot", "slots", "placed")
    )


def mix(
    documents: DataFrame,
    weights: DataFrame | None = None,
    by: str = "source",
    key: str = "doc_id",
    resolution: int = RESOLUTION,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """All rows and columns of ``documents`` plus a struct ``mix``: source, block, rank, slot, release, deadline.

    ``slot`` orders the blocks of all sources from 0 without gap, ``rank`` the rows of a block. ``weights`` has
    ``source, weight`` (positive; a source without weight gets the smallest one); None gives ``tempered_weights``.
    Within its source a row's place is a hash of ``key``, so that blocks are random samples of their source; rows with
    equal keys follow each other in any order. A null source is a source of its own. Input columns of any name are
    kept, a column named ``mix`` is replaced. An empty table gives an empty result.
    """
    columns = [name for name in documents.columns if name != "mix"]
    rows = documents.select(F.struct(*columns).alias("row"), F.col(by).cast("string").alias("source"), F.xxhash64(key).alias("h"))
    counts = materialise(documents.groupBy(F.col(by).cast("string").alias("source")).agg(F.count("*").alias("n_rows")), "mix_counts")
    chunks = max(1, -(-(counts.agg(F.max("n_rows")).first()[0] or 0) // chunk_rows))
    chunk = F.pmod(F.shiftright("h", 20), F.lit(chunks)).cast("int")

    # Ranks in two levels, so that no source is ranked by one task: rows of a chunk, then chunks of a source.
    ranked = rows.withColumn("chunk", chunk).withColumn(
        "rank", F.row_number().over(Window.partitionBy("source", "chunk").orderBy("h")) - 1
    )
    sizes = documents.select(F.col(by).cast("string").alias("source"), F.xxhash64(key).alias("h")).groupBy("source", chunk.alias("chunk")).count()
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("source").alias("o_source"), F.col("chunk").alias("o_chunk"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )

    if weights is None:
        weights = tempered_weights(counts)
    own = weights.groupBy(F.col("source").alias("w_source")).agg(F.max("weight").alias("weight"))
    weighed = counts.join(own, F.col("source").eqNullSafe(F.col("w_source")), "left")
    least = F.coalesce(F.min("weight").over(Window.partitionBy()), F.lit(1.0))
    shares = _shares(weighed.select("source", F.coalesce("weight", least).alias("weight")), resolution)
    blocks = F.ceil(F.col("n_rows") / block_rows).cast("long")
    sources = counts.join(shares.withColumnRenamed("source", "s_source"), F.col("source").eqNullSafe(F.col("s_source")))
    plan = materialise(schedule(sources.select("source", blocks.alias("blocks"), "share")), "mix_plan")
    plan = plan.select(*[F.col(name).alias(f"p_{name}") for name in plan.columns])

    # The plan's size depends on sources and resolution alone, and is measured before it is sent to all executors.
    if plan.count() * resolution <= 50_000_000 and plan.count() <= 100_000:
        plan = F.broadcast(plan)
    placed = ranked.join(
        offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("chunk") == F.col("o_chunk"))
    ).withColumn("nth_row", F.col("offset") + F.col("rank"))
    placed = placed.withColumn("block", F.expr(f"nth_row div {block_rows}"))
    turn = F.expr("block div p_share")
    joined = placed.join(
        plan, F.col("source").eqNullSafe(F.col("p_source")) & turn.between(F.col("p_first_round"), F.col("p_last_round"))
    )
    at = F.get("p_placed", F.expr("int(block % p_share)"))
    start = F.col("p_first_slot") + (turn - F.col("p_first_round")) * F.col("p_slots")
    made = F.struct(
        "source",
        "block",
        F.expr(f"int(nth_row % {block_rows})").alias("rank"),
        (start + at["slot_in_round"]).alias("slot"),
        (start + at["release"]).alias("release"),
        (start + at["deadline"]).alias("deadline"),
    )
    return joined.select("row", made.alias("mix")).select("row.*", "mix")


def in_mixed_order(documents: DataFrame, **options) -> DataFrame:
    """The rows of ``documents``, in the order of the mix: ranges of slots in successive partitions."""
    mixed = mix(documents, **options)
    order = [F.col("mix.slot"), F.col("mix.rank")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select(*documents.columns)
