"""Computations along ordered groups of any length, in blocks that compose.

A group's rows are numbered without bringing the group together: rows of one day are numbered by themselves, and a day
starts where the earlier days end, which one row a day tells. Every BLOCK consecutive numbers are a block, the unit of the
windows that follow. What a whole block does to the value before it has a small closed form, two
numbers for an affine recurrence and one map for a machine of few states. These compose, so a block starts
with what the blocks before it give, and only one row a block goes that way.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 512
#: Affine carries below this share of the value are not added up.
NEGLIGIBLE = 1e-18


def day_of(df: DataFrame, time: str) -> Column:
    """The day of a date or timestamp as a number; 0 for other types, whose groups are then not dealt by day."""
    kinds = {"date": F.unix_date(time), "timestamp": F.floor(F.unix_seconds(time) / 86400), "timestamp_ntz": F.unix_date(F.col(time).cast("date"))}
    return kinds.get(df.schema[time].dataType.typeName(), F.lit(0)).cast("long")


def numbered(df: DataFrame, key: Column, time: str, *ties: str) -> DataFrame:
    """Adds key_ (a struct, nulls equal), n_ from 1 in order of time within each key, and total_, the key's rows."""
    keyed = df.withColumn("key_", key).withColumn("day_", F.struct("key_", day_of(df, time).alias("day")))
    days = keyed.groupBy("day_").agg(F.count("*").alias("rows_"))
    group = Window.partitionBy("day_.key_").orderBy("day_.day")
    earlier = F.coalesce(F.sum("rows_").over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = F.sum("rows_").over(group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    starts = days.select("day_", earlier.alias("earlier_"), every.alias("total_"))
    within = F.row_number().over(Window.partitionBy("day_").orderBy(time, *ties))
    return keyed.join(starts, "day_").withColumn("n_", F.col("earlier_") + within).drop("day_", "earlier_")


def blocked(rows: DataFrame) -> DataFrame:
    """Adds block_ and place_ (from 1) to numbered rows, and each block's predecessor once more at place_ 0, for lags."""
    block, place = F.floor((F.col("n_") - 1) / BLOCK), F.pmod(F.col("n_") - 1, F.lit(BLOCK)) + 1
    own = F.struct(block.alias("block_"), place.alias("place_"))
    ahead = F.struct((block + 1).alias("block_"), F.lit(0).cast("long").alias("place_"))
    last = (place == BLOCK) & (F.col("n_") < F.col("total_"))
    return rows.withColumn("at_", F.explode(F.when(last, F.array(own, ahead)).otherwise(F.array(own)))).select("*", "at_.*").drop("at_")


def in_block():
    """The window of a block in order."""
    return Window.partitionBy("key_", "block_").orderBy("place_")


def exponential_means(rows: DataFrame, means: dict[str, tuple[Column | str, float]]) -> DataFrame:
    """Adds y(n) = (1 - a) y(n - 1) + a x(n), y(1) = x(1), for every name: (x, a); rows without those at place_ 0.

    Within a block the sum of a x(i) / (1 - a) ** i, times (1 - a) ** n, is the mean that starts at zero; the mean before the block
    decays on top of it. It is that of the blocks before, which decay by whole blocks, so a few of them give all digits.
    """
    upto = in_block().rowsBetween(Window.unboundedPreceding, 0)
    decay = {name: F.pow(F.lit(1 - a), F.col("place_")) for name, (_, a) in means.items()}
    partial = {}
    for name, (x, a) in means.items():
        x = F.col(x) if isinstance(x, str) else x
        partial[f"{name}_part_"] = decay[name] * F.sum(F.when(F.col("n_") == 1, x).otherwise(a * x) / decay[name]).over(upto)
    begun = rows.withColumns(partial)
    back = max(ceil(log(NEGLIGIBLE) / (BLOCK * log(1 - a))) for _, a in means.values())
    ends = begun.where(F.col("place_") == BLOCK).select("key_", "block_", *partial, F.explode(F.sequence(F.lit(1), F.lit(back))).alias("ahead_"))
    carried = [F.sum(F.col(f"{name}_part_") * F.pow(F.lit((1 - a) ** BLOCK), F.col("ahead_") - 1)).alias(f"{name}_carry_") for name, (_, a) in means.items()]
    carries = ends.groupBy("key_", (F.col("block_") + F.col("ahead_")).alias("block_")).agg(*carried)
    joined = begun.join(carries, ["key_", "block_"], "left")
    made = {name: F.col(f"{name}_part_") + F.coalesce(f"{name}_carry_", F.lit(0.0)) * decay[name] for name in means}
    return joined.withColumns(made).drop(*partial, *(f"{name}_carry_" for name in means))


def _compose(later: Column, earlier: Column, states: int) -> Column:
    """The map of both, as an array of the state that each state leads to."""
    return F.array(*[later[earlier[q]] for q in range(states)])


def _prefixes(rows: DataFrame, window, states: int, steps: int) -> DataFrame:
    """map_ becomes that of all rows of the window up to each, by doubling: after k steps it spans 2 ** k rows."""
    for k in range(steps):
        before = F.lag("map_", 1 << k).over(window)
        rows = rows.withColumn("before_", before).withColumn("map_", F.when(F.col("before_").isNull(), F.col("map_")).otherwise(_compose(F.col("map_"), F.col("before_"), states)))
    return rows.drop("before_")


def machine_states(rows: DataFrame, moves: list[Column]) -> DataFrame:
    """Adds state_before_ and state_ of a machine that starts in state 0; moves[q] is the state that a row leads to from q.

    Rows are numbered ones. The driver reads one number, of the blocks of the longest group.
    """
    states = len(moves)
    block, place = F.floor((F.col("n_") - 1) / BLOCK), F.pmod(F.col("n_") - 1, F.lit(BLOCK)) + 1
    mapped = rows.withColumns({"block_": block, "place_": place, "map_": F.array(*[m.cast("int") for m in moves])})
    inside = _prefixes(mapped, in_block(), states, (BLOCK - 1).bit_length())
    most = rows.agg(F.max(block)).first()[0] or 0
    start = F.lit(0)
    if most:
        over_blocks = Window.partitionBy("key_").orderBy("block_")
        ends = inside.where(F.col("place_") == BLOCK).select("key_", "block_", "map_")
        starts = _prefixes(ends, over_blocks, states, most.bit_length()).select("key_", (F.col("block_") + 1).alias("block_"), F.col("map_")[0].alias("start_"))
        inside = inside.join(starts, ["key_", "block_"], "left")
        start = F.coalesce("start_", F.lit(0))
    after = inside.withColumn("start_", start).withColumn("state_", F.col("map_")[F.col("start_")])
    return after.withColumn("state_before_", F.coalesce(F.lag("state_").over(in_block()), "start_")).drop("map_", "block_", "place_", "start_")
