"""Moments of series as tables that merge: appended bars are scored without a look at the history.

A state has a row for each series: n, mean and m2, the sum of squared distances from the mean, of its log returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.operators.bars import series_keys


def moments(bars: DataFrame) -> DataFrame:
    """The state of some bars; null returns do not count, and a series without any has n 0."""
    n = F.count("log_return")
    return bars.groupBy(*series_keys(bars)).agg(n.alias("n"), F.coalesce(F.avg("log_return"), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop("log_return") * n, F.lit(0.0)).alias("m2"))


def merged(*states: DataFrame) -> DataFrame:
    """One state from those of bars that do not overlap, in any order."""
    both, keys = states[0], series_keys(states[0])
    for state in states[1:]:
        both = both.unionByName(state)
    weighted = both.groupBy(*keys).agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0)).alias("mean"), F.sum("m2").alias("within"), F.collect_list(F.struct("n", "mean")).alias("parts"))  # a part for each state
    between = F.aggregate("parts", F.lit(0.0), lambda total, part: total + part["n"] * F.pow(part["mean"] - F.col("mean"), 2))
    return weighted.select(*keys, "n", "mean", (F.col("within") + between).alias("m2"))


def scored(bars: DataFrame, state: DataFrame, limit: float = 4.0) -> DataFrame:
    """The bars with z and is_outlier by a state, as `quality.outliers` gives them by the bars themselves."""
    keys = list(series_keys(bars))
    named = state.select(F.struct(*keys).alias("key_"), "n", "mean", F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0))).alias("deviation"))
    joined = bars.withColumn("key_", F.struct(*keys)).join(named, "key_", "left")
    z = F.when(F.col("deviation") > 0, (F.col("log_return") - F.col("mean")) / F.col("deviation"))
    return joined.withColumn("z", z).withColumn("is_outlier", F.coalesce(F.abs("z") > limit, F.lit(False))).drop("key_", "n", "mean", "deviation")
