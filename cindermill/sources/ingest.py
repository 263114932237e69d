"""Choosing sources, carrying yesterday's bars, and high-water marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Years of history by timeframe.
HISTORY_YEARS = {"5m": 0.16, "15m": 0.16, "1H": 2.0, "1D": 10.0, "1W": 10.0, "1M": 20.0}


def first_source(bars: DataFrame, priorities: DataFrame) -> DataFrame:
    """Per symbol, timeframe and fetch day the rows of the first source in order that has any; stamps _source."""
    keys = ["symbol", "timeframe", "fetch_date"]
    ranked = bars.join(F.broadcast(priorities.select("source", "priority")), "source")
    best = ranked.groupBy(*keys).agg(F.min("priority").alias("p_"))
    return ranked.join(best, keys).where("priority = p_").withColumn("_source", F.col("source")).drop("p_", "priority")


def with_mirrors(native: DataFrame, mirrors: DataFrame, mapping: DataFrame) -> DataFrame:
    """Native observations, and for series without any those of the series that mirrors them."""
    missing = mapping.join(native.select("series_id").distinct(), "series_id", "left_anti")
    other = mirrors.withColumnRenamed("series_id", "mirror_id").join(F.broadcast(missing), "mirror_id").drop("mirror_id")
    return native.withColumn("is_mirror", F.lit(False)).unionByName(other.withColumn("is_mirror", F.lit(True)))


def carry_yesterday(bars: DataFrame, universe: DataFrame, run_date: Column, timeframes=("1D", "1W", "1M")) -> DataFrame:
    """Bars of run_date, and for symbols without one yesterday's with staleness."""
    day = F.to_date("timestamp")
    today, keys = bars.where(day == run_date), ["symbol", "timeframe"]
    lacking = universe.select(*keys).where(F.col("timeframe").isin(*timeframes)).distinct().join(today.select(*keys), keys, "left_anti")
    carried = bars.where(day == F.date_sub(run_date, 1)).join(lacking, keys, "left_semi")
    return today.withColumn("staleness", F.lit(False)).unionByName(carried.withColumn("staleness", F.lit(True)))


def retained(cache: DataFrame, reference: Column, keep_days: int = 7) -> DataFrame:
    return cache.where(F.to_date("timestamp") >= F.date_sub(reference, keep_days))


def too_old(cache: DataFrame, reference: Column, days: int = 1) -> DataFrame:
    """Per symbol whether its newest cached bar is more than `days` old."""
    return cache.groupBy("symbol").agg(F.max(F.to_date("timestamp")).alias("last_date")).withColumn("is_too_old", F.datediff(reference, "last_date") > days)


def start_dates(bars: DataFrame, universe: DataFrame, run_date: Column, timeframe: str = "1D", overlap: int = 7) -> DataFrame:
    """Per (symbol, source) where to fetch from: the last date less the overlap, else the timeframe's whole history."""
    column = next(c for c in ("timestamp", "datetime", "date") if c in bars.columns)
    last = bars.groupBy("symbol", "source").agg(F.max(F.to_date(column)).alias("last_date"))
    full = F.date_sub(run_date, int(365 * HISTORY_YEARS[timeframe]))
    return universe.select("symbol", "source").distinct().join(last, ["symbol", "source"], "left").withColumn("start_date", F.coalesce(F.date_sub("last_date", overlap), full))


def series_marks(observations: DataFrame, overlap: int = 0) -> DataFrame:
    return observations.groupBy("series_id").agg(F.date_sub(F.max("observation_date"), overlap).alias("start_date"))
