"""The active universe: liquid symbols, symbols that are always in, anchors and orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ALWAYS_IN = ("forex", "commodity", "index")
#: By market the least mean dollar volume, close and clean days.
THRESHOLDS = {"us_stocks": (10_000_000.0, 1.0, 20), "idx": (5_000_000_000.0, 50.0, 20)}


def liquidity(bars: DataFrame, instruments: DataFrame, run_date, window_days: int = 45, recent: int = 20) -> DataFrame:
    """symbol, market, dollar_volume_20d, clean_days, last_close over clean bars in the window."""
    run_date = F.lit(run_date) if not hasattr(run_date, "cast") else run_date
    day = F.to_date("timestamp")
    known = bars.where("is_clean").where(day.between(F.date_sub(run_date, window_days), run_date)).join(F.broadcast(instruments.where("market IS NOT NULL").select("symbol", "market")), "symbol")
    newest = Window.partitionBy("symbol", "market").orderBy(F.col("timestamp").desc())
    ranked = known.withColumn("rn", F.row_number().over(newest))
    return ranked.groupBy("symbol", "market").agg(F.avg(F.when(F.col("rn") <= recent, F.col("close") * F.col("volume"))).alias("dollar_volume_20d"), F.count("*").alias("clean_days"), F.max_by("close", "timestamp").alias("last_close"))


def active(bars: DataFrame, instruments: DataFrame, run_date, thresholds: dict = THRESHOLDS, top: int = 175, version: str = "1") -> DataFrame:
    """Symbols that are always in, and the `top` most liquid of those past their market's thresholds."""
    measured = liquidity(bars, instruments, run_date)
    passing = F.lit(False)
    for market, (volume, close, days) in thresholds.items():
        passing = passing | ((F.col("market") == market) & (F.col("dollar_volume_20d") > volume) & (F.col("last_close") >= close) & (F.col("clean_days") >= days))
    always = measured.where(F.col("market").isin(*ALWAYS_IN)).withColumn("eligibility_reason", F.lit("always_in"))
    screened = measured.where(passing).orderBy(F.col("dollar_volume_20d").desc(), "symbol").limit(top).withColumn("eligibility_reason", F.lit("liquidity_screened"))
    return always.unionByName(screened).withColumns({"resolver_version": F.lit(version), "is_fallback": F.lit(False)})


def fallback(instruments: DataFrame, version: str = "1") -> DataFrame:
    """Every instrument with null measures, for when nothing could be resolved."""
    return instruments.select("symbol", "market", F.lit(None).cast("double").alias("dollar_volume_20d"), F.lit(None).cast("long").alias("clean_days"), F.lit(None).cast("double").alias("last_close"), F.lit("fallback").alias("eligibility_reason"), F.lit(version).alias("resolver_version"), F.lit(True).alias("is_fallback"))


def latest_snapshot(snapshots: DataFrame, run_date, date_column: str = "resolved_date") -> DataFrame:
    """Rows of the newest snapshot not after run_date."""
    run_date = F.lit(run_date) if not hasattr(run_date, "cast") else run_date
    newest = snapshots.where(F.col(date_column) <= run_date).agg(F.max(date_column).alias("newest_"))
    return snapshots.join(F.broadcast(newest), F.col(date_column) == F.col("newest_")).drop("newest_")


def resolved(snapshots: DataFrame, instruments: DataFrame, run_date, date_column: str = "resolved_date") -> DataFrame:
    """The newest list of active symbols not after run_date, else every instrument as `fallback` gives it."""
    found = latest_snapshot(snapshots, run_date, date_column).drop(date_column)
    none = found.agg(F.count("*").alias("n_")).where("n_ = 0").select()  # one row without columns, or none
    return found.unionByName(fallback(instruments).crossJoin(F.broadcast(none)).select(*found.columns))


def orphans(bars: DataFrame, instruments: DataFrame) -> DataFrame:
    """Symbols with bars that the dimension does not know."""
    return bars.select("symbol").distinct().join(instruments.select("symbol"), "symbol", "left_anti")


def context_anchors(instruments: DataFrame, run_date) -> DataFrame:
    """The active context symbols, stamped with the date."""
    return instruments.where("layer = 2 AND context_available").withColumn("resolved_date", F.lit(run_date).cast("date"))
