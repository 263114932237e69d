"""The ranked watchlist: joins of alignment, sector weights, universe, regime, earnings and sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def freshness_share(bars: DataFrame, universe: DataFrame, run_date, days: int = 3) -> DataFrame:
    """Share of the universe with a clean bar in the last days, and whether it is at least 0.95."""
    fresh = bars.where("is_clean").where(F.to_date("timestamp") >= F.date_sub(run_date, days)).select("symbol").distinct().withColumn("f", F.lit(1))
    return universe.select("symbol").distinct().join(fresh, "symbol", "left").agg(F.avg(F.coalesce("f", F.lit(0))).alias("share")).withColumn("passed", F.col("share") >= 0.95)


def candidates(alignment: DataFrame, sectors: DataFrame, universe: DataFrame, regime: DataFrame, least_score: int = 5, least_sector: float = 0.5, least_volume: float = 1e6) -> DataFrame:
    """Joined and filtered rows; an unknown dollar volume passes but is shown as 0."""
    now = regime.select(F.col("regime").alias("current_regime"), "confidence").limit(1)
    joined = alignment.join(sectors.select("symbol", "sector_key", "sector_weight"), "symbol", "left").join(universe.select("symbol", "dollar_volume_20d", "market"), "symbol", "left").join(F.broadcast(now), F.lit(True), "left")
    kept = joined.where((F.abs("mtf_score") >= least_score) & F.col("signal_quality").isin("A", "B") & (F.coalesce("sector_weight", F.lit(1.0)) > least_sector) & (F.coalesce("dollar_volume_20d", F.lit(1e9)) > least_volume))
    return kept.withColumns({"dollar_volume_20d": F.coalesce("dollar_volume_20d", F.lit(0.0)), "direction": F.when(F.col("mtf_score") > 0, "long").otherwise("short")})


def enrich(rows: DataFrame, next_earnings: DataFrame, sentiment: DataFrame, clusters: DataFrame) -> DataFrame:
    """days_to_earnings, sentiment_score and cluster_id (-1 where there is none)."""
    out = rows.join(next_earnings.select("symbol", "days_to_earnings"), "symbol", "left").join(sentiment.select("symbol", "sentiment_score"), "symbol", "left").join(clusters.select("symbol", "cluster_id"), "symbol", "left")
    return out.withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1)))


def _ranking() -> list:
    return [F.abs("mtf_score").desc(), F.col("reward_risk_ratio").desc_nulls_last(), F.col("symbol")]


def cap_clusters(rows: DataFrame, most: int = 2, cap_unclustered: bool = True) -> DataFrame:
    """At most `most` rows of each cluster, best first; rows without a cluster count as one unless told otherwise."""
    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy(*_ranking())) - 1
    kept = F.col("place_") < most
    return rows.withColumn("place_", place).where(kept if cap_unclustered else kept | (F.col("cluster_id") == -1)).drop("place_")


def build(alignment: DataFrame, sectors: DataFrame, universe: DataFrame, regime: DataFrame, next_earnings: DataFrame, sentiment: DataFrame, clusters: DataFrame, top: int = 20, **limits) -> DataFrame:
    """The watchlist with its rank."""
    best = cap_clusters(enrich(candidates(alignment, sectors, universe, regime, **limits), next_earnings, sentiment, clusters)).orderBy(*_ranking()).limit(top)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*_ranking())))  # over the top rows only


def simplified(alignment: DataFrame, top: int = 20) -> DataFrame:
    """Grades A and B by score, for when the other sources are missing."""
    return alignment.where(F.col("signal_quality").isin("A", "B")).orderBy(F.col("mtf_score").desc(), "symbol").limit(top)
