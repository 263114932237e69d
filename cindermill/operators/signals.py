"""Multi-timeframe alignment, macro regimes and their history, sector weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIMEFRAMES = ("5m", "15m", "1H", "4H", "1D", "1W", "1M")
#: What an indicator is taken to be when no series has it, and the series in order of preference.
DEFAULTS = {"vix": 20.0, "yield_spread": 0.5, "cpi": 3.0, "gdp": 2.0, "dxy": 100.0}


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def trend() -> Column:
    """1, -1 or 0 by close against ema_50 and ema_9 against ema_21."""
    return F.when((F.col("close") > F.col("ema_50")) & (F.col("ema_9") > F.col("ema_21")), 1).when((F.col("close") < F.col("ema_50")) & (F.col("ema_9") < F.col("ema_21")), -1).otherwise(0)


def alignment(signals: DataFrame, timeframes=TIMEFRAMES, zone_timeframe: str = "1H", reward_risk: float = 1.2) -> DataFrame:
    """One row per symbol from (symbol, timeframe, timestamp, close, ema_9, ema_21, ema_50, atr_14): the trend on each timeframe's last bar, score, grade and price zones."""
    last = signals.groupBy("symbol", "timeframe").agg(F.max_by(F.struct("close", "ema_9", "ema_21", "ema_50", "atr_14"), "timestamp").alias("b")).select("symbol", "timeframe", "b.*").withColumn("trend", trend())
    of = lambda value, tf: F.first(F.when(F.col("timeframe") == tf, F.col(value)), ignorenulls=True)
    wide = last.groupBy("symbol").agg(*[F.coalesce(of("trend", tf), F.lit(0)).alias(f"trend_{tf}") for tf in timeframes], *[of("atr_14", tf).alias(f"atr_{tf}") for tf in timeframes], *[of("close", tf).alias(f"close_{tf}") for tf in timeframes])
    order = [zone_timeframe, *(tf for tf in timeframes if tf != zone_timeframe)]
    scored = wide.withColumns({"mtf_score": sum((F.col(f"trend_{tf}") for tf in timeframes[1:]), F.col(f"trend_{timeframes[0]}")), "atr": F.coalesce(*[F.col(f"atr_{tf}") for tf in order]), "last_close": F.coalesce(*[F.col(f"close_{tf}") for tf in order])})
    size = F.abs("mtf_score")
    out = scored.withColumns({"signal_quality": F.when(size >= 6, "A").when(size == 5, "B").when(size == 4, "C").otherwise("D"), "entry_zone_low": F.col("last_close") - 0.5 * F.col("atr"), "entry_zone_high": F.col("last_close") + 0.5 * F.col("atr"), "stop_zone": F.col("last_close") - 1.5 * F.col("atr"), "reward_risk_ratio": F.when(F.col("atr") > 0, F.lit(reward_risk))})
    return out.drop(*[f"{v}_{tf}" for v in ("atr", "close") for tf in timeframes])


def compatible(score: Column, regime: Column) -> Column:
    return F.when(regime == "RISK_ON", score > 0).when(regime == "RISK_OFF", score < 0).otherwise(F.lit(True))


def regime(indicators: DataFrame) -> DataFrame:
    """Scores, regime and confidence from columns vix, yield_spread, cpi, gdp, dxy; nulls take the defaults."""
    v, s, c, g, d = (F.coalesce(F.col(n), F.lit(x)) for n, x in DEFAULTS.items())
    scores = {"vix_score": clamp((40 - v) / 20), "yield_curve_score": clamp((s + 1) / 2), "cpi_score": clamp((5 - c) / 5), "gdp_score": clamp(g / 4), "dxy_score": clamp((110 - d) / 20)}
    scored = indicators.withColumns(scores).withColumn("composite_score", (F.col("vix_score") + F.col("yield_curve_score") + F.col("cpi_score") + F.col("gdp_score") + F.col("dxy_score")) / 5)
    m = F.col("composite_score")
    rules = [
        (v > 30, "RISK_OFF", (v - 30) / 20),
        ((c > 5) & (g < 1), "STAGFLATION", (c - 5) / 3 * 0.5 + F.greatest(F.lit(0.0), 1 - g) * 0.5),
        (c < 2.5, "DISINFLATION", (2.5 - c) / 2.5),
        ((v < 20) & (s > 0) & (c < 4), "RISK_ON", (20 - v) / 10 * 0.5 + F.least(s, F.lit(1.0)) * 0.5),
        ((s > 0.5) & (c < 4), "REFLATION", s / 2 * 0.6 + (4 - c) / 4 * 0.4),
    ]
    name, confidence = F.when(m > 0.5, "RISK_ON").otherwise("RISK_OFF"), F.abs(m - 0.5) * 2
    for condition, label, value in reversed(rules):
        name, confidence = F.when(condition, label).otherwise(name), F.when(condition, value).otherwise(confidence)
    return scored.withColumns({"regime": name, "confidence": F.round(F.least(confidence, F.lit(1.0)), 3)})


def regime_history(regimes: DataFrame, gap_days: int = 7) -> DataFrame:
    """Per date: previous regime, transition, alert, persistence (restarts after a gap) and days_in_regime (restarts on a change too)."""
    order = Window.orderBy("date")  # one row per date: as long as the calendar
    steps = regimes.withColumns({"previous_regime": F.lag("regime").over(order), "gap": F.datediff("date", F.lag("date").over(order))})
    breaks = F.coalesce(F.col("gap") > gap_days, F.lit(True))
    changed = F.col("regime") != F.coalesce("previous_regime", "regime")
    marked = steps.withColumns({"transition": changed, "run_": F.sum(breaks.cast("int")).over(order), "island_": F.sum((breaks | changed).cast("int")).over(order)})
    alert = F.when(F.col("transition"), F.concat_ws(" -> ", "previous_regime", "regime"))
    return marked.withColumns({"alert": alert, "persistence": F.row_number().over(Window.partitionBy("run_").orderBy("date")), "days_in_regime": F.row_number().over(Window.partitionBy("island_").orderBy("date"))}).drop("run_", "island_", "gap")


def sector_key() -> Column:
    """commodity_<subcategory>, the sector of a US stock, else the market."""
    return F.when(F.col("market") == "commodity", F.concat(F.lit("commodity_"), F.col("subcategory"))).when((F.col("market") == "us_stocks") & F.col("sector").isNotNull(), F.col("sector")).otherwise(F.col("market"))


def sector_weights(instruments: DataFrame, weights: DataFrame, regime_name: str = "RISK_ON") -> DataFrame:
    """Each instrument's weight from rows (regime, sector_key, weight); a missing key weighs 1."""
    now = weights.where(F.col("regime") == regime_name).select("sector_key", "weight")
    return instruments.withColumn("sector_key", sector_key()).join(F.broadcast(now), "sector_key", "left").withColumn("sector_weight", F.coalesce("weight", F.lit(1.0))).drop("weight")


def indicator_values(observations: DataFrame, candidates: dict[str, tuple[tuple[str, str], ...]], run_date: Column) -> DataFrame:
    """One row with the last value of the first (source, series_id) of each indicator that has one by run_date.

    Vintages after run_date are not read; of one observation date the newest vintage counts.
    """
    known = observations.where((F.col("vintage_date") <= run_date) & (F.col("observation_date") <= run_date))
    last = lambda source, series: F.max_by(F.when((F.col("source") == source) & (F.col("series_id") == series), F.col("value")), F.when((F.col("source") == source) & (F.col("series_id") == series) & F.col("value").isNotNull(), F.struct("observation_date", "vintage_date")))
    return known.agg(*[F.coalesce(*[last(*c) for c in options]).alias(name) for name, options in candidates.items()])


def grade_counts(aligned: DataFrame) -> DataFrame:
    return aligned.groupBy("signal_quality").agg(F.count("*").alias("n_symbols"))
