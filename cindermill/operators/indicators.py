"""Technical indicators over bar tables, per symbol and timeframe.

Window means are plain window functions. The recurrences (exponential means, Wilder smoothing) are prefix
compositions over blocks of a series (`prefix`), so they run in Spark's own code and a long series is many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cindermill.operators.bars import series_keys
from cindermill.operators.macro import as_of
from cindermill.operators.prefix import blocked, exponential_means, in_block, numbered
from cindermill.sources.storage import layer_one

EMA_PERIODS = (9, 21, 50, 200)
RSI_PERIODS = (14, 28)


def _trailing(rows: int, by: tuple[str, ...]):
    return Window.partitionBy(*by).orderBy("timestamp").rowsBetween(1 - rows, 0)


def sma(column: str, rows: int = 20, by: tuple[str, ...] = ("symbol",)) -> Column:
    """Mean of the last rows values of a series, null until there are that many."""
    frame = _trailing(rows, by)
    return F.when(F.count(column).over(frame) == rows, F.avg(column).over(frame))


def add_bollinger(bars: DataFrame, rows: int = 20, width: float = 2.0) -> DataFrame:
    """bb_mid, bb_upper and bb_lower with the population deviation."""
    frame = _trailing(rows, series_keys(bars))
    enough = F.count("close").over(frame) == rows
    mid, deviation = F.avg("close").over(frame), F.stddev_pop("close").over(frame)
    return bars.withColumns({"bb_mid": F.when(enough, mid), "bb_upper": F.when(enough, mid + width * deviation), "bb_lower": F.when(enough, mid - width * deviation)})


def add_momentum(bars: DataFrame) -> DataFrame:
    """volume_sma_20, relative_volume, trend_strength (close above ema_50) and momentum_score (rsi_14 - 50)."""
    out = bars.withColumn("volume_sma_20", sma("volume", by=series_keys(bars)))
    return out.withColumns({"relative_volume": F.col("volume") / F.when(F.col("volume_sma_20") == 0, 1.0).otherwise(F.col("volume_sma_20")), "trend_strength": (F.col("close") > F.col("ema_50")).cast("int"), "momentum_score": F.col("rsi_14") - 50})


RECURRENT = [*(f"ema_{p}" for p in EMA_PERIODS), *(f"rsi_{p}" for p in RSI_PERIODS), "macd", "macd_signal", "macd_hist", "atr_14", "atr_pct", "di_plus", "di_minus", "adx_14"]


def add_recurrences(bars: DataFrame, *by: str) -> DataFrame:
    """EMA, RSI, MACD, ATR, directional indicators and ADX; null for bars without close, high or low, which count as absent."""
    bars = bars.drop(*RECURRENT)
    columns = bars.columns
    whole = F.col("close").isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull()
    series = F.struct(*(by or series_keys(bars)), whole.alias("whole_"))
    rows = blocked(numbered(bars, series, "timestamp", "close", "high", "low"))
    before = lambda c: F.lag(c).over(in_block())
    zero = F.lit(0.0)
    rows = rows.withColumns({"delta_": F.coalesce(F.col("close") - before("close"), zero), "up_": F.coalesce(F.col("high") - before("high"), zero), "down_": F.coalesce(before("low") - F.col("low"), zero), "range_": F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before("close")), F.abs(F.col("low") - before("close")))})
    up, down = F.col("up_"), F.col("down_")
    means = {f"ema_{p}": ("close", 2 / (p + 1)) for p in (*EMA_PERIODS, 12, 26)}
    for p in RSI_PERIODS:
        means |= {f"gain_{p}": (F.greatest(F.col("delta_"), zero), 1 / p), f"loss_{p}": (F.greatest(-F.col("delta_"), zero), 1 / p)}
    means |= {"atr_14": ("range_", 1 / 14), "plus_": (F.when((up > down) & (up > 0), up).otherwise(zero), 1 / 14), "minus_": (F.when((down > up) & (down > 0), down).otherwise(zero), 1 / 14)}
    first = exponential_means(rows.where("place_ > 0"), means)
    made = {f"rsi_{p}": 100 - 100 / (1 + F.col(f"gain_{p}") / F.when(F.col(f"loss_{p}") == 0, 1e-10).otherwise(F.col(f"loss_{p}"))) for p in RSI_PERIODS}
    smooth = F.nullif(F.col("atr_14"), zero)
    made |= {"macd": F.col("ema_12") - F.col("ema_26"), "atr_pct": F.col("atr_14") / F.col("close") * 100, "di_plus": 100 * F.col("plus_") / smooth, "di_minus": 100 * F.col("minus_") / smooth}
    first = first.withColumns(made)
    spread = F.coalesce(100 * F.abs(F.col("di_plus") - F.col("di_minus")) / F.nullif(F.col("di_plus") + F.col("di_minus"), zero), zero)
    second = exponential_means(first, {"macd_signal": ("macd", 2 / 10), "adx_14": (spread, 1 / 14)}).withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    return second.select(*columns, *[F.when(F.col("key_.whole_"), F.col(c)).alias(c) for c in RECURRENT])


def volatility_levels(days: DataFrame, *series: DataFrame) -> DataFrame:
    """vix_level for each day: the last value on or before it of the first of the series (date, value) that has one, else 0.

    Days and series are no longer than the calendar.
    """
    out, found = days.select("day").distinct(), []
    for k, one in enumerate(series):
        facts = one.select(F.lit(0).alias("one"), F.to_date("date").alias("date"), F.col("value").cast("double").alias(f"v{k}_")).where(F.col(f"v{k}_").isNotNull())
        out = as_of(facts, out.withColumn("one", F.lit(0)), "one", "date", "day", f"v{k}_").drop("one", "fact_time")
        found.append(F.col(f"v{k}_"))
    return out.select("day", F.coalesce(*found, F.lit(0.0)).alias("vix_level"))


def technical_signals(bars: DataFrame, symbols: DataFrame | None = None, volatility: float | DataFrame | list[DataFrame] | None = None, limit: float = 40.0) -> DataFrame:
    """All indicators over clean bars of the listed symbols, with the volatility flag; series by symbol and timeframe.

    Without a list, or with an empty one, all symbols are taken, of layer one where bars have a market. Volatility is a
    level, or series (date, value) in order of preference, such as an index's bars and a macro series, read as of each bar's day.
    """
    clean = bars.where("is_clean")
    if symbols is not None and not symbols.isEmpty():
        chosen = clean.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    else:
        chosen = layer_one(clean) if "market" in clean.columns else clean
    out = add_momentum(add_bollinger(add_recurrences(chosen)))
    if volatility is None or isinstance(volatility, (int, float)):
        return out.withColumns({"vix_level": F.lit(float(volatility or 0.0)), "high_volatility_flag": F.lit(volatility is not None and volatility > limit)})
    series = [volatility] if isinstance(volatility, DataFrame) else volatility
    levels = volatility_levels(chosen.select(F.to_date("timestamp").alias("day")), *series)
    return out.withColumn("day", F.to_date("timestamp")).join(levels, "day", "left").drop("day").withColumn("high_volatility_flag", F.coalesce(F.col("vix_level") > limit, F.lit(False)))
