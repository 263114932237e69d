"""Bar tables: aggregation from ticks, normalising, derived columns, cleanliness and resampling.

A bar table has one row per symbol, timeframe and timestamp. Windows by symbol therefore hold no more
rows than the calendar has timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRICES = ("open", "high", "low", "close")
AUDIT = ("_source", "_ingested_at", "_symbol", "_tz_hint")
#: Session hours in local minutes; every other market counts as open around the clock.
SESSIONS = {"us_stocks": (9 * 60 + 30, 16 * 60, "America/New_York"), "index": (9 * 60 + 30, 16 * 60, "America/New_York"), "idx": (9 * 60, 14 * 60 + 30, "Asia/Jakarta")}
#: The zone of a market's naive timestamps.
MARKET_ZONES = {"us_stocks": "America/New_York", "index": "America/New_York", "idx": "Asia/Jakarta", "forex": "UTC", "commodity": "America/New_York"}
BLOCK_HOURS = 4


def series_keys(df: DataFrame) -> tuple[str, ...]:
    """What tells the series of a bar table apart: the symbol, and the timeframe where there is one."""
    return ("symbol", "timeframe") if "timeframe" in df.columns else ("symbol",)


def from_ticks(ticks: DataFrame, unit: str, ties: bool = False) -> DataFrame:
    """OHLCV bars from (symbol, timestamp, price, volume, tie); unit is a date_trunc unit.

    With ties the bars also have the ties of their first and last tick, so that roll_up can make longer bars of them.
    """
    ends = [F.min("tie").alias("first_tie"), F.max("tie").alias("last_tie")] if ties else []
    return ticks.groupBy("symbol", F.date_trunc(unit, "timestamp").alias("timestamp")).agg(F.min_by("price", "tie").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "tie").alias("close"), F.sum("volume").alias("volume"), *ends)


def roll_up(bars: DataFrame, unit: str) -> DataFrame:
    """Longer bars from bars with ties, the same as from their ticks."""
    return bars.groupBy("symbol", F.date_trunc(unit, "timestamp").alias("timestamp")).agg(F.min_by("open", "first_tie").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "last_tie").alias("close"), F.sum("volume").alias("volume"))


def normalise_columns(bars: DataFrame) -> DataFrame:
    """Without audit columns, prices as doubles and volume as a whole number."""
    return bars.drop(*AUDIT).withColumns({c: F.col(c).cast("double") for c in PRICES} | {"volume": F.col("volume").cast("long")})


def to_utc(timestamp: Column, market: Column, tz_hint: Column | None = None) -> Column:
    """Naive local time to UTC, by the hint, else the market's zone, else UTC."""
    zone = F.lit("UTC")
    for name, value in MARKET_ZONES.items():
        zone = F.when(market == name, F.lit(value)).otherwise(zone)
    return F.to_utc_timestamp(timestamp, zone if tz_hint is None else F.coalesce(tz_hint, zone))


def dedupe(bars: DataFrame, keys=("symbol", "timeframe", "timestamp"), newest: str = "_ingested_at", *ties: str) -> DataFrame:
    """One bar per key, the one ingested last; further columns settle ties, larger first."""
    # a maximum of structs is combined before the shuffle, so copies of one key stay few
    keys = [k for k in keys if k in bars.columns]
    first = [c for c in (newest, *ties) if c in bars.columns]
    best = F.max(F.struct(*first, *[c for c in bars.columns if c not in keys and c not in first])).alias("best")
    return bars.groupBy(*keys).agg(best).select(*keys, "best.*").select(*bars.columns)


def _typical() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / 3


def add_derived(bars: DataFrame, *by: str, session_vwap: bool = False) -> DataFrame:
    """log_return, dollar_volume, spread_hl, and for intraday bars the VWAP since the start of the UTC day."""
    by = by or series_keys(bars)
    order = Window.partitionBy(*by).orderBy("timestamp")
    out = bars.withColumns({"log_return": F.ln(F.col("close") / F.lag("close").over(order)), "dollar_volume": F.col("close") * F.col("volume"), "spread_hl": (F.col("high") - F.col("low")) / F.col("close")})
    if session_vwap:
        day = Window.partitionBy(*by, F.to_date("timestamp")).orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
        traded = F.sum("volume").over(day)
        return out.withColumn("vwap", F.when(traded > 0, F.sum(_typical() * F.col("volume")).over(day) / traded))
    return out.withColumn("vwap", _typical())


def add_flags(bars: DataFrame, is_adjusted: bool = True, adj_factor: float = 1.0) -> DataFrame:
    return bars.withColumns({"is_adjusted": F.lit(is_adjusted), "adj_factor": F.lit(adj_factor)})


def add_metadata(bars: DataFrame, timeframe: str, source: str, version: str) -> DataFrame:
    """A timeframe and a source that the bars have stay; the source is that of the rows (_source), first in name order within a series."""
    named = F.first("_source", ignorenulls=True).over(Window.partitionBy(*series_keys(bars)).orderBy(F.col("_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) if "_source" in bars.columns else F.lit(None).cast("string")
    made = {"data_source": F.coalesce(named, F.lit(source)), "processing_version": F.lit(version)}
    if "timeframe" not in bars.columns:
        made["timeframe"] = F.lit(timeframe)
    return bars.withColumns(made).drop("staleness", *AUDIT)


def flag_clean(bars: DataFrame, *by: str, limit: float = 4.0, also: Column | None = None) -> DataFrame:
    """is_clean: consistent prices and no outlying return; null where the return is null and nothing else fails."""
    every = Window.partitionBy(*(by or series_keys(bars)))
    deviation, mean = F.stddev_samp("log_return").over(every), F.avg("log_return").over(every)
    within = F.when(deviation > 0, F.abs((F.col("log_return") - mean) / deviation) <= limit).otherwise(F.col("log_return").isNotNull() | F.lit(None).cast("boolean"))
    ordered = (F.col("high") >= F.col("low")) & F.col("open").between(F.col("low"), F.col("high")) & F.col("close").between(F.col("low"), F.col("high"))
    present = F.col("open").isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull() & F.col("close").isNotNull()
    clean = ordered & present & within
    if "staleness" in bars.columns:
        clean = clean & ~F.coalesce(F.col("staleness"), F.lit(False))
    return bars.withColumn("is_clean", clean if also is None else clean & also)


def silver(bars: DataFrame, timeframe: str, source: str = "primary", version: str = "1", session_vwap: bool = False, unique: bool = False) -> DataFrame:
    """Silver bars of all series at once: typed, in UTC, one row a key, derived columns, flags, is_clean, then metadata.

    Timestamps are local to _tz_hint, or else to the market, where the bars have one of these columns. Of several rows with one key that
    ingested last stays; unique says that there are none. A stale bar is never clean.
    """
    typed = bars.withColumns({c: F.col(c).cast("double") for c in PRICES} | {"volume": F.col("volume").cast("long")})
    if "_tz_hint" in bars.columns or "market" in bars.columns:
        market = F.col("market") if "market" in bars.columns else F.lit("")
        typed = typed.withColumn("timestamp", to_utc(F.col("timestamp"), market, F.col("_tz_hint") if "_tz_hint" in bars.columns else None))
    once = typed if unique else dedupe(typed)
    return add_metadata(flag_clean(add_flags(add_derived(once, session_vwap=session_vwap))), timeframe, source, version)


def block_start(timestamp: Column) -> Column:
    """Start of the four-hour UTC block."""
    return F.timestamp_seconds(F.floor(F.unix_timestamp(timestamp) / (BLOCK_HOURS * 3600)) * (BLOCK_HOURS * 3600))


def can_aggregate(from_timeframe: str, to_timeframe: str) -> bool:
    return (from_timeframe, to_timeframe) == ("1H", "4H")


def expected_bars(block: Column, market: Column) -> Column:
    """Hourly bars that the session allows in a block, by local time, so that daylight saving counts."""
    total = F.lit(BLOCK_HOURS)
    for name, (opens, closes, zone) in SESSIONS.items():
        hours = []
        for k in range(BLOCK_HOURS):
            local = F.from_utc_timestamp(F.timestamp_seconds(F.unix_timestamp(block) + 3600 * k), zone)
            minute = F.hour(local) * 60 + F.minute(local)
            hours.append(((minute < closes) & (minute + 60 > opens)).cast("int"))
        total = F.when(market == name, sum(hours[1:], hours[0])).otherwise(total)
    return total


def block_measures() -> list[Column]:
    """What a block of hourly bars is aggregated to."""
    volume = F.sum("volume")
    return [F.min_by("open", "timestamp").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "timestamp").alias("close"), volume.alias("volume"), F.when(volume > 0, F.sum(_typical() * F.col("volume")) / volume).alias("vwap"), F.count("*").alias("bar_count")]


def add_completeness(blocks: DataFrame, market: Column | None = None) -> DataFrame:
    """expected_bars and is_incomplete_bar by the market's session."""
    expected = expected_bars(F.col("timestamp"), F.lit("") if market is None else market)
    return blocks.withColumn("expected_bars", expected).withColumn("is_incomplete_bar", (F.col("expected_bars") > 0) & (F.col("bar_count") < F.col("expected_bars")))


def four_hour(bars: DataFrame, market: Column | None = None) -> DataFrame:
    """1H to 4H: first, max, min, last, sum and VWAP by block, with bar_count and is_incomplete_bar; `streaming.bars` has the same over streams."""
    grouped = bars.groupBy("symbol", block_start(F.col("timestamp")).alias("block")).agg(*block_measures())
    return add_completeness(grouped.withColumnRenamed("block", "timestamp"), market)


def silver_four_hour(bars: DataFrame, market: Column | None = None) -> DataFrame:
    """Four-hour bars with derived columns and is_clean; incomplete ones are not clean."""
    made = four_hour(bars, market)
    order = Window.partitionBy("symbol").orderBy("timestamp")
    derived = made.withColumns({"log_return": F.ln(F.col("close") / F.lag("close").over(order)), "dollar_volume": F.col("close") * F.col("volume"), "spread_hl": (F.col("high") - F.col("low")) / F.col("close")})
    return flag_clean(derived, also=~F.col("is_incomplete_bar"))
