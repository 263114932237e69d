"""Macro series with vintages, policy-rate grids, point-in-time reads, earnings, quotes and sentiment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Structural breaks (bank, first day, day after the last or null, id), later ones win.
BREAKS = (("BI", "2026-01-01", None, "BI_RATE"), ("BOJ", "2024-01-01", "2024-03-19", "BOJ_NIRP"))


def released(observations: DataFrame, run_date: Column) -> DataFrame:
    """Observations that were out on run_date."""
    return observations.where(F.coalesce("release_date", "observation_date") <= run_date)


def with_revisions(current: DataFrame, previous: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Adds is_revision and revision_seq against the previous vintage."""
    before = previous.select("series_id", "observation_date", F.col("value").alias("previous_value"), F.col("revision_seq").alias("previous_seq"))
    revised = F.col("previous_value").isNotNull() & (F.abs(F.col("value") - F.col("previous_value")) > tolerance)
    joined = current.join(before, ["series_id", "observation_date"], "left")
    return joined.withColumn("is_revision", F.coalesce(revised, F.lit(False))).withColumn("revision_seq", F.coalesce("previous_seq", F.lit(0)) + F.col("is_revision").cast("int")).drop("previous_value", "previous_seq")


def previous_vintage(vintages: DataFrame, run_date: Column) -> DataFrame:
    """The rows of the newest vintage before run_date."""
    newest = vintages.where(F.col("vintage_date") < run_date).agg(F.max("vintage_date").alias("v_"))
    return vintages.join(F.broadcast(newest), F.col("vintage_date") == F.col("v_")).drop("v_")


def latest_values(observations: DataFrame, *keys: str) -> DataFrame:
    """The last value of each key and its date."""
    return observations.groupBy(*keys).agg(F.max("observation_date").alias("observation_date"), F.max_by("value", "observation_date").alias("value"))


def rate_grid(decisions: DataFrame, run_date: Column, breaks=BREAKS, stale_days: int = 90) -> DataFrame:
    """A row per bank and day up to run_date: filled rate, basis points, direction, size and age of the last move.

    The grid is as long as the calendar from the first decision; decisions of one day count once, the latest ingested.
    """
    tie = "_ingested_at" if "_ingested_at" in decisions.columns else "rate_pct"
    known = decisions.groupBy("central_bank", "obs_date").agg(F.max_by("rate_pct", tie).alias("rate_raw"))
    bounds = known.agg(F.min("obs_date").alias("first")).select(F.explode(F.sequence("first", run_date)).alias("date"))
    grid = known.select("central_bank").distinct().crossJoin(F.broadcast(bounds))  # banks times days: the grid that is asked for
    joined = grid.join(known.withColumnRenamed("obs_date", "date"), ["central_bank", "date"], "left")
    upto = Window.partitionBy("central_bank").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    order = Window.partitionBy("central_bank").orderBy("date")
    meeting = F.col("rate_raw").isNotNull()
    filled = joined.withColumns({"is_meeting_day": meeting, "rate_pct": F.last("rate_raw", ignorenulls=True).over(upto), "effective_date": F.last(F.when(meeting, F.col("date")), ignorenulls=True).over(upto)}).withColumn("rate_bps", F.col("rate_pct") * 100)
    change = F.col("rate_bps") - F.lag("rate_bps").over(order)
    out = filled.withColumn("change", change).withColumns({"direction": F.when(meeting, F.coalesce(F.signum("change"), F.lit(0.0))).otherwise(0.0).cast("int"), "magnitude_bps": F.when(meeting, F.abs("change")), "ffill_days": F.datediff("date", "effective_date")})
    out = out.withColumn("is_stale", F.col("ffill_days") > stale_days)
    flag = F.lit(None).cast("string")
    for bank, first, end, name in breaks:
        inside = (F.col("central_bank") == bank) & (F.col("date") >= F.lit(first).cast("date"))
        flag = F.when(inside if end is None else inside & (F.col("date") < F.lit(end).cast("date")), F.lit(name)).otherwise(flag)
    return out.withColumn("structural_break", flag).where("rate_pct IS NOT NULL").drop("rate_raw", "change")


def as_of(facts: DataFrame, decisions: DataFrame, key: str, fact_time: str, decision_time: str, *values: str, strict: bool = False) -> DataFrame:
    """For each decision row the values of its key's last fact before (strict) or at its time; no pairs are made.

    Facts and decisions of a key's day are ordered together and the last fact is carried forward, so a key's rows
    are dealt by day. Each day starts with the last fact of the key's earlier days, which comes from one row a day.
    Times that are neither dates nor timestamps are not dealt by day. Null keys and null times equal each other,
    and a null time is the earliest; of facts at one time the largest values count.
    """
    ids = decisions.columns
    carried = F.struct(F.col(fact_time).alias("fact_time"), *values)
    rank = 1 if strict else 0  # at equal times facts come first unless they have to be earlier
    union = facts.select(F.col(key).alias("k_"), F.col(fact_time).alias("t_"), F.lit(rank).alias("o_"), carried.alias("f_"), F.lit(None).cast(decisions.select(F.struct(*ids).alias("d")).schema["d"].dataType).alias("d_"))
    union = union.unionByName(decisions.select(F.col(key).alias("k_"), F.col(decision_time).alias("t_"), F.lit(1 - rank).alias("o_"), F.lit(None).cast(union.schema["f_"].dataType).alias("f_"), F.struct(*ids).alias("d_")))
    days = {"date": F.unix_date("t_"), "timestamp": F.floor(F.unix_seconds("t_") / 86400), "timestamp_ntz": F.unix_date(F.col("t_").cast("date"))}
    union = union.withColumn("day_", days.get(union.schema["t_"].dataType.typeName(), F.lit(0)).cast("long"))
    earlier = Window.partitionBy("k_").orderBy("day_").rowsBetween(Window.unboundedPreceding, -1)
    starts = union.groupBy("k_", "day_").agg(F.max("f_").alias("f_")).withColumn("f_", F.last("f_", ignorenulls=True).over(earlier)).where("f_ IS NOT NULL")
    starts = starts.select("k_", F.lit(None).cast(union.schema["t_"].dataType).alias("t_"), F.lit(-1).alias("o_"), "f_", F.lit(None).cast(union.schema["d_"].dataType).alias("d_"), "day_")
    upto = Window.partitionBy("k_", "day_").orderBy(F.col("o_") >= 0, "t_", "o_", F.col("f_").asc()).rowsBetween(Window.unboundedPreceding, 0)
    found = union.unionByName(starts).withColumn("f_", F.last("f_", ignorenulls=True).over(upto)).where("d_ IS NOT NULL")
    return found.select("d_.*", "f_.*")


def window_before(bars: DataFrame, decisions: DataFrame, lookback_days: int = 252) -> DataFrame:
    """Clean bars of each (symbol, trade_date) decision in [trade_date - lookback, trade_date), with that trade_date.

    The calendar is cut into spans as long as the lookback, so a window meets at most two of them. Decisions go to the spans that
    they meet and join the bars by symbol and span, which gives at most twice the rows of the result; a
    symbol's decisions are as many keys as its years have spans, and a span has no more bars than the lookback. Null symbols
    and dates meet nothing; repeated decisions repeat their rows.
    """
    span = lambda day: F.floor(F.unix_date(day) / max(1, lookback_days))
    first, last = span(F.date_sub("trade_date", lookback_days)), span(F.date_sub("trade_date", 1))
    asked = decisions.where("trade_date IS NOT NULL").select("symbol", "trade_date", F.explode(F.sequence(first, last)).alias("span_"))
    day = F.to_date("timestamp")
    met = bars.where("is_clean").withColumn("span_", span(day)).join(asked, ["symbol", "span_"])
    return met.where((day >= F.date_sub("trade_date", lookback_days)) & (day < F.col("trade_date"))).drop("span_")


def vintages_as_of(vintages: DataFrame, day: Column, lookback_days: int = 365, newest_only: bool = False) -> DataFrame:
    """Observations of the lookback that were known on a day; all vintages or the newest of each."""
    known = vintages.where((F.col("observation_date") >= F.date_sub(day, lookback_days)) & (F.col("vintage_date") <= day))
    return known.groupBy("series_id", "observation_date").agg(F.max("vintage_date").alias("vintage_date"), F.max_by("value", "vintage_date").alias("value")) if newest_only else known


def earnings(events: DataFrame, run_date: Column) -> DataFrame:
    """The latest fetch of each (symbol, earnings_date) known on run_date, with days_to_earnings and is_reported."""
    rest = [c for c in events.columns if c not in ("symbol", "earnings_date", "fetched_date")]
    newest = events.where(F.col("fetched_date") <= run_date).groupBy("symbol", "earnings_date").agg(F.max(F.struct("fetched_date", *rest)).alias("n_")).select("symbol", "earnings_date", "n_.*")
    return newest.withColumns({"days_to_earnings": F.datediff("earnings_date", run_date), "is_reported": F.col("eps_actual").isNotNull()})


def upcoming(processed: DataFrame, within_days: int) -> DataFrame:
    return processed.where(F.col("days_to_earnings").between(0, within_days))


def days_to_next(processed: DataFrame) -> DataFrame:
    return processed.where("days_to_earnings >= 0").groupBy("symbol").agg(F.min("days_to_earnings").alias("days_to_earnings"))


def latest_quotes(quotes: DataFrame) -> DataFrame:
    rest = [c for c in quotes.columns if c not in ("symbol", "timestamp")]
    return quotes.groupBy("symbol").agg(F.max(F.struct("timestamp", *rest)).alias("n_")).select("symbol", "n_.*")


SENTIMENT = {"symbol": "string", "date": "date", "sentiment_score": "double", "buzz_score": "double", "news_volume_7d": "long", "source": "string"}


def sentiment(raw: DataFrame, run_date: Column) -> DataFrame:
    """Six typed columns of rows with a score; empty where columns are missing."""
    needed = [c for c in SENTIMENT if c != "date"]
    if not set(needed) <= set(raw.columns):
        return raw.sparkSession.createDataFrame([], ", ".join(f"{c} {t}" for c, t in SENTIMENT.items()))
    return raw.where("sentiment_score IS NOT NULL").withColumn("date", run_date).select(*[F.col(c).cast(t).alias(c) for c, t in SENTIMENT.items()])
