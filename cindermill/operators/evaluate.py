"""Walk-forward windows, calendars, signal episodes and trade statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cindermill.operators.prefix import machine_states, numbered
from cindermill.sources.scratch import Scratch


def walk_forward_windows(spans: DataFrame, train_months: int = 12, test_months: int = 3) -> DataFrame:
    """From rows (start, end): window, train_start, test_start, test_end; months have 30 days and windows slide by the test length."""
    train, test = 30 * train_months, 30 * test_months
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.datediff("end", "start") - train - test) / test)).cast("int"))
    rows = spans.where(F.datediff("end", "start") >= train + test).select("*", F.explode(starts).alias("window"))
    begin = F.date_add("start", F.col("window") * test)
    return rows.select("window", begin.alias("train_start"), F.date_add(begin, train).alias("test_start"), F.date_add(begin, train + test).alias("test_end"))


def weekdays(spans: DataFrame) -> DataFrame:
    """Monday to Friday from start to end."""
    return spans.select(F.explode(F.sequence("start", "end")).alias("date")).where(F.weekday("date") < 5)


FLAT, LONG, SHORT = range(3)


def episodes(scored: DataFrame, least_score: int = 5) -> DataFrame:
    """Trades per (symbol, window) from rows (symbol, window, date, close, mtf_score, signal_quality), one row a date.

    Enter when flat on a strong grade A or B score, leave on a sign flip, a grade D or the window's last row, on which
    nothing is entered. Each row maps flat, long and short to the state that follows; maps compose along the
    group (`prefix`), so a group's days are not walked one by one. A null score or grade neither enters nor leaves.
    Scores, days and changes are read more than once each and so are written, or every reader would make them anew.
    """
    kept = Scratch(scored.sparkSession)
    rows = kept.keep("scored", scored.select("symbol", "window", "date", "close", "mtf_score", "signal_quality"))
    days = kept.keep("days", numbered(rows, F.struct("symbol", "window"), "date"))
    kept.drop("scored")
    last, score = F.col("n_") == F.col("total_"), F.coalesce("mtf_score", F.lit(0))
    grade = F.coalesce("signal_quality", F.lit(""))
    strong = (F.abs(score) >= least_score) & grade.isin("A", "B") & ~last
    leave = last | (grade == "D")
    moves = [F.when(strong & (score > 0), LONG).when(strong & (score < 0), SHORT).otherwise(FLAT), F.when(leave | (score < 0), FLAT).otherwise(LONG), F.when(leave | (score > 0), FLAT).otherwise(SHORT)]
    walked = machine_states(days, moves)
    direction = F.when(F.col("state_before_") == LONG, 1).when(F.col("state_before_") == SHORT, -1)
    reason = F.when(score * direction < 0, "flip").when(grade == "D", "grade").otherwise("window_end")
    changes = kept.keep("changes", walked.where("(state_before_ = 0) != (state_ = 0)").select("symbol", "window", "date", "close", direction.alias("direction"), F.when(direction.isNotNull(), reason).alias("exit_reason")))
    kept.drop("days")
    # entries and exits take turns, beginning with an entry, and the last row leaves none open
    turns = numbered(changes, F.struct("symbol", "window"), "date").select("*", F.floor((F.col("n_") + 1) / 2).alias("trade_"))
    entries = turns.where("direction IS NULL").select("key_", "trade_", F.col("date").alias("entry_date"), F.col("close").alias("entry_price"))
    exits = turns.where("direction IS NOT NULL").withColumnsRenamed({"date": "exit_date", "close": "exit_price"})
    return exits.join(entries, ["key_", "trade_"]).select("symbol", "window", "direction", "entry_date", "exit_date", "entry_price", "exit_price", F.datediff("exit_date", "entry_date").alias("hold_days"), "exit_reason")


def with_pnl(trades: DataFrame, notional: float = 10_000.0, commission: float = 0.0) -> DataFrame:
    """qty, pnl and pnl_pct at a fixed notional; shorts gain when the price falls."""
    quantity = F.floor(F.lit(notional) / F.col("entry_price"))
    pnl = F.col("direction") * (F.col("exit_price") - F.col("entry_price")) * quantity - commission
    return trades.withColumns({"qty": quantity, "pnl": pnl, "pnl_pct": F.col("direction") * (F.col("exit_price") / F.col("entry_price") - 1)})


def trade_statistics(trades: DataFrame, *by: str) -> DataFrame:
    """Counts, win rate, totals, profit factor (infinite without losses), expectancy, holding times and Sharpe per trade."""
    win, lose = F.col("pnl") > 0, F.col("pnl") < 0
    gained, lost = F.coalesce(F.sum(F.when(win, F.col("pnl"))), F.lit(0.0)), F.abs(F.coalesce(F.sum(F.when(lose, F.col("pnl"))), F.lit(0.0)))
    deviation = F.stddev_samp("pnl_pct")
    return trades.groupBy(*by).agg(F.count("*").alias("n_trades"), F.count_if(win).alias("n_wins"), F.avg(win.cast("int")).alias("win_rate"), F.sum("pnl").alias("total_pnl"), F.avg("pnl").alias("avg_pnl"), F.avg(F.when(win, F.col("pnl"))).alias("avg_win"), F.avg(F.when(lose, F.col("pnl"))).alias("avg_loss"), F.when(lost > 0, gained / lost).otherwise(F.lit(float("inf"))).alias("profit_factor"), F.avg("pnl").alias("expectancy"), F.min("hold_days").alias("hold_min"), F.avg("hold_days").alias("hold_avg"), F.max("hold_days").alias("hold_max"), F.when((F.count("*") >= 2) & (deviation > 0), F.avg("pnl_pct") / deviation * (252 ** 0.5)).otherwise(0.0).alias("sharpe"))


def equity(trades: DataFrame, *by: str, initial: float = 100_000.0) -> DataFrame:
    """Equity after each exit date."""
    daily = trades.groupBy(*by, F.col("exit_date").alias("date")).agg(F.sum("pnl").alias("pnl"))
    return daily.withColumn("equity", initial + F.sum("pnl").over(Window.partitionBy(*by).orderBy("date")))


def drawdown(curve: DataFrame, *by: str, initial: float = 100_000.0, years: Column | None = None) -> DataFrame:
    """Largest fall from the running peak, recovery factor and Calmar ratio."""
    peak = F.greatest(F.max("equity").over(Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)), F.lit(initial))
    measured = curve.withColumns({"fall": (peak - F.col("equity")) / peak, "fall_abs": peak - F.col("equity")})
    out = measured.groupBy(*by).agg(F.max("fall").alias("max_drawdown"), F.max("fall_abs").alias("max_fall"), F.max_by("equity", "date").alias("final"))
    annual = F.pow(F.greatest(F.col("final"), F.lit(0.0)) / initial, 1 / (F.lit(1.0) if years is None else F.greatest(years, F.lit(0.1)))) - 1
    return out.withColumns({"recovery_factor": F.when(F.col("max_fall") > 0, (F.col("final") - initial) / F.col("max_fall")).otherwise(0.0), "calmar": F.when(F.col("max_drawdown") > 0, annual / F.col("max_drawdown")).otherwise(0.0)}).drop("max_fall")


def walk_forward_consistency(windows: DataFrame) -> DataFrame:
    """From rows (window, return_pct): share of profitable windows, mean, spread, best, worst and score."""
    share, spread = F.avg((F.col("return_pct") > 0).cast("int")), F.coalesce(F.stddev_samp("return_pct"), F.lit(0.0))
    return windows.agg(F.count("*").alias("n_windows"), share.alias("pct_profitable"), F.avg("return_pct").alias("avg_return"), spread.alias("std_return"), F.max("return_pct").alias("best"), F.min("return_pct").alias("worst"), (share * (1 - spread)).alias("consistency_score"))


def span(spark: SparkSession, bars: DataFrame) -> DataFrame:
    """One row (start, end) with the first and last day of a bar table."""
    return bars.agg(F.to_date(F.min("timestamp")).alias("start"), F.to_date(F.max("timestamp")).alias("end"))
