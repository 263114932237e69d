"""Data-quality checks over bar and macro tables, and the gate that reads them.

Each check is an aggregate that gives one row (check_name, severity, passed, status, measured);
`check_table` puts them together. Checks of a layer are the same functions over that layer's rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cindermill.operators.bars import series_keys

CRITICAL, WARNING, INFO = "CRITICAL", "WARNING", "INFO"


def _verdict(measured: DataFrame, name: str, severity: str, passed: Column) -> DataFrame:
    """One row; no data gives status 'skipped', which passes."""
    return measured.select(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), F.coalesce(passed, F.lit(True)).alias("passed"), F.when(F.col("n") == 0, "skipped").when(passed, "ok").otherwise("failed").alias("status"), F.col("measured").cast("double").alias("measured"))


def null_rate(bars: DataFrame, limit: float = 0.001, name: str = "null_check", severity: str = CRITICAL) -> DataFrame:
    missing = F.col("open").isNull() | F.col("high").isNull() | F.col("low").isNull() | F.col("close").isNull()
    return _verdict(bars.agg(F.count("*").alias("n"), F.avg(missing.cast("int")).alias("measured")), name, severity, F.col("measured") <= limit)


def price_sanity(bars: DataFrame, name: str = "price_sanity", severity: str = CRITICAL) -> DataFrame:
    wrong = (F.col("high") < F.col("low")) | ~F.col("open").between(F.col("low"), F.col("high")) | ~F.col("close").between(F.col("low"), F.col("high")) | (F.col("close") <= 0)
    return _verdict(bars.agg(F.count("*").alias("n"), F.count_if(wrong).alias("measured")), name, severity, F.col("measured") == 0)


def coverage(bars: DataFrame, universe: DataFrame, run_date: Column, days: int = 5, share: float = 0.95, name: str = "coverage", severity: str = CRITICAL) -> DataFrame:
    recent = bars.where(F.to_date("timestamp") >= F.date_sub(run_date, days)).select("symbol").distinct()
    known = universe.select("symbol").distinct().join(recent.withColumn("present", F.lit(1)), "symbol", "left")
    return _verdict(known.agg(F.count("*").alias("n"), F.avg(F.coalesce("present", F.lit(0))).alias("measured")), name, severity, F.col("measured") >= share)


def gaps(bars: DataFrame, days: int = 5) -> DataFrame:
    """symbol, date, gap_days of bars more than `days` after the one before."""
    keys = series_keys(bars)
    order = Window.partitionBy(*keys).orderBy("date")
    return bars.select(*keys, F.to_date("timestamp").alias("date")).withColumn("gap_days", F.datediff("date", F.lag("date").over(order))).where(F.col("gap_days") > days)


def gap_detection(bars: DataFrame, days: int = 5, allowed: int = 50, name: str = "gap_detection", severity: str = WARNING) -> DataFrame:
    return _verdict(gaps(bars, days).agg(F.count("*").alias("measured"), F.lit(1).alias("n")), name, severity, F.col("measured") <= allowed)


def outliers(bars: DataFrame, limit: float = 4.0) -> DataFrame:
    """The bars with z, the log return's distance from the symbol's mean in standard deviations, and is_outlier."""
    every = Window.partitionBy(*series_keys(bars))
    deviation = F.stddev_samp("log_return").over(every)
    z = F.when(deviation > 0, (F.col("log_return") - F.avg("log_return").over(every)) / deviation)
    return bars.withColumn("z", z).withColumn("is_outlier", F.coalesce(F.abs("z") > limit, F.lit(False)))


def flag_outliers(bars: DataFrame, limit: float = 4.0) -> DataFrame:
    """is_clean turned from true to false for outliers; nothing else changes."""
    return outliers(bars, limit).withColumn("is_clean", F.when(F.col("is_outlier") & F.col("is_clean"), False).otherwise(F.col("is_clean"))).drop("z", "is_outlier")


def outlier_counts(bars: DataFrame, limit: float = 4.0) -> DataFrame:
    return outliers(bars, limit).groupBy("symbol").agg(F.count_if("is_outlier").alias("n_outliers"), F.count("*").alias("n_bars"))


def outlier_check(bars: DataFrame, limit: float = 4.0, name: str = "outliers", severity: str = WARNING) -> DataFrame:
    return _verdict(outliers(bars, limit).agg(F.count("*").alias("n"), F.count_if("is_outlier").alias("measured")), name, severity, F.col("measured") == 0)


def freshness(bars: DataFrame, run_date: Column, days: int = 5, name: str = "freshness", severity: str = WARNING) -> DataFrame:
    return _verdict(bars.agg(F.count("*").alias("n"), F.datediff(run_date, F.max(F.to_date("timestamp"))).alias("measured")), name, severity, F.col("measured") <= days)


def pit_integrity(vintages: DataFrame, name: str = "pit_integrity", severity: str = WARNING) -> DataFrame:
    return _verdict(vintages.agg(F.count("*").alias("n"), F.count_if(F.col("vintage_date") < F.col("observation_date")).alias("measured")), name, severity, F.col("measured") == 0)


def adjusted_count(bars: DataFrame, name: str = "adj_integrity") -> DataFrame:
    return _verdict(bars.agg(F.count("*").alias("n"), F.count_if("is_adjusted").alias("measured")), name, INFO, F.lit(True))


def volatility_spike(series: DataFrame, warn: float = 40.0, note: float = 30.0) -> DataFrame:
    """level of the last value of (date, value): WARN, INFO or OK; never blocks."""
    last = series.agg(F.count("*").alias("n"), F.max_by("value", "date").alias("measured"))
    return last.select(F.lit("volatility_spike").alias("check_name"), F.when(F.col("measured") > warn, "WARN").when(F.col("measured") > note, "INFO").otherwise("OK").alias("level"), "measured")


def layer_checks(bars: DataFrame, universe: DataFrame, run_date: Column, prefix: str = "", null_limit: float = 0.001, share: float = 0.95, days: int = 5, allowed_gaps: int = 50, limit: float = 4.0) -> DataFrame:
    """The checks of one layer's bars in one pass over them: nulls, prices, coverage, gaps, outliers, freshness, and adjusted bars for the traded layer.

    A window pass marks gaps and outliers, one aggregate sums all marks by symbol, and one more over these, joined with the
    universe, measures everything. With a prefix the checks are those of the context layer, which only warn.
    """
    keys = series_keys(bars)
    every, order = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("timestamp")
    deviation, day = F.stddev_samp("log_return").over(every), F.to_date("timestamp")
    outlier = (deviation > 0) & (F.abs((F.col("log_return") - F.avg("log_return").over(every)) / deviation) > limit)
    gap = F.datediff(day, F.lag(day).over(order)) > days
    missing = F.col("open").isNull() | F.col("high").isNull() | F.col("low").isNull() | F.col("close").isNull()
    wrong = (F.col("high") < F.col("low")) | ~F.col("open").between(F.col("low"), F.col("high")) | ~F.col("close").between(F.col("low"), F.col("high")) | (F.col("close") <= 0)
    marked = bars.select("symbol", day.alias("day"), missing.alias("missing"), wrong.alias("wrong"), gap.alias("gap"), outlier.alias("outlier"), *([F.col("is_adjusted").alias("adjusted")] if not prefix else []))
    flags = [c for c in ("missing", "wrong", "gap", "outlier", "adjusted") if c in marked.columns]
    by_symbol = marked.groupBy("symbol").agg(F.count("*").alias("n"), F.max("day").alias("last"), *[F.count_if(c).alias(c) for c in flags])
    known = universe.select("symbol").distinct().withColumn("known", F.lit(True))
    there = F.col("last") >= F.date_sub(run_date, days)
    total = by_symbol.join(known, "symbol", "full").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if("known").alias("n_known"), F.count_if(F.col("known") & there).alias("present"), F.datediff(run_date, F.max("last")).alias("age"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in flags])
    names = ("context_null", "context_price_sanity", "context_coverage", "context_gaps", "context_outliers", "context_freshness") if prefix else ("null_check", "price_sanity", "coverage", "gap_detection", "outliers", "freshness")
    measures = [F.col("missing") / F.nullif("n", F.lit(0)), F.col("wrong"), F.col("present") / F.nullif("n_known", F.lit(0)), F.col("gap"), F.col("outlier"), F.col("age")]
    counts, severe = [F.col("n"), F.col("n"), F.col("n_known"), F.lit(1), F.col("n"), F.col("n")], (CRITICAL, CRITICAL, CRITICAL, WARNING, WARNING, WARNING)
    holds = [lambda m: m <= null_limit, lambda m: m == 0, lambda m: m >= share, lambda m: m <= allowed_gaps, lambda m: m == 0, lambda m: m <= days]
    rows = [F.struct(F.lit(name).alias("check_name"), F.lit(WARNING if prefix else severity).alias("severity"), count.cast("long").alias("n"), measure.cast("double").alias("measured"), test(measure).alias("ok")) for name, severity, count, measure, test in zip(names, severe, counts, measures, holds)]
    if not prefix:
        rows.append(F.struct(F.lit("adj_integrity").alias("check_name"), F.lit(INFO).alias("severity"), F.col("n").cast("long").alias("n"), F.col("adjusted").cast("double").alias("measured"), F.lit(True).alias("ok")))
    each = total.select(F.explode(F.array(*rows)).alias("c")).select("c.*")
    return each.select("check_name", "severity", F.coalesce("ok", F.lit(True)).alias("passed"), F.when(F.col("n") == 0, "skipped").when(F.col("ok"), "ok").otherwise("failed").alias("status"), "measured")


def check_table(bars: DataFrame, universe: DataFrame, vintages: DataFrame, run_date: Column, context: DataFrame | None = None, anchors: DataFrame | None = None) -> DataFrame:
    """All checks; those of the context layer with its own universe."""
    parts = [layer_checks(bars, universe, run_date), pit_integrity(vintages)]
    if context is not None:
        parts.append(layer_checks(context, anchors, run_date, "context"))
    return reduce(DataFrame.unionByName, parts)


class QualityGateError(RuntimeError):
    """A critical check failed."""


def gate(checks: DataFrame) -> DataFrame:
    """The checks, if no critical one failed."""
    failed = [r["check_name"] for r in checks.where((F.col("severity") == CRITICAL) & ~F.col("passed")).select("check_name").collect()]  # at most the named checks
    if failed:
        raise QualityGateError(", ".join(sorted(failed)))
    return checks


def validate(df: DataFrame, registry: T.StructType) -> DataFrame:
    """column, problem for missing columns, other types, and nulls where none may be."""
    have = {f.name: f for f in df.schema}
    static = [(f.name, "missing") for f in registry if f.name not in have] + [(f.name, f"type {have[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}") for f in registry if f.name in have and have[f.name].dataType != f.dataType]
    spark, kind = df.sparkSession, "column string, problem string"
    required = [f.name for f in registry if not f.nullable and f.name in have]
    out = spark.createDataFrame(static, kind)
    if required:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        nulls = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in required])).alias("e")).where("e.n > 0").select("e.column", F.concat("e.n", F.lit(" nulls")).alias("problem"))
        out = out.unionByName(nulls)
    return out


def route(df: DataFrame, registry: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the registry's null rules, and the others with _quarantine_reason."""
    reasons = F.concat_ws(" | ", *[F.when(F.col(f.name).isNull(), F.lit(f"{f.name} is null")) for f in registry if not f.nullable and f.name in df.columns])
    marked = df.withColumn("_quarantine_reason", reasons)
    return marked.where("_quarantine_reason = ''").drop("_quarantine_reason"), marked.where("_quarantine_reason != ''")


def stale_versions(bars: DataFrame, current: str) -> DataFrame:
    """symbol, timeframe and how many rows were made by another version."""
    return bars.where(F.col("processing_version").isNull() | (F.col("processing_version") != current)).groupBy("symbol", "timeframe").agg(F.count("*").alias("stale_rows"))


def version_histogram(bars: DataFrame) -> DataFrame:
    return bars.groupBy("processing_version").agg(F.count("*").alias("n_rows"), F.countDistinct("symbol").alias("n_symbols"))


def rows_to_reprocess(raw: DataFrame, stale: DataFrame) -> DataFrame:
    return raw.join(stale.select("symbol", "timeframe"), ["symbol", "timeframe"], "left_semi")


def market_coverage(bars: DataFrame, instruments: DataFrame, day: Column, alert_above: int = 5) -> DataFrame:
    """Per market: symbols expected and missing on a day, and whether that is an alert."""
    present = bars.where(F.to_date("timestamp") == day).select("symbol").distinct().withColumn("p", F.lit(1))
    joined = instruments.select("symbol", "market").distinct().join(present, "symbol", "left")
    return joined.groupBy("market").agg(F.count("*").alias("expected"), F.count_if(F.col("p").isNull()).alias("missing")).withColumn("alert", F.col("missing") > alert_above)


def cadence(observations: DataFrame, recent_days: int = 90, at_least: int = 30, limit: float = 4.0) -> DataFrame:
    """Per series the mean gap of its recent observations, or of its last ones where those are few."""
    dates = observations.where("value IS NOT NULL").select("series_id", "observation_date").distinct()
    newest = Window.partitionBy("series_id").orderBy(F.col("observation_date").desc())
    ranked = dates.withColumns({"rn": F.row_number().over(newest), "last_": F.max("observation_date").over(Window.partitionBy("series_id"))})
    ranked = ranked.withColumn("recent", F.datediff("last_", "observation_date") <= recent_days)
    ranked = ranked.withColumn("n_recent", F.count_if("recent").over(Window.partitionBy("series_id")))
    used = ranked.where(F.when(F.col("n_recent") > 1, F.col("recent")).otherwise(F.col("rn") <= at_least))
    gap = F.datediff("observation_date", F.lag("observation_date").over(Window.partitionBy("series_id").orderBy("observation_date")))
    return used.withColumn("gap", gap).groupBy("series_id").agg(F.avg("gap").alias("mean_gap")).withColumn("passed", F.coalesce(F.col("mean_gap") <= limit, F.lit(False)))


def latest_usable(observations: DataFrame, registry: DataFrame) -> DataFrame:
    """For every registered series its last value that is a number ('.' and '' are missing), and whether there is one."""
    usable = observations.withColumn("number", F.expr("try_cast(value AS DOUBLE)")).where("number IS NOT NULL")
    last = usable.groupBy("series_id").agg(F.max("observation_date").alias("observation_date"), F.max_by("number", "observation_date").alias("value"))
    return registry.select("series_id").distinct().join(last, "series_id", "left").withColumn("passed", F.col("value").isNotNull())


def registry_gap(declared: DataFrame, registry: DataFrame) -> DataFrame:
    return declared.select("series_id").distinct().join(registry.select("series_id"), "series_id", "left_anti")


def line_match(rows: DataFrame, matches: Column, period: str, label: str, sample: int = 5) -> DataFrame:
    """Matching rows, the latest period, and the first labels that do not match."""
    misses = rows.where(~matches).select(label).distinct().orderBy(label).limit(sample).agg(F.sort_array(F.collect_list(label)).alias("sample_misses"))
    return rows.agg(F.count_if(matches).alias("n_match"), F.max(F.when(matches, F.col(period))).alias("latest_period")).join(F.broadcast(misses))


def country_coverage(nested: DataFrame, column: str = "values") -> DataFrame:
    """Countries and latest year of a map country -> year -> value."""
    flat = nested.select(F.explode(column).alias("country", "years")).select("country", F.explode("years").alias("year", "value"))
    return flat.where("value IS NOT NULL").agg(F.countDistinct("country").alias("n_countries"), F.max(F.col("year").cast("int")).alias("latest_year"))


def zero_quotes(quotes: DataFrame, *columns: str) -> DataFrame:
    """Quotes with is_all_zero where every column is null or zero."""
    flag = reduce(Column.__and__, [F.coalesce(F.col(c), F.lit(0.0)) == 0 for c in columns])
    return quotes.withColumn("is_all_zero", flag)


def run_summary(runs: DataFrame) -> DataFrame:
    """Per (job, layer) of a run log: runs, successes, failures, mean duration and rows written."""
    return runs.groupBy("job", "layer").agg(F.count("*").alias("runs"), F.count_if(F.col("status") == "success").alias("successes"), F.count_if(F.col("status") == "failed").alias("failures"), F.avg("duration_sec").alias("avg_duration_sec"), F.sum("rows_written").alias("rows_written"))


def progress(done: DataFrame, universe: DataFrame) -> DataFrame:
    """Coverage of a universe by the symbols marked done."""
    joined = universe.select("symbol").distinct().join(done.where("status = 'success'").select("symbol").distinct().withColumn("d", F.lit(1)), "symbol", "left")
    return joined.agg(F.count("*").alias("n_total"), F.count_if(F.col("d").isNull()).alias("n_pending"), F.avg(F.coalesce("d", F.lit(0)) * 100).alias("coverage_pct"))


def recent_failures(runs: DataFrame, run_date: Column, days: int = 7, top: int = 15) -> DataFrame:
    return runs.where((F.col("status") == "failed") & (F.to_date("started_at") > F.date_sub(run_date, days))).orderBy(F.col("started_at").desc(), "run_id").limit(top)


def handle_mismatch(df: DataFrame, registry: T.StructType, on_mismatch: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Rows to go on with and rows set aside: 'warn' keeps all, 'fail' raises if any row is wrong, everything else quarantines."""
    good, bad = route(df, registry)
    if on_mismatch == "warn":
        return df, bad
    if on_mismatch == "fail" and not bad.isEmpty():
        raise QualityGateError("rows break the registry")
    return good, bad


def health_report(runs: DataFrame, bars: DataFrame, instruments: DataFrame, run_date: Column, market: str, alert_below: float = 90.0) -> DataFrame:
    """One row: the runs of a day, and how much of a market has bars then.

    total_runs, total_failed, total_rows and avg_duration_sec (of the jobs' means) from the day's `run_summary`; expected,
    present and missing symbols of the market, coverage_pct (null without symbols) and whether it is under the limit.
    """
    jobs = run_summary(runs.where(F.to_date("started_at") == run_date)).agg(F.coalesce(F.sum("runs"), F.lit(0)).alias("total_runs"), F.coalesce(F.sum("failures"), F.lit(0)).alias("total_failed"), F.coalesce(F.sum("rows_written"), F.lit(0)).alias("total_rows"), F.coalesce(F.avg("avg_duration_sec"), F.lit(0.0)).alias("avg_duration_sec"))
    covered = market_coverage(bars, instruments.where(F.col("market") == market), run_date).agg(F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"))
    present = F.col("expected") - F.col("missing")
    percent = present / F.nullif("expected", F.lit(0)) * 100
    return jobs.crossJoin(F.broadcast(covered)).select(run_date.alias("date"), "*", present.alias("present"), percent.alias("coverage_pct"), F.coalesce(percent < alert_below, F.lit(False)).alias("coverage_alert"))  # one row each
