"""Every registered query, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cindermill.functions import slippage
from cindermill.operators import bars as B
from cindermill.operators import correlate, dimension, evaluate, indicators, macro, quality, signals, universe, watchlist
from cindermill.plans import ingest_queries, rule_queries, upkeep_queries
from cindermill.plans.base import clean_daily, daily, hourly, last_day, rounded, sql
from cindermill.sources import adapters as A
from cindermill.sources import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", F.to_date("timestamp")).withColumnRenamed("timestamp", "date")


# bars

# prices are quotients of cents by small numbers: eight places have no ties, which the engines would round apart
_BAR = "round(open, 8) AS open, round(high, 8) AS high, round(low, 8) AS low, round(close, 8) AS close, volume"


@query(sql(f"SELECT symbol, CAST(t AS DATE) AS date, {_BAR} FROM daily", "daily"))
def daily_bars(spark, sf_dir):
    return rounded(_dated(daily(spark, sf_dir)), 8)


@query(sql(f"SELECT symbol, CAST(t AS DATE) AS date, {_BAR}, round(log_return, 6) AS log_return, round(dollar_volume, 8) AS dollar_volume, round(spread_hl, 6) AS spread_hl, is_clean FROM clean", "clean"))
def silver_bars(spark, sf_dir):
    out = _dated(clean_daily(spark, sf_dir)).select("symbol", "date", "open", "high", "low", "close", "volume", "log_return", "dollar_volume", "spread_hl", "is_clean")
    return rounded(out, 8, log_return=6, spread_hl=6)


@query(sql("SELECT symbol, t AS timestamp, round(sum((high + low + close) / 3 * volume) OVER w / nullif(sum(volume) OVER w, 0), 4) AS vwap FROM hourly WINDOW w AS (PARTITION BY symbol, CAST(t AS DATE) ORDER BY t ROWS UNBOUNDED PRECEDING)", "hourly"))
def session_vwap(spark, sf_dir):
    return rounded(B.add_derived(hourly(spark, sf_dir), session_vwap=True).select("symbol", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "vwap"))


@query(sql(f"SELECT symbol, t AS timestamp, {_BAR}, round(vwap, 4) AS vwap, bar_count, bar_count < 4 AS is_incomplete_bar FROM blocks", "blocks"))
def four_hour_bars(spark, sf_dir):
    return rounded(B.four_hour(hourly(spark, sf_dir)).drop("expected_bars").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), 8, vwap=4)


@query(sql("SELECT symbol, t AS timestamp, round(log_return, 6) AS log_return, (high >= low AND open BETWEEN low AND high AND close BETWEEN low AND high) AND CASE WHEN sd > 0 THEN abs((log_return - mean) / sd) <= 4 WHEN log_return IS NOT NULL THEN TRUE END AND bar_count >= 4 AS is_clean FROM (SELECT *, avg(log_return) OVER (PARTITION BY symbol) AS mean, stddev_samp(log_return) OVER (PARTITION BY symbol) AS sd FROM (SELECT *, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY t)) AS log_return FROM blocks))", "blocks"))
def four_hour_silver(spark, sf_dir):
    return rounded(B.silver_four_hour(hourly(spark, sf_dir)).select("symbol", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "log_return", "is_clean"), 6)


_SESSION = "SELECT symbol, to_timestamp(floor(epoch(t) / 14400) * 14400)::TIMESTAMP AS block, count(*) AS bar_count FROM hourly GROUP BY 1, 2"


@query(sql("""SELECT symbol, block AS timestamp, bar_count, expected_bars, expected_bars > 0 AND bar_count < expected_bars AS is_incomplete_bar FROM (
SELECT symbol, block, bar_count, CAST(list_sum(list_transform([0, 1, 2, 3], lambda k: CASE WHEN date_part('hour', timezone('America/New_York', timezone('UTC', block + to_hours(k)))) * 60 < 960 AND date_part('hour', timezone('America/New_York', timezone('UTC', block + to_hours(k)))) * 60 + 60 > 570 THEN 1 ELSE 0 END)) AS INT) AS expected_bars FROM b)""", "hourly", b=_SESSION))
def session_completeness(spark, sf_dir):
    return B.four_hour(hourly(spark, sf_dir), F.lit("us_stocks")).select("symbol", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "bar_count", "expected_bars", "is_incomplete_bar")


@query(sql("SELECT symbol, timestamp, round(price, 8) AS price, volume FROM (SELECT symbol, CAST(ts AS DATE) AS timestamp, price, volume, row_number() OVER (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY l_orderkey DESC, l_linenumber DESC, price DESC, volume DESC) AS rn FROM ticks) WHERE rn = 1", "ticks"))
def dedupe_bars(spark, sf_dir):
    raw = A.ticks(spark, sf_dir).select("symbol", F.to_date("timestamp").alias("timestamp"), "price", "volume", F.col("tie.l_orderkey").alias("k"), F.col("tie.l_linenumber").alias("n"))
    return rounded(B.dedupe(raw, ("symbol", "timestamp"), "k", "n").drop("k", "n"), 8)


_STAMPED = "SELECT *, '1D' AS timeframe, CAST(year(t) % 2 = 0 AND day(t) = 13 AS BOOLEAN) AS stale FROM daily UNION ALL SELECT *, '1W', FALSE FROM weekly"
_SERIES = """SELECT *, high >= low AND open BETWEEN low AND high AND close BETWEEN low AND high AND CASE WHEN sd > 0 THEN abs((log_return - mean) / sd) <= 4 WHEN log_return IS NOT NULL THEN TRUE END AND NOT stale AS is_clean
FROM (SELECT *, avg(log_return) OVER (PARTITION BY symbol, timeframe) AS mean, stddev_samp(log_return) OVER (PARTITION BY symbol, timeframe) AS sd FROM (SELECT *, ln(close / lag(close) OVER (PARTITION BY symbol, timeframe ORDER BY t)) AS log_return FROM st))"""


def _landed(spark, sf_dir) -> DataFrame:
    """Daily and weekly bars in one table, every bar landed twice, the second time with its prices, the first with zeros; some are stale."""
    ticks = A.ticks(spark, sf_dir)
    day, week = (B.from_ticks(ticks, unit).withColumn("timeframe", F.lit(tf)) for unit, tf in (("day", "1D"), ("week", "1W")))
    stale = (F.year("timestamp") % 2 == 0) & (F.dayofmonth("timestamp") == 13) & (F.col("timeframe") == "1D")
    bars = day.unionByName(week).withColumns({"staleness": stale, "_source": F.lit("second"), "_ingested_at": F.lit(2)})
    return bars.unionByName(bars.withColumns({c: F.lit(0.0) for c in B.PRICES} | {"_source": F.lit("first"), "_ingested_at": F.lit(1)}))


@query(sql(f"SELECT symbol, timeframe, CAST(t AS DATE) AS date, {_BAR}, round(log_return, 6) AS log_return, is_clean, 'second' AS data_source FROM se", "daily", "weekly", st=_STAMPED, se=_SERIES))
def silver_of_landed_bars(spark, sf_dir):
    out = _dated(B.silver(_landed(spark, sf_dir), "1D")).select("symbol", "timeframe", "date", "open", "high", "low", "close", "volume", "log_return", "is_clean", "data_source")
    return rounded(out, 8, log_return=6)


_VIX = "SELECT CAST(o_orderdate AS DATE) AS d, avg(o_totalprice) / 5000 AS v FROM orders WHERE day(o_orderdate) = 5 GROUP BY 1"


@query(sql("SELECT symbol, timeframe, count(*) AS n_bars, count(*) FILTER (coalesce(v, 0) > 30) AS n_flagged, count(vs) AS n_volume_sma, round(sum(coalesce(v, 0)), 2) AS level_sum FROM (SELECT * FROM (SELECT symbol, timeframe, CAST(t AS DATE) AS day, CASE WHEN count(volume) OVER w = 20 THEN avg(volume) OVER w END AS vs FROM se WHERE is_clean WINDOW w AS (PARTITION BY symbol, timeframe ORDER BY t ROWS 19 PRECEDING)) b ASOF LEFT JOIN vix ON b.day >= vix.d) GROUP BY 1, 2", "daily", "weekly", st=_STAMPED, se=_SERIES, vix=_VIX))
def signals_by_timeframe(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders").where(F.dayofmonth("o_orderdate") == 5)
    level = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg((F.avg("o_totalprice") / 5000).alias("value"))
    none = spark.createDataFrame([], "date date, value double")
    out = indicators.technical_signals(B.silver(_landed(spark, sf_dir), "1D"), spark.createDataFrame([], "symbol string"), [none, level], limit=30.0)
    return rounded(out.groupBy("symbol", "timeframe").agg(F.count("*").alias("n_bars"), F.count_if("high_volatility_flag").alias("n_flagged"), F.count("volume_sma_20").alias("n_volume_sma"), F.sum("vix_level").alias("level_sum")), level_sum=2)


# universe

@query(sql("""SELECT m.symbol, m.market, round(dv, 2) AS dollar_volume_20d, n AS clean_days, round(last_close, 8) AS last_close, reason AS eligibility_reason FROM (
SELECT *, 'always_in' AS reason FROM m WHERE market IN ('forex', 'commodity', 'index') UNION ALL
SELECT *, 'liquidity_screened' FROM (SELECT * FROM m WHERE (market = 'us_stocks' AND dv > 20000 AND last_close >= 1 AND n >= 5) OR (market = 'idx' AND dv > 20000 AND last_close >= 50 AND n >= 5) ORDER BY dv DESC, symbol LIMIT 175)) m""", "clean", "dim", "run", m="""SELECT symbol, market, avg(CASE WHEN rn <= 20 THEN close * volume END) AS dv, count(*) AS n, max(CASE WHEN rn = 1 THEN close END) AS last_close FROM (
SELECT c.symbol, d.market, c.close, c.volume, row_number() OVER (PARTITION BY c.symbol ORDER BY c.t DESC) AS rn FROM clean c JOIN dim d USING (symbol), run WHERE c.is_clean AND CAST(c.t AS DATE) BETWEEN run_date - 45 AND run_date) GROUP BY 1, 2"""))
def active_universe(spark, sf_dir):
    bars = clean_daily(spark, sf_dir)
    limits = {"us_stocks": (20_000.0, 1.0, 5), "idx": (20_000.0, 50.0, 5)}  # the generated volumes are small
    out = universe.active(bars, A.instruments(spark, sf_dir), last_day(A.ticks(spark, sf_dir)), limits)
    return rounded(out.drop("resolver_version", "is_fallback"), dollar_volume_20d=2, last_close=8)


@query(sql("SELECT DISTINCT symbol FROM daily WHERE symbol NOT IN (SELECT symbol FROM dim WHERE market <> 'forex')", "daily", "dim"))
def orphan_symbols(spark, sf_dir):
    return universe.orphans(daily(spark, sf_dir), A.instruments(spark, sf_dir).where("market <> 'forex'"))


# quality

@query(sql("SELECT symbol, CAST(t AS DATE) AS date, date_diff('day', CAST(p AS DATE), CAST(t AS DATE)) AS gap_days FROM (SELECT symbol, t, lag(t) OVER (PARTITION BY symbol ORDER BY t) AS p FROM daily) WHERE date_diff('day', CAST(p AS DATE), CAST(t AS DATE)) > 5", "daily"))
def gap_detection(spark, sf_dir):
    return quality.gaps(daily(spark, sf_dir)).withColumn("gap_days", F.col("gap_days").cast("long"))


@query(sql("SELECT symbol, count(*) FILTER (sd > 0 AND abs((log_return - mean) / sd) > 4) AS n_outliers, count(*) AS n_bars FROM clean GROUP BY symbol", "clean"))
def outlier_counts(spark, sf_dir):
    return quality.outlier_counts(clean_daily(spark, sf_dir))


@query(sql("SELECT symbol, count(*) FILTER (is_clean AND NOT (sd > 0 AND abs((log_return - mean) / sd) > 3)) AS n_clean FROM clean GROUP BY symbol", "clean"))
def outlier_write_back(spark, sf_dir):
    return quality.flag_outliers(clean_daily(spark, sf_dir), 3.0).groupBy("symbol").agg(F.count_if("is_clean").alias("n_clean"))


_CHECK = "SELECT '{0}' AS check_name, '{1}' AS severity, coalesce({2}, TRUE) AS passed, CASE WHEN n = 0 THEN 'skipped' WHEN {2} THEN 'ok' ELSE 'failed' END AS status, round(CAST(measured AS DOUBLE), 4) AS measured FROM ({3})"
_COVERED = "SELECT count(*) AS n, avg(CASE WHEN symbol IN (SELECT symbol FROM clean, run WHERE CAST(t AS DATE) >= run_date - 5) THEN 1 ELSE 0 END) AS measured FROM dim"


@query(sql(" UNION ALL ".join(_CHECK.format(*x) for x in (
    ("null_check", "CRITICAL", "measured <= 0.001", "SELECT count(*) AS n, avg(CASE WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL THEN 1 ELSE 0 END) AS measured FROM clean"),
    ("price_sanity", "CRITICAL", "measured = 0", "SELECT count(*) AS n, count(*) FILTER (high < low OR NOT open BETWEEN low AND high OR NOT close BETWEEN low AND high OR close <= 0) AS measured FROM clean"),
    ("coverage", "CRITICAL", "measured >= 0.95", _COVERED),
    ("gap_detection", "WARNING", "measured <= 50", "SELECT 1 AS n, count(*) AS measured FROM (SELECT t, lag(t) OVER (PARTITION BY symbol ORDER BY t) AS p FROM clean) WHERE date_diff('day', CAST(p AS DATE), CAST(t AS DATE)) > 5"),
    ("outliers", "WARNING", "measured = 0", "SELECT count(*) AS n, count(*) FILTER (sd > 0 AND abs((log_return - mean) / sd) > 4) AS measured FROM clean"),
    ("freshness", "WARNING", "measured <= 5", "SELECT count(*) AS n, date_diff('day', max(CAST(t AS DATE)), max(run_date)) AS measured FROM clean, run"),
    ("pit_integrity", "WARNING", "measured = 0", "SELECT count(*) AS n, count(*) FILTER (observation_date + 30 < observation_date) AS measured FROM macro1"),
    ("adj_integrity", "INFO", "TRUE", "SELECT count(*) AS n, count(*) AS measured FROM clean"),
)), "clean", "dim", "run", "macro1"))
def quality_checks(spark, sf_dir):
    bars = clean_daily(spark, sf_dir)
    vintages = A.macro_observations(spark, sf_dir).where("vintage = 1").withColumn("vintage_date", F.date_add("observation_date", 30))
    return rounded(quality.check_table(bars, A.instruments(spark, sf_dir), vintages, last_day(A.ticks(spark, sf_dir))))


@query(sql("SELECT market, count(*) AS expected, count(*) FILTER (NOT p) AS missing, count(*) FILTER (NOT p) > 5 AS alert FROM (SELECT market, symbol IN (SELECT symbol FROM daily, run WHERE CAST(t AS DATE) = run_date) AS p FROM dim) GROUP BY market", "daily", "dim", "run"))
def market_coverage(spark, sf_dir):
    bars = daily(spark, sf_dir)
    return quality.market_coverage(bars, A.instruments(spark, sf_dir), last_day(bars))


@query(sql("SELECT symbol, CASE WHEN year(t) % 2 = 0 THEN '1' ELSE '2' END AS processing_version, count(*) AS n_rows FROM daily WHERE year(t) % 2 = 0 GROUP BY 1, 2", "daily"))
def stale_versions(spark, sf_dir):
    bars = daily(spark, sf_dir).withColumns({"timeframe": F.lit("1D"), "processing_version": F.when(F.year("timestamp") % 2 == 0, "1").otherwise("2")})
    stale = quality.stale_versions(bars, "2")
    return quality.rows_to_reprocess(bars, stale).where("processing_version <> '2'").groupBy("symbol", "processing_version").agg(F.count("*").alias("n_rows"))


@query(sql("SELECT series_id, round(avg(gap), 4) AS mean_gap, avg(gap) <= 4 AS passed FROM (SELECT series_id, date_diff('day', lag(d) OVER (PARTITION BY series_id ORDER BY d), d) AS gap FROM (SELECT series_id, d, max(d) OVER (PARTITION BY series_id) AS m FROM o) WHERE date_diff('day', d, m) <= 90) GROUP BY series_id", o="SELECT DISTINCT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS d FROM orders"))
def series_cadence(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("observation_date"), F.col("o_totalprice").alias("value"))
    return rounded(quality.cadence(orders))


@query(sql("SELECT event_type AS job, 'bronze' AS layer, count(*) AS runs, count(*) FILTER (user_id % 5 <> 0) AS successes, count(*) FILTER (user_id % 5 = 0) AS failures, round(avg(value), 4) AS avg_duration_sec, CAST(sum(user_id) AS BIGINT) AS rows_written FROM events GROUP BY event_type"))
def run_summary(spark, sf_dir):
    runs = A.table(spark, sf_dir, "events").select(F.col("event_type").alias("job"), F.lit("bronze").alias("layer"), F.when(F.col("user_id") % 5 == 0, "failed").otherwise("success").alias("status"), F.col("value").alias("duration_sec"), F.col("user_id").alias("rows_written"))
    return rounded(quality.run_summary(runs))


# macro

@query(sql("SELECT b.series_id, b.observation_date, round(b.value, 4) AS value, a.value IS NOT NULL AND abs(b.value - a.value) > 1e-9 AS is_revision, CAST(CASE WHEN a.value IS NOT NULL AND abs(b.value - a.value) > 1e-9 THEN 1 ELSE 0 END AS INT) AS revision_seq FROM macro1 b LEFT JOIN macro0 a USING (series_id, observation_date)", "macro0", "macro1"))
def macro_revisions(spark, sf_dir):
    observations = A.macro_observations(spark, sf_dir)
    first = observations.where("vintage = 0").withColumn("revision_seq", F.lit(0))
    return rounded(macro.with_revisions(observations.where("vintage = 1").drop("vintage"), first))


@query(sql("SELECT series_id, observation_date, round(value, 4) AS value FROM macro1, (SELECT max(observation_date) AS m FROM macro1) WHERE observation_date + 45 <= m", "macro1"))
def point_in_time_macro(spark, sf_dir):
    observations = A.macro_observations(spark, sf_dir).where("vintage = 1").withColumn("release_date", F.date_add("observation_date", 45))
    run_date = F.lit(observations.agg(F.max("observation_date")).first()[0])
    return rounded(macro.released(observations, run_date).drop("vintage", "release_date"))


@query(sql("SELECT series_id, max(observation_date) AS observation_date, round(arg_max(value, observation_date), 4) AS value FROM macro1 GROUP BY series_id", "macro1"))
def latest_macro(spark, sf_dir):
    return rounded(macro.latest_values(A.macro_observations(spark, sf_dir).where("vintage = 1"), "series_id"))


_GRID = """SELECT central_bank, date, r, last_value(r IGNORE NULLS) OVER w AS rate_pct, last_value(CASE WHEN r IS NOT NULL THEN date END IGNORE NULLS) OVER w AS effective_date FROM (
SELECT b.central_bank, d.date, rates.rate_pct AS r FROM (SELECT DISTINCT central_bank FROM rates) b CROSS JOIN (SELECT CAST(unnest(generate_series((SELECT min(obs_date) FROM rates), (SELECT max(obs_date) + 120 FROM rates), INTERVAL 1 DAY)) AS DATE) AS date) d LEFT JOIN rates ON rates.central_bank = b.central_bank AND rates.obs_date = d.date) WINDOW w AS (PARTITION BY central_bank ORDER BY date ROWS UNBOUNDED PRECEDING)"""


@query(sql("""SELECT central_bank, date, r IS NOT NULL AS is_meeting_day, round(rate_pct, 4) AS rate_pct, effective_date, round(rate_pct * 100, 4) AS rate_bps, CAST(CASE WHEN r IS NOT NULL THEN coalesce(sign(change), 0) ELSE 0 END AS INT) AS direction, round(CASE WHEN r IS NOT NULL THEN abs(change) END, 4) AS magnitude_bps, CAST(date_diff('day', effective_date, date) AS INT) AS ffill_days, date_diff('day', effective_date, date) > 90 AS is_stale, CASE WHEN central_bank = 'BUILDING' AND date >= DATE '1994-01-01' THEN 'B' WHEN central_bank = 'MACHINERY' AND date >= DATE '1995-01-01' AND date < DATE '1996-01-01' THEN 'M' END AS structural_break FROM (SELECT *, rate_pct * 100 - lag(rate_pct * 100) OVER (PARTITION BY central_bank ORDER BY date) AS change FROM g) WHERE rate_pct IS NOT NULL""", "rates", g=_GRID))
def policy_rate_grid(spark, sf_dir):
    decisions = A.rate_decisions(spark, sf_dir)
    run_date = F.lit(decisions.agg(F.date_add(F.max("obs_date"), 120)).first()[0])
    breaks = (("BUILDING", "1994-01-01", None, "B"), ("MACHINERY", "1995-01-01", "1996-01-01", "M"))
    return rounded(macro.rate_grid(decisions, run_date, breaks))


@query(sql("SELECT e.event_id, e.symbol, round(b.close, 8) AS close FROM (SELECT o_orderkey AS event_id, ([" + ", ".join(f"'Brand#{a}{b}'" for a in range(1, 6) for b in range(1, 6)) + "])[o_custkey % 25 + 1] AS symbol, CAST(o_orderdate AS DATE) AS d FROM orders) e ASOF LEFT JOIN (SELECT symbol, CAST(t AS DATE) AS d, close FROM daily) b ON e.symbol = b.symbol AND e.d > b.d", "daily"))
def bars_as_of(spark, sf_dir):
    names = F.array(*[F.lit(f"Brand#{a}{b}") for a in range(1, 6) for b in range(1, 6)])
    decisions = A.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), F.element_at(names, (F.col("o_custkey") % 25 + 1).cast("int")).alias("symbol"), F.to_date("o_orderdate").alias("trade_date"))
    facts = daily(spark, sf_dir).withColumn("day", F.to_date("timestamp"))
    return rounded(macro.as_of(facts, decisions, "symbol", "day", "trade_date", "close", strict=True).select("event_id", "symbol", "close"), 8)


@query(sql("SELECT symbol, source, last_date, CASE WHEN last_date IS NULL THEN run_date - 3650 ELSE last_date - 7 END AS start_date FROM (SELECT dim.symbol, 'primary' AS source, max(CAST(t AS DATE)) AS last_date FROM dim LEFT JOIN daily ON daily.symbol = dim.symbol AND dim.market <> 'idx' GROUP BY 1), run", "daily", "dim", "run"))
def fetch_starts(spark, sf_dir):
    bars, dim = daily(spark, sf_dir), A.instruments(spark, sf_dir)
    landed = bars.join(F.broadcast(dim.where("market <> 'idx'").select("symbol")), "symbol", "left_semi").withColumn("source", F.lit("primary"))
    return ingest.start_dates(landed, dim.withColumn("source", F.lit("primary")), last_day(bars))


@query(sql("SELECT symbol, timeframe, fetch_date, source AS _source, count(*) AS n FROM (SELECT *, min(source) OVER (PARTITION BY symbol, fetch_date) AS best FROM (SELECT l_returnflag AS source, '1D' AS timeframe, p_brand AS symbol, CAST(l_shipdate AS DATE) AS fetch_date FROM lineitem JOIN part ON l_partkey = p_partkey)) WHERE source = best GROUP BY ALL"))
def source_fallback(spark, sf_dir):
    rows = A.ticks(spark, sf_dir).select("symbol", F.lit("1D").alias("timeframe"), F.to_date("timestamp").alias("fetch_date"), F.col("tie.l_returnflag").alias("source"))
    order = spark.createDataFrame([("A", 1), ("N", 2), ("R", 3)], "source string, priority int")
    return ingest.first_source(rows, order).groupBy("symbol", "timeframe", "fetch_date", "_source").agg(F.count("*").alias("n"))


@query(sql("SELECT symbol, CAST(t AS DATE) AS date, CAST(t AS DATE) < run_date AS staleness FROM (SELECT daily.*, run_date, max(CAST(t AS DATE)) OVER (PARTITION BY symbol) AS m FROM daily, run WHERE CAST(t AS DATE) >= run_date - 1) WHERE CAST(t AS DATE) = m", "daily", "run"))
def stale_carry(spark, sf_dir):
    bars = daily(spark, sf_dir).withColumn("timeframe", F.lit("1D"))
    carried = ingest.carry_yesterday(bars, A.instruments(spark, sf_dir).withColumn("timeframe", F.lit("1D")), last_day(bars))
    return carried.select("symbol", F.to_date("timestamp").alias("date"), "staleness")


# indicators

@query(sql("SELECT symbol, CAST(t AS DATE) AS date, round(CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END, 4) AS bb_mid, round(CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w + 2 * stddev_pop(close) OVER w END, 4) AS bb_upper, round(CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w - 2 * stddev_pop(close) OVER w END, 4) AS bb_lower FROM daily WINDOW w AS (PARTITION BY symbol ORDER BY t ROWS 19 PRECEDING)", "daily"))
def bollinger_bands(spark, sf_dir):
    return rounded(_dated(indicators.add_bollinger(daily(spark, sf_dir))).select("symbol", "date", "bb_mid", "bb_upper", "bb_lower"))


_STEP = {"ema_9": ("close", 2 / 10), "ema_21": ("close", 2 / 22), "ema_50": ("close", 2 / 51), "ema_200": ("close", 2 / 201), "e12": ("close", 2 / 13), "e26": ("close", 2 / 27), "g14": ("gain", 1 / 14), "l14": ("loss", 1 / 14), "g28": ("gain", 1 / 28), "l28": ("loss", 1 / 28), "atr_14": ("tr", 1 / 14), "p14": ("pdm", 1 / 14), "m14": ("mdm", 1 / 14)}
_INPUTS = """SELECT symbol, t, close, rn, greatest(coalesce(d, 0), 0) AS gain, greatest(-coalesce(d, 0), 0) AS loss, tr, CASE WHEN up > dn AND up > 0 THEN up ELSE 0.0 END AS pdm, CASE WHEN dn > up AND dn > 0 THEN dn ELSE 0.0 END AS mdm FROM (
SELECT symbol, t, close, row_number() OVER w AS rn, close - lag(close) OVER w AS d, greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr, coalesce(high - lag(high) OVER w, 0) AS up, coalesce(lag(low) OVER w - low, 0) AS dn FROM clean WHERE is_clean WINDOW w AS (PARTITION BY symbol ORDER BY t))"""
_WALK = f"SELECT symbol, t, close, rn, {', '.join(f'{x} AS {n}' for n, (x, _) in _STEP.items())} FROM i WHERE rn = 1 UNION ALL SELECT i.symbol, i.t, i.close, i.rn, {', '.join(f'{a!r} * i.{x} + (1 - {a!r}) * r.{n}' for n, (x, a) in _STEP.items())} FROM r JOIN i ON i.symbol = r.symbol AND i.rn = r.rn + 1"
_MADE = "SELECT *, e12 - e26 AS macd, 100 * p14 / nullif(atr_14, 0) AS di_plus, 100 * m14 / nullif(atr_14, 0) AS di_minus FROM r"
_MORE = f"SELECT symbol, t, rn, macd AS macd_signal, coalesce(100 * abs(di_plus - di_minus) / nullif(di_plus + di_minus, 0), 0) AS adx_14 FROM m WHERE rn = 1 UNION ALL SELECT m.symbol, m.t, m.rn, {2 / 10!r} * m.macd + (1 - {2 / 10!r}) * s.macd_signal, {1 / 14!r} * coalesce(100 * abs(m.di_plus - m.di_minus) / nullif(m.di_plus + m.di_minus, 0), 0) + (1 - {1 / 14!r}) * s.adx_14 FROM s JOIN m ON m.symbol = s.symbol AND m.rn = s.rn + 1"


@query(sql("SELECT m.symbol, CAST(m.t AS DATE) AS date, round(ema_9, 4) AS ema_9, round(ema_21, 4) AS ema_21, round(ema_50, 4) AS ema_50, round(ema_200, 4) AS ema_200, round(100 - 100 / (1 + g14 / CASE WHEN l14 = 0 THEN 1e-10 ELSE l14 END), 4) AS rsi_14, round(100 - 100 / (1 + g28 / CASE WHEN l28 = 0 THEN 1e-10 ELSE l28 END), 4) AS rsi_28, round(macd, 4) AS macd, round(macd_signal, 4) AS macd_signal, round(macd - macd_signal, 4) AS macd_hist, round(atr_14, 4) AS atr_14, round(atr_14 / close * 100, 4) AS atr_pct, round(di_plus, 4) AS di_plus, round(di_minus, 4) AS di_minus, round(adx_14, 4) AS adx_14 FROM m JOIN s ON m.symbol = s.symbol AND m.rn = s.rn", "clean", recursive=True, i=_INPUTS, r=_WALK, m=_MADE, s=_MORE))
def technical_signals(spark, sf_dir):
    out = indicators.technical_signals(clean_daily(spark, sf_dir))
    return rounded(_dated(out).select("symbol", "date", *indicators.RECURRENT))


_EMAS = {"ema_9": 2 / 10, "ema_21": 2 / 22, "ema_50": 2 / 51}


def _timeframe_signals(spark, sf_dir) -> DataFrame:
    """Weeks and months are made of the days, so that the ticks are read and joined once."""
    days = B.from_ticks(A.ticks(spark, sf_dir), "day", ties=True)
    parts = [B.roll_up(days, unit).withColumn("timeframe", F.lit(tf)) for tf, unit in (("1W", "week"), ("1M", "month"))]
    bars = days.drop("first_tie", "last_tie").withColumn("timeframe", F.lit("1D")).unionByName(parts[0]).unionByName(parts[1])
    return indicators.add_recurrences(bars, "symbol", "timeframe")


_TF_BARS = "SELECT *, row_number() OVER w AS rn, greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr FROM (SELECT *, '1D' AS tf FROM daily UNION ALL SELECT *, '1W' FROM weekly UNION ALL SELECT *, '1M' FROM monthly) WINDOW w AS (PARTITION BY symbol, tf ORDER BY t)"
_TF_WALK = f"SELECT symbol, tf, rn, close, {', '.join(f'close AS {n}' for n in _EMAS)}, tr AS atr FROM b WHERE rn = 1 UNION ALL SELECT b.symbol, b.tf, b.rn, b.close, {', '.join(f'{a!r} * b.close + (1 - {a!r}) * r.{n}' for n, a in _EMAS.items())}, {1 / 14!r} * b.tr + (1 - {1 / 14!r}) * r.atr FROM r JOIN b ON b.symbol = r.symbol AND b.tf = r.tf AND b.rn = r.rn + 1"
_TF_LAST = "SELECT symbol, tf, arg_max(close, rn) AS close, arg_max(CASE WHEN close > ema_50 AND ema_9 > ema_21 THEN 1 WHEN close < ema_50 AND ema_9 < ema_21 THEN -1 ELSE 0 END, rn) AS trend, arg_max(atr, rn) AS atr FROM r GROUP BY symbol, tf"
_TF_WIDE = "SELECT symbol, CAST(sum(CASE WHEN tf = '1D' THEN trend ELSE 0 END) AS INT) AS d, CAST(sum(CASE WHEN tf = '1W' THEN trend ELSE 0 END) AS INT) AS w, CAST(sum(CASE WHEN tf = '1M' THEN trend ELSE 0 END) AS INT) AS mo, CAST(sum(trend) AS INT) AS score, max(CASE WHEN tf = '1D' THEN close END) AS close, max(CASE WHEN tf = '1D' THEN atr END) AS atr FROM l GROUP BY symbol"
_GRADE = "CASE WHEN abs(score) >= 6 THEN 'A' WHEN abs(score) = 5 THEN 'B' WHEN abs(score) = 4 THEN 'C' ELSE 'D' END"


@query(sql(f"SELECT symbol, d AS \"trend_1D\", w AS \"trend_1W\", mo AS \"trend_1M\", score AS mtf_score, {_GRADE} AS signal_quality, round(close - 0.5 * atr, 4) AS entry_zone_low, round(close + 0.5 * atr, 4) AS entry_zone_high, round(close - 1.5 * atr, 4) AS stop_zone, CASE WHEN atr > 0 THEN 1.2 END::DOUBLE AS reward_risk_ratio, CASE WHEN score > 0 THEN TRUE ELSE FALSE END AS regime_compatible FROM x", "daily", "weekly", "monthly", recursive=True, b=_TF_BARS, r=_TF_WALK, l=_TF_LAST, x=_TF_WIDE))
def timeframe_alignment(spark, sf_dir):
    out = signals.alignment(_timeframe_signals(spark, sf_dir), ("1D", "1W", "1M"), "1D").drop("atr", "last_close")
    return rounded(out.withColumn("regime_compatible", signals.compatible(F.col("mtf_score"), F.lit("RISK_ON"))))


@query(sql(f"SELECT {_GRADE} AS signal_quality, count(*) AS n_symbols FROM x GROUP BY 1", "daily", "weekly", "monthly", recursive=True, b=_TF_BARS, r=_TF_WALK, l=_TF_LAST, x=_TF_WIDE))
def grade_counts(spark, sf_dir):
    return signals.grade_counts(signals.alignment(_timeframe_signals(spark, sf_dir), ("1D", "1W", "1M"), "1D"))


@query(sql("SELECT series AS indicator, round(v, 7) AS value FROM (SELECT 'vix' AS series, coalesce((SELECT arg_max(value, observation_date) FROM macro1 WHERE series_id = 'absent'), (SELECT arg_max(value, observation_date) FROM macro1 WHERE series_id = '1-URGENT' AND observation_date + 40 <= DATE '1996-06-01')) AS v UNION ALL SELECT 'gdp', (SELECT arg_max(value, observation_date) FROM macro1 WHERE series_id = '2-HIGH' AND observation_date + 40 <= DATE '1996-06-01'))", "macro1"))
def indicator_values(spark, sf_dir):
    observations = A.macro_observations(spark, sf_dir).where("vintage = 1").select(F.lit("fred").alias("source"), "series_id", "observation_date", F.date_add("observation_date", 40).alias("vintage_date"), "value")
    one = signals.indicator_values(observations, {"vix": (("fred", "absent"), ("fred", "1-URGENT")), "gdp": (("fred", "2-HIGH"),)}, F.lit("1996-06-01").cast("date"))
    return rounded(one.select(F.explode(F.create_map(F.lit("vix"), "vix", F.lit("gdp"), "gdp")).alias("indicator", "value")), 7)


# regimes and sectors

_IND = "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, avg(o_totalprice) / 8000.0 AS vix, (avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) - 0.4) * 3 AS yield_spread, avg(o_custkey % 100) / 12.0 AS cpi, CASE WHEN month(min(o_orderdate)) % 5 <> 0 THEN avg(o_custkey % 7) END AS gdp, 95 + avg(o_orderkey % 21) AS dxy FROM orders GROUP BY 1"
_SCORED = "SELECT *, (vs + ys + cs + gs + ds) / 5 AS composite FROM (SELECT date, v, s, c, g, d, least(greatest((40 - v) / 20, 0), 1) AS vs, least(greatest((s + 1) / 2, 0), 1) AS ys, least(greatest((5 - c) / 5, 0), 1) AS cs, least(greatest(g / 4, 0), 1) AS gs, least(greatest((110 - d) / 20, 0), 1) AS ds FROM (SELECT date, coalesce(vix, 20) AS v, coalesce(yield_spread, 0.5) AS s, coalesce(cpi, 3) AS c, coalesce(gdp, 2) AS g, coalesce(dxy, 100) AS d FROM ind))"
_RULES = (("v > 30", "RISK_OFF", "(v - 30) / 20"), ("c > 5 AND g < 1", "STAGFLATION", "(c - 5) / 3 * 0.5 + greatest(0, 1 - g) * 0.5"), ("c < 2.5", "DISINFLATION", "(2.5 - c) / 2.5"), ("v < 20 AND s > 0 AND c < 4", "RISK_ON", "(20 - v) / 10 * 0.5 + least(s, 1) * 0.5"), ("s > 0.5 AND c < 4", "REFLATION", "s / 2 * 0.6 + (4 - c) / 4 * 0.4"))
_REGIME = "SELECT date, CASE " + " ".join(f"WHEN {c} THEN '{n}'" for c, n, _ in _RULES) + " WHEN composite > 0.5 THEN 'RISK_ON' ELSE 'RISK_OFF' END AS regime, least(CASE " + " ".join(f"WHEN {c} THEN {x}" for c, _, x in _RULES) + " ELSE abs(composite - 0.5) * 2 END, 1) AS confidence, composite FROM sc"


def _regimes(spark, sf_dir) -> DataFrame:
    orders = A.table(spark, sf_dir, "orders")
    month = F.to_date(F.trunc("o_orderdate", "month")).alias("date")
    made = orders.groupBy(month).agg((F.avg("o_totalprice") / 8000.0).alias("vix"), ((F.avg((F.col("o_orderstatus") == "F").cast("double")) - 0.4) * 3).alias("yield_spread"), (F.avg(F.col("o_custkey") % 100) / 12.0).alias("cpi"), F.when(F.month(F.min("o_orderdate")) % 5 != 0, F.avg(F.col("o_custkey") % 7)).alias("gdp"), (95 + F.avg(F.col("o_orderkey") % 21)).alias("dxy"))
    return signals.regime(made)


@query(sql("SELECT date, regime, round(confidence, 3) AS confidence, round(composite, 4) AS composite_score FROM rg", ind=_IND, sc=_SCORED, rg=_REGIME))
def macro_regime(spark, sf_dir):
    return rounded(_regimes(spark, sf_dir).select("date", "regime", "confidence", "composite_score"), confidence=3)


@query(sql("SELECT date, regime, previous_regime, regime <> coalesce(previous_regime, regime) AS transition, CASE WHEN regime <> coalesce(previous_regime, regime) THEN previous_regime || ' -> ' || regime END AS alert, CAST(row_number() OVER (PARTITION BY run_ ORDER BY date) AS INT) AS persistence, CAST(row_number() OVER (PARTITION BY isl ORDER BY date) AS INT) AS days_in_regime FROM (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 40 THEN 1 ELSE 0 END) OVER (ORDER BY date) AS run_, sum(CASE WHEN gap IS NULL OR gap > 40 OR regime <> coalesce(previous_regime, regime) THEN 1 ELSE 0 END) OVER (ORDER BY date) AS isl FROM (SELECT date, regime, lag(regime) OVER (ORDER BY date) AS previous_regime, date_diff('day', lag(date) OVER (ORDER BY date), date) AS gap FROM rg))", ind=_IND, sc=_SCORED, rg=_REGIME))
def regime_history(spark, sf_dir):
    return signals.regime_history(_regimes(spark, sf_dir).select("date", "regime"), gap_days=40)


_KEYED = "SELECT symbol, market, sector, CASE WHEN market = 'commodity' THEN 'commodity_' || sector WHEN market = 'us_stocks' THEN sector ELSE market END AS sector_key FROM dim"
_WEIGHT = "CASE WHEN length(sector_key) % 3 = 0 THEN NULL ELSE length(sector_key) / 10.0 END"


@query(sql(f"SELECT symbol, market, sector_key, CAST(coalesce({_WEIGHT}, 1.0) AS DOUBLE) AS sector_weight FROM k", "dim", k=_KEYED))
def sector_weights(spark, sf_dir):
    dim = A.instruments(spark, sf_dir).withColumn("subcategory", F.col("sector"))
    keys = dim.select(signals.sector_key().alias("sector_key")).distinct()
    weights = keys.where(F.length("sector_key") % 3 != 0).select(F.lit("RISK_ON").alias("regime"), "sector_key", (F.length("sector_key") / 10.0).alias("weight"))
    return signals.sector_weights(dim, weights).select("symbol", "market", "sector_key", "sector_weight")


# correlation

_RET = "SELECT symbol, CAST(t AS DATE) AS date, log_return FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY t DESC) AS rn FROM clean WHERE is_clean) WHERE rn <= 250"


@query(sql("SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, round(corr(a.log_return, b.log_return), 4) AS correlation, count(*) AS n_obs FROM ret a JOIN ret b ON a.date = b.date AND a.symbol < b.symbol WHERE a.log_return IS NOT NULL AND b.log_return IS NOT NULL GROUP BY 1, 2", "clean", ret=_RET))
def pair_correlations(spark, sf_dir):
    return rounded(correlate.pair_correlations(correlate.recent_returns(clean_daily(spark, sf_dir), 250)))


_PAIRS = "SELECT a.symbol AS a, b.symbol AS b, abs(corr(a.log_return, b.log_return)) AS s FROM ret a JOIN ret b ON a.date = b.date AND a.symbol < b.symbol WHERE a.log_return IS NOT NULL AND b.log_return IS NOT NULL GROUP BY 1, 2"
_SIZE = "SELECT count(*) AS n, least(10, greatest(2, count(*) // 2)) AS k FROM (SELECT a FROM p UNION SELECT b FROM p)"
_NEXT = "min({'d': 1 - s / (na * nb), 'a': a, 'b': b, 'n': na + nb})"
_LINK = f"""SELECT 0 AS step, a, b, s, 1::BIGINT AS na, 1::BIGINT AS nb FROM p WHERE s > 0
UNION ALL SELECT step + 1, least(x, y), greatest(x, y), sum(s), max(CASE WHEN x < y THEN nx ELSE ny END), max(CASE WHEN x < y THEN ny ELSE nx END) FROM (
SELECT step, s, CASE WHEN a = m.b THEN m.a ELSE a END AS x, CASE WHEN b = m.b THEN m.a ELSE b END AS y, CASE WHEN a IN (m.a, m.b) THEN m.n ELSE na END AS nx, CASE WHEN b IN (m.a, m.b) THEN m.n ELSE nb END AS ny FROM (SELECT *, {_NEXT} OVER () AS m FROM st)), z WHERE x <> y AND step + 1 < z.n - z.k GROUP BY 1, 2, 3"""
_MERGED = f"SELECT step, m.a AS a, m.b AS b FROM (SELECT step, {_NEXT} AS m FROM st GROUP BY step)"
_UP = "SELECT symbol, symbol AS root, 0 AS hops FROM (SELECT a AS symbol FROM p UNION SELECT b FROM p) UNION ALL SELECT up.symbol, g.a, hops + 1 FROM up JOIN g ON g.b = up.root"


@query(sql("SELECT r.symbol, CAST(dense_rank() OVER (ORDER BY root) - 1 AS BIGINT) AS cluster_id, round(t.s / (z.n - 1), 4) AS correlation_avg, count(*) OVER (PARTITION BY root) AS n_cluster_members FROM (SELECT symbol, arg_max(root, hops) AS root FROM up GROUP BY symbol) r JOIN (SELECT symbol, sum(s) AS s FROM (SELECT a AS symbol, s FROM p UNION ALL SELECT b, s FROM p) GROUP BY 1) t ON t.symbol = r.symbol, z", "clean", recursive=True, ret=_RET, p=_PAIRS, z=_SIZE, st=_LINK, g=_MERGED, up=_UP))
def correlation_clusters(spark, sf_dir):
    return rounded(correlate.clusters(correlate.pair_correlations(correlate.recent_returns(clean_daily(spark, sf_dir), 250))))


@query(sql("SELECT 'Brand#11' AS proxy, y.symbol AS benchmark, count(*) AS n_months, round(CASE WHEN count(*) >= 12 THEN corr(x.r, y.r) END, 4) AS correlation FROM r x JOIN r y ON x.m = y.m WHERE x.symbol = 'Brand#11' AND y.symbol <> 'Brand#11' AND x.r IS NOT NULL AND y.r IS NOT NULL GROUP BY y.symbol", "daily", r="SELECT symbol, m, close / lag(close) OVER (PARTITION BY symbol ORDER BY m) - 1 AS r FROM (SELECT symbol, date_trunc('month', t) AS m, arg_max(close, t) AS close FROM daily GROUP BY 1, 2)"))
def proxy_correlation(spark, sf_dir):
    bars = daily(spark, sf_dir)
    pairs = A.instruments(spark, sf_dir).where("symbol <> 'Brand#11'").select(F.lit("Brand#11").alias("proxy"), F.col("symbol").alias("benchmark"))
    return rounded(correlate.proxy_correlation(bars, pairs))


# watchlist

@query(sql(f"SELECT symbol, mtf_score, signal_quality, sector_weight, cluster_id, CAST(row_number() OVER (ORDER BY abs(mtf_score) DESC, rrr DESC NULLS LAST, symbol) AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY abs(mtf_score) DESC, rrr DESC NULLS LAST, symbol) AS place FROM (SELECT x.symbol, score AS mtf_score, CASE WHEN abs(score) >= 3 THEN 'A' WHEN abs(score) >= 1 THEN 'B' ELSE 'D' END AS signal_quality, CASE WHEN atr > 0 THEN 1.2 END AS rrr, CAST(coalesce({_WEIGHT}, 1.0) AS DOUBLE) AS sector_weight, CASE WHEN market = 'forex' THEN -1 ELSE length(k.sector) % 4 END AS cluster_id FROM x JOIN k ON k.symbol = x.symbol) WHERE abs(mtf_score) >= 1 AND signal_quality IN ('A', 'B') AND sector_weight > 0.5) WHERE place <= 2 ORDER BY abs(mtf_score) DESC, rrr DESC NULLS LAST, symbol LIMIT 20", "daily", "weekly", "monthly", "dim", recursive=True, b=_TF_BARS, r=_TF_WALK, l=_TF_LAST, x=_TF_WIDE, k=_KEYED))
def ranked_watchlist(spark, sf_dir):
    size = F.abs("mtf_score")
    aligned = signals.alignment(_timeframe_signals(spark, sf_dir), ("1D", "1W", "1M"), "1D").withColumn("signal_quality", F.when(size >= 3, "A").when(size >= 1, "B").otherwise("D"))
    dim = A.instruments(spark, sf_dir)
    sectors = sector_weights(spark, sf_dir)
    liquid = dim.select("symbol", "market", F.lit(None).cast("double").alias("dollar_volume_20d"))
    none = spark.createDataFrame([], "symbol string, days_to_earnings int, sentiment_score double")
    groups = dim.where("market <> 'forex'").select("symbol", (F.length("sector") % 4).alias("cluster_id"))
    out = watchlist.build(aligned, sectors, liquid, _regimes(spark, sf_dir).orderBy(F.col("date").desc()), none, none, groups, least_score=1)
    return out.select("symbol", "mtf_score", "signal_quality", "sector_weight", "cluster_id", "rank")


# evaluation

@query(sql("SELECT CAST(w AS INT) AS \"window\", CAST(s + CAST(w * 90 AS INT) AS DATE) AS train_start, CAST(s + CAST(w * 90 + 360 AS INT) AS DATE) AS test_start, CAST(s + CAST(w * 90 + 450 AS INT) AS DATE) AS test_end FROM (SELECT s, unnest(range(0, CAST(floor((date_diff('day', s, e) - 450) / 90.0) AS INT) + 1)) AS w FROM (SELECT min(CAST(t AS DATE)) AS s, max(CAST(t AS DATE)) AS e FROM daily))", "daily"))
def walk_forward_windows(spark, sf_dir):
    return evaluate.walk_forward_windows(evaluate.span(spark, daily(spark, sf_dir)))


@query(sql("SELECT date FROM (SELECT CAST(unnest(generate_series((SELECT min(CAST(t AS DATE)) FROM daily), (SELECT max(CAST(t AS DATE)) FROM daily), INTERVAL 1 DAY)) AS DATE) AS date) WHERE isodow(date) < 6", "daily"))
def trading_weekdays(spark, sf_dir):
    return evaluate.weekdays(evaluate.span(spark, daily(spark, sf_dir)))


_P, _Q, _A, _D = "l_extendedprice / l_quantity", "l_quantity", "l_tax * l_extendedprice / l_quantity", "l_extendedprice * l_quantity"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(p * 5 / 1e4, 10) AS fixed, round(CASE WHEN a <= 0 THEN p * 5 / 1e4 ELSE a * 0.1 / 2 END, 10) AS spread, round(p * least(greatest(1e4 * 0.1 * CASE WHEN a > 0 THEN a / p ELSE 0.002 END, 2), 50) / 1e4, 10) AS volatility, round(CASE WHEN d <= 0 THEN p * 5 / 1e4 ELSE p * least(1e4 * 0.1 * sqrt(p * q / d), 200) / 1e4 END, 10) AS impact, round(p * 5 / 1e4 * q, 8) AS total FROM (SELECT *, {_P} AS p, {_Q} AS q, {_A} AS a, {_D} AS d FROM lineitem)")
def slippage_costs(spark, sf_dir):
    p, q, a, d = (F.expr(x) for x in (_P, _Q, _A, _D))
    items = A.table(spark, sf_dir, "lineitem")
    return rounded(items.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", slippage.fixed(p).alias("fixed"), slippage.spread(p, a).alias("spread"), slippage.volatility(p, a).alias("volatility"), slippage.impact(p, q, d).alias("impact"), slippage.total_cost(slippage.fixed(p), q).alias("total")), 10, total=8)


_TRADES = "SELECT l_returnflag AS symbol, CAST(l_shipdate AS DATE) AS exit_date, CAST(l_linenumber AS BIGINT) AS hold_days, (l_discount - 0.05) * l_extendedprice AS pnl, l_discount - 0.05 AS pnl_pct FROM lineitem"


def _trades(spark, sf_dir) -> DataFrame:
    return A.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("symbol"), F.to_date("l_shipdate").alias("exit_date"), F.col("l_linenumber").cast("long").alias("hold_days"), ((F.col("l_discount") - 0.05) * F.col("l_extendedprice")).alias("pnl"), (F.col("l_discount") - 0.05).alias("pnl_pct"))


@query(sql("SELECT symbol, count(*) AS n_trades, count(*) FILTER (pnl > 0) AS n_wins, round(avg(CASE WHEN pnl > 0 THEN 1 ELSE 0 END), 4) AS win_rate, round(sum(pnl), 2) AS total_pnl, round(avg(pnl), 4) AS avg_pnl, round(avg(CASE WHEN pnl > 0 THEN pnl END), 4) AS avg_win, round(avg(CASE WHEN pnl < 0 THEN pnl END), 4) AS avg_loss, round(sum(CASE WHEN pnl > 0 THEN pnl END) / abs(sum(CASE WHEN pnl < 0 THEN pnl END)), 4) AS profit_factor, round(avg(pnl), 4) AS expectancy, min(hold_days) AS hold_min, round(avg(hold_days), 4) AS hold_avg, max(hold_days) AS hold_max, round(avg(pnl_pct) / stddev_samp(pnl_pct) * sqrt(252), 4) AS sharpe FROM tr GROUP BY symbol", tr=_TRADES))
def trade_statistics(spark, sf_dir):
    return rounded(evaluate.trade_statistics(_trades(spark, sf_dir), "symbol"), total_pnl=2)


@query(sql("SELECT symbol, round(max((peak - equity) / peak), 6) AS max_drawdown, round(arg_max(equity, exit_date), 2) AS final FROM (SELECT *, greatest(max(equity) OVER (PARTITION BY symbol ORDER BY exit_date ROWS UNBOUNDED PRECEDING), 100000) AS peak FROM (SELECT symbol, exit_date, 100000 + sum(p) OVER (PARTITION BY symbol ORDER BY exit_date) AS equity FROM (SELECT symbol, exit_date, sum(pnl) AS p FROM tr GROUP BY 1, 2))) GROUP BY symbol", tr=_TRADES))
def max_drawdown(spark, sf_dir):
    curve = evaluate.equity(_trades(spark, sf_dir), "symbol")
    return rounded(evaluate.drawdown(curve, "symbol").select("symbol", "max_drawdown", "final"), max_drawdown=6, final=2)


@query(sql("SELECT count(*) AS n_windows, round(avg(CASE WHEN r > 0 THEN 1 ELSE 0 END), 4) AS pct_profitable, round(avg(r), 4) AS avg_return, round(stddev_samp(r), 4) AS std_return, round(max(r), 4) AS best, round(min(r), 4) AS worst, round(avg(CASE WHEN r > 0 THEN 1 ELSE 0 END) * (1 - stddev_samp(r)), 4) AS consistency_score FROM (SELECT sum(pnl) / 1e6 AS r FROM tr GROUP BY date_trunc('quarter', exit_date))", tr=_TRADES))
def walk_forward_consistency(spark, sf_dir):
    windows = _trades(spark, sf_dir).groupBy(F.date_trunc("quarter", "exit_date")).agg((F.sum("pnl") / 1e6).alias("return_pct"))
    return rounded(evaluate.walk_forward_consistency(windows))


_SCORED_DAYS = "SELECT m.symbol, CAST(year(m.t) AS INT) AS win, CAST(m.t AS DATE) AS date, m.close, CAST(3 * CASE WHEN m.close > ema_50 AND ema_9 > ema_21 THEN 1 WHEN m.close < ema_50 AND ema_9 < ema_21 THEN -1 ELSE 0 END + CASE WHEN 100 - 100 / (1 + g14 / CASE WHEN l14 = 0 THEN 1e-10 ELSE l14 END) > 50 THEN 2 ELSE -2 END + sign(macd - macd_signal) AS INT) AS score, row_number() OVER (PARTITION BY m.symbol, year(m.t) ORDER BY m.t) AS k, count(*) OVER (PARTITION BY m.symbol, year(m.t)) AS n FROM m JOIN s ON m.symbol = s.symbol AND m.rn = s.rn"
_ENTER = "CASE WHEN abs(d.score) >= 5 AND d.k < d.n THEN sign(d.score) ELSE 0 END"
_LEAVE = "CASE WHEN d.score * h.held < 0 THEN 'flip' WHEN abs(d.score) < 4 THEN 'grade' WHEN d.k = d.n THEN 'window_end' END"
_HOLD = f"""SELECT symbol, win, k, date, close, {_ENTER} AS held, date AS entry_date, close AS entry_price, NULL::VARCHAR AS reason, 0 AS was FROM d WHERE k = 1
UNION ALL SELECT d.symbol, d.win, d.k, d.date, d.close, CASE WHEN h.held = 0 THEN {_ENTER} WHEN {_LEAVE} IS NULL THEN h.held ELSE 0 END, CASE WHEN h.held = 0 THEN d.date ELSE h.entry_date END, CASE WHEN h.held = 0 THEN d.close ELSE h.entry_price END, CASE WHEN h.held <> 0 THEN {_LEAVE} END, h.held FROM h JOIN d ON d.symbol = h.symbol AND d.win = h.win AND d.k = h.k + 1"""


@query(sql("SELECT symbol, win AS \"window\", CAST(was AS INT) AS direction, entry_date, date AS exit_date, round(entry_price, 8) AS entry_price, round(close, 8) AS exit_price, CAST(date_diff('day', entry_date, date) AS INT) AS hold_days, reason AS exit_reason, CAST(floor(10000 / entry_price) AS BIGINT) AS qty, round(was * (close - entry_price) * floor(10000 / entry_price), 8) AS pnl, round(was * (close / entry_price - 1), 8) AS pnl_pct FROM h WHERE reason IS NOT NULL", "clean", recursive=True, i=_INPUTS, r=_WALK, m=_MADE, s=_MORE, d=_SCORED_DAYS, h=_HOLD))
def signal_episodes(spark, sf_dir):
    signs = indicators.add_recurrences(clean_daily(spark, sf_dir).where("is_clean"))
    score = signals.trend() * 3 + F.when(F.col("rsi_14") > 50, 2).otherwise(-2) + F.signum("macd_hist").cast("int")
    size = F.abs("mtf_score")
    rows = signs.select("symbol", F.year("timestamp").alias("window"), F.to_date("timestamp").alias("date"), "close", score.alias("mtf_score")).withColumn("signal_quality", F.when(size >= 6, "A").when(size == 5, "B").when(size == 4, "C").otherwise("D"))
    return rounded(evaluate.with_pnl(evaluate.episodes(rows)), 8)


# dimension

@query(sql("SELECT market, count(*) AS n_symbols, count(DISTINCT sector) AS n_sectors FROM dim GROUP BY market", "dim"))
def market_counts(spark, sf_dir):
    return dimension.market_counts(A.instruments(spark, sf_dir))


@query("SELECT DISTINCT p_name AS raw, upper(translate(p_name, './', '-_')) AS symbol, CASE WHEN p_size % 2 = 0 THEN regexp_replace(upper(translate(p_name, './', '-_')), '[_/]', '', 'g') || '=X' ELSE upper(translate(p_name, './', '-_')) || '.JK' END AS api_symbol FROM part")
def symbol_forms(spark, sf_dir):
    parts = A.table(spark, sf_dir, "part")
    symbol = dimension.normal_symbol(F.col("p_name"))
    market = F.when(F.col("p_size") % 2 == 0, "forex").otherwise("idx")
    return parts.select(F.col("p_name").alias("raw"), symbol.alias("symbol"), dimension.api_symbol(symbol, market).alias("api_symbol")).distinct()


QUERIES.update(ingest_queries.QUERIES)
ORACLES.update(ingest_queries.ORACLES)
for part in (rule_queries, upkeep_queries):
    QUERIES.update(part.QUERIES)
    ORACLES.update(part.ORACLES)
