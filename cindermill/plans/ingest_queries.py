"""Registered queries for landed payloads, ingest rules, the dimension, and point-in-time reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cindermill.operators import dimension, macro, quality, regimes, watchlist
from cindermill.plans.base import clean_daily, daily, last_day, rounded, sql
from cindermill.sources import adapters as A
from cindermill.sources import ingest, payloads, storage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _day(text: str):
    return F.lit(text).cast("date")


# payloads

@query("SELECT event_type AS symbol, date_trunc('millisecond', ts) AS timestamp, value AS open, CAST(NULL AS DOUBLE) AS high, value AS close, CAST(user_id AS DOUBLE) AS volume, CAST(NULL AS DOUBLE) AS vwap FROM events")
def bar_payloads(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    entry = F.struct(F.unix_millis("ts").alias("t"), F.col("value").alias("o"), F.col("value").alias("c"), F.col("user_id").alias("v"))
    landed = events.select(F.col("event_type").alias("symbol"), F.to_json(F.struct(F.array(entry).alias("results"))).alias("payload"))
    return payloads.bars(landed).select("symbol", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "open", "high", "close", "volume", "vwap")


@query("SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date, o_totalprice AS open, CAST(NULL AS DOUBLE) AS high, o_totalprice AS close, CAST(NULL AS BIGINT) AS volume FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'")
def dated_rate_payloads(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders")
    value = F.struct(F.col("o_totalprice").cast("string").alias("open"), F.lit("n/a").alias("high"), F.col("o_totalprice").cast("string").alias("close"))
    landed = orders.select(F.col("o_orderpriority").alias("symbol"), F.to_json(F.create_map(F.date_format("o_orderdate", "yyyy-MM-dd"), value)).alias("payload"))
    return payloads.dated_rates(landed, _day("1995-01-01"), _day("1996-12-31")).select("symbol", "date", "open", "high", "close", "volume")


_SEGMENT = "CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 1 THEN left(c_mktsegment, 3) || '/' || right(c_mktsegment, 3) ELSE left(c_mktsegment, 3) || right(c_mktsegment, 3) || '=X' END"


@query(f"SELECT symbol, CASE WHEN k <> 0 THEN left(c_mktsegment, 3) END AS base, CASE WHEN k <> 0 THEN right(c_mktsegment, 3) END AS quote, count(*) AS n FROM (SELECT {_SEGMENT} AS symbol, c_mktsegment, c_custkey % 3 AS k FROM customer) GROUP BY 1, 2, 3")
def currency_pairs(spark, sf_dir):
    pair = payloads.currency_pair(F.col("symbol"))
    return A.table(spark, sf_dir, "customer").select(F.expr(_SEGMENT).alias("symbol")).select("symbol", pair["base"].alias("base"), pair["quote"].alias("quote")).groupBy("symbol", "base", "quote").agg(F.count("*").alias("n"))


@query(sql("SELECT series_id, observation_date, round(value, 4) AS value, least(observation_date + CASE WHEN series_id LIKE '1%' THEN 30 WHEN series_id LIKE '2%' THEN 14 ELSE 7 END, DATE '1998-01-10') AS release_date FROM macro1", "macro1"))
def release_dates(spark, sf_dir):
    lags = spark.createDataFrame([("1-URGENT", 30), ("2-HIGH", 14)], "series_id string, lag_days int")
    observations = A.macro_observations(spark, sf_dir).where("vintage = 1").drop("vintage")
    return rounded(payloads.with_release(observations, lags, _day("1998-01-10")))


@query(sql("SELECT series_id, CASE WHEN q THEN CAST(date_trunc('year', d) AS DATE) ELSE d END AS observation_date, value, least((CASE WHEN q THEN CAST(date_trunc('year', d) AS DATE) ELSE d END) + CASE WHEN month(d) % 3 = 1 AND NOT q THEN 35 ELSE 33 END, DATE '1998-01-10') AS release_date FROM (SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS d, month(o_orderdate) = 12 AS q, o_totalprice AS value FROM orders) WHERE month(d) <> 11"))
def labour_payloads(spark, sf_dir):
    month = F.month("o_orderdate")
    period = F.when(month == 12, "A01").when(month == 11, "M13").when(month % 3 == 1, F.format_string("Q%02d", F.ceil(month / 3))).otherwise(F.format_string("M%02d", month))
    point = F.struct(F.year("o_orderdate").cast("string").alias("year"), period.alias("period"), F.col("o_totalprice").cast("string").alias("value"))
    series = F.struct(F.col("o_orderpriority").alias("seriesID"), F.array(point).alias("data"))
    landed = A.table(spark, sf_dir, "orders").select(F.to_json(F.struct(F.struct(F.array(series).alias("series")).alias("Results"))).alias("payload"))
    return payloads.labour(landed, _day("1998-01-10"))


@query("SELECT CASE WHEN o_orderstatus = 'F' THEN 'byline' ELSE 'bytext' END AS series_id, make_date(year(o_orderdate), quarter(o_orderdate) * 3 - 2, 1) AS observation_date, round(o_totalprice, 2) AS value, least(make_date(year(o_orderdate), quarter(o_orderdate) * 3 - 2, 1) + 120, DATE '1998-01-10') AS release_date FROM orders WHERE o_orderstatus IN ('F', 'O')")
def account_payloads(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders")
    row = F.struct(F.lit("T1").alias("TableName"), F.when(F.col("o_orderstatus") == "F", "1").otherwise("9").alias("LineNumber"), F.col("o_orderstatus").alias("LineDescription"), F.concat(F.year("o_orderdate"), F.lit("Q"), F.quarter("o_orderdate")).alias("TimePeriod"), F.format_number("o_totalprice", 2).alias("DataValue"))
    landed = orders.select(F.to_json(F.struct(F.array(row).alias("Data"))).alias("payload"))
    lines = spark.createDataFrame([("byline", "T1", "1", None), ("bytext", "T1", None, "O")], "series_id string, table_name string, line_number string, line_description string")
    return payloads.accounts(landed, lines, _day("1998-01-10"))


@query("SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS observation_date, o_totalprice AS value, DATE '1998-01-10' AS release_date, CASE WHEN o_orderpriority = '2-HIGH' THEN 'high' END AS name, CASE WHEN o_orderpriority = '2-HIGH' THEN 'usd' END AS unit FROM orders WHERE o_custkey % 10 <> 0")
def energy_payloads(spark, sf_dir):
    value = F.when(F.col("o_custkey") % 10 != 0, F.col("o_totalprice").cast("string"))
    landed = A.table(spark, sf_dir, "orders").select(F.to_json(F.struct(F.col("o_orderpriority").alias("series_id"), F.array(F.array(F.date_format("o_orderdate", "yyyyMMdd"), value)).alias("data"))).alias("payload"))
    names = spark.createDataFrame([("2-HIGH", "high", "usd")], "series_id string, name string, unit string")
    return payloads.energy(landed, names, _day("1998-01-10"))


@query("SELECT o_orderpriority AS indicator, o_orderstatus AS country, make_date(year(o_orderdate), 1, 1) AS observation_date, o_totalprice AS value, CASE WHEN make_date(year(o_orderdate), 10, 1) <= DATE '1995-06-01' THEN make_date(year(o_orderdate), 10, 1) ELSE DATE '1995-06-01' END AS release_date FROM orders WHERE o_orderstatus IN ('F', 'O')")
def outlook_payloads(spark, sf_dir):
    years = F.create_map(F.year("o_orderdate").cast("string"), F.col("o_totalprice"))
    landed = A.table(spark, sf_dir, "orders").select(F.to_json(F.struct(F.create_map(F.col("o_orderpriority"), F.create_map(F.col("o_orderstatus"), years)).alias("values"))).alias("payload"))
    return payloads.outlook(landed, ["F", "O"], _day("1995-06-01"))


@query("SELECT CASE c_nationkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'XM' ELSE 'JP' END AS ref_area, CASE c_nationkey % 3 WHEN 0 THEN 'FED' WHEN 1 THEN 'ECB' ELSE 'BOJ' END AS central_bank, DATE '2020-01-01' + CAST(c_custkey % 1000 AS INT) AS obs_date, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS rate_pct FROM customer WHERE c_custkey % 11 <> 0")
def policy_rate_files(spark, sf_dir):
    customers = A.table(spark, sf_dir, "customer")
    area = F.element_at(F.array(F.lit("US"), F.lit("XM"), F.lit("JP")), F.col("c_nationkey") % 3 + 1)
    date = F.when(F.col("c_custkey") % 11 == 0, "n.d.").otherwise(F.date_add(_day("2020-01-01"), (F.col("c_custkey") % 1000).cast("int")).cast("string"))
    lines = customers.select(F.lit("f").alias("file"), (F.col("c_custkey") + 10).alias("line_number"), F.concat_ws(",", area, date, F.when(F.col("c_custkey") % 7 == 0, ".").otherwise(F.col("c_acctbal").cast("string"))).alias("line"))
    head = spark.createDataFrame([("f", -2, "a preamble"), ("f", -1, "REF_AREA,TIME_PERIOD,OBS_VALUE")], "file string, line_number long, line string")
    return payloads.policy_rates(lines.unionByName(head), banks={**payloads.AREA_BANKS, "US": "FED"})


# events of companies

def _earnings(spark, sf_dir) -> DataFrame:
    orders = A.table(spark, sf_dir, "orders")
    events = orders.select(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("earnings_date"), F.date_add(_day("1990-01-01"), (F.col("o_custkey") % 400).cast("int")).alias("fetched_date"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("eps_estimate"), F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("eps_actual"))
    return events


@query(sql("SELECT symbol, earnings_date, round(eps_estimate, 4) AS eps_estimate, CAST(date_diff('day', DATE '1995-06-01', earnings_date) AS INT) AS days_to_earnings, st = 'F' AS is_reported FROM (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS earnings_date, o_totalprice AS eps_estimate, o_orderstatus AS st, row_number() OVER (PARTITION BY o_orderpriority, CAST(o_orderdate AS DATE) ORDER BY o_custkey % 400 DESC, o_orderkey DESC) AS rn FROM orders WHERE o_custkey % 400 <= 350) WHERE rn = 1"))
def earnings_events(spark, sf_dir):
    out = macro.earnings(_earnings(spark, sf_dir), F.date_add(_day("1990-01-01"), 350))
    dated = out.withColumn("days_to_earnings", F.datediff("earnings_date", _day("1995-06-01")))
    return rounded(dated.select("symbol", "earnings_date", "eps_estimate", "days_to_earnings", "is_reported"))


@query("SELECT o_orderpriority AS symbol, CAST(min(date_diff('day', DATE '1995-06-01', CAST(o_orderdate AS DATE))) AS INT) AS days_to_earnings FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-06-01' AND DATE '1995-06-01' + 60 GROUP BY 1")
def next_earnings(spark, sf_dir):
    dated = _earnings(spark, sf_dir).withColumn("days_to_earnings", F.datediff("earnings_date", _day("1995-06-01")))
    return macro.days_to_next(macro.upcoming(dated, 60))


@query("SELECT event_type AS symbol, ts AS timestamp, value AS price FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, value DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_quotes(spark, sf_dir):
    events = A.table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp_ntz").alias("timestamp"), F.col("value").alias("price"), "event_id")
    return macro.latest_quotes(events).drop("event_id")


@query("SELECT event_type AS symbol, DATE '2024-06-01' AS date, value AS sentiment_score, CAST(user_id AS DOUBLE) AS buzz_score, event_id AS news_volume_7d, 'feed' AS source FROM events WHERE user_id % 4 <> 0")
def sentiment_rows(spark, sf_dir):
    raw = A.table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), F.when(F.col("user_id") % 4 != 0, F.col("value")).alias("sentiment_score"), F.col("user_id").alias("buzz_score"), F.col("event_id").alias("news_volume_7d"), F.lit("feed").alias("source"))
    return macro.sentiment(raw, _day("2024-06-01"))


@query("SELECT event_type AS symbol, CASE WHEN user_id % 3 = 0 THEN 0.0 ELSE value END AS sentiment_score, 0.0::DOUBLE AS buzz_score, event_id AS news_volume_7d FROM events")
def sentiment_payloads(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    body = F.struct(F.when(F.col("user_id") % 3 != 0, F.col("value")).alias("companyNewsScore"), F.struct(F.col("event_id").alias("articlesInLastWeek")).alias("buzz"))
    return payloads.sentiment(events.select(F.col("event_type").alias("symbol"), F.to_json(body).alias("payload")))


# ingest rules

@query(sql("SELECT series_id, CAST(max(observation_date) AS DATE) - 14 AS start_date FROM macro1 GROUP BY series_id", "macro1"))
def series_marks(spark, sf_dir):
    return ingest.series_marks(A.macro_observations(spark, sf_dir).where("vintage = 1"), 14)


@query(sql("SELECT series_id, observation_date, round(value, 7) AS value, FALSE AS is_mirror FROM macro0 WHERE series_id <> '1-URGENT' UNION ALL SELECT '1-URGENT', observation_date, round(value, 7), TRUE FROM macro1 WHERE series_id = '5-LOW'", "macro0", "macro1"))
def mirrored_series(spark, sf_dir):
    observations = A.macro_observations(spark, sf_dir)
    native = observations.where("vintage = 0 AND series_id <> '1-URGENT'").drop("vintage")
    mapping = spark.createDataFrame([("1-URGENT", "5-LOW"), ("2-HIGH", "5-LOW")], "series_id string, mirror_id string")
    return rounded(ingest.with_mirrors(native, observations.where("vintage = 1").drop("vintage"), mapping), 7)


@query(sql("SELECT symbol, max(CAST(t AS DATE)) AS last_date, date_diff('day', max(CAST(t AS DATE)), max(run_date)) > 1 AS is_too_old, count(*) FILTER (CAST(t AS DATE) >= run_date - 7) AS n_retained FROM daily, run GROUP BY symbol", "daily", "run"))
def cache_ages(spark, sf_dir):
    bars = daily(spark, sf_dir)
    run_date = last_day(bars)
    kept = ingest.retained(bars, run_date).groupBy("symbol").agg(F.count("*").alias("n_retained"))
    return ingest.too_old(bars, run_date).join(kept, "symbol", "left").withColumn("n_retained", F.coalesce("n_retained", F.lit(0)))


@query(sql("SELECT symbol, count(*) AS n_bars, round(max(close), 8) AS top FROM clean WHERE is_clean AND year(t) = 1996 GROUP BY symbol", "clean"))
def views_over_layers(spark, sf_dir):
    storage.register_views(spark, {"v_ohlcv_1D": clean_daily(spark, sf_dir)})
    return rounded(spark.sql("SELECT symbol, count(*) AS n_bars, max(close) AS top FROM v_ohlcv_1D WHERE is_clean AND year(timestamp) = 1996 GROUP BY symbol"), 8)


# quality of landed data

@query("SELECT 'o_custkey is null' AS reason, count(*) AS n FROM orders WHERE o_orderkey % 10 = 0 AND o_custkey % 7 <> 0 UNION ALL SELECT 'o_custkey is null | o_orderstatus is null', count(*) FROM orders WHERE o_orderkey % 10 = 0 AND o_custkey % 7 = 0 UNION ALL SELECT 'o_orderstatus is null', count(*) FROM orders WHERE o_orderkey % 10 <> 0 AND o_custkey % 7 = 0")
def quarantined_rows(spark, sf_dir):
    from pyspark.sql import types as T

    rows = A.table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).alias("o_custkey"), F.when(F.col("o_custkey") % 7 != 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    registry = T.StructType([T.StructField("o_custkey", T.LongType(), False), T.StructField("o_orderstatus", T.StringType(), False)])
    return quality.route(rows, registry)[1].groupBy(F.col("_quarantine_reason").alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT r.series_id, d AS observation_date, v AS value, v IS NOT NULL AS passed FROM (SELECT DISTINCT o_orderpriority AS series_id FROM orders UNION ALL SELECT 'none') r LEFT JOIN (SELECT o_orderpriority AS series_id, max(o_orderdate) AS d0, CAST(max(o_orderdate) AS DATE) AS d, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS v FROM orders WHERE o_custkey % 5 <> 0 GROUP BY 1) o USING (series_id)")
def latest_usable(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders")
    observed = orders.select(F.col("o_orderpriority").alias("series_id"), F.struct("o_orderdate", "o_orderkey").alias("observation_date"), F.when(F.col("o_custkey") % 5 == 0, ".").otherwise(F.col("o_totalprice").cast("string")).alias("value"))
    registry = orders.select(F.col("o_orderpriority").alias("series_id")).distinct().unionByName(spark.createDataFrame([("none",)], "series_id string"))
    return quality.latest_usable(observed, registry).withColumn("observation_date", F.to_date("observation_date.o_orderdate"))


@query("SELECT DISTINCT o_orderpriority AS series_id FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
def registry_gap(spark, sf_dir):
    declared = A.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("series_id"))
    return quality.registry_gap(declared, spark.createDataFrame([("1-URGENT",), ("2-HIGH",)], "series_id string"))


@query("SELECT count(*) FILTER (l_returnflag = 'R') AS n_match, max(CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END) AS latest_period, (SELECT list(f ORDER BY f) FROM (SELECT DISTINCT l_returnflag AS f FROM lineitem WHERE l_returnflag <> 'R'))::VARCHAR AS sample_misses FROM lineitem")
def line_match(spark, sf_dir):
    items = A.table(spark, sf_dir, "lineitem").withColumn("period", F.to_date("l_shipdate"))
    return quality.line_match(items, F.col("l_returnflag") == "R", "period", "l_returnflag").withColumn("sample_misses", F.concat(F.lit("["), F.array_join("sample_misses", ", "), F.lit("]")))


@query("SELECT count(DISTINCT o_orderpriority) AS n_countries, max(year(o_orderdate)) AS latest_year FROM orders WHERE o_custkey % 5 <> 0")
def country_coverage(spark, sf_dir):
    value = F.when(F.col("o_custkey") % 5 != 0, F.col("o_totalprice"))
    nested = A.table(spark, sf_dir, "orders").select(F.create_map("o_orderpriority", F.create_map(F.year("o_orderdate").cast("string"), value)).alias("values"))
    return quality.country_coverage(nested).withColumn("latest_year", F.col("latest_year").cast("long"))


@query("SELECT count(*) FILTER (c_nationkey = 0 AND c_acctbal <= 0) AS n_zero, count(*) AS n FROM customer")
def zero_quotes(spark, sf_dir):
    quotes = A.table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("double").alias("open"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("close"))
    return quality.zero_quotes(quotes, "open", "close").agg(F.count_if("is_all_zero").alias("n_zero"), F.count("*").alias("n"))


@query("SELECT 'volatility_spike' AS check_name, CASE WHEN v > 40 THEN 'WARN' WHEN v > 30 THEN 'INFO' ELSE 'OK' END AS level, round(v, 4) AS measured FROM (SELECT arg_max(value, (ts, event_id)) AS v FROM events)")
def volatility_spike(spark, sf_dir):
    series = A.table(spark, sf_dir, "events").select(F.struct("ts", "event_id").alias("date"), "value")
    return rounded(quality.volatility_spike(series))


@query(sql("SELECT round(avg(CASE WHEN f THEN 1.0 ELSE 0.0 END), 4) AS share, avg(CASE WHEN f THEN 1.0 ELSE 0.0 END) >= 0.95 AS passed FROM (SELECT symbol IN (SELECT symbol FROM clean, run WHERE is_clean AND CAST(t AS DATE) >= run_date - 3) AS f FROM dim)", "clean", "dim", "run"))
def screener_freshness(spark, sf_dir):
    return rounded(watchlist.freshness_share(clean_daily(spark, sf_dir), A.instruments(spark, sf_dir), last_day(daily(spark, sf_dir))))


@query(sql("SELECT count(*) AS n_total, count(*) FILTER (NOT d) AS n_pending, round(avg(CASE WHEN d THEN 100.0 ELSE 0.0 END), 4) AS coverage_pct FROM (SELECT user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase') AS d FROM (SELECT DISTINCT user_id FROM events))"))
def ingest_progress(spark, sf_dir):
    events = A.table(spark, sf_dir, "events").select(F.col("user_id").alias("symbol"), F.when(F.col("event_type") == "purchase", "success").otherwise("failed").alias("status"))
    return rounded(quality.progress(events, events))


@query("SELECT event_id AS run_id, ts AS started_at FROM events WHERE user_id % 5 = 0 AND CAST(ts AS DATE) > (SELECT CAST(max(ts) AS DATE) FROM events) - 7 ORDER BY ts DESC, event_id LIMIT 15")
def recent_failures(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    runs = events.select(F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"), F.when(F.col("user_id") % 5 == 0, "failed").otherwise("success").alias("status"))
    run_date = F.lit(events.agg(F.max(F.to_date("ts"))).first()[0])
    return quality.recent_failures(runs, run_date).select("run_id", F.col("started_at").cast("timestamp_ntz").alias("started_at"))


# dimension

@query("SELECT p_name AS symbol, count(DISTINCT p_brand) AS n_markets FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) > 1")
def ambiguous_symbols(spark, sf_dir):
    return dimension.ambiguous_symbols(A.table(spark, sf_dir, "part").select(F.col("p_name").alias("symbol"), F.col("p_brand").alias("market")))


@query("SELECT 'p' AS path, p_partkey AS idx, CASE WHEN p_size % 10 = 0 THEN 'missing in taxonomy' WHEN p_size % 10 = 1 THEN 'missing in identity' WHEN p_size % 10 = 2 THEN 'anchor differs' ELSE 'kind conflicts' END AS problem FROM part WHERE p_size % 10 < 4")
def config_merge_problems(spark, sf_dir):
    parts = A.table(spark, sf_dir, "part").withColumn("k", F.col("p_size") % 10)
    base = [F.lit("p").alias("path"), F.col("p_partkey").alias("idx")]
    identity = parts.where("k <> 1").select(*base, F.col("p_name").alias("symbol"), F.col("p_type").alias("kind"))
    taxonomy = parts.where("k <> 0").select(*base, F.when(F.col("k") == 2, "other").otherwise(F.col("p_name")).alias("symbol"), F.when(F.col("k") == 3, "other").otherwise(F.col("p_type")).alias("kind"))
    return dimension.merge_configs(identity, taxonomy)[1]


@query("SELECT o_orderpriority AS score, round(sum(o_totalprice), 2) AS weight_sum, FALSE AS passed FROM orders GROUP BY 1")
def domain_weight_sums(spark, sf_dir):
    rows = A.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("score"), F.col("o_totalprice").alias("weight"))
    return rounded(dimension.weight_sums(rows), 2)


@query("SELECT count(*) AS n_instruments, count(*) = 699 AS passed FROM part")
def universe_total(spark, sf_dir):
    return dimension.universe_total(A.table(spark, sf_dir, "part"), 699)


# point in time

@query(sql("SELECT c.symbol, d.trade_date, count(*) AS n_bars, round(avg(c.close), 4) AS mean_close FROM clean c JOIN (SELECT DISTINCT p_brand AS symbol, DATE '1996-06-01' + CAST(p_size AS INT) AS trade_date FROM part) d ON c.symbol = d.symbol AND CAST(c.t AS DATE) >= d.trade_date - 60 AND CAST(c.t AS DATE) < d.trade_date WHERE c.is_clean GROUP BY 1, 2", "clean"))
def bars_before_decisions(spark, sf_dir):
    decisions = A.table(spark, sf_dir, "part").select(F.col("p_brand").alias("symbol"), F.date_add(_day("1996-06-01"), F.col("p_size")).alias("trade_date")).distinct()
    return rounded(macro.window_before(clean_daily(spark, sf_dir), decisions, 60).groupBy("symbol", "trade_date").agg(F.count("*").alias("n_bars"), F.avg("close").alias("mean_close")))


@query(sql("SELECT coalesce(b.series_id, a.series_id) AS series_id, coalesce(b.observation_date, a.observation_date) AS observation_date, coalesce(b.observation_date + 40, a.observation_date + 10) AS vintage_date, round(coalesce(b.value, a.value), 4) AS value FROM (SELECT * FROM macro0 WHERE observation_date >= DATE '1996-06-01' - 365 AND observation_date + 10 <= DATE '1996-06-01') a FULL JOIN (SELECT * FROM macro1 WHERE observation_date >= DATE '1996-06-01' - 365 AND observation_date + 40 <= DATE '1996-06-01') b USING (series_id, observation_date)", "macro0", "macro1"))
def vintages_as_of(spark, sf_dir):
    vintages = A.macro_observations(spark, sf_dir).withColumn("vintage_date", F.date_add("observation_date", F.when(F.col("vintage") == 0, 10).otherwise(40))).drop("vintage")
    return rounded(macro.vintages_as_of(vintages, _day("1996-06-01"), newest_only=True))


@query(sql("SELECT observation_date AS date, " + ", ".join(f"round((s{i} - avg(s{i}) OVER ()) / nullif(stddev_samp(s{i}) OVER (), 0), 4) AS s{i}" for i in (1, 2, 5)) + " FROM (SELECT observation_date, max(CASE WHEN series_id LIKE '1%' THEN value END) AS s1, max(CASE WHEN series_id LIKE '2%' THEN value END) AS s2, max(CASE WHEN series_id LIKE '5%' THEN value END) AS s5 FROM macro1 GROUP BY 1) WHERE s1 IS NOT NULL AND s2 IS NOT NULL AND s5 IS NOT NULL", "macro1"))
def regime_features(spark, sf_dir):
    observations = A.macro_observations(spark, sf_dir).where("vintage = 1")
    return rounded(regimes.feature_panel(observations, {"1-URGENT": "s1", "2-HIGH": "s2", "5-LOW": "s5"}))


@query()
def regime_states(spark, sf_dir):
    observations = A.macro_observations(spark, sf_dir).where("vintage = 1")
    panel = regimes.feature_panel(observations, {"1-URGENT": "s1", "2-HIGH": "s2", "5-LOW": "s5"})
    return rounded(regimes.assign_states(panel, ["s1", "s2", "s5"], 3))
