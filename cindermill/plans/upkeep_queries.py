"""Registered queries for stored layers, their upkeep, and the checks of the dimension and of the context layer.

Those that store tables write rows of the given ones below the shared folder of the session.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cindermill.operators import bars as B
from cindermill.operators import dimension, maintenance, moments, quality, universe
from cindermill.plans.base import clean_daily, daily, last_day, rounded, sql
from cindermill.sources import adapters as A
from cindermill.sources import storage, versions
from cindermill.sources.scratch import Scratch, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _root(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/layers/{uuid.uuid4().hex}"


# stored layers

@query(sql("SELECT symbol, count(*) FILTER (is_clean AND NOT (sd > 0 AND abs((log_return - mean) / sd) > 3)) AS n_clean, count(*) AS n_bars, coalesce(bool_or(is_clean AND sd > 0 AND abs((log_return - mean) / sd) > 3), FALSE) AS rewritten FROM clean GROUP BY symbol", "clean"))
def outliers_in_files(spark, sf_dir):
    """Silver bars stored by symbol; files with clean outliers are rewritten, the others stay."""
    root = _root(spark)
    versions.replace(clean_daily(spark, sf_dir).repartition("symbol"), root, "symbol")
    before = versions.commit_of(spark, root)[2]
    maintenance.write_back_outliers(spark, root, "symbol", limit=3.0)
    number, schema, files = versions.commit_of(spark, root)
    places = versions.with_places(versions.read_files(spark, root, schema, files), root)
    kept = spark.createDataFrame([(name,) for name in files if name in set(before)], "file_ string")
    marked = places.join(F.broadcast(kept.withColumn("kept", F.lit(True))), "file_", "left")  # the names in a commit, which the driver holds
    return marked.groupBy("symbol").agg(F.count_if("is_clean").alias("n_clean"), F.count("*").alias("n_bars"), F.max(F.col("kept").isNull()).alias("rewritten"))


_STALE = "CAST(regexp_extract(symbol, '(\\d+)', 1) AS INT) % 3"


@query(sql(f"SELECT symbol, CASE WHEN {_STALE} = 0 THEN '1' ELSE '2' END AS was, count(*) AS n_bars, CASE WHEN {_STALE} = 0 THEN count(*) ELSE 0 END AS stale_rows, round(sum(close), 6) AS close_sum, count(*) FILTER (is_clean) AS n_clean FROM clean GROUP BY symbol", "clean"))
def stale_series_rebuilt(spark, sf_dir):
    """Silver bars of which every third symbol was built by another version, with other prices; after the rebuild all are as built at once."""
    root, bars = _root(spark), Scratch(spark).keep("bars", daily(spark, sf_dir).withColumn("timeframe", F.lit("1D")))
    old = F.regexp_extract("symbol", r"(\d+)", 1).cast("int") % 3 == 0
    wrong = B.silver(bars.where(old).withColumns({c: F.col(c) * 3 for c in B.PRICES}), "1D", version="1", unique=True)
    versions.replace(wrong.unionByName(B.silver(bars.where(~old), "1D", version="2", unique=True)), root, "symbol")
    plan = maintenance.reprocess(spark, root, bars, "2", "symbol")
    built = versions.read(spark, root).where("processing_version = '2'").groupBy("symbol").agg(F.count("*").alias("n_bars"), F.sum("close").alias("close_sum"), F.count_if("is_clean").alias("n_clean"))
    joined = built.join(plan.select("symbol", "stale_rows"), "symbol", "left")
    out = joined.select("symbol", F.when(F.col("stale_rows").isNull(), "2").otherwise("1").alias("was"), "n_bars", F.coalesce("stale_rows", F.lit(0).cast("long")).alias("stale_rows"), "close_sum", "n_clean")
    return rounded(out, close_sum=6)


@query(sql(f"SELECT symbol, count(*) AS stale_rows, count(*) FILTER ({_STALE} = 0) AS landed_rows FROM daily WHERE {_STALE} < 2 GROUP BY symbol", "daily"))
def rebuild_dry_run(spark, sf_dir):
    """Series that another version made, and what has landed to build them from; nothing is written but the stored bars."""
    root, bars = _root(spark), daily(spark, sf_dir).withColumn("timeframe", F.lit("1D"))
    third = F.regexp_extract("symbol", r"(\d+)", 1).cast("int") % 3
    stored = B.silver(bars, "1D", version="2", unique=True).withColumn("processing_version", F.when(third == 0, "1").when(third == 2, "2"))
    versions.replace(stored, root, "symbol")
    return maintenance.reprocess(spark, root, bars.where(third == 0), "2", "symbol", dry_run=True).drop("timeframe")


@query(sql("SELECT symbol, count(*) FILTER (sd > 0 AND abs((log_return - mean) / sd) > 4) AS n_outliers, count(*) AS n_bars FROM clean GROUP BY symbol", "clean"))
def outliers_from_moments(spark, sf_dir):
    """Outliers by the moments of the bars before 1995 and those that came after, merged."""
    kept, bars = Scratch(spark), clean_daily(spark, sf_dir)
    early = F.year("timestamp") < 1995
    history = kept.keep("history", moments.moments(bars.where(early)))
    state = kept.keep("state", moments.merged(history, moments.moments(bars.where(~early))))
    return moments.scored(bars, state).groupBy("symbol").agg(F.count_if("is_outlier").alias("n_outliers"), F.count("*").alias("n_bars"))


@query(sql("SELECT 'v_ohlcv_1D' AS view, count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols FROM daily JOIN dim USING (symbol) WHERE market <> 'commodity' UNION ALL SELECT 'v_ohlcv_all', count(*), count(DISTINCT symbol) FROM (SELECT symbol FROM daily UNION ALL SELECT symbol FROM weekly) JOIN dim USING (symbol) WHERE market <> 'commodity' UNION ALL SELECT 'v_watchlist_latest', count(*), count(DISTINCT symbol) FROM daily, run WHERE CAST(t AS DATE) = run_date UNION ALL SELECT 'v_screener', count(*), count(DISTINCT symbol) FROM daily, run WHERE CAST(t AS DATE) >= run_date - 9", "daily", "weekly", "dim", "run"))
def views_from_layers(spark, sf_dir):
    """Bars, with one market as the context layer, and watchlists of ten days stored below a root, read through their views."""
    root, ticks = _root(spark), A.ticks(spark, sf_dir)
    dim = A.instruments(spark, sf_dir).select("symbol", F.when(F.col("market") == "commodity", storage.CONTEXT).otherwise(F.col("market")).alias("market"))
    day, week = (B.from_ticks(ticks, unit).withColumn("timeframe", F.lit(tf)) for unit, tf in (("day", "1D"), ("week", "1W")))
    versions.replace(day.unionByName(week).join(dim, "symbol"), f"{root}/silver/market_ohlcv", "market", "timeframe")
    lists = day.select("symbol", F.to_date("timestamp").alias("watchlist_date")).where(F.col("watchlist_date") >= F.date_sub(last_day(ticks), 9))
    lists.write.partitionBy("watchlist_date").parquet(f"{root}/gold/screener")
    storage.register_views(spark, storage.layer_views(spark, root))
    names = ("v_ohlcv_1D", "v_ohlcv_all", "v_watchlist_latest", "v_screener")
    return spark.sql(" UNION ALL ".join(f"SELECT '{name}' AS view, count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols FROM {name}" for name in names))


@query(sql("SELECT market, count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols, 'second' AS last_source FROM daily JOIN dim USING (symbol) WHERE market = 'idx' GROUP BY market UNION ALL SELECT market, count(*), count(DISTINCT symbol), 'first' FROM daily JOIN dim USING (symbol) WHERE market <> 'idx' GROUP BY market", "daily", "dim"))
def stored_round_trip(spark, sf_dir):
    """Bars appended in two overlapping halves, stamped with their source, read back by partition; one partition replaced as a whole."""
    root = f"{_root(spark)}/bronze"
    bars = Scratch(spark).keep("bars", daily(spark, sf_dir).join(A.instruments(spark, sf_dir).select("symbol", "market"), "symbol"))
    early = bars.where(F.year("timestamp") <= 1995)
    keys, partitions = ["symbol", "timestamp"], ["market"]
    storage.append_new(early, root, keys, partitions, source="first")
    storage.append_new(bars, root, keys, partitions, source="first")
    storage.append_new(early, root, keys, partitions, source="again")
    storage.replace_partitions(storage.stamp(bars.where("market = 'idx'"), "second"), root, partitions)
    return storage.scan(spark, root).groupBy("market").agg(F.count("*").alias("n_rows"), F.countDistinct("symbol").alias("n_symbols"), F.max("_source").alias("last_source"))


@query(sql("SELECT DATE '1990-01-01' AS run_date, market, count(*) AS n_symbols, TRUE AS is_fallback FROM dim GROUP BY market UNION ALL SELECT DATE '1996-06-30', market, count(*), FALSE FROM dim WHERE symbol IN (SELECT symbol FROM daily WHERE CAST(t AS DATE) = (SELECT max(CAST(t AS DATE)) FROM daily WHERE CAST(t AS DATE) <= DATE '1996-06-30')) GROUP BY market", "daily", "dim"))
def resolved_universe(spark, sf_dir):
    """The newest list of symbols not after a date, each day's traded ones being its list; before all lists, every instrument."""
    dim = A.instruments(spark, sf_dir)
    empty = universe.fallback(dim).where("false").drop("eligibility_reason", "is_fallback")
    lists = daily(spark, sf_dir).select("symbol", F.to_date("timestamp").alias("resolved_date")).join(dim.select("symbol", "market"), "symbol").withColumns({"eligibility_reason": F.lit("listed"), "is_fallback": F.lit(False)}).unionByName(empty, allowMissingColumns=True)
    parts = [universe.resolved(lists, dim, F.lit(day).cast("date")).groupBy("market", "is_fallback").agg(F.count("*").alias("n_symbols")).select(F.lit(day).cast("date").alias("run_date"), "market", "n_symbols", "is_fallback") for day in ("1990-01-01", "1996-06-30")]
    return parts[0].unionByName(parts[1])


@query(sql("SELECT d AS date, total_runs, total_failed, total_rows, round(avg_duration_sec, 4) AS avg_duration_sec, expected, missing, expected - missing AS present, round((expected - missing) / expected * 100, 4) AS coverage_pct, (expected - missing) / expected * 100 < 90 AS coverage_alert FROM (SELECT sum(runs)::BIGINT AS total_runs, sum(failed)::BIGINT AS total_failed, CAST(sum(n_rows) AS BIGINT) AS total_rows, avg(mean) AS avg_duration_sec FROM (SELECT event_type, count(*) AS runs, count(*) FILTER (user_id % 5 = 0) AS failed, sum(user_id) AS n_rows, avg(value) AS mean FROM events, e WHERE CAST(ts AS DATE) = e.d GROUP BY 1)), (SELECT count(*)::BIGINT AS expected, count(*) FILTER (symbol NOT IN (SELECT symbol FROM daily, e WHERE CAST(t AS DATE) = e.d))::BIGINT AS missing FROM dim WHERE market = 'idx'), e", "daily", "dim", e="SELECT CAST(min(ts) AS DATE) AS d FROM events"))
def health_report(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    runs = events.select(F.col("event_type").alias("job"), F.lit("bronze").alias("layer"), F.when(F.col("user_id") % 5 == 0, "failed").otherwise("success").alias("status"), F.col("value").alias("duration_sec"), F.col("user_id").alias("rows_written"), F.col("ts").alias("started_at"))
    day = F.lit(events.agg(F.to_date(F.min("ts"))).first()[0])
    return rounded(quality.health_report(runs, daily(spark, sf_dir), A.instruments(spark, sf_dir), day, "idx"))


# checks

_CHECK = "SELECT '{0}' AS check_name, 'WARNING' AS severity, coalesce({1}, TRUE) AS passed, CASE WHEN n = 0 THEN 'skipped' WHEN {1} THEN 'ok' ELSE 'failed' END AS status, round(CAST(measured AS DOUBLE), 4) AS measured FROM ({2})"


@query(sql(" UNION ALL ".join(_CHECK.format(*x) for x in (
    ("context_null", "measured <= 0.001", "SELECT count(*) AS n, avg(CASE WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL THEN 1 ELSE 0 END) AS measured FROM cx"),
    ("context_price_sanity", "measured = 0", "SELECT count(*) AS n, count(*) FILTER (high < low OR NOT open BETWEEN low AND high OR NOT close BETWEEN low AND high OR close <= 0) AS measured FROM cx"),
    ("context_coverage", "measured >= 0.95", "SELECT count(*) AS n, avg(CASE WHEN symbol IN (SELECT symbol FROM cx, run WHERE CAST(t AS DATE) >= run_date - 5) THEN 1 ELSE 0 END) AS measured FROM dim WHERE market IN ('forex', 'idx')"),
    ("context_gaps", "measured <= 50", "SELECT 1 AS n, count(*) AS measured FROM (SELECT t, lag(t) OVER (PARTITION BY symbol ORDER BY t) AS p FROM cx) WHERE date_diff('day', CAST(p AS DATE), CAST(t AS DATE)) > 5"),
    ("context_outliers", "measured = 0", "SELECT count(*) AS n, count(*) FILTER (sd > 0 AND abs((log_return - mean) / sd) > 4) AS measured FROM cx"),
    ("context_freshness", "measured <= 5", "SELECT count(*) AS n, date_diff('day', max(CAST(t AS DATE)), max(run_date)) AS measured FROM cx, run"),
)), "clean", "dim", "run", cx="SELECT * FROM clean WHERE symbol IN (SELECT symbol FROM dim WHERE market = 'forex')"))
def context_checks(spark, sf_dir):
    dim = A.instruments(spark, sf_dir)
    bars = clean_daily(spark, sf_dir).join(dim.where("market = 'forex'").select("symbol"), "symbol", "left_semi")
    return rounded(quality.layer_checks(bars, dim.where("market IN ('forex', 'idx')"), last_day(A.ticks(spark, sf_dir)), "context"))


_SYMBOL = "CASE p_partkey % 11 WHEN 0 THEN replace(p_name, ' ', '.') WHEN 1 THEN 'SPX' WHEN 2 THEN replace(p_name, ' ', '/') ELSE replace(p_name, ' ', '') END"
_API = "CASE p_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'X.JK' WHEN 3 THEN 'X=X' WHEN 4 THEN 'X=F' WHEN 5 THEN 'DX-Y.NYB' WHEN 6 THEN '^X' ELSE 'X' END"
_FIELDS = {"market": "CASE p_size % 5 WHEN 0 THEN 'us_stocks' WHEN 1 THEN 'idx_stocks' WHEN 2 THEN 'commodity' WHEN 3 THEN 'forex' ELSE 'context' END", "symbol": _SYMBOL, "yfinance_symbol": _API, "raw_symbol": "CASE WHEN p_partkey % 3 > 0 THEN 'raw' END", "commodity_role": "CASE p_partkey % 4 WHEN 0 THEN 'trading' WHEN 1 THEN 'context' WHEN 2 THEN 'holding' END", "commodity_subcategory": "CASE p_partkey % 5 WHEN 0 THEN 'energy' WHEN 1 THEN 'bulks' WHEN 2 THEN 'water' WHEN 3 THEN 'base_metals' END"}
_ONE = {"no raw_symbol": "market = 'forex' AND raw_symbol IS NULL", "no yfinance_symbol": "market <> 'us_stocks' AND yfinance_symbol IS NULL", "no commodity_role": "market = 'commodity' AND commodity_role IS NULL", "no commodity_subcategory": "market = 'commodity' AND commodity_subcategory IS NULL", "unsafe character": "contains(symbol, '.') OR contains(symbol, '/')", "api symbol of idx_stocks": "market = 'idx_stocks' AND yfinance_symbol <> '' AND NOT ends_with(yfinance_symbol, '.JK')", "api symbol of forex": "market = 'forex' AND yfinance_symbol <> '' AND NOT ends_with(yfinance_symbol, '=X') AND yfinance_symbol <> 'DX-Y.NYB'", "api symbol of commodity": "market = 'commodity' AND yfinance_symbol <> '' AND NOT ends_with(yfinance_symbol, '=F')", "unknown commodity role": "market = 'commodity' AND commodity_role NOT IN ('trading', 'context')", "unknown commodity subcategory": "market = 'commodity' AND commodity_subcategory NOT IN ('energy', 'precious_metals', 'base_metals', 'agricultural', 'bulks')", "reclassified": "symbol IN ('SPX', 'VIX', 'DXY')"}


@query(sql(" UNION ALL ".join(f"SELECT symbol, '{rule}' AS rule FROM k WHERE {test}" for rule, test in _ONE.items()) + " UNION ALL SELECT symbol, 'repeated in market' FROM k GROUP BY symbol, market HAVING count(*) > 1", k="SELECT * FROM (SELECT " + ", ".join(f"{x} AS {n}" for n, x in _FIELDS.items()) + " FROM part) WHERE market <> 'context'"))
def dimension_rules(spark, sf_dir):
    return dimension.layer_one_violations(A.table(spark, sf_dir, "part").select(*[F.expr(x).alias(n) for n, x in _FIELDS.items()]))


_GROUPS = ("context_dollar_basket", "context_rates_fed", "context_etf_broad", "context_commodity_energy", "context_fx_normalization", "context_rates_dm_cb", "context_equity_dm")
_GROUP = "CASE s_nationkey % 7 " + " ".join(f"WHEN {k} THEN '{name}'" for k, name in enumerate(_GROUPS)) + " END"
_CONTEXT = {"subcategory": _GROUP, "parent": "CASE WHEN s_nationkey % 7 = 3 THEN 'commodity' ELSE 'other' END", "symbol": "CASE WHEN s_suppkey % 13 > 0 THEN concat('S', CAST(s_suppkey % 60 AS STRING)) END", "context_available": "CASE s_suppkey % 3 WHEN 0 THEN FALSE WHEN 1 THEN TRUE END", "deferred_reason": "CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'later' END", "planned_wave": "CASE WHEN s_suppkey % 5 > 1 THEN s_suppkey % 5 END", "proxy_for": "CASE WHEN s_suppkey % 2 = 0 THEN 'P' END", "proxy_instrument": "CASE WHEN s_suppkey % 6 = 0 THEN 'I' END", "proxy_correlation_expected": "CASE WHEN s_suppkey % 8 < 4 THEN 0.8 END", "commodity_role": "CASE s_suppkey % 3 WHEN 0 THEN 'trading' WHEN 1 THEN 'holding' END", "commodity_subcategory": "CASE s_suppkey % 4 WHEN 0 THEN 'energy' WHEN 1 THEN 'water' WHEN 2 THEN '' END", "include_in_forecast": "CASE s_suppkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END"}
_DEFERRED, _PROXY, _COMMODITY = "context_available = FALSE", "proxy_for <> ''", "parent = 'commodity'"
_TWO = {"no symbol": "symbol IS NULL", "deferred without reason": f"{_DEFERRED} AND coalesce(deferred_reason, '') = ''", "deferred without wave": f"{_DEFERRED} AND planned_wave IS NULL", "proxy without instrument": f"{_PROXY} AND coalesce(proxy_instrument, '') = ''", "proxy without correlation": f"{_PROXY} AND proxy_correlation_expected IS NULL", "no commodity role": f"{_COMMODITY} AND coalesce(commodity_role, '') = ''", "no commodity subcategory": f"{_COMMODITY} AND coalesce(commodity_subcategory, '') = ''", "unknown commodity role": f"{_COMMODITY} AND commodity_role NOT IN ('trading', 'context')", "unknown commodity subcategory": f"{_COMMODITY} AND commodity_subcategory NOT IN ('energy', 'precious_metals', 'base_metals', 'agricultural', 'bulks')", "instrument of a rates group": "subcategory IN ('context_rates_fed', 'context_rates_dm_cb')", "in forecasts": "subcategory IN ('context_etf_broad', 'context_fx_normalization') AND coalesce(include_in_forecast, TRUE)"}


@query(sql(" UNION ALL ".join(f"SELECT symbol, '{rule}' AS rule FROM k WHERE {test}" for rule, test in _TWO.items()) + """ UNION ALL SELECT symbol, 'repeated in subcategory' FROM k GROUP BY symbol, subcategory HAVING count(*) > 1
UNION ALL SELECT 'context_dollar_basket', 'contributes to a score' FROM s WHERE n > 0 UNION ALL SELECT 'context_rates_dm_cb', 'not 9 central banks' FROM s WHERE banks <> 9 UNION ALL SELECT 'context_equity_dm', 'unexpected subcategory' FROM s UNION ALL SELECT 'context_volatility', 'missing subcategory' FROM s""", k="SELECT " + ", ".join(f"{x.replace('STRING', 'VARCHAR')} AS {n}" for n, x in _CONTEXT.items()) + " FROM supplier", s="SELECT count(*) AS n, (SELECT count(*) FROM nation WHERE n_regionkey = 1) AS banks FROM supplier WHERE s_nationkey % 7 = 0"))
def context_rules(spark, sf_dir):
    """Suppliers as instruments of the context layer: nations give the group, and its scores and banks."""
    suppliers = A.table(spark, sf_dir, "supplier")
    rows = suppliers.select(*[F.expr(x).alias(n) for n, x in _CONTEXT.items()])
    found = suppliers.groupBy(F.expr(_GROUP).alias("subcategory")).agg(F.collect_set(F.col("s_nationkey").cast("string")).alias("contributes_to"))  # at most as many as nations
    every = spark.createDataFrame([(name,) for name in _GROUPS], "subcategory string")
    banks = A.table(spark, sf_dir, "nation").where("n_regionkey = 1").agg(F.collect_list("n_name").alias("central_banks"))
    score = F.when(F.col("subcategory") == "context_fx_normalization", F.array().cast("array<string>")).otherwise(F.col("contributes_to")).alias("contributes_to")
    groups = every.join(found, "subcategory", "left").crossJoin(F.broadcast(banks)).select("subcategory", score, "central_banks")
    expected = spark.createDataFrame([(name,) for name in (*_GROUPS[:-1], "context_volatility")], "subcategory string")
    return dimension.layer_two_violations(rows, groups, expected)
