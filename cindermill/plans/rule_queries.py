"""Registered queries for the instrument and series dimensions, normalised frames, snapshots, and contracts of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cindermill.operators import bars as B
from cindermill.operators import dimension, macro, quality, universe, watchlist
from cindermill.plans.base import clean_daily, daily, hourly, last_day, rounded, sql
from cindermill.sources import adapters as A
from cindermill.sources import payloads, storage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


# frames and bars

@query(sql("SELECT t AS timestamp, round(open, 8) AS open, round(high, 8) AS high, round(low, 8) AS low, round(close, 8) AS close, volume FROM daily", "daily"))
def price_frames(spark, sf_dir):
    named = daily(spark, sf_dir).withColumnsRenamed({"timestamp": "Date", "open": "Open", "high": "High ", "low": "LOW", "close": "close", "volume": "Volume"}).withColumn("Adj Close", F.col("close"))
    out = payloads.price_frame(named)
    return rounded(out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), 8)


_ZONED = "SELECT symbol, CASE WHEN symbol = 'click' THEN 'Asia/Tokyo' WHEN length(symbol) % 2 = 0 THEN 'Asia/Jakarta' ELSE 'UTC' END AS zone, t FROM hourly"


@query(sql("SELECT symbol, timezone('UTC', timezone(zone, t)) AS timestamp, count(*) OVER (PARTITION BY symbol) AS n FROM z", "hourly", z=_ZONED))
def utc_bars(spark, sf_dir):
    """Hourly bars as if their times were local to a hint, else to their market, else UTC."""
    bars = hourly(spark, sf_dir).withColumns({"market": F.when(F.length("symbol") % 2 == 0, "idx").otherwise("elsewhere"), "_tz_hint": F.when(F.col("symbol") == "click", "Asia/Tokyo"), "timeframe": F.lit("1H")})
    out = B.silver(bars, "1H", unique=True).select("symbol", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))
    return out.join(out.groupBy("symbol").agg(F.count("*").alias("n")), "symbol").select("symbol", "timestamp", "n")


@query(sql("SELECT symbol, FALSE AS is_adjusted, CAST(0.5 AS DOUBLE) AS adj_factor, count(*) AS n_bars FROM daily GROUP BY symbol", "daily"))
def adjusted_bars(spark, sf_dir):
    return B.add_flags(daily(spark, sf_dir), False, 0.5).groupBy("symbol", "is_adjusted", "adj_factor").agg(F.count("*").alias("n_bars"))


_SHEETS = "SELECT s_suppkey AS sheet, n_name AS code, s_nationkey % 4 > 0 AS held, CASE WHEN n_nationkey <> s_suppkey % 25 THEN CAST(s_suppkey % 7 * n_nationkey AS DOUBLE) END AS weight FROM supplier, nation"


@query(sql("SELECT sheet, code, CASE WHEN held THEN weight END AS weight FROM w", w=_SHEETS))
def matrix_weights(spark, sf_dir):
    """A sheet for each supplier: nations as the header, one row of weights, with words between them."""
    nations = A.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    codes = [r["n_name"] for r in nations.collect()]  # the known codes, a row for each nation
    every = A.table(spark, sf_dir, "supplier").crossJoin(F.broadcast(nations))  # the sheets' cells
    cell = lambda row, col, value: F.struct(F.col("s_suppkey").alias("sheet"), row.cast("int").alias("row"), col.cast("int").alias("col"), value.cast("string").alias("value"))
    header = cell(F.col("s_suppkey") % 3 + 1, F.col("n_nationkey") + 3, F.col("n_name"))
    name = F.when((F.col("n_nationkey") == 0) & (F.col("s_nationkey") % 4 > 0), cell(F.lit(10), F.lit(2), F.lit("the area")))
    weight = cell(F.lit(10), F.col("n_nationkey") + 3, F.when(F.col("n_nationkey") == F.col("s_suppkey") % 25, "n/a").otherwise((F.col("s_suppkey") % 7 * F.col("n_nationkey")).cast("string")))
    cells = every.select(F.explode(F.array_compact(F.array(header, name, weight))).alias("c")).select("c.*")
    return payloads.matrix_row(cells, "the area", codes)


# dimensions

@query(sql("SELECT symbol, market, 1 AS layer, CASE market WHEN 'forex' THEN regexp_replace(symbol, '[_/]', '', 'g') || '=X' WHEN 'idx' THEN symbol || '.JK' WHEN 'commodity' THEN symbol || '=F' ELSE symbol END AS api_symbol, CASE market WHEN 'us_stocks' THEN 'America/New_York' WHEN 'idx' THEN 'Asia/Jakarta' ELSE 'UTC' END AS timezone FROM dim", "dim"))
def tradeable_instruments(spark, sf_dir):
    zones = {"us_stocks": "America/New_York", "idx": "Asia/Jakarta"}
    return dimension.tradeable(A.instruments(spark, sf_dir), zones).select("symbol", "market", "layer", "api_symbol", "timezone")


@query("SELECT 2 AS layer, 'nation ' || s_nationkey AS subcategory, s_name AS symbol, CAST(NULL AS VARCHAR) AS role, 's' || s_suppkey AS phone, 1 + CAST(s_suppkey % 2 = 0 AS INT) AS n_meta FROM supplier")
def context_instruments(spark, sf_dir):
    """Suppliers as members of their nation's group; what is no column of an instrument goes to meta."""
    plain = F.create_map(F.lit("symbol"), "s_name", F.lit("name"), "s_name", F.lit("phone"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")))
    more = F.when(F.col("s_suppkey") % 2 == 0, F.map_concat(plain, F.create_map(F.lit("note"), F.lit("even")))).otherwise(plain)
    groups = A.table(spark, sf_dir, "supplier").select(F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("subcategory"), F.array(more).alias("members"))
    return dimension.context_rows(groups).select("layer", "subcategory", "symbol", "role", F.col("meta")["phone"].alias("phone"), F.size("meta").alias("n_meta"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS subcategory, 'nation' AS key, CAST(c_nationkey AS VARCHAR) AS value FROM customer UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'segment', c_mktsegment FROM customer WHERE c_custkey % 2 = 0")
def subcategory_metas(spark, sf_dir):
    nation = F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string"))
    both = F.map_concat(nation, F.create_map(F.lit("segment"), "c_mktsegment"))
    return dimension.subcategory_meta(A.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("subcategory"), F.when(F.col("c_custkey") % 2 == 0, both).otherwise(nation).alias("meta")))


@query(sql("SELECT symbol, market, sector FROM dim WHERE market = 'idx' AND symbol IN (SELECT p_brand FROM part WHERE p_size > 40)", "dim"))
def instrument_lookup(spark, sf_dir):
    asked = A.table(spark, sf_dir, "part").where("p_size > 40").select(F.col("p_brand").alias("symbol"))
    return dimension.lookup(A.instruments(spark, sf_dir), asked, "idx").select("symbol", "market", "sector")


_SERIES_ID = "CASE WHEN p_partkey % 13 = 0 THEN 'DGS10' WHEN p_partkey % 13 = 1 THEN 'T10Y2Y' ELSE p_name END"


@query(f"SELECT series_id, CASE series_id WHEN 'DGS10' THEN '10Y' WHEN 'T10Y2Y' THEN 'spread_10y2y' END AS tenor, count(*) AS n FROM (SELECT {_SERIES_ID} AS series_id FROM part WHERE p_brand = 'Brand#12' AND p_size > 10 AND (p_size % 2 = 1 OR p_size % 7 = 3)) GROUP BY 1, 2")
def selected_series(spark, sf_dir):
    registry = A.table(spark, sf_dir, "part").select(F.expr(_SERIES_ID).alias("series_id"), F.col("p_brand").alias("domain"), F.when(F.col("p_size") % 2 == 0, "weekly").otherwise("daily").alias("cadence"), (F.col("p_size") % 7).alias("weekday"), (F.col("p_size") > 10).alias("regime_input"))
    chosen = dimension.select_series(registry, "Brand#12", regime_only=True, run_weekday=F.lit(3))
    return dimension.with_tenors(chosen).groupBy("series_id", "tenor").agg(F.count("*").alias("n"))


@query("SELECT s_name AS symbol, DATE '1996-01-01' AS resolved_date FROM supplier WHERE s_nationkey % 2 = 0 AND s_acctbal > 0")
def context_anchor_list(spark, sf_dir):
    rows = A.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("symbol"), (F.col("s_nationkey") % 2 + 2).alias("layer"), (F.col("s_acctbal") > 0).alias("context_available"))
    return universe.context_anchors(rows, "1996-01-01").select("symbol", "resolved_date")


# snapshots

@query(sql("SELECT symbol, CAST(t AS DATE) AS date, volume FROM daily, run WHERE CAST(t AS DATE) = run_date", "daily", "run"))
def last_snapshot(spark, sf_dir):
    bars = daily(spark, sf_dir).select("symbol", F.to_date("timestamp").alias("date"), "volume")
    return storage.snapshot(bars, "date", last_day(A.ticks(spark, sf_dir)))


_VINTAGES = "SELECT series_id, observation_date, CAST(date_trunc('year', observation_date) + INTERVAL 1 YEAR AS DATE) AS vintage_date, value FROM macro1"


@query(sql("SELECT series_id, observation_date, vintage_date, round(value, 4) AS value FROM v WHERE vintage_date = (SELECT max(vintage_date) FROM v WHERE vintage_date < DATE '1997-06-01')", "macro1", v=_VINTAGES))
def previous_vintages(spark, sf_dir):
    dated = A.macro_observations(spark, sf_dir).where("vintage = 1").drop("vintage").withColumn("vintage_date", F.add_months(F.trunc("observation_date", "year"), 12))
    return rounded(macro.previous_vintage(dated, F.lit("1997-06-01").cast("date")).select("series_id", "observation_date", "vintage_date", "value"))


@query(sql("SELECT symbol, market, CASE WHEN market = 'idx' THEN NULL ELSE sector END AS sector, CASE WHEN market = 'idx' THEN 1::INT END AS changed FROM dim", "dim"))
def upserted_rows(spark, sf_dir):
    """Rows of one market put in place of the current ones, without one column and with a new one."""
    current = A.instruments(spark, sf_dir)
    return storage.upsert(current, current.where("market = 'idx'").drop("sector").withColumn("changed", F.lit(1)), "symbol", "market")


# contracts and gates

@query("SELECT * FROM (SELECT 'absent' AS \"column\", 'missing' AS problem UNION ALL SELECT 'o_custkey', 'type bigint, not string' UNION ALL SELECT 'o_orderstatus', count(*) || ' nulls' FROM orders WHERE o_orderkey % 7 = 0)")
def contract_problems(spark, sf_dir):
    rows = A.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("long"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    fields = (("absent", T.StringType(), True), ("o_custkey", T.StringType(), True), ("o_orderstatus", T.StringType(), False))
    return quality.validate(rows, T.StructType([T.StructField(*f) for f in fields]))


@query(sql("SELECT 'null_check' AS check_name, 'CRITICAL' AS severity, TRUE AS passed, 'ok' AS status, avg(CASE WHEN close IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS measured FROM clean UNION ALL SELECT 'price_sanity', 'CRITICAL', TRUE, 'ok', count(*) FILTER (high < low OR close <= 0)::DOUBLE FROM clean", "clean"))
def gated_checks(spark, sf_dir):
    """The critical checks of nulls and prices, let through by the gate, which would raise if one failed."""
    bars = clean_daily(spark, sf_dir)
    checks = quality.layer_checks(bars, A.instruments(spark, sf_dir), last_day(A.ticks(spark, sf_dir)))
    return quality.gate(checks.where("check_name IN ('null_check', 'price_sanity')"))


@query("SELECT symbol, mtf_score, signal_quality FROM (SELECT c_name AS symbol, CAST(c_custkey % 15 - 7 AS INT) AS mtf_score, CASE WHEN abs(c_custkey % 15 - 7) >= 6 THEN 'A' WHEN abs(c_custkey % 15 - 7) = 5 THEN 'B' ELSE 'D' END AS signal_quality FROM customer) WHERE signal_quality IN ('A', 'B') ORDER BY mtf_score DESC, symbol LIMIT 20")
def simplified_watchlist(spark, sf_dir):
    score = (F.col("c_custkey") % 15 - 7).cast("int")
    rows = A.table(spark, sf_dir, "customer").select(F.col("c_name").alias("symbol"), score.alias("mtf_score"), F.when(F.abs(score) >= 6, "A").when(F.abs(score) == 5, "B").otherwise("D").alias("signal_quality"))
    return watchlist.simplified(rows)
