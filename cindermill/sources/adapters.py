"""The star-schema tables read as market data.

Daily bars come from line items (symbol = brand, price = extended price / quantity), hourly bars from
events (symbol = event type), macro series and rate decisions from orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKETS = ("us_stocks", "idx", "forex", "commodity")
#: Sector names in the order in which brands are dealt to them.
SECTORS = ("energy", "materials", "industrials", "consumer_discretionary", "consumer_staples", "healthcare", "financials", "information_technology", "communication_services", "utilities", "real_estate")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with its timestamps as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    naive = {f.name: F.to_utc_timestamp(F.col(f.name).cast("timestamp"), F.current_timezone()) for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
    return df.withColumns(naive) if naive else df


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, timestamp, price, volume, tie: one row per line item."""
    tie = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    items, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = items.join(parts, items["l_partkey"] == parts["p_partkey"])
    return joined.select(F.col("p_brand").alias("symbol"), F.col("l_shipdate").alias("timestamp"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").cast("long").alias("volume"), F.struct(*tie).alias("tie"))


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, timestamp, price, volume, tie: one row per event."""
    events = table(spark, sf_dir, "events")
    return events.select(F.col("event_type").alias("symbol"), F.col("ts").alias("timestamp"), F.col("value").alias("price"), F.coalesce(F.get_json_object("props", "$.k").cast("long"), F.lit(0)).alias("volume"), F.struct("ts", "event_id").alias("tie"))


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instrument dimension: symbol, market, sector, one row per brand."""
    number = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    pick = lambda names: F.element_at(F.array(*map(F.lit, names)), (number % len(names) + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_brand").distinct().select(F.col("p_brand").alias("symbol"), pick(MARKETS).alias("market"), pick(SECTORS).alias("sector"))


def macro_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """series_id, observation_date, value, vintage: monthly means of order totals, first from every second order, then from all."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("series_id"), F.to_date(F.trunc("o_orderdate", "month")).alias("observation_date"), F.col("o_totalprice").alias("value"), "o_orderkey")
    by = ["series_id", "observation_date"]
    first = orders.where("o_orderkey % 2 = 0").groupBy(*by).agg(F.avg("value").alias("value")).withColumn("vintage", F.lit(0))
    return first.unionByName(orders.groupBy(*by).agg(F.avg("value").alias("value")).withColumn("vintage", F.lit(1)))


def rate_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """central_bank, obs_date, rate_pct: one decision per market segment and quarter."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    return joined.groupBy(F.col("c_mktsegment").alias("central_bank"), F.trunc("o_orderdate", "quarter").alias("q")).agg(F.to_date(F.min("o_orderdate")).alias("obs_date"), F.round(F.avg("o_totalprice") / 1e5, 2).alias("rate_pct")).drop("q")
