"""Shared inputs of the registered queries, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cindermill.operators import bars as B
from cindermill.sources import adapters as A
from cindermill.sources.scratch import Scratch

_TIE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"
_MARKETS = ", ".join(f"'{m}'" for m in A.MARKETS)
_SECTORS = ", ".join(f"'{s}'" for s in A.SECTORS)


def _bars_sql(source: str, unit: str, tie: str) -> str:
    return f"SELECT symbol, date_trunc('{unit}', ts) AS t, first(price ORDER BY {tie}) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY {tie}) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM {source} GROUP BY symbol, date_trunc('{unit}', ts)"


def _clean_sql(source: str, also: str = "TRUE") -> str:
    return f"""SELECT *, (high >= low AND open BETWEEN low AND high AND close BETWEEN low AND high) AND CASE WHEN sd > 0 THEN abs((log_return - mean) / sd) <= 4 WHEN log_return IS NOT NULL THEN TRUE END AND {also} AS is_clean
    FROM (SELECT *, avg(log_return) OVER (PARTITION BY symbol) AS mean, stddev_samp(log_return) OVER (PARTITION BY symbol) AS sd FROM
    (SELECT *, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY t)) AS log_return, close * volume AS dollar_volume, (high - low) / close AS spread_hl FROM {source}))"""


#: Each expression by name, with the names that it reads.
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "ticks": (f"SELECT p_brand AS symbol, l_shipdate AS ts, l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS volume, {_TIE} FROM lineitem JOIN part ON l_partkey = p_partkey", ()),
    "daily": (_bars_sql("ticks", "day", _TIE), ("ticks",)),
    "clean": (_clean_sql("daily"), ("daily",)),
    "weekly": (_bars_sql("ticks", "week", _TIE), ("ticks",)),
    "monthly": (_bars_sql("ticks", "month", _TIE), ("ticks",)),
    "event_ticks": ("SELECT event_type AS symbol, ts, value AS price, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS volume, event_id FROM events", ()),
    "hourly": (_bars_sql("event_ticks", "hour", "ts, event_id"), ("event_ticks",)),
    "blocks": ("SELECT symbol, to_timestamp(floor(epoch(t) / 14400) * 14400)::TIMESTAMP AS t, first(open ORDER BY t) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY t) AS close, CAST(sum(volume) AS BIGINT) AS volume, CASE WHEN sum(volume) > 0 THEN sum((high + low + close) / 3 * volume) / sum(volume) END AS vwap, count(*) AS bar_count FROM hourly GROUP BY 1, 2", ("hourly",)),
    "dim": (f"SELECT DISTINCT p_brand AS symbol, ([{_MARKETS}])[CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) % 4 + 1] AS market, ([{_SECTORS}])[CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) % 11 + 1] AS sector FROM part", ()),
    "run": ("SELECT max(CAST(t AS DATE)) AS run_date FROM daily", ("daily",)),
    "macro0": ("SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS observation_date, avg(o_totalprice) AS value FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1, 2", ()),
    "macro1": ("SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS observation_date, avg(o_totalprice) AS value FROM orders GROUP BY 1, 2", ()),
    "rates": ("SELECT c_mktsegment AS central_bank, CAST(min(o_orderdate) AS DATE) AS obs_date, round(avg(o_totalprice) / 1e5, 2) AS rate_pct FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, date_trunc('quarter', o_orderdate)", ()),
}


def sql(query: str, *names: str, recursive: bool = False, **extra: str) -> str:
    """A query with the common table expressions that it names and those that they read, then extra ones."""
    order: list[str] = []

    def add(name: str) -> None:
        for read in CTES[name][1]:
            add(read)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({CTES[n][0]})" for n in order] + [f"{n} AS ({body})" for n, body in extra.items()]
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + query if parts else query


def stored(bars: DataFrame) -> DataFrame:
    """Bars as a written table: what reads them several times over aggregates the ticks once."""
    return Scratch(bars.sparkSession).keep("bars", bars)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(B.from_ticks(A.ticks(spark, sf_dir), "day"))


def clean_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(B.silver(daily(spark, sf_dir), "1D", unique=True))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.from_ticks(A.event_ticks(spark, sf_dir), "hour")


def last_day(bars: DataFrame) -> Column:
    """The bar table's last date, as a literal."""
    return F.lit(bars.agg(F.max(F.to_date("timestamp"))).first()[0]).cast("date")


def rounded(df: DataFrame, places: int = 4, **places_of: int) -> DataFrame:
    """Doubles rounded for comparison."""
    return df.withColumns({f.name: F.round(f.name, places_of.get(f.name, places)) for f in df.schema if f.dataType.typeName() == "double"})
