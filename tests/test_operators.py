"""Operators on small hand-made frames."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cindermill.functions import slippage
from cindermill.operators import bars as B
from cindermill.operators import correlate, dimension, evaluate, indicators, macro, quality, signals, universe, watchlist
from cindermill.sources import ingest, payloads, storage
from cindermill.streaming import bars as streaming

D = dt.date


def hours(spark, day, hours_of_day, symbol="X"):
    rows = [(symbol, dt.datetime(*day, h), 10.0 + h, 12.0 + h, 9.0 + h, 11.0 + h, 1000 * (h - 7)) for h in hours_of_day]
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp, open double, high double, low double, close double, volume long")


def test_four_hour_bars(spark):
    bar = B.four_hour(hours(spark, (2025, 1, 6), [8, 9, 10, 11])).first()
    assert (bar["open"], bar["close"], bar["high"], bar["low"], bar["volume"], bar["bar_count"]) == (18.0, 22.0, 23.0, 17.0, 10000, 4)
    typical = [(12 + h + 9 + h + 11 + h) / 3 for h in (8, 9, 10, 11)]
    assert bar["vwap"] == pytest.approx(sum(t * v for t, v in zip(typical, (1000, 2000, 3000, 4000))) / 10000)
    assert not bar["is_incomplete_bar"]


@pytest.mark.parametrize("day, counts", [((2025, 1, 6), [3, 4, 1]), ((2025, 7, 7), [3, 4, 0])])
def test_sessions_follow_daylight_saving(spark, day, counts):
    blocks = spark.createDataFrame([(dt.datetime(*day, h),) for h in (12, 16, 20)], "b timestamp")
    got = [r[0] for r in blocks.orderBy("b").select(B.expected_bars(F.col("b"), F.lit("us_stocks"))).collect()]
    assert got == ([2, 4, 1] if day[1] == 1 else [3, 4, 0])


def test_incomplete_flags(spark):
    bars = hours(spark, (2025, 1, 6), range(14, 21))
    without = [r["is_incomplete_bar"] for r in B.four_hour(bars).orderBy("timestamp").collect()]
    within = [r["is_incomplete_bar"] for r in B.four_hour(bars, F.lit("us_stocks")).orderBy("timestamp").collect()]
    assert without == [True, False, True] and within == [False, False, False]
    assert B.can_aggregate("1H", "4H") and not B.can_aggregate("4H", "1D")


def test_first_return_is_null_and_so_is_clean(spark):
    out = B.silver(hours(spark, (2025, 1, 6), [9, 10, 11, 12]), "1H").orderBy("timestamp").collect()
    assert out[0]["is_clean"] is None and all(r["is_clean"] for r in out[1:])


def test_dedupe_keeps_latest(spark):
    rows = spark.createDataFrame([("A", "1D", 1, 1.0, 5), ("A", "1D", 1, 2.0, 6), ("A", "1D", 2, 3.0, 5)], "symbol string, timeframe string, timestamp int, close double, _ingested_at int")
    assert sorted(r["close"] for r in B.dedupe(rows).collect()) == [2.0, 3.0]


def test_to_utc(spark):
    row = spark.createDataFrame([(dt.datetime(2025, 1, 6, 9, 30), "us_stocks")], "t timestamp, m string").select(B.to_utc(F.col("t"), F.col("m")).alias("u")).first()
    assert row["u"] == dt.datetime(2025, 1, 6, 14, 30)


def test_indicators(spark):
    n = 60
    close = 100 + np.cumsum(np.sin(np.arange(n)))
    frame = pd.DataFrame({"symbol": "A", "timestamp": pd.date_range("2024-01-01", periods=n), "open": close, "high": close + 1, "low": close - 1, "close": close, "volume": 10})
    both = pd.concat([frame, frame.assign(symbol="B", close=frame["close"] * 2)])
    out = indicators.add_bollinger(indicators.add_recurrences(spark.createDataFrame(both))).toPandas().sort_values(["symbol", "timestamp"])
    a = out[out.symbol == "A"]
    e = [close[0]]
    for x in close[1:]:
        e.append(0.2 * x + 0.8 * e[-1])
    assert np.allclose(a["ema_9"], e) and a["rsi_14"].between(0, 100).all()
    assert np.allclose(a["macd_hist"], a["macd"] - a["macd_signal"]) and a["bb_mid"].isna().sum() == 19
    assert a["adx_14"].between(0, 100).all()


def test_outlier_flag_turns_true_to_false_only(spark):
    rows = [("A", i, 0.01 if i % 2 else -0.01, True) for i in range(100)] + [("A", 100, 12.0, True), ("A", 101, 13.0, None)]
    bars = spark.createDataFrame(rows, "symbol string, timestamp int, log_return double, is_clean boolean")
    flags = {r["timestamp"]: r["is_clean"] for r in quality.flag_outliers(bars).collect()}
    assert flags[100] is False and flags[101] is None and flags[3] is True


def test_gate(spark):
    checks = spark.createDataFrame([("coverage", "CRITICAL", False), ("gaps", "WARNING", False)], "check_name string, severity string, passed boolean")
    with pytest.raises(quality.QualityGateError, match="coverage"):
        quality.gate(checks)
    assert quality.gate(checks.where("severity = 'WARNING'")).count() == 1


def test_registry_validation_and_quarantine(spark):
    registry = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType()), T.StructField("c", T.DoubleType())])
    df = spark.createDataFrame([(1, 2), (None, 3)], "a long, b int")
    assert {(r["column"], r["problem"].split(",")[0]) for r in quality.validate(df, registry).collect()} == {("c", "missing"), ("b", "type int"), ("a", "1 nulls")}
    good, bad = quality.route(df, registry)
    assert good.count() == 1 and bad.first()["_quarantine_reason"] == "a is null"


def test_revisions(spark):
    kind = "series_id string, observation_date date, value double"
    before = spark.createDataFrame([("S", D(2026, 1, 1), 0.0025, 0), ("T", D(2026, 1, 1), 0.0025, 0)], kind + ", revision_seq int")
    now = spark.createDataFrame([("S", D(2026, 1, 1), 0.00250000000001), ("T", D(2026, 1, 1), 0.003), ("U", D(2026, 1, 1), 1.0)], kind)
    got = {r["series_id"]: (r["is_revision"], r["revision_seq"]) for r in macro.with_revisions(now, before).collect()}
    assert got == {"S": (False, 0), "T": (True, 1), "U": (False, 0)}


def test_rate_grid(spark):
    rows = [("ECB", D(2026, 1, 15), 3.5), ("ECB", D(2026, 4, 15), 3.75), ("BI", D(2026, 1, 15), 5.0)]
    grid = macro.rate_grid(spark.createDataFrame(rows, "central_bank string, obs_date date, rate_pct double"), F.lit(D(2026, 8, 1)).cast("date"))
    at = {(r["central_bank"], r["date"]): r for r in grid.collect()}
    assert at["ECB", D(2026, 4, 15)]["direction"] == 1 and at["ECB", D(2026, 4, 15)]["magnitude_bps"] == pytest.approx(25)
    assert at["ECB", D(2026, 1, 15)]["direction"] == 0 and at["ECB", D(2026, 4, 14)]["ffill_days"] == 89
    assert at["ECB", D(2026, 8, 1)]["is_stale"] and at["BI", D(2026, 2, 1)]["structural_break"] == "BI_RATE"
    assert at["ECB", D(2026, 2, 1)]["structural_break"] is None


def test_as_of_strict_and_not(spark):
    facts = spark.createDataFrame([("A", 1, 10.0), ("A", 3, 30.0)], "k string, t int, v double")
    asked = spark.createDataFrame([("A", 3), ("A", 4), ("A", 1), ("B", 5)], "k string, d int")
    got = lambda strict: {(r["k"], r["d"]): r["v"] for r in macro.as_of(facts, asked, "k", "t", "d", "v", strict=strict).collect()}
    assert got(True) == {("A", 3): 10.0, ("A", 4): 30.0, ("A", 1): None, ("B", 5): None}
    assert got(False)[("A", 3)] == 30.0


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "int"])
@pytest.mark.parametrize("strict", [False, True])
def test_as_of_over_days_equals_brute_force(spark, kind, strict):
    draw = random.Random(7)
    time = lambda: None if draw.random() < 0.05 else draw.randrange(-40, 120)
    keys = ["a", "a", "a", "b", None]
    facts = [(draw.choice(keys), time(), draw.randrange(9)) for _ in range(60)]
    asked = [(i, draw.choice([*keys, "c"]), time()) for i in range(80)]
    moment = {"int": "t", "date": "date_from_unix_date(t)", "timestamp": "timestamp_seconds(t * 30000)", "timestamp_ntz": "cast(timestamp_seconds(t * 30000) as timestamp_ntz)"}[kind]
    left = spark.createDataFrame(facts, "k string, t int, v int").selectExpr("k", f"{moment} AS t", "v")
    right = spark.createDataFrame(asked, "id int, k string, t int").selectExpr("id", "k", f"{moment} AS d")
    order = lambda t: float("-inf") if t is None else t
    want = {}
    for i, k, t in asked:
        known = [(order(u), v) for q, u, v in facts if q == k and (order(u) < order(t) if strict else order(u) <= order(t))]
        want[i] = max(known)[1] if known else None
    got = {r["id"]: r["v"] for r in macro.as_of(left, right, "k", "t", "d", "v", strict=strict).collect()}
    assert got == want



@pytest.mark.parametrize("vix, spread, cpi, gdp, name", [(35.0, 0.5, 3.0, 2.0, "RISK_OFF"), (20.0, 0.5, 6.0, 0.5, "STAGFLATION"), (20.0, 0.5, 2.0, 2.0, "DISINFLATION"), (15.0, 0.5, 3.0, 2.0, "RISK_ON"), (22.0, 1.0, 3.0, 2.0, "REFLATION")])
def test_regimes(spark, vix, spread, cpi, gdp, name):
    row = signals.regime(spark.createDataFrame([(vix, spread, cpi, gdp, None)], "vix double, yield_spread double, cpi double, gdp double, dxy double")).first()
    assert row["regime"] == name and 0 <= row["confidence"] <= 1


def test_regime_history_restarts_after_gap(spark):
    rows = [(D(2026, 1, 1), "A"), (D(2026, 1, 2), "A"), (D(2026, 1, 3), "B"), (D(2026, 2, 1), "B")]
    got = signals.regime_history(spark.createDataFrame(rows, "date date, regime string")).orderBy("date").collect()
    assert [r["persistence"] for r in got] == [1, 2, 3, 1] and [r["days_in_regime"] for r in got] == [1, 2, 1, 1]
    assert got[2]["alert"] == "A -> B"


def test_alignment_grades(spark):
    rows = [("A", tf, 1, 110.0, 105.0, 103.0, 100.0, 2.0) for tf in signals.TIMEFRAMES] + [("B", "1D", 1, 90.0, 95.0, 97.0, 100.0, None)]
    got = {r["symbol"]: r for r in signals.alignment(spark.createDataFrame(rows, "symbol string, timeframe string, timestamp int, close double, ema_9 double, ema_21 double, ema_50 double, atr_14 double")).collect()}
    assert got["A"]["mtf_score"] == 7 and got["A"]["signal_quality"] == "A" and got["A"]["stop_zone"] == 107.0 and got["A"]["reward_risk_ratio"] == 1.2
    assert got["B"]["mtf_score"] == -1 and got["B"]["signal_quality"] == "D" and got["B"]["reward_risk_ratio"] is None


def test_cluster_cap(spark):
    rows = [("a", 7, 1.2, 1), ("b", 6, 1.2, 1), ("c", 5, 1.2, 1), ("d", 5, 1.2, -1), ("e", 5, 1.2, -1), ("f", 5, 1.2, -1)]
    df = spark.createDataFrame(rows, "symbol string, mtf_score int, reward_risk_ratio double, cluster_id int")
    assert {r["symbol"] for r in watchlist.cap_clusters(df).collect()} == {"a", "b", "d", "e"}
    assert watchlist.cap_clusters(df, cap_unclustered=False).count() == 5


def test_clusters(spark):
    pairs = [("a", "b", 0.9), ("c", "d", -0.8), ("a", "c", 0.1), ("a", "d", 0.0), ("b", "c", 0.05), ("b", "d", 0.1)]
    got = {r["symbol"]: r["cluster_id"] for r in correlate.clusters(spark.createDataFrame(pairs, "symbol_a string, symbol_b string, correlation double")).collect()}
    assert got == {"a": 0, "b": 0, "c": 1, "d": 1}


def test_slippage(spark):
    row = spark.range(1).select(slippage.fixed(F.lit(100.0)).alias("f"), slippage.volatility(F.lit(100.0), F.lit(0.0)).alias("v"), slippage.impact(F.lit(100.0), F.lit(10.0), F.lit(0.0)).alias("i"), slippage.spread(F.lit(100.0), F.lit(2.0)).alias("s")).first()
    assert row["f"] == pytest.approx(0.05) and row["v"] == pytest.approx(100 * 2 / 1e4) and row["i"] == pytest.approx(0.05) and row["s"] == pytest.approx(0.1)


def test_episodes(spark):
    rows = [("A", 0, D(2026, 1, d), 100.0 + d, s, q) for d, s, q in ((1, 6, "A"), (2, 6, "A"), (3, -6, "A"), (4, -6, "A"), (5, -1, "D"), (6, 5, "B"), (7, 5, "B"))]
    got = evaluate.with_pnl(evaluate.episodes(spark.createDataFrame(rows, "symbol string, window int, date date, close double, mtf_score int, signal_quality string"))).orderBy("entry_date").collect()
    assert [(r["direction"], r["exit_reason"]) for r in got] == [(1, "flip"), (-1, "grade"), (1, "window_end")]
    assert got[1]["pnl"] < 0


def test_active_universe_orders_and_limits(spark):
    days = [(s, dt.datetime(2026, 6, d), c, v, True) for d in range(1, 26) for s, c, v in (("AAPL", 100.0, 900_000), ("LOW", 1.0, 10), ("EUR_USD", 1.1, 0), ("MSFT", 100.0, 800_000))]
    bars = spark.createDataFrame(days, "symbol string, timestamp timestamp, close double, volume long, is_clean boolean")
    dim = spark.createDataFrame([("AAPL", "us_stocks"), ("LOW", "us_stocks"), ("EUR_USD", "forex"), ("MSFT", "us_stocks")], "symbol string, market string")
    got = {r["symbol"]: r["eligibility_reason"] for r in universe.active(bars, dim, D(2026, 6, 25), top=1).collect()}
    assert got == {"AAPL": "liquidity_screened", "EUR_USD": "always_in"}


def test_payloads(spark):
    df = spark.createDataFrame([("A", '{"results": [{"t": 0, "o": 1, "c": 2, "v": 5}]}')], "symbol string, payload string")
    bar = payloads.bars(df).first()
    assert bar["open"] == 1.0 and bar["high"] is None and bar["timestamp"] == dt.datetime(1970, 1, 1)
    pairs = spark.createDataFrame([("EUR/USD",), ("EUR_USD",), ("EURUSD=X",), ("DXY",)], "s string").select(payloads.currency_pair(F.col("s")).alias("p")).collect()
    assert [p["p"] and tuple(p["p"]) for p in pairs] == [("EUR", "USD")] * 3 + [None]
    labour = spark.createDataFrame([('{"Results": {"series": [{"seriesID": "S", "data": [{"year": "2025", "period": "M02", "value": "3.5"}, {"year": "2025", "period": "M13", "value": "1"}, {"year": "2025", "period": "Q03", "value": "-"}]}]}}',)], "payload string")
    got = {r["observation_date"]: (r["value"], r["release_date"]) for r in payloads.labour(labour, F.lit(D(2026, 1, 1))).collect()}
    assert got == {D(2025, 2, 1): (3.5, D(2025, 3, 6)), D(2025, 7, 1): (None, D(2025, 8, 5))}
    outlook = spark.createDataFrame([('{"values": {"GDP": {"US": {"2024": 2.5}, "ZZ": {"2024": 1}}}}',)], "payload string")
    row = payloads.outlook(outlook, ["US"], F.lit(D(2024, 12, 1))).collect()
    assert [(r["country"], r["release_date"]) for r in row] == [("US", D(2024, 10, 1))]
    energy = spark.createDataFrame([('{"series_id": "E", "data": [["20250131", "70.5"], ["20250201", null]]}',)], "payload string")
    names = spark.createDataFrame([("E", "oil", "usd")], "series_id string, name string, unit string")
    assert [(r["observation_date"], r["value"], r["unit"]) for r in payloads.energy(energy, names, F.lit(D(2025, 3, 1))).collect()] == [(D(2025, 1, 31), 70.5, "usd")]


def test_accounts_payload(spark):
    text = '{"Data": [{"TableName": "T1", "LineNumber": "1", "LineDescription": "GDP", "TimePeriod": "2025Q4", "DataValue": "1,234.5"}, {"TableName": "T1", "LineNumber": "2", "LineDescription": "X", "TimePeriod": "2025Q4", "DataValue": "1"}]}'
    lines = spark.createDataFrame([("G", "T1", "1", None)], "series_id string, table_name string, line_number string, line_description string")
    row = payloads.accounts(spark.createDataFrame([(text,)], "payload string"), lines, F.lit(D(2027, 1, 1))).collect()
    assert [(r["observation_date"], r["value"]) for r in row] == [(D(2025, 10, 1), 1234.5)]


def test_policy_rate_lines(spark):
    lines = ["some preamble", "REF_AREA,TIME_PERIOD,OBS_VALUE", "XM,2026-01-15,3.50", "XM,bad,1", "GB,2026-02-01,.", "QQ,2026-02-01,1"]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, line_number int, line string")
    got = {(r["central_bank"], r["obs_date"], r["rate_pct"]) for r in payloads.policy_rates(df).collect()}
    assert got == {("ECB", D(2026, 1, 15), 3.5), ("BOE", D(2026, 2, 1), None)}


def test_matrix_row(spark):
    grid = [["t", "", "", ""], ["", "area", "US", "GB"], ["", "XM", "0.4", "0.6"]]
    cells = spark.createDataFrame([("s", r + 1, c + 1, v) for r, line in enumerate(grid) for c, v in enumerate(line)], "sheet string, row int, col int, value string")
    assert {(r["code"], r["weight"]) for r in payloads.matrix_row(cells, "XM", ["US", "GB", "JP"]).collect()} == {("US", 0.4), ("GB", 0.6)}


def test_mirrors_and_carry(spark):
    kind = "series_id string, observation_date date, value double"
    native = spark.createDataFrame([("A", D(2026, 1, 1), 1.0)], kind)
    mirror = spark.createDataFrame([("mA", D(2026, 1, 1), 9.0), ("mB", D(2026, 1, 1), 2.0)], kind)
    mapping = spark.createDataFrame([("A", "mA"), ("B", "mB")], "series_id string, mirror_id string")
    assert {(r["series_id"], r["value"]) for r in ingest.with_mirrors(native, mirror, mapping).collect()} == {("A", 1.0), ("B", 2.0)}


def test_dimension(spark):
    identity = spark.createDataFrame([("p", 0, "A", "x"), ("p", 1, "B", "x")], "path string, idx int, symbol string, kind string")
    taxonomy = spark.createDataFrame([("p", 0, "A", "y"), ("p", 2, "C", "x")], "path string, idx int, symbol string, kind string")
    _, bad = dimension.merge_configs(identity, taxonomy)
    assert {(r["idx"], r["problem"]) for r in bad.collect()} == {(0, "kind conflicts"), (1, "missing in taxonomy"), (2, "missing in identity")}
    sums = dimension.weight_sums(spark.createDataFrame([("s", 0.4), ("s", 0.6), ("t", 0.5)], "score string, weight double"))
    assert {r["score"]: r["passed"] for r in sums.collect()} == {"s": True, "t": False}


def test_storage(spark, tmp_path):
    df = spark.createDataFrame([("A", "x", 1)], "symbol string, source string, v int")
    path = str(tmp_path / "bronze")
    assert storage.append_new(df, path, ["symbol", "source"], ["source"]).count() == 1
    storage.append_new(df, path, ["symbol", "source"], ["source"])
    assert spark.read.parquet(path).count() == 1
    storage.replace_partitions(df.withColumn("v", F.lit(7)), path, ["source"])
    assert storage.scan(spark, path, source="x").first()["v"] == 7
    up = storage.upsert(df, spark.createDataFrame([("A", 5)], "symbol string, w int"), "symbol")
    assert up.count() == 1 and up.first()["w"] == 5
    assert storage.register_views(spark, {"v_sentiment": df, "v_screener": None}) == ["v_sentiment"] and "v_sentiment" in storage.list_views(spark)


def test_stream_matches_batch(spark, tmp_path):
    bars = hours(spark, (2025, 1, 6), range(8, 20))
    bars.unionByName(hours(spark, (2025, 1, 9), [8])).write.parquet(str(tmp_path / "in"))
    stream = streaming.four_hour_stream(spark.readStream.schema(bars.schema).parquet(str(tmp_path / "in")))
    run = stream.writeStream.format("memory").queryName("four_hours").outputMode("complete" if False else "append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run.awaitTermination(60)
    got = {(r["timestamp"], r["close"], r["bar_count"]) for r in spark.table("four_hours").collect()}
    assert got == {(r["timestamp"], r["close"], r["bar_count"]) for r in B.four_hour(bars).collect()}


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.replace_table(spark.range(3), path)
    storage.replace_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["t"]
    broken = spark.range(2).select(F.raise_error(F.lit("no")).alias("id"))
    assert storage.try_replace_table(broken, path) is False and spark.read.parquet(path).count() == 5


def test_mismatch_modes(spark):
    registry = T.StructType([T.StructField("a", T.LongType(), False)])
    df = spark.createDataFrame([(1,), (None,)], "a long")
    assert quality.handle_mismatch(df, registry)[0].count() == 1 and quality.handle_mismatch(df, registry, "warn")[0].count() == 2
    with pytest.raises(quality.QualityGateError):
        quality.handle_mismatch(df, registry, "fail")


def test_instrument_selection(spark):
    dim = spark.createDataFrame([("A", "us_stocks", 1, True), ("A", "idx", 1, False), ("B", "idx", 1, True)], "symbol string, market string, layer int, for_forecast boolean")
    assert dimension.select_instruments(dim, layer=1, markets=["idx"], flag="for_forecast").first()["symbol"] == "B"
    asked = spark.createDataFrame([("A",)], "symbol string")
    with pytest.raises(LookupError):
        dimension.lookup(dim, asked)
    assert dimension.lookup(dim, asked, "idx").count() == 1


def test_quote_payload(spark):
    row = payloads.quotes(spark.createDataFrame([("A", '{"c": 2.5, "t": 60}')], "symbol string, payload string")).first()
    assert row["close"] == 2.5 and row["high"] is None and row["timestamp"] == dt.datetime(1970, 1, 1, 0, 1)


@pytest.mark.parametrize("blocks", [1, 3, 8])
def test_pair_correlations_are_the_same_in_any_number_of_blocks(spark, blocks):
    draw = np.random.default_rng(3)
    wide = pd.DataFrame(draw.normal(size=(60, 7)), columns=list("abcdefg"))
    wide.iloc[5:9, 2] = np.nan
    wide.iloc[:40, 6] = np.nan  # too short a history
    rows = [(s, D(2020, 1, 1) + dt.timedelta(days=i), None if np.isnan(wide.at[i, s]) else float(wide.at[i, s])) for s in wide for i in wide.index]
    got = correlate.pair_correlations(spark.createDataFrame(rows, "symbol string, date date, log_return double"), blocks=blocks).toPandas()
    assert len(got) == 15
    want = wide.corr()
    for r in got.itertuples():
        assert r.correlation == pytest.approx(want.at[r.symbol_a, r.symbol_b])
        assert r.n_obs == wide[[r.symbol_a, r.symbol_b]].dropna().shape[0]
