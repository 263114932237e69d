"""Mergeable moments, replayed micro-batches, instrument rules, views of layers, tenors and the fallback universe."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cindermill.operators import bars as B
from cindermill.operators import correlate, dimension, moments, quality, universe
from cindermill.sources import payloads, storage, versions
from cindermill.streaming import bars as streaming

D = dt.date


def test_merged_moments_score_like_all_bars(spark):
    rng = np.random.default_rng(3)
    rows = [(s, "1D", dt.datetime(2020, 1, 1) + dt.timedelta(days=i), float(x) if i else None) for s, mean, n in (("A", 0.0, 80), ("B", 5.0, 60), (None, 0.1, 40), ("one", 0.0, 2)) for i, x in enumerate(np.where(rng.random(n) < 0.05, 40, rng.normal(mean, 1, n)))]
    bars = spark.createDataFrame(rows, "symbol string, timeframe string, timestamp timestamp, log_return double")
    parts = [bars.where(F.dayofyear("timestamp") % 3 == k) for k in range(3)]
    state = moments.merged(moments.merged(moments.moments(parts[0]), moments.moments(parts[1])), moments.moments(parts[2]))
    key = lambda r: (str(r["symbol"]), r["timestamp"])
    got = sorted(moments.scored(bars, state, 3.0).collect(), key=key)
    want = sorted(quality.outliers(bars, 3.0).collect(), key=key)
    assert len(got) == len(rows) and [r["is_outlier"] for r in got] == [r["is_outlier"] for r in want] and any(r["is_outlier"] for r in got)
    assert [r["z"] for r in got] == [None if r["z"] is None else pytest.approx(r["z"], rel=1e-9, abs=1e-12) for r in want]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    registry = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType())])
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    spark.createDataFrame([(1, "x"), (None, "y")], "a long, b string").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("a long, b string").parquet(str(tmp_path / "in"))
    for checkpoint in ("c1", "c2"):  # the second run has forgotten the first and gives batch 0 again
        streaming.quarantine_stream(source, registry, good, bad, str(tmp_path / checkpoint)).trigger(availableNow=True).start().awaitTermination(60)
    assert [(r["a"], r["b"]) for r in spark.read.parquet(good).collect()] == [(1, "x")]
    assert [(r["a"], r["_quarantine_reason"]) for r in spark.read.parquet(bad).collect()] == [(None, "a is null")]
    streaming.write_batch(spark.createDataFrame([(2, "z")], "a long, b string"), good, 1)
    assert {(r["a"], r["batch_id"]) for r in spark.read.parquet(good).collect()} == {(1, 0), (2, 1)}


def test_streamed_blocks_have_all_columns_of_the_batch(spark, tmp_path):
    rows = [("A", dt.datetime(2025, 1, 6, h), 1.0 + h, 2.0 + h, 0.5 + h, 1.5 + h, h % 5) for h in range(8, 21)]
    bars = spark.createDataFrame(rows, "symbol string, timestamp timestamp, open double, high double, low double, close double, volume long")
    late = spark.createDataFrame([("A", dt.datetime(2025, 1, 9), 1.0, 1.0, 1.0, 1.0, 1)], bars.schema)
    bars.unionByName(late).write.parquet(str(tmp_path / "in"))
    stream = streaming.four_hour_stream(spark.readStream.schema(bars.schema).parquet(str(tmp_path / "in")), market=F.lit("us_stocks"))
    stream.writeStream.format("memory").queryName("all_columns").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(60)
    batch = B.four_hour(bars, F.lit("us_stocks"))
    assert set(stream.columns) == set(batch.columns)
    rows_of = lambda df: sorted(tuple(r) for r in df.select(*sorted(batch.columns)).collect())
    assert rows_of(spark.table("all_columns")) == rows_of(batch)


FIELDS = "market string, symbol string, yfinance_symbol string, raw_symbol string, commodity_role string, commodity_subcategory string"


@pytest.mark.parametrize("row, rules", [
    (("us_stocks", "AAPL", None, None, None, None), set()),
    (("us_stocks", "BRK.B", None, None, None, None), {"unsafe character"}),
    (("idx_stocks", "BBCA", "BBCA.JK", None, None, None), set()),
    (("idx_stocks", "BBCA", "BBCA", None, None, None), {"api symbol of idx_stocks"}),
    (("idx_stocks", "BBCA", "", None, None, None), set()),
    (("idx_stocks", "BBCA", None, None, None, None), {"no yfinance_symbol"}),
    (("forex", "EURUSD", "EURUSD=X", "EUR/USD", None, None), set()),
    (("forex", "EUR/USD", "EURUSD", None, None, None), {"unsafe character", "api symbol of forex", "no raw_symbol"}),
    (("forex", "DXY", "DX-Y.NYB", "DXY", None, None), {"reclassified"}),
    (("commodity", "GC", "GC=F", None, "trading", "precious_metals"), set()),
    (("commodity", "GC", "GC", None, "holding", None), {"api symbol of commodity", "unknown commodity role", "no commodity subcategory"}),
    (("other", "x/y", None, None, None, None), set()),
])
def test_rules_of_the_traded_layer(spark, row, rules):
    got = {r["rule"] for r in dimension.layer_one_violations(spark.createDataFrame([row], FIELDS)).collect()}
    assert got == {r.replace("no commodity subcategory", "no commodity_subcategory") for r in rules}


def test_repeats_within_a_market(spark):
    rows = [("us_stocks", "A", None, None, None, None)] * 2 + [("idx_stocks", "A", "A.JK", None, None, None)]
    assert [tuple(r) for r in dimension.layer_one_violations(spark.createDataFrame(rows, FIELDS)).collect()] == [("A", "repeated in market")]


CONTEXT = "subcategory string, parent string, symbol string, context_available boolean, deferred_reason string, planned_wave int, proxy_for string, proxy_instrument string, proxy_correlation_expected double, commodity_role string, commodity_subcategory string, include_in_forecast boolean"


def test_rules_of_the_context_layer(spark):
    plain = ("context_equity_dm", "equity", "OK", True, None, None, None, None, None, None, None, True)
    rows = [
        plain,
        ("context_equity_dm", "equity", "LATER", False, "no data", 2, None, None, None, None, None, True),
        ("context_equity_dm", "equity", "NOREASON", False, "", None, None, None, None, None, None, True),
        ("context_equity_dm", "equity", "PROXY", True, None, None, "X", "Y", 0.9, None, None, True),
        ("context_equity_dm", "equity", "BADPROXY", True, None, None, "X", "", None, None, None, True),
        ("context_commodity_energy", "commodity", "TIN", False, "no data", 0, None, None, None, None, "water", True),
        ("context_etf_broad", "etf", "SPY", True, None, None, None, None, None, None, None, None),
        ("context_etf_broad", "etf", "VTI", True, None, None, None, None, None, None, None, False),
        ("context_rates_fed", "rates", "DFF", True, None, None, None, None, None, None, None, True),
    ]
    groups = [("context_equity_dm", ["a"], None), ("context_dollar_basket", ["a"], None), ("context_fx_normalization", [], None), ("context_rates_dm_cb", None, ["b"] * 9), ("context_rates_em_cb", None, ["b"]), ("context_rates_policy", None, None)]
    expected = [(g[0],) for g in groups[:-1]] + [("context_volatility",)]
    got = {tuple(r) for r in dimension.layer_two_violations(spark.createDataFrame(rows, CONTEXT), spark.createDataFrame(groups, "subcategory string, contributes_to array<string>, central_banks array<string>"), spark.createDataFrame(expected, "subcategory string")).collect()}
    assert got == {
        ("NOREASON", "deferred without reason"), ("NOREASON", "deferred without wave"), ("BADPROXY", "proxy without instrument"), ("BADPROXY", "proxy without correlation"),
        ("TIN", "no commodity role"), ("TIN", "unknown commodity subcategory"), ("SPY", "in forecasts"), ("DFF", "instrument of a rates group"),
        ("context_dollar_basket", "contributes to a score"), ("context_rates_em_cb", "not 3 central banks"), ("context_rates_policy", "renamed subcategory"),
        ("context_rates_policy", "unexpected subcategory"), ("context_volatility", "missing subcategory"),
    }


def test_areas_and_tenors(spark):
    assert len(payloads.AREA_BANKS) == 12 and not {"US", "IN"} & set(payloads.AREA_BANKS)
    got = {r["series_id"]: r["tenor"] for r in dimension.with_tenors(spark.createDataFrame([("DGS10",), ("T10Y2Y",), ("GDP",), (None,)], "series_id string")).collect()}
    assert got == {"DGS10": "10Y", "T10Y2Y": "spread_10y2y", "GDP": None, None: None}


def test_universe_falls_back_where_no_list_is(spark):
    dim = spark.createDataFrame([("A", "x"), ("B", "y")], "symbol string, market string")
    lists = universe.fallback(dim).where("symbol = 'A'").withColumns({"resolved_date": F.lit(D(2026, 1, 5)), "is_fallback": F.lit(False)})
    early, late = (universe.resolved(lists, dim, day).collect() for day in (D(2026, 1, 1), D(2026, 1, 9)))
    assert sorted((r["symbol"], r["is_fallback"]) for r in early) == [("A", True), ("B", True)]
    assert [(r["symbol"], r["is_fallback"]) for r in late] == [("A", False)]


def test_views_of_layers(spark, tmp_path):
    root = str(tmp_path)
    versions.replace(spark.createDataFrame([("A", "us", "1D", 1), ("A", "us", "1H", 2), ("V", "context", "1D", 3)], "symbol string, market string, timeframe string, v int"), f"{root}/silver/market_ohlcv", "market")
    spark.createDataFrame([("A", D(2026, 1, 1)), ("B", D(2026, 1, 2))], "symbol string, watchlist_date date").write.parquet(f"{root}/gold/screener")
    made = storage.register_views(spark, storage.layer_views(spark, root))
    assert made == ["v_ohlcv_1D", "v_ohlcv_1H", "v_ohlcv_all", "v_screener", "v_watchlist_latest"]
    assert [r["v"] for r in spark.table("v_ohlcv_1D").collect()] == [1] and spark.table("v_ohlcv_all").count() == 2
    assert [r["symbol"] for r in spark.table("v_watchlist_latest").collect()] == ["B"]


def test_checks_in_one_pass_on_nothing_and_on_bad_bars(spark):
    kind = "symbol string, timestamp timestamp, open double, high double, low double, close double, log_return double, is_adjusted boolean"
    run = F.lit(D(2026, 1, 10))
    known = spark.createDataFrame([("A",), ("B",)], "symbol string")
    nothing = {r["check_name"]: (r["passed"], r["status"]) for r in quality.layer_checks(spark.createDataFrame([], kind), known, run).collect()}
    assert nothing["null_check"] == (True, "skipped") and nothing["coverage"] == (False, "failed") and nothing["gap_detection"] == (True, "ok") and nothing["freshness"] == (True, "skipped")
    rows = [("A", dt.datetime(2026, 1, 1), 1.0, 2.0, 0.5, 1.0, None, True), ("A", dt.datetime(2026, 1, 9), None, 1.0, 2.0, 3.0, 0.1, True), ("C", dt.datetime(2026, 1, 9), 1.0, 1.0, 1.0, 1.0, None, False)]
    got = {r["check_name"]: (r["severity"], r["passed"], r["measured"]) for r in quality.layer_checks(spark.createDataFrame(rows, kind), known, run).collect()}
    assert got == {"null_check": ("CRITICAL", False, pytest.approx(1 / 3)), "price_sanity": ("CRITICAL", False, 1.0), "coverage": ("CRITICAL", False, 0.5), "gap_detection": ("WARNING", True, 1.0), "outliers": ("WARNING", True, 0.0), "freshness": ("WARNING", True, 1.0), "adj_integrity": ("INFO", True, 2.0)}


def test_gram_sums_have_no_pairs_of_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(f"s{i:02d}", D(2025, 1, 1) + dt.timedelta(days=int(d)), float(rng.normal())) for i in range(30) for d in rng.choice(600, 90, replace=False)] + [("flat", D(2025, 1, 1) + dt.timedelta(days=d), 1.0) for d in range(600)]
    got = correlate.pair_correlations(spark.createDataFrame(rows, "symbol string, date date, log_return double"), blocks=3)
    by = {(r["symbol_a"], r["symbol_b"]): r for r in got.collect()}
    series = {s: {d: r for t, d, r in rows if t == s} for s in {r[0] for r in rows}}
    for a in series:
        for b in series:
            common = sorted(set(series[a]) & set(series[b]))
            if a < b and common:
                x, y = ([series[s][d] for d in common] for s in (a, b))
                want = None if len(common) < 2 or "flat" in (a, b) else pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9)
                assert (by[a, b]["n_obs"], by[a, b]["correlation"]) == (len(common), want)


def test_states_of_separated_clusters(spark):
    from cindermill.operators import regimes

    rng = np.random.default_rng(1)
    centres = [-10.0, 0.0, 12.0]
    rows = [(D(2020, 1, 1) + dt.timedelta(days=i), centres[i % 3] + rng.normal() * 0.3, 2 * centres[i % 3] + rng.normal() * 0.3) for i in range(150)] + [(D(2021, 1, 1), None, 1.0)]
    got = regimes.assign_states(spark.createDataFrame(rows, "date date, a double, b double"), ["a", "b"], states=3).collect()
    # states are numbered by the mean of the first column, and a date without all features has none
    assert len(got) == 150 and all(r["state"] == (r["date"] - D(2020, 1, 1)).days % 3 and r["probability"] > 0.99 for r in got)
