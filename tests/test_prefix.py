"""Block-wise recurrences and state machines, linkage in rounds and windows before decisions against plain Python."""

import datetime as dt
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cindermill.operators import correlate, evaluate, indicators, macro, prefix
from cindermill.sources.scratch import Scratch


@pytest.fixture(params=[4, 16, 512])
def block(request, monkeypatch):
    monkeypatch.setattr(prefix, "BLOCK", request.param)
    return request.param


def walked(bars):
    """Every indicator of one series by pandas, row after row."""
    bars = bars.sort_values("timestamp").reset_index(drop=True)
    ewm = lambda v, a: v.ewm(alpha=a, adjust=False).mean()
    close, high, low = bars.close, bars.high, bars.low
    for p in (9, 21, 50, 200):
        bars[f"ema_{p}"] = ewm(close, 2 / (p + 1))
    delta = close.diff().fillna(0.0)
    for p in (14, 28):
        gain, loss = ewm(delta.clip(lower=0), 1 / p), ewm((-delta).clip(lower=0), 1 / p)
        bars[f"rsi_{p}"] = 100 - 100 / (1 + gain / loss.where(loss != 0, 1e-10))
    bars["macd"] = ewm(close, 2 / 13) - ewm(close, 2 / 27)
    bars["macd_signal"] = ewm(bars.macd, 2 / 10)
    bars["macd_hist"] = bars.macd - bars.macd_signal
    bars["atr_14"] = ewm(pd.concat([high - low, (high - close.shift(1)).abs(), (low - close.shift(1)).abs()], axis=1).max(axis=1), 1 / 14)
    bars["atr_pct"] = bars.atr_14 / close * 100
    up, down = high.diff().fillna(0.0), (-low.diff()).fillna(0.0)
    smooth = bars.atr_14.where(bars.atr_14 != 0, np.nan)
    bars["di_plus"] = 100 * ewm(up.where((up > down) & (up > 0), 0.0), 1 / 14) / smooth
    bars["di_minus"] = 100 * ewm(down.where((down > up) & (down > 0), 0.0), 1 / 14) / smooth
    total = bars.di_plus + bars.di_minus
    bars["adx_14"] = ewm((100 * (bars.di_plus - bars.di_minus).abs() / total.where(total != 0, np.nan)).fillna(0.0), 1 / 14)
    return bars


def test_recurrences_in_blocks(spark, block):
    rng = np.random.default_rng(block)
    rows = []
    for symbol, n in (("A", 150), ("B", 1), ("C", 16), ("D", 33), (None, 20), ("flat", 30)):
        close = 100 + np.cumsum(rng.normal(0, symbol != "flat", n))
        rows += [(symbol, dt.datetime(2020, 1, 1) + dt.timedelta(hours=7 * i), float(close[i] + rng.random() * (symbol != "flat")), float(close[i] - rng.random() * (symbol != "flat")), float(close[i])) for i in range(n)]
    bars = spark.createDataFrame(rows, "symbol string, timestamp timestamp, high double, low double, close double")
    got = indicators.add_recurrences(bars).toPandas().sort_values("timestamp")
    assert len(got) == len(rows)
    for symbol, series in pd.DataFrame(rows, columns=["symbol", "timestamp", "high", "low", "close"]).groupby("symbol", dropna=False):
        mine = got[got.symbol == symbol] if isinstance(symbol, str) else got[got.symbol.isna()]
        want = walked(series)
        for column in indicators.RECURRENT:
            assert np.allclose(mine[column].astype(float), want[column].astype(float), rtol=1e-9, atol=1e-9, equal_nan=True), (symbol, column)


def test_bars_without_prices_count_as_absent(spark):
    rows = [("A", dt.datetime(2020, 1, d), c and c + 1, c and c - 1, c) for d, c in ((1, 5.0), (2, None), (3, 7.0), (4, 8.0))]
    bars = spark.createDataFrame(rows, "symbol string, timestamp timestamp, high double, low double, close double")
    got = {r["timestamp"].day: r["ema_9"] for r in indicators.add_recurrences(bars).collect()}
    assert got == {1: 5.0, 2: None, 3: pytest.approx(5.4), 4: pytest.approx(5.92)}
    assert indicators.add_recurrences(bars.where("false")).count() == 0


def test_numbers_by_day(spark):
    rows = [("A" if i % 3 else None, dt.datetime(2020, 1, 1) + dt.timedelta(hours=5 * i), i) for i in range(50)]
    got = prefix.numbered(spark.createDataFrame(rows, "k string, t timestamp, i int"), F.struct("k"), "t").collect()
    for key in ("A", None):
        mine = sorted((r for r in got if r["k"] == key), key=lambda r: r["i"])
        assert [r["n_"] for r in mine] == list(range(1, len(mine) + 1)) and {r["total_"] for r in mine} == {len(mine)}


def folded(days, least=5):
    """Trades of one group, day by day."""
    out, held = [], None
    for k, (date, close, score, grade) in enumerate(days):
        score = score or 0
        if held is not None:
            reason = "flip" if score * held[2] < 0 else "grade" if grade == "D" else "window_end" if k == len(days) - 1 else None
            if reason:
                out.append((held[2], held[0], date, held[1], close, reason))
                held = None
        elif abs(score) >= least and grade in ("A", "B") and k < len(days) - 1:
            held = (date, close, 1 if score > 0 else -1)
    return out


def test_episodes_by_composition(spark, block):
    rng, rows, want = np.random.default_rng(block), [], []
    for symbol, window, n in (("A", 1, 120), ("A", 2, 1), ("B", 1, 40), ("B", 2, 16), (None, 3, 17), ("C", 1, 300)):
        days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), float(rng.integers(50, 150)), None if rng.random() < 0.05 else int(rng.integers(-7, 8)), str(rng.choice(["A", "B", "C", "D"], p=[0.4, 0.3, 0.25, 0.05]))) for i in range(n)]
        rows += [(symbol, window, *d) for d in days]
        want += [(symbol, window, *t) for t in folded(days)]
    scored = spark.createDataFrame(rows, "symbol string, window int, date date, close double, mtf_score int, signal_quality string")
    got = [(r["symbol"], r["window"], r["direction"], r["entry_date"], r["exit_date"], r["entry_price"], r["exit_price"], r["exit_reason"]) for r in evaluate.episodes(scored).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 30
    assert evaluate.episodes(scored.where("false")).count() == 0


def greedy(distance, wanted):
    """Average linkage that merges the nearest pair again and again."""
    groups = {i: [i] for i in range(len(distance))}
    while len(groups) > wanted:
        i, j = min(((i, j) for i in groups for j in groups if i < j), key=lambda p: (round(float(np.mean([[distance[x, y] for y in groups[p[1]]] for x in groups[p[0]]])), 12), p))
        groups[i] += groups.pop(j)
    return {m: n for n, members in enumerate(sorted(groups.values(), key=min)) for m in members}


@pytest.mark.parametrize("n, density", [(20, 1.0), (14, 0.1), (2, 1.0)])
def test_linkage_in_rounds(spark, n, density):
    rng, strength, rows = np.random.default_rng(n), np.eye(n), []
    for i in range(n):
        for j in range(i + 1, n):
            c = float(rng.uniform(-1, 1)) if rng.random() < density else None
            rows.append((f"s{i:02d}", f"s{j:02d}", c))
            strength[i, j] = strength[j, i] = abs(c or 0.0)
    got = {r["symbol"]: (r["cluster_id"], r["correlation_avg"], r["n_cluster_members"]) for r in correlate.clusters(spark.createDataFrame(rows, "symbol_a string, symbol_b string, correlation double")).collect()}
    labels = greedy(1 - strength, min(10, max(2, n // 2)))
    sizes = Counter(labels.values())
    assert got == {f"s{i:02d}": (labels[i], pytest.approx((strength[i].sum() - 1) / (n - 1)), sizes[labels[i]]) for i in range(n)}


def test_linkage_by_scope_and_with_ties(spark):
    rows = [("x", "a", "b", 0.9), ("x", "c", "d", 0.9), ("x", "a", "c", 0.2), ("y", "a", "b", 0.1), ("y", "c", "d", 0.8), ("y", "b", "c", 0.7)]
    pairs = spark.createDataFrame(rows, "market string, symbol_a string, symbol_b string, correlation double")
    got = {(r["market"], r["symbol"]): r["cluster_id"] for r in correlate.clusters(pairs, "market").collect()}
    assert got == {("x", "a"): 0, ("x", "b"): 0, ("x", "c"): 1, ("x", "d"): 1, ("y", "a"): 0, ("y", "b"): 1, ("y", "c"): 1, ("y", "d"): 1}
    assert correlate.clusters(pairs.where("false").drop("market")).count() == 0


@pytest.mark.parametrize("lookback", [1, 7, 30])
def test_window_before(spark, lookback):
    rng = np.random.default_rng(lookback)
    bars = [(str(rng.choice(["A", "B"])), dt.datetime(2019, 12, 1) + dt.timedelta(hours=int(h)), bool(rng.random() < 0.9), float(h)) for h in rng.integers(0, 2500, 200)] + [(None, dt.datetime(2020, 1, 1), True, 0.0)]
    decisions = [(str(rng.choice(["A", "B", "C"])), dt.date(2019, 12, 1) + dt.timedelta(days=int(d))) for d in rng.integers(0, 120, 40)] + [("A", None), (None, dt.date(2020, 1, 5))]
    decisions.append(decisions[0])
    got = macro.window_before(spark.createDataFrame(bars, "symbol string, timestamp timestamp, is_clean boolean, close double"), spark.createDataFrame(decisions, "symbol string, trade_date date"), lookback).select("symbol", "timestamp", "close", "trade_date").collect()
    want = [(s, t, c, d) for s, t, clean, c in bars for e, d in decisions if clean and s is not None and s == e and d is not None and d - dt.timedelta(days=lookback) <= t.date() < d]
    assert sorted(map(tuple, got)) == sorted(want)


def test_scratch_replaces_versions(spark):
    kept = Scratch(spark)
    one = kept.keep("t", spark.range(3))
    two = kept.keep("t", one.withColumn("x", F.lit(1)))
    assert two.count() == 3 and two.columns == ["id", "x"]
    with pytest.raises(Exception):
        one.count()
