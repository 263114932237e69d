"""Queries that read all of their input, and shared inputs that are made once."""

import datetime as dt

from pyspark.sql import functions as F

from cindermill.operators import correlate, evaluate
from cindermill.plans import base, ingest_queries
from cindermill.sources import adapters as A

SF = "/root/testdata/sf0.001"


def test_policy_rates_of_every_area_in_the_files(spark):
    dated = A.table(spark, SF, "customer").where(F.col("c_custkey") % 11 != 0)
    got = ingest_queries.policy_rate_files(spark, SF)
    assert got.count() == dated.count()
    assert {r["central_bank"] for r in got.select("central_bank").distinct().collect()} == {"FED", "ECB", "BOJ"}


def test_ticks_are_aggregated_once_for_all_readers(spark):
    for bars in (base.daily(spark, SF), base.clean_daily(spark, SF)):
        assert bars.count() and not [f for f in bars.inputFiles() if "lineitem" in f]
    pairs = correlate.pair_correlations(correlate.recent_returns(base.clean_daily(spark, SF), 250))
    assert not {f for f in correlate.clusters(pairs).inputFiles()} & set(base.clean_daily(spark, SF).inputFiles() + pairs.inputFiles())


def test_episodes_make_their_scores_once(spark, tmp_path):
    start = dt.date(2025, 1, 1)
    rows = [("A", 2025, start + dt.timedelta(k), 10.0 + k, 6 if k % 4 < 2 else -6, "A") for k in range(12)]
    spark.createDataFrame(rows, "symbol string, window int, date date, close double, mtf_score int, signal_quality string").write.parquet(str(tmp_path / "in"))
    trades = evaluate.episodes(spark.read.parquet(str(tmp_path / "in")))
    assert trades.count() and not [f for f in trades.inputFiles() if str(tmp_path / "in") in f]
