"""Correlations of returns, clusters of correlated symbols, proxy studies."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cindermill.sources.scratch import Scratch


def recent_returns(bars: DataFrame, lookback: int = 65) -> DataFrame:
    """symbol, date, log_return of each symbol's last clean bars."""
    newest = Window.partitionBy("symbol").orderBy(F.col("timestamp").desc())
    return bars.where("is_clean").withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= lookback).select("symbol", F.to_date("timestamp").alias("date"), "log_return")


def _gram_sums(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums over the dates that two symbols have in common, for all pairs of two blocks, a before b by name."""
    sides = []
    for side in (left, right):
        names, column = np.unique(np.array(side.column("symbol").to_pylist(), dtype=object), return_inverse=True)
        values, there = np.zeros((DATES, len(names))), np.zeros((DATES, len(names)))
        at = (side.column("day").to_numpy(), column)
        values[at], there[at] = side.column("log_return").to_numpy(), 1.0
        sides.append((names, values, there))
    (names, x, m), (others, y, k) = sides
    sums = [m.T @ k, x.T @ k, m.T @ y, (x * x).T @ k, m.T @ (y * y), x.T @ y]
    i, j = np.nonzero(sums[0])
    a, b = names[i], others[j]
    own = left.column("a")[0].as_py() == left.column("b")[0].as_py()  # a block with itself has every pair twice
    kept = (a < b) if own else np.ones(len(a), bool)
    i, j, a, b = i[kept], j[kept], a[kept], b[kept]
    swap = a > b
    n, sx, sy, sxx, syy, sxy = (matrix[i, j] for matrix in sums)
    pick = lambda one, other: np.where(swap, other, one)
    columns = [pick(a, b), pick(b, a), n.astype(np.int64), pick(sx, sy), pick(sy, sx), pick(sxx, syy), pick(syy, sxx), sxy]
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), *[pa.float64()] * 5))], names=["symbol_a", "symbol_b", "n", "sx", "sy", "sxx", "syy", "sxy"])


DATES, SYMBOLS = 256, 256


def pair_correlations(returns: DataFrame, min_history: int = 52, blocks: int | None = None) -> DataFrame:
    """symbol_a < symbol_b with Pearson correlation over common dates and their number; symbols need 0.8 of the history.

    The matrix of all symbol pairs is what is asked for. Returns are cut into blocks of dates and of symbols; every two blocks
    of symbols meet on a block of dates, as two small matrices of which the products are the pairs' sums, and these add up over the
    dates. A return is sent once for each block of symbols, not once for each pair; blocks have about SYMBOLS of them unless
    their number is given. One return a symbol and date; null without variance. Returns are read several times and so are written.
    """
    returns = Scratch(returns.sparkSession).keep("returns", returns.select("symbol", "date", "log_return"))
    enough = returns.groupBy("symbol").agg(F.count("log_return").alias("n")).where(F.col("n") >= 0.8 * min_history).select("symbol")
    blocks = blocks or max(1, -(-enough.count() // SYMBOLS))
    day = F.unix_date("date")
    cells = returns.where("symbol IS NOT NULL AND date IS NOT NULL AND log_return IS NOT NULL").join(enough, "symbol", "left_semi").select("symbol", "log_return", F.floor(day / DATES).alias("span"), F.pmod(day, F.lit(DATES)).alias("day"), F.pmod(F.xxhash64("symbol"), F.lit(blocks)).alias("own"))
    meets = lambda low, high: F.explode(F.sequence(low, high))
    fields = ("symbol", "log_return", "span", "day")
    left = cells.select(*fields, F.col("own").alias("a"), meets(F.col("own"), F.lit(blocks - 1).cast("long")).alias("b"))
    # new names for the same columns, or the two sides could not be told apart
    right = cells.select(*[F.col(c).alias(c) for c in fields], F.col("own").alias("b"), meets(F.lit(0).cast("long"), F.col("own")).alias("a"))
    keys = ("span", "a", "b")
    kinds = "symbol_a string, symbol_b string, n long, sx double, sy double, sxx double, syy double, sxy double"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _gram_sums(left, right) if left.num_rows and right.num_rows else pa.table({name: pa.array([], kind) for name, kind in zip(kinds.replace(",", "").split()[::2], (pa.string(), pa.string(), pa.int64(), *[pa.float64()] * 5))})

    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, kinds).groupBy("symbol_a", "symbol_b").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n = F.col("n")

    def variance(c: str) -> Column:
        squares = n * F.col(f"s{c}{c}")
        spread = squares - F.col(f"s{c}") * F.col(f"s{c}")
        return F.when(spread > 1e-14 * squares, spread).alias(f"var_{c}")

    sums = sums.select("symbol_a", "symbol_b", n.alias("n_obs"), (n * F.col("sxy") - F.col("sx") * F.col("sy")).alias("both"), variance("x"), variance("y"))
    return sums.select("symbol_a", "symbol_b", (F.col("both") / F.sqrt(F.col("var_x")) / F.sqrt(F.col("var_y"))).alias("correlation"), "n_obs")


def linkage(pairs: DataFrame, *scope: str) -> tuple[DataFrame, DataFrame]:
    """Average linkage on 1 - |correlation| in rounds: merges (scope, a, b, height, round_) and symbols (scope, symbol).

    A cluster goes by its first symbol in name order. In each round every cluster finds its nearest, of equals the first by
    names; two that are each other's nearest merge, b into a, and the strengths to them add up. Merging
    never brings a third cluster nearer, so these are the merges of the one-by-one method, found by its height in the end.
    A state is the pair table with its sums of |correlation|, written once a round; pairs without correlation have strength 0 and
    are not held.
    """
    kept = Scratch(pairs.sparkSession)
    a, b, keys = F.least("symbol_a", "symbol_b"), F.greatest("symbol_a", "symbol_b"), list(scope)
    one = F.lit(1).cast("long")
    strong = pairs.where("symbol_a != symbol_b").select(*keys, a.alias("a"), b.alias("b"), F.abs("correlation").alias("s"), one.alias("n_a"), one.alias("n_b"))
    symbols = kept.keep("symbols", pairs.select(*keys, F.explode(F.array("symbol_a", "symbol_b")).alias("symbol")).distinct())
    state = kept.keep("pairs", strong.where("s > 0 AND NOT isnan(s)").groupBy(*keys, "a", "b").agg(F.max("s").alias("s"), F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b")))
    merged = []
    while not state.isEmpty():
        far = state.withColumn("height", 1 - F.col("s") / (F.col("n_a") * F.col("n_b")))
        sides = far.select(*keys, F.explode(F.array("a", "b")).alias("cluster"), F.struct("height", "a", "b", "n_a", "n_b").alias("pair"))
        nearest = sides.groupBy(*keys, "cluster").agg(F.min("pair").alias("pair"))
        mutual = nearest.groupBy(*keys, "pair").agg(F.count("*").alias("sides")).where("sides = 2").select(*keys, "pair.*")
        made = kept.keep(f"merges{len(merged)}", mutual)
        merged.append(made.select(*keys, "a", "b", "height", F.lit(len(merged)).alias("round_")))
        grown = made.select(*keys, F.explode(F.array("a", "b")).alias("old"), F.col("a").alias("new"), (F.col("n_a") + F.col("n_b")).alias("n"))
        moved = state
        for side in "ab":
            to = grown.select(*keys, F.col("old").alias(side), F.col("new").alias(f"new_{side}"), F.col("n").alias(f"n_{side}_"))
            moved = moved.join(to, [*keys, side], "left").withColumns({side: F.coalesce(f"new_{side}", side), f"n_{side}": F.coalesce(f"n_{side}_", f"n_{side}")}).drop(f"new_{side}", f"n_{side}_")
        ordered = F.when(F.col("a") < F.col("b"), F.struct("a", "b", "n_a", "n_b")).otherwise(F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("n_b").alias("n_a"), F.col("n_a").alias("n_b")))
        state = kept.keep("pairs", moved.where("a != b").select(*keys, "s", ordered.alias("p")).groupBy(*keys, "p").agg(F.sum("s").alias("s")).select(*keys, "p.*", "s"))
    kept.drop("pairs")
    none = symbols.select(*keys, F.col("symbol").alias("a"), F.col("symbol").alias("b"), F.lit(0.0).alias("height"), F.lit(0).alias("round_")).where("false")
    return (reduce(DataFrame.unionByName, merged) if merged else none), symbols


def _roots(parents: DataFrame, kept: Scratch, *scope: str) -> DataFrame:
    """From rows (scope, node, root) that hang nodes on others: the last of each chain, which every round follows twice as far."""
    links = kept.keep("links", parents)
    while True:
        onward = links.select(*scope, F.col("node").alias("root"), F.col("root").alias("further"))
        doubled = kept.keep("links", links.join(onward, [*scope, "root"], "left").select(*scope, "node", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        links = doubled.drop("moved")
        if doubled.where("moved").isEmpty():
            return links


def clusters(pairs: DataFrame, *scope: str) -> DataFrame:
    """symbol, cluster_id, correlation_avg, n_cluster_members by average linkage on 1 - |correlation| within each scope.

    There are n // 2 clusters of n symbols, at least 2 and at most 10, numbered by their first symbols. The merges of the least height
    count; where there are fewer than needed, the clusters left have no correlation with each other at all and the
    first of them by name are put together. Symbols of null scopes are left out. Windows go over a scope's
    symbols and merges, one small row each, never over its pairs.
    """
    keys, kept = list(scope), Scratch(pairs.sparkSession)
    pairs = kept.keep("measured", pairs.select(*keys, "symbol_a", "symbol_b", "correlation"))  # three readers, made once
    merges, symbols = linkage(pairs, *scope)
    wanted = F.least(F.lit(10), F.greatest(F.lit(2), F.floor(F.count("*") / 2)))
    sizes = symbols.groupBy(*keys).agg(F.count("*").alias("n"), wanted.alias("k"))
    by = lambda *order: Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)
    with_sizes = (lambda df: df.join(sizes, keys)) if keys else (lambda df: df.crossJoin(F.broadcast(sizes)))  # one row without scope
    # merges above others are never lower, but may be equal or differ in the last digits
    ranked = with_sizes(merges).withColumn("rank", F.row_number().over(by(F.round("height", 12), "round_", "a", "b")))
    chains = _roots(ranked.where(F.col("rank") <= F.col("n") - F.col("k")).select(*keys, F.col("b").alias("node"), F.col("a").alias("root")), kept, *scope)
    placed = symbols.join(chains.withColumnRenamed("node", "symbol"), [*keys, "symbol"], "left").withColumn("root", F.coalesce("root", "symbol"))
    heads = with_sizes(placed.select(*keys, "root").distinct()).withColumns({"rank": F.row_number().over(by("root")), "left": F.count("*").over(Window.partitionBy(*(keys or [F.lit(0)])))})
    extra = F.greatest(F.col("left") - F.col("k"), F.lit(0))
    numbers = heads.select(*keys, "root", F.greatest(F.col("rank") - 1 - extra, F.lit(0)).cast("long").alias("cluster_id"))
    strength = pairs.select(*keys, F.explode(F.array("symbol_a", "symbol_b")).alias("symbol"), F.coalesce(F.nanvl(F.abs("correlation"), F.lit(0.0)), F.lit(0.0)).alias("s")).groupBy(*keys, "symbol").agg(F.sum("s").alias("s"))
    labelled = with_sizes(placed.join(numbers, [*keys, "root"]).join(strength, [*keys, "symbol"]))
    members = F.count("*").over(Window.partitionBy(*keys, "cluster_id"))
    return labelled.select(*keys, "symbol", "cluster_id", (F.col("s") / F.greatest(F.lit(1), F.col("n") - 1)).alias("correlation_avg"), members.alias("n_cluster_members"))


def monthly_returns(bars: DataFrame) -> DataFrame:
    """symbol, month, r: change of the last close of each month against the symbol's previous month."""
    closes = bars.groupBy("symbol", F.trunc("timestamp", "month").alias("month")).agg(F.max_by("close", "timestamp").alias("close"))
    return closes.withColumn("r", F.col("close") / F.lag("close").over(Window.partitionBy("symbol").orderBy("month")) - 1).where("r IS NOT NULL").select("symbol", "month", "r")


def proxy_correlation(bars: DataFrame, proxies: DataFrame, min_periods: int = 12) -> DataFrame:
    """For rows (proxy, benchmark): correlation of monthly returns over common months, null below min_periods or without variance."""
    r = monthly_returns(bars)
    x, y = r.select(F.col("symbol").alias("proxy"), "month", F.col("r").alias("x")), r.select(F.col("symbol").alias("benchmark"), "month", F.col("r").alias("y"))
    both = proxies.join(x, "proxy").join(y, ["benchmark", "month"])
    usable = (F.count("*") >= min_periods) & (F.stddev_samp("x") > 0) & (F.stddev_samp("y") > 0)
    return both.groupBy("proxy", "benchmark").agg(F.count("*").alias("n_months"), F.when(usable, F.corr("x", "y")).alias("correlation"))
