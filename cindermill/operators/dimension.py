"""The instrument dimension: building, selecting, symbol forms and rules. Rules give violation rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Raw symbols that are written otherwise, and suffixes of source symbols by market.
OVERRIDES = {"BRK/B": "BRK-B", "BF/B": "BF-B"}
SUFFIXES = {"idx": ".JK", "forex": "=X", "commodity": "=F"}


def merge_configs(identity: DataFrame, taxonomy: DataFrame, anchor: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """Two configs keyed by (path, idx) merged by position, and the violations: rows of one side only, other anchors, conflicting values."""
    keys = ["path", "idx"]
    shared = [c for c in identity.columns if c in taxonomy.columns and c not in keys]
    right = taxonomy.withColumnsRenamed({c: f"{c}_t" for c in shared}).withColumn("in_t", F.lit(True))
    both = identity.withColumn("in_i", F.lit(True)).join(right, keys, "full_outer")
    problem = F.when(F.col("in_t").isNull(), "missing in taxonomy").when(F.col("in_i").isNull(), "missing in identity")
    for c in shared:
        problem = problem.when(~F.col(c).eqNullSafe(F.col(f"{c}_t")), F.lit("anchor differs" if c == anchor else f"{c} conflicts"))
    marked = both.withColumn("problem", problem)
    merged = marked.where("problem IS NULL").drop("in_i", "in_t", "problem", *[f"{c}_t" for c in shared])
    return merged, marked.where("problem IS NOT NULL").select(*keys, "problem")


def tradeable(rows: DataFrame, zones: dict[str, str]) -> DataFrame:
    """Layer-1 rows with defaults: source symbols from the symbol, time zone from the market."""
    zone = F.lit("UTC")
    for market, name in zones.items():
        zone = F.when(F.col("market") == market, F.lit(name)).otherwise(zone)
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    return rows.withColumns({"layer": F.lit(1), "api_symbol": F.coalesce(have("api_symbol"), api_symbol(F.col("symbol"), F.col("market"))), "timezone": F.coalesce(have("timezone"), zone)})


def context_rows(groups: DataFrame, known=("symbol", "name", "role")) -> DataFrame:
    """Layer-2 rows from (subcategory, members: array of string maps); keys that are not columns go to `meta`."""
    rows = groups.select("subcategory", F.explode("members").alias("m"))
    meta = F.map_filter("m", lambda k, _: ~k.isin(*known))
    return rows.select(F.lit(2).alias("layer"), "subcategory", *[F.col("m")[k].alias(k) for k in known], meta.alias("meta"))


def ambiguous_symbols(instruments: DataFrame) -> DataFrame:
    """Symbols that live in several markets."""
    return instruments.groupBy("symbol").agg(F.countDistinct("market").alias("n_markets")).where("n_markets > 1")


def market_counts(instruments: DataFrame) -> DataFrame:
    return instruments.groupBy("market").agg(F.count("*").alias("n_symbols"), F.countDistinct("sector").alias("n_sectors"))


def normal_symbol(raw: Column) -> Column:
    """Overrides, then dots to dashes, slashes to underscores, upper case."""
    out = raw
    for written, meant in OVERRIDES.items():
        out = F.when(raw == written, F.lit(meant)).otherwise(out)
    return F.upper(F.translate(out, "./", "-_"))


def api_symbol(symbol: Column, market: Column, source: str = "yfinance") -> Column:
    """The symbol as a source writes it."""
    bare = F.regexp_replace(symbol, "[_/]", "")
    if source == "polygon":
        return F.when(market == "forex", F.concat(F.lit("C:"), bare)).otherwise(F.replace(symbol, F.lit("-"), F.lit(".")))
    out = F.when(market == "index", F.concat(F.lit("^"), symbol)).otherwise(symbol)
    for name, suffix in SUFFIXES.items():
        out = F.when(market == name, F.concat(bare if name == "forex" else symbol, F.lit(suffix))).otherwise(out)
    return out


def _violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """symbol, rule for every rule that holds for a row."""
    broken = F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]), lambda x: x.isNotNull())
    return rows.select("symbol", F.explode(broken).alias("rule"))


#: The fields that a market's instruments need, how their API symbols begin or end and the one that need not,
#: symbols that belong to the context layer alone, and the roles and subcategories of commodities.
REQUIRED = {"us_stocks": ("symbol",), "idx_stocks": ("symbol", "yfinance_symbol"), "commodity": ("symbol", "yfinance_symbol", "commodity_role", "commodity_subcategory"), "forex": ("symbol", "raw_symbol", "yfinance_symbol")}
API_FORMS = {"idx_stocks": r"\.JK$", "forex": "=X$", "commodity": "=F$", "index": r"^\^"}
DOLLAR_INDEX = "DX-Y.NYB"
RECLASSIFIED = ("SPX", "VIX", "DXY")
ROLES = ("trading", "context")
COMMODITIES = ("energy", "precious_metals", "base_metals", "agricultural", "bulks")
#: Subcategories of the context layer that have no weight, no forecasts, and no bars; the name that one had before;
#: and the central banks that two of them have.
WEIGHTLESS = ("context_dollar_basket", "context_fx_normalization")
NO_FORECAST = ("context_etf_broad", "context_etf_sector", "context_etf_factor", "context_fx_normalization")
NO_BARS = ("context_rates_fed", "context_rates_curve", "context_rates_spread", "context_rates_dm_cb", "context_rates_em_cb")
RENAMED = "context_rates_policy"
BANKS = {"context_rates_dm_cb": 9, "context_rates_em_cb": 3}


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")) != ""


def _taxonomy() -> dict[str, Column]:
    return {"unknown commodity role": ~F.col("commodity_role").isin(*ROLES), "unknown commodity subcategory": ~F.col("commodity_subcategory").isin(*COMMODITIES)}


def _repeated(rows: DataFrame, group: str, rule: str) -> DataFrame:
    return rows.groupBy("symbol", group).count().where("count > 1").select("symbol", F.lit(rule).alias("rule"))


def layer_one_violations(rows: DataFrame, required: dict[str, tuple[str, ...]] = REQUIRED) -> DataFrame:
    """symbol, rule for instruments (market, symbol, yfinance_symbol, ...) of the traded layer.

    Fields that a market needs, "." and "/" in symbols, forms of API symbols (an empty one has none), the taxonomy of commodities,
    repeats within a market, and symbols that belong to the context layer. A field that no row has is a null column to add. Rows of
    markets not listed in `required` are not looked at.
    """
    known = rows.where(F.col("market").isin(*required))
    rules = {f"no {field}": F.col("market").isin(*[m for m, fields in required.items() if field in fields]) & F.col(field).isNull() for field in sorted({f for fields in required.values() for f in fields})}
    rules["unsafe character"] = F.col("symbol").rlike("[./]")
    for market, form in API_FORMS.items():
        free = F.col("yfinance_symbol") == DOLLAR_INDEX if market in ("forex", "index") else F.lit(False)
        rules[f"api symbol of {market}"] = (F.col("market") == market) & _filled("yfinance_symbol") & ~F.col("yfinance_symbol").rlike(form) & ~free
    rules |= {name: (F.col("market") == "commodity") & broken for name, broken in _taxonomy().items()}
    rules["reclassified"] = F.col("symbol").isin(*RECLASSIFIED)
    return _violations(known, rules).unionByName(_repeated(known, "market", "repeated in market"))


def layer_two_violations(rows: DataFrame, groups: DataFrame, expected: DataFrame) -> DataFrame:
    """symbol, rule for the context layer; rules of a group come under its subcategory.

    rows: subcategory, parent and the fields of an instrument. groups: subcategory, contributes_to and central_banks (arrays).
    expected: the subcategories that there have to be. Deferred instruments need a reason and a wave, proxies their instrument and
    expected correlation, commodities their taxonomy; groups for rates have no instruments, some are out of forecasts, and
    two must not contribute to any score.
    """
    deferred, proxy, commodity = F.col("context_available") == False, _filled("proxy_for"), F.col("parent") == "commodity"  # noqa: E712
    rules = {"no symbol": F.col("symbol").isNull(), "deferred without reason": deferred & ~_filled("deferred_reason"), "deferred without wave": deferred & F.col("planned_wave").isNull(), "proxy without instrument": proxy & ~_filled("proxy_instrument"), "proxy without correlation": proxy & F.col("proxy_correlation_expected").isNull(), "no commodity role": commodity & ~_filled("commodity_role"), "no commodity subcategory": commodity & ~_filled("commodity_subcategory"), "instrument of a rates group": F.col("subcategory").isin(*NO_BARS), "in forecasts": F.col("subcategory").isin(*NO_FORECAST) & F.coalesce("include_in_forecast", F.lit(True))}
    rules |= {name: commodity & broken for name, broken in _taxonomy().items()}
    named = groups.withColumn("symbol", F.col("subcategory"))
    n_banks = F.when(F.col("central_banks").isNull(), 0).otherwise(F.size("central_banks"))
    of_groups = {"contributes to a score": F.col("subcategory").isin(*WEIGHTLESS) & F.coalesce(F.size("contributes_to") > 0, F.lit(False)), "renamed subcategory": F.col("subcategory") == RENAMED}
    of_groups |= {f"not {n} central banks": (F.col("subcategory") == name) & (n_banks != n) for name, n in BANKS.items()}
    have, want = groups.select("subcategory").distinct(), expected.select("subcategory").distinct()
    parts = [_violations(rows, rules), _violations(named, of_groups), _repeated(rows, "subcategory", "repeated in subcategory"), have.join(want, "subcategory", "left_anti").select(F.col("subcategory").alias("symbol"), F.lit("unexpected subcategory").alias("rule")), want.join(have, "subcategory", "left_anti").select(F.col("subcategory").alias("symbol"), F.lit("missing subcategory").alias("rule"))]
    return reduce(DataFrame.unionByName, parts)


def weight_sums(contributions: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Per score the sum of its weights and whether that is 1."""
    return contributions.groupBy("score").agg(F.sum("weight").alias("weight_sum")).withColumn("passed", F.abs(F.col("weight_sum") - 1) <= tolerance)


def universe_total(instruments: DataFrame, expected: int) -> DataFrame:
    return instruments.agg(F.count("*").alias("n_instruments")).withColumn("passed", F.col("n_instruments") == expected)


def select_series(registry: DataFrame, domain: str | None = None, ids: list[str] | None = None, regime_only: bool = False, run_weekday: Column | None = None) -> DataFrame:
    """Series of a domain or id list; weekly series only on their weekday."""
    out = registry
    if domain is not None:
        out = out.where(F.col("domain") == domain)
    if ids is not None:
        out = out.where(F.col("series_id").isin(*ids))
    if regime_only:
        out = out.where("regime_input")
    return out if run_weekday is None else out.where((F.col("cadence") != "weekly") | (F.col("weekday") == run_weekday))


def select_instruments(instruments: DataFrame, layer: int | None = None, markets: list[str] | None = None, sectors: list[str] | None = None, subcategories: list[str] | None = None, flag: str | None = None) -> DataFrame:
    """Instruments by layer, market, sector and subcategory; flag names a boolean column, such as those for forecasts or correlations."""
    out = instruments
    for column, values in (("layer", None if layer is None else [layer]), ("market", markets), ("sector", sectors), ("subcategory", subcategories)):
        if values is not None:
            out = out.where(F.col(column).isin(*values))
    return out if flag is None else out.where(F.col(flag))


def subcategory_meta(groups: DataFrame) -> DataFrame:
    """subcategory, key, value of each group's meta map."""
    return groups.select("subcategory", F.explode("meta").alias("key", "value"))


def lookup(instruments: DataFrame, symbols: DataFrame, market: str | None = None) -> DataFrame:
    """The instruments of the listed symbols; a symbol of several markets is an error unless a market is named."""
    found = instruments.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    if market is not None:
        return found.where(F.col("market") == market)
    if not ambiguous_symbols(found).isEmpty():
        raise LookupError("a symbol lives in several markets")
    return found


#: Series of the yield curve and their labels.
TENORS = {"DGS1MO": "1M", "DGS3MO": "3M", "DGS6MO": "6M", "DGS1": "1Y", "DGS2": "2Y", "DGS5": "5Y", "DGS7": "7Y", "DGS10": "10Y", "DGS20": "20Y", "DGS30": "30Y", "T10Y2Y": "spread_10y2y", "T10Y3M": "spread_10y3m", "MORTGAGE30US": "mortgage_30y"}


def with_tenors(series: DataFrame) -> DataFrame:
    """Adds tenor, the label of a yield-curve series; null for others."""
    labels = series.sparkSession.createDataFrame(list(TENORS.items()), "series_id string, tenor string")
    return series.join(F.broadcast(labels), "series_id", "left")  # as many rows as the list above
