"""Slippage per unit as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FALLBACK_BPS = 5.0
#: Model presets by market.
PRESETS = {"us_stocks": ("fixed", {"bps": 5.0}), "idx": ("fixed", {"bps": 15.0}), "forex": ("fixed", {"bps": 2.0}), "commodity": ("volatility", {"multiple": 0.1})}


def fixed(price: Column, bps: float = 5.0) -> Column:
    return price * bps / 1e4


def spread(price: Column, atr: Column, fraction: float = 0.1) -> Column:
    return F.when((atr <= 0) | (price <= 0), fixed(price, FALLBACK_BPS)).otherwise(atr * fraction / 2)


def volatility(price: Column, atr: Column, multiple: float = 0.1, low: float = 2.0, high: float = 50.0) -> Column:
    relative = F.when(atr > 0, atr / price).otherwise(0.002)
    return F.when(price <= 0, 0.0).otherwise(price * F.least(F.greatest(1e4 * multiple * relative, F.lit(low)), F.lit(high)) / 1e4)


def impact(price: Column, quantity: Column, dollar_volume: Column, factor: float = 0.1, most: float = 200.0) -> Column:
    rooted = 1e4 * factor * F.sqrt(price * quantity / dollar_volume)
    return F.when((dollar_volume <= 0) | (price <= 0), fixed(price, FALLBACK_BPS)).otherwise(price * F.least(rooted, F.lit(most)) / 1e4)


def total_cost(per_unit: Column, quantity: Column) -> Column:
    return per_unit * F.abs(quantity)
