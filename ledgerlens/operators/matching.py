"""Matching billing rows to list prices and unit factors."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.costs import gross_cost, has_price
from ledgerlens.operators.sizing import BROADCAST_LIMIT, broadcast_within, checkpointed
from ledgerlens.schemas import GROSS_COST

STRICT_KEYS = ("product_code", "product_name", "pricing_term", "pricing_unit")  # NULL never matches
NULL_SAFE_KEYS = ("instance_type",)  # NULL matches NULL
PRICE_KEYS = STRICT_KEYS + NULL_SAFE_KEYS


_SIDE = "_side_"  # prefix of the joined side's key columns, so the two sides never share a name


def _side(df: DataFrame, keys: tuple[str, ...], *values: str) -> DataFrame:
    return df.select(*[F.col(key).alias(_SIDE + key) for key in keys], *values)


def _shuffled(side: DataFrame) -> DataFrame:
    """Keeps a side that was measured too large from being broadcast on a lower estimate."""
    return side.hint("merge")


def _same_price_key() -> Column:
    strict = [F.col(key) == F.col(_SIDE + key) for key in STRICT_KEYS]
    null_safe = [F.col(key).eqNullSafe(F.col(_SIDE + key)) for key in NULL_SAFE_KEYS]
    return reduce(and_, strict + null_safe)


def _prices_in_use(side: DataFrame, usage: DataFrame) -> DataFrame:
    """Price rows whose key occurs in `usage`.

    Reads only the key columns of `usage` and removes duplicates before the shuffle, so a key that
    holds a large share of the rows costs one row per task.
    """
    seen = usage.select(*PRICE_KEYS).distinct()
    return side.join(seen, _same_price_key(), "left_semi")


def match_prices(
    usage: DataFrame, prices: DataFrame, broadcast_limit: int = BROADCAST_LIMIT, narrow: bool = True
) -> DataFrame:
    """Left join of list prices; a duplicated price key repeats the usage row.

    Three ways, by measured size: the price list fits and is broadcast, so `usage` is not shuffled; only
    the prices in use fit (tried if `narrow`, for one more pass over the key columns), and those are
    broadcast; neither fits, and both sides are shuffled for a sort-merge join, where adaptive execution
    splits the partitions of hot keys. All three return the same rows.
    """
    whole = _side(prices, PRICE_KEYS, "precio_lista")
    side = broadcast_within(whole, broadcast_limit)
    if side is None and narrow and broadcast_limit > 0:
        whole = checkpointed(_prices_in_use(whole, usage))
        side = broadcast_within(whole, broadcast_limit)
    joined = usage.join(_shuffled(whole) if side is None else side, _same_price_key(), "left")
    return joined.select(*usage.columns, "precio_lista")


def match_unit_factors(usage: DataFrame, factors: DataFrame, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Left join of the unit factor; a NULL unit never matches."""
    whole = _side(factors, ("pricing_unit",), "unidad_factor")
    side = broadcast_within(whole, broadcast_limit)
    same_unit = F.col("pricing_unit") == F.col(_SIDE + "pricing_unit")
    joined = usage.join(_shuffled(whole) if side is None else side, same_unit, "left")
    return joined.select(*usage.columns, "unidad_factor")


def billing_with_gross_cost(
    billing: DataFrame,
    prices: DataFrame,
    factors: DataFrame,
    broadcast_limit: int = BROADCAST_LIMIT,
    factor_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Billing rows with list price, unit factor, gross cost and the price-match flag.

    The price list and the few unit factors have limits of their own: shuffling on a handful of units is rarely wanted.
    """
    priced = match_unit_factors(match_prices(billing, prices, broadcast_limit), factors, factor_limit)
    price, factor = F.col("precio_lista"), F.col("unidad_factor")
    return priced.withColumns(
        {
            "gross_cost": gross_cost(F.col("usage_amount"), factor, price),
            "has_price_match": has_price(price, factor),
        }
    ).select(*GROSS_COST.fieldNames())


def matched_only(gross: DataFrame) -> DataFrame:
    return gross.where("has_price_match")
