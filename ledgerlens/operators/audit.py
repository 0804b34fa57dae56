"""Product-month cost audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.calendar import month_start
from ledgerlens.functions.costs import (
    REVIEW_TOLERANCE,
    DiscountPolicy,
    expected_cost,
    gross_cost,
    has_price,
    relative_change,
)
from ledgerlens.operators.matching import PRICE_KEYS, match_prices, match_unit_factors, matched_only
from ledgerlens.operators.ranking import join_top_flag, rank_top_flag, top_products
from ledgerlens.operators.sizing import BROADCAST_LIMIT, checkpointed
from ledgerlens.schemas import COST_AUDIT

_MEASURES = ("usage_amount", "net_cost", "gross_cost")


def _product_month_sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("month", "product_code").agg(*[F.sum(m).alias(m) for m in _MEASURES])


def product_month_base(gross: DataFrame) -> DataFrame:
    """Usage, net and gross cost per month and product over price-matched rows; NULL months are a group."""
    matched = matched_only(gross).withColumn("month", month_start(F.col("start_date")))
    return _product_month_sums(matched)


def product_month_base_from_usage(
    billing: DataFrame,
    prices: DataFrame,
    factors: DataFrame,
    broadcast_limit: int = BROADCAST_LIMIT,
    factor_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """`product_month_base` straight from billing, summed per month and price key before any join.

    All rows of one month and key share price and factor, so pricing their sum gives the same total up
    to floating-point rounding. A hot key shrinks to one row per task before the first shuffle, and
    the joins only see the sums.
    """
    sums = (
        billing.withColumn("month", month_start(F.col("start_date")))
        .groupBy("month", *PRICE_KEYS)
        .agg(F.sum("usage_amount").alias("usage_amount"), F.sum("net_cost").alias("net_cost"))
    )
    priced = match_prices(sums, prices, broadcast_limit, narrow=False)  # narrowing would sum billing twice
    priced = match_unit_factors(priced, factors, factor_limit)
    usage, factor, price = F.col("usage_amount"), F.col("unidad_factor"), F.col("precio_lista")
    matched = priced.where(has_price(price, factor))
    return _product_month_sums(matched.withColumn("gross_cost", gross_cost(usage, factor, price)))


def discounted(flagged: DataFrame, policy: DiscountPolicy = DiscountPolicy()) -> DataFrame:
    """Adds the expected cost; the first matching tier wins."""
    return flagged.withColumn("expected_cost", expected_cost(F.col("gross_cost"), F.col("is_top5"), policy))


def discounted_by_join(base: DataFrame, k: int = 5, policy: DiscountPolicy = DiscountPolicy()) -> DataFrame:
    """Discounts with the top-k flag taken from an outer join.

    The join reads `base` twice. It is one row per month and product, so it is checkpointed rather than
    summed from billing a second time; `rank_top_flag` does without either.
    """
    base = checkpointed(base)
    return discounted(join_top_flag(base, top_products(base, k)), policy)


def with_variance(costed: DataFrame) -> DataFrame:
    """Absolute and relative variance; the review flag is NULL when the relative one is."""
    net, expected = F.col("net_cost"), F.col("expected_cost")
    deviation = relative_change(net, expected)
    return costed.withColumns(
        {
            "diff_abs": net - expected,
            "diff_pct": deviation,
            "needs_review": F.abs(deviation) > F.lit(REVIEW_TOLERANCE),
        }
    )


def audit_of(base: DataFrame, k: int = 5, policy: DiscountPolicy = DiscountPolicy()) -> DataFrame:
    return with_variance(discounted(rank_top_flag(base, k), policy)).select(*COST_AUDIT.fieldNames())


def cost_audit(gross: DataFrame, k: int = 5, policy: DiscountPolicy = DiscountPolicy()) -> DataFrame:
    """Audit of the gross-cost table, per month and product."""
    return audit_of(product_month_base(gross), k, policy)


def cost_audit_from_usage(
    billing: DataFrame,
    prices: DataFrame,
    factors: DataFrame,
    k: int = 5,
    policy: DiscountPolicy = DiscountPolicy(),
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """The audit without the gross-cost table in between; see `product_month_base_from_usage`."""
    return audit_of(product_month_base_from_usage(billing, prices, factors, broadcast_limit), k, policy)
