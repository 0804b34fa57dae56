"""Cost arithmetic. Divisions yield NULL, never an error, when the divisor is zero or NULL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DiscountPolicy:
    """Share of the gross cost that is expected to be billed.

    The defaults are fixed values: results must match them unless a caller overrides them.
    """

    large_above: float = 50000.0  # strictly greater counts as large
    top_and_large: float = 0.56
    top_only: float = 0.7
    large_only: float = 0.8


REVIEW_TOLERANCE = 0.1  # fixed value: relative variance above this asks for a review


def gross_cost(usage: Column, factor: Column, list_price: Column) -> Column:
    return F.try_divide(usage, factor) * list_price


def has_price(list_price: Column, factor: Column) -> Column:
    """A factor of zero still counts as a match, although its gross cost is NULL."""
    return list_price.isNotNull() & factor.isNotNull()


def expected_cost(gross: Column, is_top: Column, policy: DiscountPolicy = DiscountPolicy()) -> Column:
    large = gross > F.lit(policy.large_above)
    return (
        F.when(is_top & large, F.lit(policy.top_and_large) * gross)
        .when(is_top, F.lit(policy.top_only) * gross)
        .when(large, F.lit(policy.large_only) * gross)
        .otherwise(gross)
    )


def relative_change(value: Column, base: Column) -> Column:
    """(value - base) / base as a fraction."""
    return F.try_divide(value - base, base)
