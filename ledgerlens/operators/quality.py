"""Data-quality counts. They report; they stop nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The labels of the checks, in report order. Each is also the condition that it counts.
BILLING_CHECKS = (
    "account_id IS NULL",
    "usage_amount < 0",
    "product_code IS NULL",
    "service_code IS NULL",
    "usage_type IS NULL",
    "instance_type IS NULL",
    "net_cost IS NULL",
    "start_date IS NULL",
)
PRICE_CHECKS = (
    "product_code IS NULL",
    "precio_lista IS NULL",
    "precio_lista < 0",
    "pricing_unit IS NULL",
)


def dq_report(df: DataFrame, checks: tuple[str, ...]) -> DataFrame:
    """One row per check with its number of bad rows, zeros included, from a single scan."""
    counts = df.agg(*[F.count_if(F.expr(check)).alias(check) for check in checks])
    return counts.unpivot([], [f"`{check}`" for check in checks], "check_name", "num_issues")


def dq_billing(billing: DataFrame) -> DataFrame:
    return dq_report(billing, BILLING_CHECKS)


def dq_prices(prices: DataFrame) -> DataFrame:
    return dq_report(prices, PRICE_CHECKS)


def dq_union(billing: DataFrame, prices: DataFrame) -> DataFrame:
    """Both reports, told apart by `source`; one scan of each table."""
    reports = {"billing": dq_billing(billing), "prices": dq_prices(prices)}
    first, second = (report.select(F.lit(name).alias("source"), "*") for name, report in reports.items())
    return first.unionByName(second)
