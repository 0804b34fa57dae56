"""Month-over-month growth of net cost per service."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.calendar import month_start
from ledgerlens.functions.costs import relative_change
from ledgerlens.schemas import SERVICE_GROWTH


def service_month_base(billing: DataFrame) -> DataFrame:
    """Net cost per month and service; rows without a service are left out."""
    return (
        billing.where(F.col("service_code").isNotNull())
        .groupBy(month_start(F.col("start_date")).alias("month"), "service_code")
        .agg(F.sum("net_cost").alias("net_cost"))
    )


def growth_of(base: DataFrame) -> DataFrame:
    """Change against the previous month that exists for the service; gaps are skipped, NULL month is first.

    The window holds one row per month of a service, however many billing rows the service has.
    """
    months = Window.partitionBy("service_code").orderBy(F.asc_nulls_first("month"))
    net, previous = F.col("net_cost"), F.col("prev_net_cost")
    return (
        base.withColumn("prev_net_cost", F.lag("net_cost").over(months))
        .withColumns({"growth_abs": net - previous, "growth_pct": relative_change(net, previous) * 100})
        .select(*SERVICE_GROWTH.fieldNames())
    )


def service_growth(billing: DataFrame) -> DataFrame:
    return growth_of(service_month_base(billing))
