"""Top-k per month with ties, by total usage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ranked_top(base: DataFrame, k: int = 5) -> DataFrame:
    """Products ranked up to k inside their month by usage; NULL usage comes last and ties share a rank.

    Spark applies the rank filter inside each task before the shuffle, so a month is never gathered whole.
    """
    order = Window.partitionBy("month").orderBy(F.desc_nulls_last("usage_amount"))
    return base.withColumn("usage_rank", F.rank().over(order)).where(F.col("usage_rank") <= k)


def top_products(base: DataFrame, k: int = 5) -> DataFrame:
    """(month, product_code) of the top k; more than k of them when ranks are tied."""
    return ranked_top(base, k).select("month", "product_code")


def join_top_flag(base: DataFrame, top: DataFrame) -> DataFrame:
    """Flag by outer join with a set from `top_products`; NULL months and products never match."""
    marker = top.select("month", "product_code", F.lit(True).alias("_hit"))
    return base.join(marker, ["month", "product_code"], "left").select(
        base["*"], F.col("_hit").isNotNull().alias("is_top5")
    )


def month_thresholds(base: DataFrame, k: int = 5) -> DataFrame:
    """(month, lowest): usage of the k-th row of each month that has so many, so one row per calendar month at most.

    Every task sends on k rows a month, however many are tied. The other columns only order ties, which leaves the
    usage as it is; that they are needed lets Spark read the sums from the same exchange as whoever else does.
    """
    ties = [field.name for field in base.schema if field.name not in ("month", "usage_amount") and isinstance(field.dataType, T.AtomicType)]
    order = Window.partitionBy("month").orderBy(F.desc_nulls_last("usage_amount"), *ties)
    kth = base.withColumn("_row", F.row_number().over(order)).where(F.col("_row") == k)
    return kth.select("month", F.col("usage_amount").alias("lowest"))


def rank_top_flag(base: DataFrame, k: int = 5) -> DataFrame:
    """The same flag by comparison with the k-th usage of the month, ties included.

    A month that has fewer than k rows, or whose k-th row has NULL usage, has no threshold: all its rows lead. The
    thresholds are broadcast: no table has more of them than the calendar has months (12 bytes each, 120,000 in the
    years 1 to 9999). So `base` is shuffled neither for the ranking nor for the flag.
    """
    thresholds = F.broadcast(month_thresholds(base, k).withColumnRenamed("month", "_month"))
    # Null-safe, since a filter on NULL months would reach only one of the two readers of the sums.
    joined = base.join(thresholds, base["month"].eqNullSafe(F.col("_month")), "left")
    named = F.col("month").isNotNull() & F.col("product_code").isNotNull()
    leads = F.col("lowest").isNull() | F.coalesce(F.col("usage_amount") >= F.col("lowest"), F.lit(False))
    return joined.select(*[base[name] for name in base.columns], (named & leads).alias("is_top5"))
