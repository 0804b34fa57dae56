"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.operators import audit, growth, matching, quality, ranking
from ledgerlens.operators.sizing import measured_bytes
from ledgerlens.plans.pipeline import PipelineConfig, run
from ledgerlens.sources import landing, readers, sinks, specs
from ledgerlens.testkit import projection
from ledgerlens.testkit.landing import land_billing, land_prices, scratch

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = date(2024, 1, 5)


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return projection.billing(spark, sf_dir), projection.prices(spark, sf_dir), projection.unit_factors(spark)


def _gross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.billing_with_gross_cost(*_inputs(spark, sf_dir))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.product_month_base(_gross(spark, sf_dir))


def _database(spark: SparkSession) -> str:
    """A database of its own in the shared folder, for queries that write tables."""
    folder = scratch(spark)
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    sinks.create_database(spark, name, folder)
    return name


def price_join_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage, prices, _ = _inputs(spark, sf_dir)
    return matching.match_prices(usage, prices)


def price_join_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price join when the whole list is over the limit by one byte."""
    usage, prices, _ = _inputs(spark, sf_dir)
    return matching.match_prices(usage, prices, broadcast_limit=measured_bytes(prices) - 1)


def price_join_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price join with no broadcast of ours."""
    usage, prices, _ = _inputs(spark, sf_dir)
    return matching.match_prices(usage, prices, broadcast_limit=0, narrow=False)


def unit_factor_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage, _, factors = _inputs(spark, sf_dir)
    return matching.match_unit_factors(usage, factors)


def matched_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.matched_only(_gross(spark, sf_dir))


def top5_usage_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranking.ranked_top(_base(spark, sf_dir))
    return ranked.select("month", "product_code", "usage_amount", F.col("usage_rank").cast("bigint").alias("usage_rank"))


def top5_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_products(_base(spark, sf_dir))


def discounted_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.discounted_by_join(_base(spark, sf_dir))


def cost_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.cost_audit(_gross(spark, sf_dir))


def cost_audit_preaggregated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.cost_audit_from_usage(*_inputs(spark, sf_dir))


def service_month_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return growth.service_month_base(projection.billing(spark, sf_dir))


def service_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return growth.service_growth(projection.billing(spark, sf_dir))


def dq_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_billing(projection.billing(spark, sf_dir))


def dq_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_prices(projection.prices(spark, sf_dir))


def dq_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_union(projection.billing(spark, sf_dir), projection.prices(spark, sf_dir))


def dq_billing_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The billing part of both reports; the optimizer leaves the other part out."""
    return dq_union(spark, sf_dir).where("source = 'billing'").drop("source")


def stage_billing_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    land_billing(projection.billing(spark, sf_dir), root, RUN_DATE)
    spec = specs.BILLING_SOURCE
    return readers.read_source(spark, spec, landing.raw_path(root, spec, RUN_DATE))


def stage_prices_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    land_prices(projection.prices(spark, sf_dir), root, RUN_DATE)
    spec = specs.PRICE_SOURCE
    return readers.read_source(spark, spec, landing.raw_path(root, spec, RUN_DATE))


def staged_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged file, then the unpartitioned table loaded from it."""
    staged = landing.stage_path(scratch(spark), specs.PRICE_SOURCE, RUN_DATE)
    sinks.write_parquet(projection.prices(spark, sf_dir), staged)
    table = f"{_database(spark)}.{specs.PRICE_TABLE}"
    sinks.replace_table(spark.read.parquet(staged), table)
    return sinks.read_table(spark, table, schemas.PRICES)


def day_partitioned_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{_database(spark)}.{specs.BILLING_TABLE}"
    sinks.replace_table(projection.billing(spark, sf_dir), table, partition_by="start_date")
    return sinks.read_table(spark, table, schemas.BILLING)


def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned load first; the growth table that replaces it has another schema and no partitions."""
    table = f"{_database(spark)}.{specs.SERVICE_GROWTH_TABLE}"
    usage = projection.billing(spark, sf_dir)
    sinks.replace_table(usage, table, partition_by="region")
    sinks.replace_table(growth.service_growth(usage), table)
    return sinks.read_table(spark, table)


def required_files_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source is required at the end of each year with usage; only billing of the last year has landed."""
    root = scratch(spark)
    usage = projection.billing(spark, sf_dir).where(F.col("start_date").isNotNull())
    year_end = F.make_date(F.year("start_date"), F.lit(12), F.lit(31))
    run_dates = usage.select(year_end.alias("run_date")).distinct()
    land_billing(usage, root, run_dates.agg(F.max("run_date")).first()[0])
    required = landing.required_files(run_dates, specs.SOURCES)
    return landing.missing_files(required, landing.landed_files(spark, root))


def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    usage, prices, factors = _inputs(spark, sf_dir)
    land_billing(usage, f"{root}/raw", RUN_DATE)
    land_prices(prices, f"{root}/raw", RUN_DATE)
    config = PipelineConfig(
        raw_root=f"{root}/raw",
        stage_root=f"{root}/stage",
        warehouse_root=f"{root}/warehouse",
        run_date=RUN_DATE,
        database=root.rsplit("/", 1)[1].replace("-", "_"),
        unit_factors=factors,
    )
    return run(spark, config)[specs.COST_AUDIT_TABLE]


QUERIES: dict[str, Query] = {
    "price_join_nullsafe": price_join_nullsafe,
    "price_join_narrowed": price_join_narrowed,
    "price_join_shuffled": price_join_shuffled,
    "unit_factor_join": unit_factor_join,
    "billing_with_gross_cost": _gross,
    "matched_billing": matched_billing,
    "product_month_base": _base,
    "top5_usage_ranks": top5_usage_ranks,
    "top5_products": top5_products,
    "discounted_cost": discounted_cost,
    "cost_audit": cost_audit,
    "cost_audit_preaggregated": cost_audit_preaggregated,
    "service_month_base": service_month_base,
    "service_growth": service_growth,
    "dq_billing": dq_billing,
    "dq_prices": dq_prices,
    "dq_union": dq_union,
    "dq_billing_union": dq_billing_union,
    "stage_billing_csv": stage_billing_csv,
    "stage_prices_json": stage_prices_json,
    "staged_parquet_roundtrip": staged_parquet_roundtrip,
    "day_partitioned_load": day_partitioned_load,
    "replace_table": replace_table,
    "required_files_missing": required_files_missing,
    "pipeline_run": pipeline_run,
}
