"""The full run: completeness check, staging, data-quality reports, result tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ledgerlens import schemas
from ledgerlens.functions.costs import DiscountPolicy
from ledgerlens.operators.audit import cost_audit
from ledgerlens.operators.growth import service_growth
from ledgerlens.operators.matching import billing_with_gross_cost
from ledgerlens.operators.quality import dq_billing, dq_prices
from ledgerlens.operators.sizing import BROADCAST_LIMIT
from ledgerlens.plans.staging import stage_all
from ledgerlens.sources import specs
from ledgerlens.sources.landing import require_complete
from ledgerlens.sources.sinks import create_database, read_table, replace_table, stored


@dataclass(frozen=True)
class PipelineConfig:
    """Everything a run depends on. `unit_factors` defaults to the unit-factor table of the database."""

    raw_root: str
    stage_root: str
    warehouse_root: str
    run_date: date
    database: str = "billing_staging"
    unit_factors: DataFrame | None = None
    top_k: int = 5
    discounts: DiscountPolicy = field(default_factory=DiscountPolicy)
    broadcast_limit: int = BROADCAST_LIMIT

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    @property
    def location(self) -> str:
        return f"{self.warehouse_root.rstrip('/')}/{self.database}"


def open_database(spark: SparkSession, config: PipelineConfig) -> None:
    """The database with all tables that earlier runs, in other processes too, left under the warehouse root."""
    create_database(spark, config.database, config.location)


def build_dq_tables(spark: SparkSession, config: PipelineConfig) -> None:
    open_database(spark, config)
    reports = {
        specs.BILLING_DQ_TABLE: dq_billing(read_table(spark, config.table(specs.BILLING_TABLE))),
        specs.PRICE_DQ_TABLE: dq_prices(read_table(spark, config.table(specs.PRICE_TABLE))),
    }
    for name, report in reports.items():
        replace_table(report, config.table(name))


def build_result_tables(spark: SparkSession, config: PipelineConfig) -> None:
    """Gross-cost table first; the audit reads it back, so the join runs once."""
    open_database(spark, config)
    billing = read_table(spark, config.table(specs.BILLING_TABLE))
    prices = read_table(spark, config.table(specs.PRICE_TABLE))
    factors = config.unit_factors
    if factors is None:
        factors = read_table(spark, config.table(specs.UNIT_FACTOR_TABLE))
    gross_table = config.table(specs.GROSS_COST_TABLE)
    replace_table(billing_with_gross_cost(billing, prices, factors, config.broadcast_limit), gross_table)
    audit = cost_audit(read_table(spark, gross_table), config.top_k, config.discounts)
    replace_table(audit, config.table(specs.COST_AUDIT_TABLE))
    replace_table(service_growth(billing), config.table(specs.SERVICE_GROWTH_TABLE))


_LAYOUTS = {
    specs.BILLING_TABLE: schemas.BILLING,
    specs.PRICE_TABLE: schemas.PRICES,
    specs.BILLING_DQ_TABLE: schemas.DQ_REPORT,
    specs.PRICE_DQ_TABLE: schemas.DQ_REPORT,
    specs.GROSS_COST_TABLE: schemas.GROSS_COST,
    specs.COST_AUDIT_TABLE: schemas.COST_AUDIT,
    specs.SERVICE_GROWTH_TABLE: schemas.SERVICE_GROWTH,
}


def check_inputs(spark: SparkSession, config: PipelineConfig) -> None:
    """Raises while nothing is written yet: for raw inputs that have not landed, and for absent unit factors."""
    require_complete(spark, config.raw_root, config.run_date, specs.SOURCES)
    table = config.table(specs.UNIT_FACTOR_TABLE)
    known = config.unit_factors is not None or stored(spark, config.location, specs.UNIT_FACTOR_TABLE)
    if not known and not spark.catalog.tableExists(table):
        raise LookupError(f"No unit factors: neither given nor in table {table}")


def stage_inputs(spark: SparkSession, config: PipelineConfig) -> None:
    open_database(spark, config)
    stage_all(spark, config.raw_root, config.stage_root, config.database, config.run_date)


STEPS: dict[str, Callable[[SparkSession, PipelineConfig], None]] = {
    "check": check_inputs,
    "stage": stage_inputs,
    "quality": build_dq_tables,
    "results": build_result_tables,
}


def run(spark: SparkSession, config: PipelineConfig, steps: Iterable[str] = tuple(STEPS)) -> dict[str, DataFrame]:
    """Runs the steps, in the order of STEPS however they are given, and returns the tables that exist afterwards."""
    wanted = set(steps)
    unknown = sorted(wanted - STEPS.keys())
    if unknown:
        raise ValueError(f"Unknown steps: {', '.join(unknown)}")
    for step, action in STEPS.items():
        if step in wanted:
            action(spark, config)
    return {
        name: read_table(spark, config.table(name), layout)
        for name, layout in _LAYOUTS.items()
        if spark.catalog.tableExists(config.table(name))
    }
