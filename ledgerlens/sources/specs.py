"""What is read, and which table each input becomes."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

from ledgerlens import schemas


@dataclass(frozen=True)
class SourceSpec:
    """One raw input.

    `declared` types these columns; other columns are staged under an inferred type. With `keep_extra` the table takes
    them too, without it only the declared ones.
    """

    file_name: str
    table: str
    declared: T.StructType
    keep_extra: bool = False
    partition_by: str | None = None

    @property
    def base(self) -> str:
        """File name without its last extension."""
        return re.sub(r"\.[^.]+$", "", self.file_name)


# The file and table names that existing landing folders and queries use.
BILLING_FILE = "aws_data_desafio.csv"
PRICE_FILE = "lista_precios.json"
BILLING_TABLE = "stage_aws_billing"
PRICE_TABLE = "stage_aws_prices"
UNIT_FACTOR_TABLE = "stage_aws_unit_factor"
GROSS_COST_TABLE = "aws_billing_with_gross_cost"
COST_AUDIT_TABLE = "aws_agg_cost_by_product_month"
SERVICE_GROWTH_TABLE = "aws_agg_service_cost_by_month"
BILLING_DQ_TABLE = "dq_stage_aws_billing"
PRICE_DQ_TABLE = "dq_stage_aws_prices"

BILLING_SOURCE = SourceSpec(BILLING_FILE, BILLING_TABLE, schemas.BILLING, partition_by="start_date")
PRICE_SOURCE = SourceSpec(PRICE_FILE, PRICE_TABLE, schemas.PRICES, keep_extra=True)
SOURCES = (BILLING_SOURCE, PRICE_SOURCE)
