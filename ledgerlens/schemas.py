"""Column layouts of the staged inputs and of the result tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _layout(columns: str) -> T.StructType:
    kinds = {"string": T.StringType(), "double": T.DoubleType(), "date": T.DateType(), "boolean": T.BooleanType(), "bigint": T.LongType()}
    pairs = (part.split() for part in columns.split(","))
    return T.StructType([T.StructField(name, kinds[kind], True) for name, kind in pairs])


# The names and types of all columns.
BILLING = _layout(
    "account_id string, instance_type string, net_cost double, pricing_term string, pricing_unit string, "
    "product_code string, product_name string, region string, service_code string, start_date date, "
    "tag_application string, usage_amount double, usage_type string"
)

# A price list may carry more columns than these; the extra ones are kept with an inferred type.
PRICES = _layout(
    "product_code string, product_name string, pricing_term string, pricing_unit string, instance_type string, "
    "precio_lista double"
)

UNIT_FACTOR = _layout("pricing_unit string, unidad_factor double")

GROSS_COST = _layout(
    "start_date date, product_code string, product_name string, pricing_term string, pricing_unit string, "
    "instance_type string, usage_type string, usage_amount double, net_cost double, precio_lista double, "
    "unidad_factor double, gross_cost double, has_price_match boolean"
)

COST_AUDIT = _layout(
    "month date, product_code string, usage_amount double, net_cost double, gross_cost double, is_top5 boolean, "
    "expected_cost double, diff_abs double, diff_pct double, needs_review boolean"
)

SERVICE_GROWTH = _layout(
    "month date, service_code string, net_cost double, prev_net_cost double, growth_abs double, growth_pct double"
)

DQ_REPORT = _layout("check_name string, num_issues bigint")
