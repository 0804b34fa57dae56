"""SQL of every registered query, over the test tables.

Written separately from the DataFrame code. Divisions go through nullif, since a zero divisor gives
infinity here, and literals are doubles (0.56e0), as in the results to match.
"""

from __future__ import annotations

_INPUTS = """
WITH billing AS (
  SELECT
    CASE WHEN l_orderkey % 997 <> 0 THEN cast(o_custkey AS varchar) END AS account_id,
    CASE WHEN p_size % 5 <> 0 THEN p_type END AS instance_type,
    CASE WHEN l_orderkey % 991 <> 0 THEN
      l_quantity * floor(p_retailprice) * (6 + cast(round(l_discount * 100) AS int)) / 16.0e0
        / (CASE l_linenumber % 5 WHEN 0 THEN 4.0e0 WHEN 1 THEN 8.0e0 ELSE 64.0e0 END)
    END AS net_cost,
    l_returnflag AS pricing_term,
    concat('U', cast(l_linenumber % 5 AS varchar)) AS pricing_unit,
    CASE WHEN l_orderkey % 971 <> 0 THEN p_brand END AS product_code,
    p_name AS product_name,
    o_orderstatus AS region,
    nullif(o_orderpriority, '4-NOT SPECIFIED') AS service_code,
    CASE WHEN l_orderkey % 983 <> 0 THEN cast(l_shipdate AS date) END AS start_date,
    l_linestatus AS tag_application,
    CASE WHEN l_orderkey % 977 = 0 THEN -l_quantity ELSE l_quantity END AS usage_amount,
    CASE WHEN l_orderkey % 967 <> 0 THEN l_linestatus END AS usage_type
  FROM lineitem, orders, part
  WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey
),
prices AS (
  SELECT p_brand AS product_code, p_name AS product_name, term AS pricing_term, unit AS pricing_unit,
    CASE WHEN p_size % 5 <> 0 THEN p_type END AS instance_type,
    cast(max(floor(p_retailprice)) AS double) AS precio_lista
  FROM part,
    (SELECT DISTINCT l_returnflag AS term FROM lineitem) terms,
    (SELECT DISTINCT concat('U', cast(l_linenumber % 5 AS varchar)) AS unit FROM lineitem) units
  WHERE p_brand <> 'Brand#7'
  GROUP BY 1, 2, 3, 4, 5
),
unit_factor(pricing_unit, unidad_factor) AS (
  VALUES ('U0', 4.0e0), ('U1', 8.0e0), ('U2', 64.0e0), ('U3', 0.0e0)
)"""

_GROSS = """,
priced AS (
  SELECT u.*, l.precio_lista
  FROM billing u LEFT JOIN prices l
    ON (u.product_code, u.product_name, u.pricing_term, u.pricing_unit)
       = (l.product_code, l.product_name, l.pricing_term, l.pricing_unit)
    AND u.instance_type IS NOT DISTINCT FROM l.instance_type
    AND u.product_code IS NOT NULL AND u.product_name IS NOT NULL
    AND u.pricing_term IS NOT NULL AND u.pricing_unit IS NOT NULL
),
gross AS (
  SELECT start_date, product_code, product_name, pricing_term, priced.pricing_unit, instance_type, usage_type,
    usage_amount, net_cost, precio_lista, unidad_factor,
    usage_amount / nullif(unidad_factor, 0) * precio_lista AS gross_cost,
    (precio_lista IS NOT NULL AND unidad_factor IS NOT NULL) AS has_price_match
  FROM priced LEFT JOIN unit_factor ON unit_factor.pricing_unit = priced.pricing_unit
)"""

_AUDIT = """,
totals AS (
  SELECT cast(date_trunc('month', start_date) AS date) AS month, product_code,
    sum(usage_amount) AS usage_amount, sum(net_cost) AS net_cost, sum(gross_cost) AS gross_cost
  FROM gross WHERE has_price_match GROUP BY 1, 2
),
standing AS (
  SELECT m.month, m.product_code, m.usage_amount,
    1 + (SELECT count(*) FROM totals o
         WHERE o.month IS NOT DISTINCT FROM m.month
           AND (o.usage_amount > m.usage_amount OR (m.usage_amount IS NULL AND o.usage_amount IS NOT NULL))
        ) AS usage_rank
  FROM totals m
),
leaders AS (SELECT month, product_code FROM standing WHERE usage_rank <= 5),
costed AS (
  SELECT t.*, flag AS is_top5,
    gross_cost * (CASE WHEN flag THEN CASE WHEN gross_cost > 50000 THEN 0.56e0 ELSE 0.7e0 END
                       WHEN gross_cost > 50000 THEN 0.8e0 ELSE 1.0e0 END) AS expected_cost
  FROM (SELECT totals.*, (month, product_code) IN (
          SELECT (month, product_code) FROM leaders WHERE month IS NOT NULL AND product_code IS NOT NULL
        ) AND month IS NOT NULL AND product_code IS NOT NULL AS flag FROM totals) t
),
audit AS (
  SELECT costed.* EXCLUDE (flag), net_cost - expected_cost AS diff_abs,
    (net_cost - expected_cost) / nullif(expected_cost, 0) AS diff_pct,
    abs((net_cost - expected_cost) / nullif(expected_cost, 0)) > 0.1e0 AS needs_review
  FROM costed
)"""

_GROWTH = """,
monthly AS (
  SELECT cast(date_trunc('month', start_date) AS date) AS month, service_code, sum(net_cost) AS net_cost
  FROM billing WHERE service_code IS NOT NULL GROUP BY ALL
),
growth AS (
  SELECT monthly.*, lag(net_cost) OVER earlier AS prev_net_cost,
    net_cost - lag(net_cost) OVER earlier AS growth_abs,
    (net_cost - lag(net_cost) OVER earlier) / nullif(lag(net_cost) OVER earlier, 0) * 100 AS growth_pct
  FROM monthly WINDOW earlier AS (PARTITION BY service_code ORDER BY month NULLS FIRST)
)"""

_BILLING_CONDITIONS = (
    "account_id IS NULL", "usage_amount < 0", "product_code IS NULL", "service_code IS NULL",
    "usage_type IS NULL", "instance_type IS NULL", "net_cost IS NULL", "start_date IS NULL",
)
_PRICE_CONDITIONS = (
    "product_code IS NULL", "precio_lista IS NULL", "precio_lista < 0", "pricing_unit IS NULL",
)


def _counts(table: str, conditions: tuple[str, ...]) -> str:
    return _INPUTS + " UNION ALL ".join(
        f"\nSELECT '{condition}' AS check_name, (SELECT count(*) FROM {table} WHERE {condition}) AS num_issues"
        for condition in conditions
    )


_ALL_BILLING = _INPUTS + "\nSELECT * FROM billing"
_ALL_PRICES = _INPUTS + "\nSELECT * FROM prices"
_ALL_AUDIT = _INPUTS + _GROSS + _AUDIT + "\nSELECT * FROM audit"
_ALL_GROWTH = _INPUTS + _GROWTH + "\nSELECT * FROM growth"
_BILLING_DQ = _counts("billing", _BILLING_CONDITIONS)
_PRICE_DQ = _counts("prices", _PRICE_CONDITIONS)

_ALL_DQ = (
    f"SELECT 'billing' AS source, * FROM ({_BILLING_DQ}) b UNION ALL SELECT 'prices' AS source, * FROM ({_PRICE_DQ}) p"
)

# Two files are required per year; the billing file of the last year is the one that has landed.
_MISSING = (
    _INPUTS
    + """,
years AS (SELECT DISTINCT year(start_date) AS y FROM billing WHERE start_date IS NOT NULL)
SELECT 'lista_precios/' || cast(y AS varchar) || '/12/31/lista_precios.json' AS path FROM years
UNION ALL
SELECT 'aws_data_desafio/' || cast(y AS varchar) || '/12/31/aws_data_desafio.csv' FROM years
WHERE y < (SELECT max(y) FROM years)"""
)

ORACLE = {
    "price_join_nullsafe": _INPUTS + _GROSS + "\nSELECT * FROM priced",
    "price_join_narrowed": _INPUTS + _GROSS + "\nSELECT * FROM priced",
    "price_join_shuffled": _INPUTS + _GROSS + "\nSELECT * FROM priced",
    "unit_factor_join": _INPUTS
    + "\nSELECT billing.*, unidad_factor FROM billing LEFT JOIN unit_factor USING (pricing_unit)",
    "billing_with_gross_cost": _INPUTS + _GROSS + "\nSELECT * FROM gross",
    "matched_billing": _INPUTS + _GROSS + "\nSELECT * FROM gross WHERE has_price_match",
    "product_month_base": _INPUTS + _GROSS + _AUDIT + "\nSELECT * FROM totals",
    "top5_usage_ranks": _INPUTS + _GROSS + _AUDIT + "\nSELECT * FROM standing WHERE usage_rank <= 5",
    "top5_products": _INPUTS + _GROSS + _AUDIT + "\nSELECT * FROM leaders",
    "discounted_cost": _INPUTS + _GROSS + _AUDIT + "\nSELECT * EXCLUDE (flag) FROM costed",
    "cost_audit": _ALL_AUDIT,
    "cost_audit_preaggregated": _ALL_AUDIT,
    "service_month_base": _INPUTS + _GROWTH + "\nSELECT * FROM monthly",
    "service_growth": _ALL_GROWTH,
    "dq_billing": _BILLING_DQ,
    "dq_prices": _PRICE_DQ,
    "dq_union": _ALL_DQ,
    "dq_billing_union": _BILLING_DQ,
    "stage_billing_csv": _ALL_BILLING,
    "stage_prices_json": _ALL_PRICES,
    "staged_parquet_roundtrip": _ALL_PRICES,
    "day_partitioned_load": _ALL_BILLING,
    "replace_table": _ALL_GROWTH,
    "required_files_missing": _MISSING,
    "pipeline_run": _ALL_AUDIT,
}
