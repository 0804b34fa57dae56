"""Price and factor matching on literal rows, each of the three join ways."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.operators import matching, sizing

DAY = dt.date(2024, 1, 5)


def usage_row(**over):
    row = dict.fromkeys(schemas.BILLING.fieldNames())
    row |= dict(
        instance_type="m5", net_cost=1.0, pricing_term="od", pricing_unit="Hrs", product_code="ec2",
        product_name="box", start_date=DAY, usage_amount=6.0,
    )
    return tuple((row | over).values())


def price_row(**over):
    row = dict(
        product_code="ec2", product_name="box", pricing_term="od", pricing_unit="Hrs", instance_type="m5",
        precio_lista=0.5,
    )
    return tuple((row | over).values())


@pytest.fixture
def gross(spark):
    def build(usage, prices, factors=(("Hrs", 2.0),), **options):
        return matching.billing_with_gross_cost(
            spark.createDataFrame(list(usage), schemas.BILLING),
            spark.createDataFrame(list(prices), schemas.PRICES),
            spark.createDataFrame(list(factors), schemas.UNIT_FACTOR),
            **options,
        )

    return build


def test_layout(gross):
    assert [(f.name, f.dataType) for f in gross([usage_row()], [price_row()]).schema] == [
        (f.name, f.dataType) for f in schemas.GROSS_COST
    ]


def test_plain_match(gross):
    (row,) = gross([usage_row()], [price_row()]).collect()
    assert (row.gross_cost, row.has_price_match) == (1.5, True)


def test_null_instance_matches_null(gross):
    (row,) = gross([usage_row(instance_type=None)], [price_row(instance_type=None)]).collect()
    assert row.precio_lista == 0.5


def test_null_instance_does_not_match_a_value(gross):
    (row,) = gross([usage_row(instance_type=None)], [price_row(), price_row(instance_type="")]).collect()
    assert row.precio_lista is None


@pytest.mark.parametrize("key", matching.STRICT_KEYS)
def test_null_in_other_keys_never_matches(gross, key):
    (row,) = gross([usage_row(**{key: None})], [price_row(**{key: None})]).collect()
    assert (row.precio_lista, row.gross_cost, row.has_price_match) == (None, None, False)


def test_duplicate_price_key_repeats_the_row(gross):
    rows = gross([usage_row()], [price_row(), price_row(precio_lista=1.0)]).collect()
    assert sorted(row.gross_cost for row in rows) == [1.5, 3.0]


def test_zero_factor_is_a_match_without_gross_cost(gross):
    (row,) = gross([usage_row()], [price_row()], [("Hrs", 0.0)]).collect()
    assert (row.gross_cost, row.has_price_match) == (None, True)


def test_missing_factor_is_no_match(gross):
    (row,) = gross([usage_row()], [price_row()], [("GB", 1.0), (None, 1.0)]).collect()
    assert (row.unidad_factor, row.has_price_match) == (None, False)


def test_null_list_price_is_no_match(gross):
    (row,) = gross([usage_row()], [price_row(precio_lista=None)]).collect()
    assert (row.gross_cost, row.has_price_match) == (None, False)


def test_all_join_ways_agree(spark, gross):
    usage = [usage_row(product_name=f"p{i % 7}", instance_type=None if i % 3 else "m5") for i in range(60)]
    prices = [price_row(product_name=f"p{i}", instance_type=t) for i in range(40) for t in (None, "m5")]
    prices.append(price_row(product_name="p1", precio_lista=9.0))
    size = sizing.measured_bytes(spark.createDataFrame(prices, schemas.PRICES))
    results = [sorted(map(str, gross(usage, prices, broadcast_limit=n).collect())) for n in (size, size // 2, 0)]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) > 60


def test_size_counts_text_bytes(spark):
    short = sizing.measured_bytes(spark.createDataFrame([("a",)] * 10, "s string"))
    long = sizing.measured_bytes(spark.createDataFrame([("é" * 100,)] * 10, "s string"))
    assert long - short == 10 * 2 * (200 - 8)  # padded to words, as key and as value
    assert sizing.measured_bytes(spark.createDataFrame([], "s string")) == 0


@pytest.mark.parametrize(("rows", "width"), [(1, 1), (3000, 3), (3000, 203), (40_000, 24)])
def test_size_is_never_below_that_of_the_broadcast(spark, rows, width):
    """Compared with the `data size` that the exchange reports."""
    side = spark.range(rows).select(
        F.concat(F.col("id").cast("string"), F.lit("x" * width)).alias("k1"), F.lpad("id", width, "y").alias("k2"), F.rand().alias("v")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        query = side.select("k1", "k2").join(F.broadcast(side), ["k1", "k2"])._jdf.queryExecution().executedPlan()
        query.executeCollect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    found, nodes = [], [query]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "BroadcastExchange":
            found.append(node.metrics().apply("dataSize").value())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert found and 0 < max(found) <= sizing.measured_bytes(side)


def test_broadcast_only_within_the_limit(spark):
    df = spark.createDataFrame([("a", 1.0)], schemas.UNIT_FACTOR)
    size = sizing.measured_bytes(df)
    assert sizing.broadcast_within(df, size) is not None
    assert sizing.broadcast_within(df, size - 1) is None
