"""Billing, price and unit-factor inputs derived from the test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.sinks import input_bytes

#: Bytes of line items, as stored, that a partition of a join takes; they are some twenty times as many in memory.
JOIN_BYTES = 4 * 1024 * 1024

FACTORS = (("U0", 4.0), ("U1", 8.0), ("U2", 64.0), ("U3", 0.0))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _null_every(n: int, key: str, value: Column) -> Column:
    return F.when(F.col(key) % n != 0, value)


def _spread(side: DataFrame, key: str, partitions: int) -> DataFrame:
    """A side of a join in so many partitions, which the other side then follows. Where the session's number is as large,
    it is left to adaptive execution."""
    enough = partitions <= int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return side if enough else side.repartition(partitions, key)


def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of partitions of the joins follows the stored line items, so that of a task's rows does not."""
    lines = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders")
    parts = _table(spark, sf_dir, "part")
    partitions = -(-input_bytes(lines) // JOIN_BYTES)
    orders, parts = _spread(orders, "o_orderkey", partitions), _spread(parts, "p_partkey", partitions)
    rows = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).join(
        parts, lines["l_partkey"] == parts["p_partkey"]
    )
    unit = F.col("l_linenumber") % 5
    quantity = F.col("l_quantity")
    percent = F.round(F.col("l_discount") * 100).cast("int")
    divisor = F.when(unit == 0, F.lit(4.0)).when(unit == 1, F.lit(8.0)).otherwise(F.lit(64.0))
    net = quantity * F.floor("p_retailprice") * (percent + 6) / F.lit(16.0) / divisor
    return rows.select(
        _null_every(997, "l_orderkey", F.col("o_custkey").cast("string")).alias("account_id"),
        _null_every(5, "p_size", F.col("p_type")).alias("instance_type"),
        _null_every(991, "l_orderkey", net).alias("net_cost"),
        F.col("l_returnflag").alias("pricing_term"),
        F.concat(F.lit("U"), unit.cast("string")).alias("pricing_unit"),
        _null_every(971, "l_orderkey", F.col("p_brand")).alias("product_code"),
        F.col("p_name").alias("product_name"),
        F.col("o_orderstatus").alias("region"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("service_code"),
        _null_every(983, "l_orderkey", F.col("l_shipdate").cast("date")).alias("start_date"),
        F.col("l_linestatus").alias("tag_application"),
        F.when(F.col("l_orderkey") % 977 == 0, -quantity).otherwise(quantity).alias("usage_amount"),
        _null_every(967, "l_orderkey", F.col("l_linestatus")).alias("usage_type"),
    )


def line_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pricing terms and units as they occur together, a few rows. One aggregate with sets of both would put every line item
    into them, since Spark drops a `distinct` below it."""
    unit = F.concat(F.lit("U"), (F.col("l_linenumber") % 5).cast("string"))
    return _table(spark, sf_dir, "lineitem").select("l_returnflag", unit.alias("unit")).distinct()


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price per part group, pricing term and unit in use. Grouping comes first: it shrinks what is multiplied.

    Terms and units are what all line items have, a few values each, so they are gathered into arrays.
    """
    groups = (
        _table(spark, sf_dir, "part")
        .where(F.col("p_brand") != "Brand#7")
        .groupBy(
            F.col("p_brand").alias("product_code"),
            F.col("p_name").alias("product_name"),
            _null_every(5, "p_size", F.col("p_type")).alias("instance_type"),
        )
        .agg(F.max(F.floor("p_retailprice")).cast("double").alias("precio_lista"))
    )
    kinds = line_kinds(spark, sf_dir).collect()
    terms, units = (sorted({kind[i] for kind in kinds} - {None}) for i in (0, 1))
    with_term = groups.withColumn("pricing_term", F.explode(F.array(*map(F.lit, terms))))
    with_unit = with_term.withColumn("pricing_unit", F.explode(F.array(*map(F.lit, units))))
    return with_unit.select(
        "product_code", "product_name", "pricing_term", "pricing_unit", "instance_type", "precio_lista"
    )


def unit_factors(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{unit}', {factor}D)" for unit, factor in FACTORS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS factors(pricing_unit, unidad_factor)")
