from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.operators import quality


def report(df):
    return [(row.check_name, row.num_issues) for row in df.collect()]


def billing(spark, *overrides):
    full = dict.fromkeys(schemas.BILLING.fieldNames(), "x") | dict(net_cost=1.0, usage_amount=1.0, start_date=None)
    return spark.createDataFrame([tuple((full | o).values()) for o in overrides], schemas.BILLING)


def test_zero_counts_stay(spark):
    empty = spark.createDataFrame([], schemas.PRICES)
    assert report(quality.dq_prices(empty)) == [
        ("product_code IS NULL", 0), ("precio_lista IS NULL", 0), ("precio_lista < 0", 0), ("pricing_unit IS NULL", 0)]


def test_null_is_not_negative(spark):
    out = dict(report(quality.dq_billing(billing(spark, dict(usage_amount=None), dict(usage_amount=-1.0)))))
    assert out["usage_amount < 0"] == 1
    assert out["start_date IS NULL"] == 2
    assert out["account_id IS NULL"] == 0


def test_negative_price(spark):
    rows = [("a", "n", "t", None, None, -0.5), ("a", "n", "t", "u", None, None)]
    out = dict(report(quality.dq_prices(spark.createDataFrame(rows, schemas.PRICES))))
    assert out == {"product_code IS NULL": 0, "precio_lista IS NULL": 1, "precio_lista < 0": 1, "pricing_unit IS NULL": 1}


def report_by_union(df, checks):
    """One filtered count per check, each a scan of its own."""
    parts = [
        df.where(check).agg(F.count("*").alias("num_issues")).select(F.lit(check).alias("check_name"), "num_issues")
        for check in checks
    ]
    return reduce(DataFrame.unionByName, parts)


def test_union_scans_each_table_once(spark, tmp_path):
    billing(spark, dict(account_id=None), dict()).write.parquet(str(tmp_path / "billing"))
    spark.createDataFrame([], schemas.PRICES).write.parquet(str(tmp_path / "prices"))
    bills, prices = (spark.read.parquet(str(tmp_path / name)) for name in ("billing", "prices"))
    both = quality.dq_union(bills, prices)
    assert both._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    wanted = [("billing", *row) for row in report(quality.dq_billing(bills))]
    wanted += [("prices", *row) for row in report(quality.dq_prices(prices))]
    assert sorted(map(tuple, both.collect())) == sorted(wanted)
    part = both.where("source = 'billing'")
    assert part._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_single_scan_equals_union(spark):
    df = billing(spark, dict(account_id=None), dict(usage_type=None, net_cost=None), dict())
    once = quality.dq_billing(df)
    assert report(once) == report(report_by_union(df, quality.BILLING_CHECKS))
    assert [(f.name, f.dataType) for f in once.schema] == [(f.name, f.dataType) for f in schemas.DQ_REPORT]
