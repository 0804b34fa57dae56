"""Physical plans: what must not appear, and how hot keys are handled at run time."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (puts the repository on the path)
from ledgerlens import schemas
from ledgerlens.operators import audit, growth, matching, quality, ranking
from ledgerlens.sources import sinks
from ledgerlens.testkit import projection

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("staged")
    inputs = {
        "billing": (projection.billing(spark, SF_DIR), schemas.BILLING),
        "prices": (projection.prices(spark, SF_DIR), schemas.PRICES),
        "factors": (projection.unit_factors(spark), schemas.UNIT_FACTOR),
    }
    for name, (df, _) in inputs.items():
        df.write.parquet(str(home / name))
    return {name: spark.read.schema(layout).parquet(str(home / name)) for name, (_, layout) in inputs.items()}


def jobs(staged):
    b, p, f = staged["billing"], staged["prices"], staged["factors"]
    gross = matching.billing_with_gross_cost(b, p, f)
    return {
        "gross": gross,
        "audit": audit.cost_audit(gross),
        "audit_early": audit.cost_audit_from_usage(b, p, f),
        "audit_shuffled": audit.cost_audit(matching.billing_with_gross_cost(b, p, f, broadcast_limit=0, factor_limit=0)),
        "growth": growth.service_growth(b),
        "dq_billing": quality.dq_billing(b),
        "dq_prices": quality.dq_prices(p),
    }


def test_no_python_and_no_nested_loops(staged):
    for name, df in jobs(staged).items():
        for node in FORBIDDEN:
            assert node not in plan(df), (name, node)


def final(df):
    """The plan as it was run, in which an exchange that is read twice shows its input once."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_each_job_reads_billing_once(staged):
    for name, df in jobs(staged).items():
        scans = len(re.findall(r"FileScan parquet .*usage_amount|FileScan parquet .*service_code", final(df)))
        assert scans == (0 if name == "dq_prices" else 1), name


def test_gross_cost_does_not_shuffle_when_prices_fit(staged):
    assert "Exchange hashpartitioning" not in plan(jobs(staged)["gross"])


def test_no_broadcast_beyond_the_limit(staged):
    usage = matching.billing_with_gross_cost(*(staged[name] for name in ("billing", "prices", "factors")), broadcast_limit=0, factor_limit=0)
    assert "BroadcastExchange" not in plan(usage)
    # The audit of it adds the thresholds, a row per month.
    text = plan(jobs(staged)["audit_shuffled"])
    assert text.count("BroadcastExchange") == 1
    assert "AS lowest" in text[text.index("BroadcastExchange") :].splitlines()[1]


def test_prices_beyond_their_limit_do_not_shuffle_on_units(staged):
    gross = plan(matching.billing_with_gross_cost(staged["billing"], staged["prices"], staged["factors"], broadcast_limit=0))
    assert "SortMergeJoin" in gross
    assert gross.count("BroadcastHashJoin") == 1
    assert "hashpartitioning(pricing_unit" not in gross


def test_scans_read_only_what_is_used(staged):
    read = re.search(r"ReadSchema: struct<(.*?)>", plan(growth.service_growth(staged["billing"]))).group(1)
    assert sorted(column.split(":")[0] for column in read.split(",")) == ["net_cost", "service_code", "start_date"]
    assert "PushedFilters: [IsNotNull(service_code)]" in plan(growth.service_growth(staged["billing"]))


def test_early_audit_sums_before_it_shuffles_or_joins(staged):
    early = plan(jobs(staged)["audit_early"])
    scan = early.index("usage_amount", early.index("FileScan parquet [instance_type"))
    below_join = early[early.index("Join"):scan]
    assert "partial_sum(usage_amount" in below_join


def test_top_products_limits_inside_tasks(staged):
    base = audit.product_month_base(jobs(staged)["gross"])
    assert "WindowGroupLimit" in plan(ranking.top_products(base))
    assert "Partial" in plan(ranking.top_products(base)).split("WindowGroupLimit")[-1].splitlines()[0]


def test_audit_shuffles_the_sums_once(staged):
    text = final(jobs(staged)["audit"])
    sums = [line for line in text.splitlines() if re.search(r"Exchange hashpartitioning\(month#\d+, product_code", line)]
    assert sorted("ReusedExchange" in line for line in sums) == [False, True]
    assert re.search(r"WindowGroupLimit .*row_number\(\), 5, Partial", text)


@pytest.fixture
def settings(spark):
    """Sets session configuration for one test."""
    before = {}

    def apply(**conf):
        for key, value in conf.items():
            key = "spark.sql." + key.replace("__", ".")
            before[key] = spark.conf.get(key)
            spark.conf.set(key, value)

    yield apply
    for key, value in before.items():
        spark.conf.set(key, value)


def hot_usage(spark, tmp_path):
    """A third of the rows share one price key, another third has no product at all."""
    n = F.col("id")
    product = F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.concat(F.lit("p"), (n % 997).cast("string")))
    columns = dict.fromkeys(schemas.BILLING.fieldNames(), F.lit("x")) | {
        "product_code": product,
        "account_id": F.sha2(n.cast("string"), 256),
        "net_cost": F.lit(1.0),
        "usage_amount": F.lit(2.0),
        "start_date": F.when(n % 3 != 0, F.date_add(F.lit("2024-01-01"), (n % 60).cast("int"))),
    }
    spark.range(0, 60000, 1, 8).select(*[c.alias(name) for name, c in columns.items()]).write.parquet(str(tmp_path / "u"))
    return spark.read.schema(schemas.BILLING).parquet(str(tmp_path / "u"))


def test_hot_keys_are_split_in_the_shuffled_join(spark, tmp_path, settings):
    # Thresholds scaled down so that a small hot key counts as skew.
    settings(
        adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="50KB",
        adaptive__coalescePartitions__minPartitionSize="1KB",
    )
    usage = hot_usage(spark, tmp_path)
    prices = usage.where("product_code IS NOT NULL").select(
        *matching.PRICE_KEYS, F.lit(3.0).alias("precio_lista")
    ).distinct()
    joined = matching.match_prices(usage, prices, broadcast_limit=0)
    assert "SortMergeJoin(skew=true)" in executed(joined)
    assert joined.count() == 60000
    assert joined.where("precio_lista = 3").count() == 40000


def test_hot_day_is_written_by_several_tasks(spark, tmp_path, settings):
    settings(adaptive__advisoryPartitionSizeInBytes="500KB")
    usage = hot_usage(spark, tmp_path)
    sinks.create_database(spark, "hot_days", str(tmp_path / "hot_days"))
    try:
        sinks.replace_table(usage, "hot_days.t", partition_by="start_date")
        folders = {folder.name: len(list(folder.glob("*.parquet"))) for folder in (tmp_path / "hot_days" / "t").glob("v*/start*")}
        assert folders.pop("start_date=__HIVE_DEFAULT_PARTITION__") > 1
        assert len(folders) == 40
        assert sum(files == 1 for files in folders.values()) >= 35  # others share a shuffle partition with the hot day
        assert spark.table("hot_days.t").count() == 60000
    finally:
        spark.sql("DROP DATABASE hot_days CASCADE")
