"""The full run on landed files, every result table checked against SQL."""

import datetime as dt
import os
import subprocess
import sys
from pathlib import Path

import pytest
from compare import spark_rows, sql_rows

import __spark_entry__ as contract
from ledgerlens.plans.pipeline import PipelineConfig, run
from ledgerlens.sources import specs
from ledgerlens.sources.sinks import create_database, replace_table
from ledgerlens.testkit import projection
from ledgerlens.testkit.landing import land_billing, land_prices

SF_DIR = "/root/testdata/sf0.001"
RUN_DATE = dt.date(2024, 1, 5)


def config(tmp_path, **options):
    return PipelineConfig(
        raw_root=f"{tmp_path}/raw", stage_root=f"{tmp_path}/stage", warehouse_root=f"{tmp_path}/warehouse",
        run_date=RUN_DATE, database="run_" + tmp_path.name.replace("-", "_"), **options,
    )


def test_every_table(spark, tmp_path):
    settings = config(tmp_path)
    land_billing(projection.billing(spark, SF_DIR), settings.raw_root, RUN_DATE)
    land_prices(projection.prices(spark, SF_DIR), settings.raw_root, RUN_DATE)
    create_database(spark, settings.database, f"{tmp_path}/warehouse/{settings.database}")
    replace_table(projection.unit_factors(spark), settings.table(specs.UNIT_FACTOR_TABLE))
    tables = run(spark, settings)
    expected = {
        specs.BILLING_TABLE: "stage_billing_csv",
        specs.PRICE_TABLE: "stage_prices_json",
        specs.BILLING_DQ_TABLE: "dq_billing",
        specs.PRICE_DQ_TABLE: "dq_prices",
        specs.GROSS_COST_TABLE: "billing_with_gross_cost",
        specs.COST_AUDIT_TABLE: "cost_audit",
        specs.SERVICE_GROWTH_TABLE: "service_growth",
    }
    assert tables.keys() == expected.keys()
    for name, query in expected.items():
        assert spark_rows(tables[name]) == sql_rows(contract.oracle_sql()[query], SF_DIR), name
    days = spark.sql(f"SHOW PARTITIONS {settings.table(specs.BILLING_TABLE)}").count()
    assert days == tables[specs.BILLING_TABLE].select("start_date").distinct().count()


def test_absent_unit_factors_are_found_before_anything_is_written(spark, tmp_path):
    settings = config(tmp_path)
    land_billing(projection.billing(spark, SF_DIR).limit(10), settings.raw_root, RUN_DATE)
    land_prices(projection.prices(spark, SF_DIR).limit(10), settings.raw_root, RUN_DATE)
    with pytest.raises(LookupError, match="unit factors"):
        run(spark, settings)
    assert not spark.catalog.databaseExists(settings.database)


def test_unknown_steps_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="Unknown steps: nothing"):
        run(spark, config(tmp_path), ["stage", "nothing"])


def test_incomplete_landing_writes_nothing(spark, tmp_path):
    settings = config(tmp_path)
    land_prices(projection.prices(spark, SF_DIR), settings.raw_root, RUN_DATE)
    with pytest.raises(FileNotFoundError):
        run(spark, settings)
    assert not spark.catalog.databaseExists(settings.database)


def test_first_failure_stops_staging(spark, tmp_path):
    settings = config(tmp_path)
    billing = projection.billing(spark, SF_DIR).selectExpr("* EXCEPT (net_cost)", "'junk' AS net_cost")
    land_billing(billing, settings.raw_root, RUN_DATE)
    land_prices(projection.prices(spark, SF_DIR), settings.raw_root, RUN_DATE)
    with pytest.raises(Exception, match="net_cost is not a number"):
        run(spark, settings, ["stage", "results"])
    assert not spark.catalog.tableExists(settings.table(specs.PRICE_TABLE))
    assert not spark.catalog.tableExists(settings.table(specs.COST_AUDIT_TABLE))


def test_command_line_in_processes_of_their_own(spark, tmp_path):
    """Steps in two processes, in a wrong order, and then a whole run on the same roots."""
    from ledgerlens import schemas

    settings = config(tmp_path)
    few_days = projection.billing(spark, SF_DIR).where("start_date IS NULL OR day(start_date) = 1 AND month(start_date) = 6")
    land_billing(few_days, settings.raw_root, RUN_DATE)
    land_prices(projection.prices(spark, SF_DIR), settings.raw_root, RUN_DATE)
    projection.unit_factors(spark).write.parquet(f"{tmp_path}/factors")
    root = Path(__file__).resolve().parent.parent
    command = [
        sys.executable, str(root / "run_audit.py"), "--raw-root", settings.raw_root, "--stage-root", settings.stage_root,
        "--warehouse-root", settings.warehouse_root, "--run-date", "2024-01-05", "--database", settings.database,
        "--unit-factors", f"{tmp_path}/factors",
    ]
    options = "--master local[4] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=8 pyspark-shell"
    environment = os.environ | {"PYTHONPATH": str(root), "PYSPARK_SUBMIT_ARGS": options, "SPARK_LOCAL_IP": "127.0.0.1"}
    for steps in (["--steps", "stage", "check"], ["--steps", "results", "quality"], []):
        done = subprocess.run([*command, *steps], env=environment, cwd=tmp_path, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-3000:]
    create_database(spark, settings.database, settings.location)
    assert spark.table(settings.table(specs.BILLING_TABLE)).count() == few_days.count()
    audit = spark.table(settings.table(specs.COST_AUDIT_TABLE))
    assert audit.columns == schemas.COST_AUDIT.fieldNames()
    assert audit.count() > 0
    assert sorted(p.name for p in Path(f"{settings.location}/{specs.COST_AUDIT_TABLE}").iterdir()) == ["v00000001", "v00000002"]
