"""Times the headline queries and prints one JSON line.

The inputs are projected from the test tables and written as Parquet once, as the stage tables are in a
real run; each query then reads those. `end_to_end_*` reads the test tables directly.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402

from ledgerlens import schemas  # noqa: E402
from ledgerlens.operators import audit, growth, matching, quality  # noqa: E402
from ledgerlens.plans.pipeline import PipelineConfig, run  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402
from ledgerlens.sources.landing import raw_path  # noqa: E402
from ledgerlens.sources.readers import read_source  # noqa: E402
from ledgerlens.sources.sinks import create_database, replace_table  # noqa: E402
from ledgerlens.sources.specs import BILLING_SOURCE, PRICE_SOURCE, SourceSpec  # noqa: E402
from ledgerlens.testkit import projection, queries  # noqa: E402
from ledgerlens.testkit.landing import land_billing, land_prices  # noqa: E402

WARM_UPS = 2
RUNS = 3


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed_once(action) -> float:
    """For the long writes: no warm-up, one run."""
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def timed(build) -> float:
    for _ in range(WARM_UPS):
        drain(build())
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        drain(build())
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="ledgerlens-bench-")
    spark = build_session(
        "ledgerlens-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    layouts = {
        "billing": schemas.BILLING,
        "prices": schemas.PRICES,
        "factors": schemas.UNIT_FACTOR,
        "gross": schemas.GROSS_COST,
    }

    def table(name: str) -> DataFrame:
        return spark.read.schema(layouts[name]).parquet(f"{work}/{name}")

    def gross() -> DataFrame:
        return matching.billing_with_gross_cost(table("billing"), table("prices"), table("factors"))

    start = time.perf_counter()
    # The test tables are single files, one task each; staged tables are split like any larger data set.
    projection.billing(spark, sf_dir).repartition(int(cpus)).write.parquet(f"{work}/billing")
    projection.prices(spark, sf_dir).write.parquet(f"{work}/prices")
    projection.unit_factors(spark).write.parquet(f"{work}/factors")
    gross().write.parquet(f"{work}/gross")
    land_billing(table("billing"), f"{work}/raw", queries.RUN_DATE)
    land_prices(table("prices"), f"{work}/raw", queries.RUN_DATE)
    setup = round(time.perf_counter() - start, 3)

    def raw(spec: SourceSpec) -> DataFrame:
        return read_source(spark, spec, raw_path(f"{work}/raw", spec, queries.RUN_DATE))

    plans = {
        "stage_billing_csv": lambda: raw(BILLING_SOURCE),
        "stage_prices_json": lambda: raw(PRICE_SOURCE),
        "billing_with_gross_cost": gross,
        "cost_audit": lambda: audit.cost_audit(table("gross")),
        "cost_audit_join_and_audit": lambda: audit.cost_audit(gross()),
        "cost_audit_preaggregated": lambda: audit.cost_audit_from_usage(
            table("billing"), table("prices"), table("factors")
        ),
        "service_growth": lambda: growth.service_growth(table("billing")),
        "dq_billing": lambda: quality.dq_billing(table("billing")),
        "dq_union": lambda: quality.dq_union(table("billing"), table("prices")),
        "dq_prices": lambda: quality.dq_prices(table("prices")),
        "end_to_end_cost_audit": lambda: queries.cost_audit(spark, sf_dir),
        "end_to_end_service_growth": lambda: queries.service_growth(spark, sf_dir),
    }
    try:
        seconds = {name: timed(build) for name, build in plans.items()}
        headline = sum(seconds.values())  # without the long writes below, to stay comparable over rounds
        create_database(spark, "bench", f"{work}/bench")
        seconds["day_partitioned_load"] = timed_once(lambda: replace_table(table("billing"), "bench.days", partition_by="start_date"))
        config = PipelineConfig(
            raw_root=f"{work}/raw", stage_root=f"{work}/stage", warehouse_root=f"{work}/warehouse", run_date=queries.RUN_DATE,
            database="bench_run", unit_factors=table("factors"),
        )
        seconds["full_run"] = timed_once(lambda: run(spark, config))
        rows = table("billing").count()
    finally:
        spark.stop()
        shutil.rmtree(work, ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(headline, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "billing_rows": rows,
                "setup_sec": setup,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
