"""Command line of the full run, for spark-submit."""

from __future__ import annotations

import argparse
from datetime import date

from ledgerlens.plans.pipeline import STEPS, PipelineConfig, run
from ledgerlens.session import build_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw-root", required=True)
    parser.add_argument("--stage-root", required=True)
    parser.add_argument("--warehouse-root", required=True)
    parser.add_argument("--run-date", required=True, type=date.fromisoformat)
    parser.add_argument("--database", default=PipelineConfig.database)
    parser.add_argument("--unit-factors", help="Parquet path; the unit-factor table of the database if not given")
    parser.add_argument("--steps", nargs="+", choices=list(STEPS), default=list(STEPS))
    options = parser.parse_args(arguments)
    spark = build_session("ledgerlens-audit")
    config = PipelineConfig(
        raw_root=options.raw_root,
        stage_root=options.stage_root,
        warehouse_root=options.warehouse_root,
        run_date=options.run_date,
        database=options.database,
        unit_factors=spark.read.parquet(options.unit_factors) if options.unit_factors else None,
    )
    run(spark, config, options.steps)


if __name__ == "__main__":
    main()
