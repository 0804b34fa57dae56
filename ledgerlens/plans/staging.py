"""Raw file to staged Parquet to table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.sources.landing import raw_path, stage_path
from ledgerlens.sources.readers import read_source
from ledgerlens.sources.sinks import read_table, replace_table, write_parquet
from ledgerlens.sources.specs import SOURCES, SourceSpec


def stage_source(
    spark: SparkSession, spec: SourceSpec, raw_root: str, stage_root: str, database: str, run_date: date
) -> DataFrame:
    """Stages one input of `run_date`, all its columns, and truncate-loads its table, which is returned."""
    staged = stage_path(stage_root, spec, run_date)
    write_parquet(read_source(spark, spec, raw_path(raw_root, spec, run_date)), staged)
    table = f"{database}.{spec.table}"
    rows = spark.read.parquet(staged)
    replace_table(rows if spec.keep_extra else rows.select(*spec.declared.fieldNames()), table, spec.partition_by)
    return read_table(spark, table, spec.declared)


def stage_all(
    spark: SparkSession,
    raw_root: str,
    stage_root: str,
    database: str,
    run_date: date,
    specs: Iterable[SourceSpec] = SOURCES,
) -> dict[str, DataFrame]:
    """Stages the inputs in order; the first failure stops the rest."""
    return {spec.table: stage_source(spark, spec, raw_root, stage_root, database, run_date) for spec in specs}
