"""Dated landing paths and the completeness check of required inputs."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.specs import SourceSpec

# Fixed value: inputs lie at base/YYYY/MM/DD/file below their root.
DAY_FOLDERS = "%Y/%m/%d"


def raw_path(root: str, spec: SourceSpec, run_date: date) -> str:
    return "/".join((root.rstrip("/"), spec.base, run_date.strftime(DAY_FOLDERS), spec.file_name))


def stage_path(root: str, spec: SourceSpec, run_date: date) -> str:
    return "/".join((root.rstrip("/"), spec.base, run_date.strftime(DAY_FOLDERS), spec.base + ".parquet"))


def required_files(run_dates: DataFrame, specs: Iterable[SourceSpec]) -> DataFrame:
    """Expected relative paths: one per source and row of `run_dates` (column run_date)."""
    names = F.explode(F.array(*[F.lit(spec.file_name) for spec in specs]))
    return run_dates.select("run_date", names.alias("_file")).select(
        F.concat_ws(
            "/",
            F.regexp_replace("_file", r"\.[^.]+$", ""),
            F.date_format("run_date", "yyyy/MM/dd"),
            "_file",
        ).alias("path")
    )


def landed_files(spark: SparkSession, root: str, days: str = "*/*/*") -> DataFrame:
    """Relative paths found under the day folders `days` (a glob) of every source.

    An input may be one file or a folder of part files; file contents are not read. The root may itself have dated
    folders, since it is cut off before the rest is looked at.
    """
    try:
        found = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(f"{root.rstrip('/')}/*/{days}/*")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string")
    whole = spark._jvm.org.apache.hadoop.fs.Path(root)
    qualified = whole.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(whole).toUri().getPath().rstrip("/")
    # Paths come with a scheme and perhaps a host, the root may be given without.
    below = F.regexp_replace("path", r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "").substr(F.lit(len(qualified) + 2), F.length("path"))
    relative = F.regexp_extract(below, r"^([^/]+/\d{4}/\d{2}/\d{2}/[^/]+)", 1)
    return found.select(relative.alias("path")).distinct()


def missing_files(required: DataFrame, landed: DataFrame) -> DataFrame:
    return required.join(landed, "path", "left_anti")


def require_complete(spark: SparkSession, root: str, run_date: date, specs: Iterable[SourceSpec]) -> None:
    """Raises FileNotFoundError naming every required input of `run_date` that is absent."""
    required = required_files(spark.range(1).select(F.lit(run_date).alias("run_date")), specs)
    landed = landed_files(spark, root, run_date.strftime(DAY_FOLDERS))
    # At most one path per source comes back.
    missing = sorted(row.path for row in missing_files(required, landed).collect())
    if missing:
        raise FileNotFoundError(f"Inputs of {run_date} that have not landed under {root}: {', '.join(missing)}")
