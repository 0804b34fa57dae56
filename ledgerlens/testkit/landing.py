"""Writes the projected inputs the way raw inputs arrive: a CSV with a header, JSON array documents."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.sizing import delete_on_exit, reliable_dir
from ledgerlens.sources.landing import raw_path
from ledgerlens.sources.specs import BILLING_SOURCE, PRICE_SOURCE

RECORDS_PER_DOCUMENT = 20_000


def scratch(spark: SparkSession) -> str:
    """A new folder for one run, below the shared folder; it goes when the driver ends, since results may be read until then."""
    path = f"{reliable_dir(spark).rstrip('/')}/ledgerlens-{uuid.uuid4().hex}"
    delete_on_exit(spark, path)
    return path


def land_billing(billing: DataFrame, raw_root: str, run_date: date) -> None:
    """Columns in reverse order and NULL as NA, so that a reader must bind by name and know null tokens."""
    billing.select(*reversed(billing.columns)).write.csv(
        raw_path(raw_root, BILLING_SOURCE, run_date), header=True, nullValue="NA", escape='"'
    )


def land_prices(prices: DataFrame, raw_root: str, run_date: date) -> None:
    """JSON array documents, list prices as numeric strings.

    Price keys are unique, so hashing them gives documents of about the same, bounded size. Each is one
    row, hence one file.
    """
    documents = -(-prices.count() // RECORDS_PER_DOCUMENT)
    record = F.struct(*[F.col(name).cast("string").alias(name) for name in prices.columns])
    (
        prices.groupBy(F.pmod(F.xxhash64(*prices.columns), F.lit(max(documents, 1))).alias("document"))
        .agg(F.to_json(F.collect_list(record), {"ignoreNullFields": "false"}).alias("value"))
        .select("value")
        .write.option("maxRecordsPerFile", 1)
        .text(raw_path(raw_root, PRICE_SOURCE, run_date))
    )
