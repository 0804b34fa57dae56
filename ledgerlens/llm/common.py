"""Helpers shared by the operators: shared-folder tables, folds, byte texts, runs of sorted rows."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.sizing import delete_on_exit, reliable_dir

#: The word pattern of all operators: whatever lies between ASCII blanks. `bytes.split()` cuts at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows that go to Python in one batch, unless the session says otherwise. Spark's own number, 10,000, is tens of MB of
#: texts, which JVM and Python hold several times over.
BATCH_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session, whose own setting stays if it has one."""
    if spark.conf.get(_BATCH_ROWS, None) is None:
        spark.conf.set(_BATCH_ROWS, str(BATCH_ROWS))


@contextmanager
def arrow_batches(spark: SparkSession, most: int | None) -> Iterator[None]:
    """Bounds the bytes of the session's Arrow batches for a while; None leaves them."""
    before = spark.conf.get(_BATCH_BYTES, None)
    if most:
        spark.conf.set(_BATCH_BYTES, str(most))
    try:
        yield
    finally:
        if most:
            spark.conf.unset(_BATCH_BYTES) if before is None else spark.conf.set(_BATCH_BYTES, before)


class Workspace:
    """Parquet tables of one run in the shared folder; what they hold outlives any executor.

    They go when the driver ends, unless `keep` says that they are results to be read later.
    """

    def __init__(self, spark: SparkSession, name: str, keep: bool = False):
        self.spark = spark
        self.root = f"{reliable_dir(spark)}/{name}-{uuid.uuid4().hex}"
        if not keep:
            delete_on_exit(spark, self.root)

    def table(self, name: str, df: DataFrame, batch_bytes: int | None = None, **options: str) -> DataFrame:
        """Writes `df` and reads it back, which cuts the lineage.

        `batch_bytes` bounds the Arrow batches that go to Python meanwhile, but for their last row.
        """
        path = f"{self.root}/{name}"
        with arrow_batches(self.spark, batch_bytes):
            df.write.mode("overwrite").option("compression", "zstd").options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Removes a table, or all of them, once nothing reads it any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished queries now: its cleaner acts once the driver's JVM has collected
    them, which may otherwise be long after the disk is full."""
    gc.collect()
    spark._jvm.System.gc()


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; an id that is NULL counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def seeded_order(seed: int, *parts: Column) -> Column:
    """A 60-bit number that depends on the seed and the parts only, the same in every engine that has MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(part.cast("string"), F.lit("")) for part in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def documents(docs: DataFrame) -> DataFrame:
    """doc_id as long and text as string, whatever else the table has."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; NULL is empty."""
    return [b"" if text is None else text for text in column.cast(pa.binary()).to_pylist()]


def record_batch(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a flat DDL layout, for batches made in tasks."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
        "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split(" ", 1) for part in ddl.split(", "))])


def numpy_columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Columns without NULLs as arrays; binary and nested ones as arrays of objects."""
    columns = {}
    for name, column in zip(batch.schema.names, batch.columns, strict=True):
        if pa.types.is_primitive(column.type) and not pa.types.is_boolean(column.type):
            columns[name] = column.to_numpy(zero_copy_only=False)
        elif pa.types.is_boolean(column.type):
            columns[name] = np.asarray(column.to_pylist(), dtype=bool)
        else:
            values = np.empty(len(column), dtype=object)
            values[:] = column.to_pylist()
            columns[name] = values
    return columns


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Groups of rows with equal keys, from batches that are sorted by the keys.

    Only one group is held beyond the current batch, so memory follows the largest group.
    """
    held: list[dict[str, np.ndarray]] = []

    def joined() -> dict[str, np.ndarray]:
        return {name: np.concatenate([part[name] for part in held]) for name in held[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = numpy_columns(batch)
        changed = np.zeros(batch.num_rows, dtype=bool)
        for key in keys:
            changed[1:] |= columns[key][1:] != columns[key][:-1]
        starts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for begin, end in zip(starts[:-1], starts[1:], strict=True):
            part = {name: values[begin:end] for name, values in columns.items()}
            if held and any(held[0][key][0] != part[key][0] for key in keys):
                yield joined()
                held = []
            held.append(part)
    if held:
        yield joined()


def with_partners(entries: DataFrame, key: str) -> DataFrame:
    """Entries of buckets that have several, one of them `filed`; adds `rows`, the size of the bucket.

    Buckets are counted first, which combines inside tasks, and the counts are written and joined back. So both sides of
    the join come straight from their shuffles, where adaptive execution can split the entries of a large bucket over
    tasks, as a window over buckets could not.
    """
    sizes = entries.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.count_if("filed").alias("files"))
    several = Workspace(entries.sparkSession, "buckets").table("sizes", sizes.where("rows > 1 AND files > 0").drop("files"))
    return entries.join(several, key)


def with_tiles(members: DataFrame, key: str, identity: str, rows: Column, tile_rows: int) -> DataFrame:
    """Splits large groups: adds tile, lo and hi so that each pair of members meets in exactly one (key, lo, hi).

    A group of `rows` members is cut into b tiles of about `tile_rows`; a member joins the b groups that pair its tile
    with each tile. Two members of the same tile meet in (t, t), two of different ones in (lo, hi) with lo < hi, where
    only pairs across the tiles count.
    """
    tiles = F.greatest(F.lit(1), F.ceil(rows / tile_rows)).cast("int")
    placed = members.withColumn("_tiles", tiles).withColumn(
        "tile", F.pmod(F.xxhash64(F.col(identity)), F.col("_tiles")).cast("int")
    )
    met = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    return met.withColumns(
        {"lo": F.least("tile", "_other").cast("int"), "hi": F.greatest("tile", "_other").cast("int")}
    ).drop("_tiles", "_other")


def empty_like(spark: SparkSession, layout: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], layout)
