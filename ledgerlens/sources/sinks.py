"""Parquet files and tables. Every write replaces what was there, schema included.

A table is a folder below its database's location with numbered versions. A version counts once its `_layout.json` is
written, after its data; the newest such version is the table. So the files, not the catalog, say what a table
holds: a later process finds it, a failed or killed write leaves the old version in place, and leftovers block nothing.

A writer claims its number by creating a file that must not exist yet. Of writers that overlap, none touches the folder of
another, and the one with the highest number has the last word whichever finishes first. A replaced version stays until
the next replacement, so that whoever has opened it can read on.
"""

from __future__ import annotations

import json
import re
import time
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

_LAYOUT = "_layout.json"
_VERSION = re.compile(r"v(\d{8})$")
_CLAIM = re.compile(r"v(\d{8})\.claim$")

#: Finished versions that a replacement leaves: the new one and the one before.
KEPT_VERSIONS = 2
#: Seconds after which a version that was claimed but never finished counts as left by a killed writer.
ABANDONED_AFTER = 7 * 24 * 3600
#: Shuffle partitions of a partitioned load, at most.
MOST_PARTITIONS = 16_384


def _replacing(df: DataFrame) -> DataFrameWriter:
    # Static overwrite: partitions of an earlier load must not survive.
    return df.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "static")


def write_parquet(df: DataFrame, path: str) -> None:
    _replacing(df).parquet(path)


def _path(spark: SparkSession, path: str):
    """(file system, Hadoop path)."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _entries(spark: SparkSession, path: str) -> dict[str, tuple[bool, int]]:
    """What a folder holds: name to (whether it is a folder, time of its last change in milliseconds). Nothing if it is absent."""
    system, folder = _path(spark, path)
    if not system.exists(folder):
        return {}
    return {found.getPath().getName(): (found.isDirectory(), found.getModificationTime()) for found in system.listStatus(folder)}


def _versions(spark: SparkSession, home: str) -> list[int]:
    """Numbers of all versions in the folder of a table, finished or not."""
    folders = [name for name, (is_folder, _) in _entries(spark, home).items() if is_folder]
    return sorted(int(found[1]) for found in map(_VERSION.match, folders) if found)


def _version(home: str, number: int) -> str:
    return f"{home}/v{number:08d}"


def _claim(spark: SparkSession, home: str) -> int:
    """A version number of our own. The file system lets only one writer create a file that does not exist."""
    while True:
        names = _entries(spark, home)
        taken = [int(found[1]) for name in names for found in (_VERSION.match(name) or _CLAIM.match(name),) if found]
        number = max(taken, default=0) + 1
        system, marker = _path(spark, f"{_version(home, number)}.claim")
        try:
            if system.getScheme() == "file":  # Hadoop's local file system looks first and creates then
                system.mkdirs(marker.getParent())
                if not spark._jvm.java.io.File(marker.toUri().getPath()).createNewFile():
                    continue
            else:
                system.create(marker, False).close()
            return number
        except Py4JJavaError as error:
            if not system.exists(marker) or "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise


def _discard(spark: SparkSession, home: str, number: int) -> None:
    """Removes a version, its layout first, so that what is half removed does not count."""
    for path in (f"{_version(home, number)}/{_LAYOUT}", _version(home, number), f"{_version(home, number)}.claim"):
        system, found = _path(spark, path)
        system.delete(found, True)


def _tidy(spark: SparkSession, home: str) -> None:
    """Removes finished versions but the newest `KEPT_VERSIONS`, and older ones that were abandoned.

    Whatever is newer than the current version, or unfinished and not old, may be the work of another writer.
    """
    finished = [number for number in _versions(spark, home) if _layout(spark, _version(home, number)) is not None]
    for number in finished[:-KEPT_VERSIONS]:
        _discard(spark, home, number)
    abandoned = 1000 * (time.time() - ABANDONED_AFTER)
    for name, (_, changed) in _entries(spark, home).items():
        found = _VERSION.match(name) or _CLAIM.match(name)
        if found and int(found[1]) not in finished and int(found[1]) < finished[-1] and changed < abandoned:
            _discard(spark, home, int(found[1]))


def _layout(spark: SparkSession, folder: str) -> dict | None:
    """What a finished version was written with."""
    system, file = _path(spark, f"{folder}/{_LAYOUT}")
    if not system.exists(file):
        return None
    stream = system.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _finish(spark: SparkSession, folder: str, df: DataFrame, partition_by: str | None) -> None:
    layout = {"schema": df.schema.jsonValue(), "partition_by": partition_by}
    system, file = _path(spark, f"{folder}/{_LAYOUT}")
    stream = system.create(file, True)
    stream.write(bytearray(json.dumps(layout).encode()))
    stream.close()


def _current(spark: SparkSession, home: str) -> tuple[str, dict] | None:
    """Folder and layout of the newest finished version."""
    for number in reversed(_versions(spark, home)):
        folder = _version(home, number)
        layout = _layout(spark, folder)
        if layout is not None:
            return folder, layout
    return None


def _home(spark: SparkSession, table: str) -> str:
    database, name = table.split(".")
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}"


def _location(spark: SparkSession, table: str) -> str | None:
    """The folder that the catalog has for a table, without scheme and host."""
    if not spark.catalog.tableExists(table):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").where("col_name = 'Location'").collect()
    return _path(spark, described[-1]["data_type"])[1].toUri().getPath() if described else None


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def refresh(spark: SparkSession, table: str) -> None:
    """Points the catalog's entry to the newest finished version, if it does not yet; the data are external to it.

    Another process may have replaced the table since this one opened it. Tables without versions are left as they are.
    """
    home = _home(spark, table)
    for _ in range(5):
        found = _current(spark, home)
        if found is None or _location(spark, table) == _path(spark, found[0])[1].toUri().getPath():
            return
        folder, layout = found
        schema, partition_by = T.StructType.fromJson(layout["schema"]), layout["partition_by"]
        columns = ", ".join(f"`{field.name.replace('`', '``')}` {field.dataType.simpleString()}" for field in schema)
        partitions = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(table)}")
        # Whoever shares the catalog may be quicker; the next turn looks at what came of it.
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({columns}) USING parquet{partitions} LOCATION '{_escaped(folder)}'")
        if partition_by:
            spark.sql(f"ALTER TABLE {_quoted(table)} RECOVER PARTITIONS")
    raise RuntimeError(f"The catalog's entry of {table} keeps changing")


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def create_database(spark: SparkSession, name: str, location: str) -> None:
    """The database, with every table in its location as other processes have left it last."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{_escaped(location)}'")
    for table, (is_folder, _) in _entries(spark, location).items():
        if is_folder:
            refresh(spark, f"{name}.{table}")


def stored(spark: SparkSession, location: str, table: str) -> bool:
    """Whether a database location holds a finished table of that name."""
    return _current(spark, f"{location.rstrip('/')}/{table}") is not None


def _file_bytes(spark: SparkSession, files: list[str]) -> int:
    """Bytes of files, from one listing of each of their folders."""
    names: dict[str, set[str]] = {}
    for file in files:
        folder, _, name = file.rpartition("/")
        names.setdefault(folder, set()).add(unquote(name))
    total = 0
    for folder, wanted in names.items():
        system, path = _path(spark, unquote(folder))
        total += sum(found.getLen() for found in system.listStatus(path) if found.getPath().getName() in wanted)
    return total


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that `df` is made from, which are only listed."""
    return _file_bytes(df.sparkSession, df.inputFiles())


def _balanced(df: DataFrame, partition_by: str) -> DataFrame:
    """Rebalanced on the partition column: each value goes to few files, small values share a task, and adaptive
    execution splits a value that holds much of the data over many tasks.

    The number of shuffle partitions follows the bytes of the files that `df` is made from, which are only listed: a
    sixteenth of the advised size each, since rows may take four times as much in the shuffle and a partition with several
    small values should stay below a quarter of that size, so that it is not split. Beyond `MOST_PARTITIONS`
    more of them would not separate the days of a decade any better, and larger ones are split in any case.
    """
    spark = df.sparkSession
    advised = spark._jsparkSession.sessionState().conf().getConf(
        spark._jvm.org.apache.spark.sql.internal.SQLConf.ADVISORY_PARTITION_SIZE_IN_BYTES()
    )
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-16 * input_bytes(df) // advised)
    return df.hint("rebalance", max(default, min(MOST_PARTITIONS, wanted)), partition_by)


def replace_table(df: DataFrame, table: str, partition_by: str | None = None) -> None:
    """Overwrites `table` with `df`, which may read the table itself. `df` is computed once.

    The data go to a new version; only when they are complete does the catalog turn to it. The version before stays
    readable. A write that fails leaves nothing but the table as it was.
    """
    spark = df.sparkSession
    home = _home(spark, table)
    number = _claim(spark, home)
    folder = _version(home, number)
    try:
        if partition_by is None:
            write_parquet(df, folder)
        else:
            _replacing(_balanced(df, partition_by)).partitionBy(partition_by).parquet(folder)
        _finish(spark, folder, df, partition_by)
    except BaseException:
        _discard(spark, home, number)
        raise
    system, marker = _path(spark, f"{folder}.claim")
    system.delete(marker, False)
    refresh(spark, table)
    _tidy(spark, home)


def read_table(spark: SparkSession, table: str, layout: T.StructType | None = None) -> DataFrame:
    """The table as it is now, whichever process wrote it, its columns in the order of `layout`; a partition column is
    stored last otherwise."""
    refresh(spark, table)
    df = spark.table(table)
    if layout is None:
        return df
    names = layout.fieldNames()
    return df.select(*names, *[name for name in df.columns if name not in names])
