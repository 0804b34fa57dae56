"""Readers of raw CSV and JSON inputs, typed for staging.

Everything is read as text and converted afterwards, so that keys such as "00123" survive and junk in a
numeric column fails the job instead of becoming NULL.
"""

from __future__ import annotations

import csv
import re
import uuid
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.conversion import NUMBER, family, nan_to_null, null_tokens, text_to
from ledgerlens.operators.sizing import checkpointed, delete_on_exit, reliable_dir
from ledgerlens.sources.specs import SourceSpec

_LINE = "_source_line"
_DIALECT = {"sep": ",", "quote": '"', "escape": '"'}

# A quote counts only where it opens a field or stands in a field that one has opened.
_FIELD = r"""(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+)"""
_ENDS_OUTSIDE = rf"^{_FIELD}(?:,{_FIELD})*+$"
_CLOSES_AND_ENDS_OUTSIDE = rf"""^[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_FIELD})*+$"""


def _all_text(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _lines(spark: SparkSession, paths: str | list[str], separator: str | None = None) -> DataFrame:
    """Lines with their file, their order in it, and the state, inside of a quoted field or not, that each ends in: `opens`
    if it starts outside, `stays` if it starts inside."""
    line = F.col("value")
    text = spark.read.text(paths) if separator is None else spark.read.text(paths, lineSep=separator)
    closes = ~line.rlike(_CLOSES_AND_ENDS_OUTSIDE)
    return text.select(
        line,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("begin"),
        F.monotonically_increasing_id().alias("position"),  # follows line order inside a split
        (line.contains('"') & ~line.rlike(_ENDS_OUTSIDE)).alias("opens"),
        F.when(line.contains('"'), closes).otherwise(F.lit(True)).alias("stays"),
    )


def _header_and_files(spark: SparkSession, path: str) -> tuple[list[str], list[str], list[str], list[str]]:
    """Column names, then three lists of files from one splittable pass: those without a field that spans lines, those with
    one, and those with one whose lines end in a bare carriage return.

    If no line of a file, read from outside of quotes, ends inside, then every line starts outside, and the file can be
    split. Any part file may supply the header, since the real read checks all of them against it. One row per file
    reaches the driver, which lists the files anyway.
    """
    files = (
        _lines(spark, path)
        .where("value <> ''")
        .groupBy("file")
        .agg(
            F.min_by("value", F.when(F.col("begin") == 0, F.col("position"))).alias("header"),
            F.bool_or("opens").alias("opens"),
        )
        .orderBy("file")
        .collect()
    )
    headers = [row["header"] for row in files if row["header"] is not None]
    if not headers:
        raise ValueError(f"No header in {path}")
    names = _cells(headers[0])
    doubled = sorted({name for name in names if [other.lower() for other in names].count(name.lower()) > 1})
    if doubled:
        raise ValueError(f"Columns that occur more than once in the header of {path}: {', '.join(doubled)}")
    opened = [row for row in files if row["opens"]]
    for row in opened:
        if row["header"] is None or _cells(row["header"]) != names:
            raise ValueError(f"CSV header does not conform to {', '.join(names)}: {row['header']!r} in {unquote(row['file'])}")
    split = [unquote(row["file"]) for row in files if not row["opens"]]
    spanning = [unquote(row["file"]) for row in opened]
    bare = _with_bare_returns(spark, spanning) if spanning else set()
    return names, split, [file for file in spanning if file not in bare], [file for file in spanning if file in bare]


def _cells(header: str) -> list[str]:
    return next(csv.reader([header.lstrip("\ufeff")]))


def _with_bare_returns(spark: SparkSession, files: list[str]) -> set[str]:
    """Files with a carriage return that no line feed follows."""
    text = spark.read.text(files, lineSep="\n").where(F.col("value").rlike(r"\r(?!\z)"))
    return {unquote(row["file"]) for row in text.select(F.col("_metadata.file_path").alias("file")).distinct().collect()}


def _running(maps: DataFrame, within: list[str], order: str) -> DataFrame:
    """Adds what the rows before say of the state at a row's start: `known`, the state after the last row that fixes it whatever
    was before, NULL if none does, and `turned`, whether the rows since then turn it round.

    A row maps the state before it to the state after it: `opens` from outside, `stays` from inside.
    """
    here = Window.partitionBy(*within).orderBy(order)
    fixes, turn = F.col("opens") == F.col("stays"), (F.col("opens") & ~F.col("stays")).cast("int")
    counted = maps.withColumn("_turns", F.sum(turn).over(here.rowsBetween(Window.unboundedPreceding, 0)))
    fixed = F.last(F.when(fixes, F.struct("opens", "_turns")), ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, -1))
    since = F.coalesce(F.lag("_turns").over(here), F.lit(0))
    found = counted.withColumns({"_fixed": fixed, "_since": since})
    turned = (F.col("_since") - F.coalesce("_fixed._turns", F.lit(0))) % 2 == 1
    return found.withColumns({"known": F.col("_fixed.opens"), "turned": turned}).drop("_turns", "_fixed", "_since")


def _inside(before: Column | bool) -> Column:
    """The state at a row's start, given the one before the first row."""
    return F.coalesce("known", before if isinstance(before, Column) else F.lit(before)) != F.col("turned")


_SPLIT = ["file", "begin"]


def _split_states(lines: DataFrame) -> DataFrame:
    """One row per split of a file: `inside`, the state it starts in; `carried`, where the last record before it starts; `header`,
    where the first record of the file starts; `ends`, the state it ends in.

    The maps of a split's lines are composed to a map of the split, and those of the splits to their states.
    """
    shown = F.length(F.rtrim("value", F.lit("\r"))) > 0
    by_start = {}
    for name, before in (("outside", False), ("within", True)):
        starts = F.when(~_inside(before) & shown, F.col("position"))
        after = F.when(_inside(before), F.col("stays")).otherwise(F.col("opens"))
        by_start[name] = F.struct(F.max(starts).alias("last"), F.min(starts).alias("first"), F.max_by(after, "position").alias("ends"))
    maps = _running(lines, _SPLIT, "position").groupBy(*_SPLIT).agg(*[column.alias(name) for name, column in by_start.items()])
    ordered = Window.partitionBy("file").orderBy("begin")
    states = _running(maps.withColumns({"opens": F.col("outside.ends"), "stays": F.col("within.ends")}), ["file"], "begin")
    own = F.when(_inside(False), F.col("within")).otherwise(F.col("outside"))
    return states.select(*_SPLIT, _inside(False).alias("inside"), own.alias("own")).select(
        *_SPLIT,
        "inside",
        F.last("own.last", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"),
        F.min("own.first").over(Window.partitionBy("file")).alias("header"),
        F.last("own.ends").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("ends"),
    )


def _require_closed_quotes(splits: DataFrame) -> None:
    """Raises for files that end inside a quoted field, which a parser would read as one long cell."""
    broken = splits.where("ends").select("file").distinct().orderBy("file").limit(10).collect()
    if broken:
        raise ValueError(f"Unclosed quote at the end of {', '.join(unquote(row['file']) for row in broken)}")


def _records_over_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """record: text of each record but the header, from files read split.

    A line that starts outside of quotes starts a record; those that start inside continue it, from one split into the
    next too. States come from a pass that keeps one row per split; then lines move to their split and to their record.
    """
    lines = _lines(spark, files, "\n")
    splits = checkpointed(_split_states(lines))
    _require_closed_quotes(splits)
    here = Window.partitionBy(*_SPLIT).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    placed = _running(lines, _SPLIT, "position").join(splits, _SPLIT).withColumn("inside", _inside(F.col("inside")))
    starts = ~F.col("inside") & (F.length(F.rtrim("value", F.lit("\r"))) > 0)
    keyed = placed.withColumns({"starts": starts, "record": F.max(F.when(starts, F.col("position"))).over(here)})
    kept = keyed.where("starts OR inside").withColumn("record", F.coalesce("record", "carried")).where(F.col("record") != F.col("header"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "value"))), lambda line: line["value"]), "\n")
    return kept.groupBy("record").agg(F.rtrim(text, F.lit("\r")).alias("record_text")).select(F.col("record_text").alias("record"))


def _fits_header(names: list[str]) -> Column:
    """True, or a failed job for a record with more fields than the header.

    Shorter records are fine and end in NULLs. Only a record whose field count differs from the header
    carries its text in `_LINE`. The message names the first field because Spark refuses a query that
    needs `_LINE` alone, as a count would.
    """
    wider = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    surplus = F.from_csv(F.col(_LINE), wider, _DIALECT)[f"c{len(names)}"]
    first = F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))
    complaint = F.concat(F.lit(f"more than {len(names)} fields in the record of "), first, F.lit(": "), F.col(_LINE))
    return F.when(F.col(_LINE).isNotNull() & surplus.isNotNull(), F.raise_error(complaint).cast("boolean")).otherwise(
        F.lit(True)
    )


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header as text columns, bound by header name, null tokens removed.

    Part files whose header differs from the first one are rejected rather than bound by position, and a file that
    ends inside a quoted field is rejected. Files with fields that span lines are read split as well, by their records;
    only such files whose lines end in bare carriage returns are read whole.
    """
    names, split, spanning, bare = _header_and_files(spark, path)
    layout = _all_text([*names, _LINE])
    if bare:
        _require_closed_quotes(_split_states(_lines(spark, bare)))

    def rows(files: list[str] | str, multi_line: bool) -> DataFrame:
        return (
            spark.read.schema(layout)
            .options(**_DIALECT, columnPruning=False)  # fields are counted whichever columns a query needs
            .csv(files, header=True, enforceSchema=False, columnNameOfCorruptRecord=_LINE, multiLine=multi_line)
        )

    parts = []
    if split:
        parts.append(rows(split if spanning or bare else path, False))
    if spanning:
        options = {**_DIALECT, "columnNameOfCorruptRecord": _LINE, "multiLine": "true"}
        columns = ", ".join(f"{_quoted(name)} string" for name in layout.fieldNames())
        parts.append(_records_over_lines(spark, spanning).select(F.from_csv("record", columns, options).alias("cells")).select("cells.*"))
    if bare:
        parts.append(rows(bare, True))
    raw = reduce(DataFrame.unionByName, parts)
    return raw.where(_fits_header(names)).select(*map(null_tokens, names))


def _bound(spec: SourceSpec, names: list[str]) -> tuple[dict[str, str], list[str]]:
    """(declared name to name in the input, other names); letter case does not matter."""
    declared = {name.lower(): name for name in spec.declared.fieldNames()}
    return {declared[name.lower()]: name for name in names if name.lower() in declared}, [name for name in names if name.lower() not in declared]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _read_csv(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    text = read_csv_text(spark, path)
    bound, others = _bound(spec, text.columns)
    columns = [
        text_to(field, F.col(_quoted(bound[field.name])) if field.name in bound else F.lit(None).cast("string")).alias(field.name)
        for field in spec.declared
    ]
    if others:
        columns += _typed_by_family(text, others)
    return text.select(*columns)


def _typed_by_family(text: DataFrame, names: list[str]) -> list[Column]:
    """Columns of text under the narrowest family that takes all their values, from one pass over these columns."""
    def all_match(name: str, pattern: str) -> Column:
        return F.coalesce(F.bool_and(F.col(_quoted(name)).rlike(pattern)), F.lit(False))

    whole_number, truth = r"^\s*[+-]?\d{1,18}\s*\z", r"^([Tt]rue|TRUE|[Ff]alse|FALSE)\z"
    families = [F.struct(all_match(n, whole_number), all_match(n, NUMBER), all_match(n, truth)) for n in names]
    columns = []
    for name, (integral, number, flag) in zip(names, text.agg(*families).first(), strict=True):
        kind = "bigint" if integral else "double" if number else "boolean" if flag else "string"
        value = F.col(_quoted(name))
        columns.append((value if kind == "string" else F.trim(value).cast(kind)).alias(name))
    return columns


_COMPLAINT = "Not exactly one JSON array of records: "


def _records(spark: SparkSession, path: str) -> DataFrame:
    """record (a variant), file: one row per element of the JSON documents.

    Each document must be one array. It is parsed within an array of our own, whose last element is empty: text after
    it, a second array, a surplus bracket or an empty document then shows in the outer size. What cannot be parsed is
    NULL. Either fails the job, and so does an element that is null.
    """
    document = F.concat(F.lit("["), F.col("value"), F.lit(",[]]"))
    parsed = F.from_json(document, "array<array<variant>>")
    whole = spark.read.text(path, wholetext=True).select(parsed.alias("arrays"), F.col("_metadata.file_path").alias("file"))
    complaint = F.concat(F.lit(_COMPLAINT), F.col("file"))
    faulty = F.col("arrays").isNull() | (F.size("arrays") != 2) | F.col("arrays")[0].isNull() | F.exists(F.col("arrays")[0], F.is_variant_null)
    checked = F.when(faulty, F.raise_error(complaint).cast("array<variant>")).otherwise(F.col("arrays")[0])
    return whole.select(F.explode(checked).alias("record"), "file")


def _kept_records(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """(records, merged schema of all): the documents are parsed once, into a scratch table that can be read split, and the
    schema is merged by the same job."""
    folder = f"{reliable_dir(spark).rstrip('/')}/records-{uuid.uuid4().hex}"
    delete_on_exit(spark, folder)
    records, seen = _records(spark, path), Observation()
    merged = F.schema_of_variant_agg("record").alias("schema")
    records.observe(seen, merged).write.mode("overwrite").parquet(folder)
    return spark.read.schema(records.schema).parquet(folder), seen.get["schema"]


def _empty_files(spark: SparkSession, path: str) -> list[str]:
    """Data files of no bytes, which Spark's readers leave out of their listing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    empty = [file.getPath() for file in files if file.isFile() and file.getLen() == 0]
    return sorted(file.toString() for file in empty if not file.getName().startswith(("_", ".")))


_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT<")


def _member(name: str, kind: str) -> Column:
    """A member of a record, whatever characters its name has; NULL where its value is not of that kind."""
    for quote in "'\"":
        if quote not in name:
            return F.try_variant_get("record", f"$[{quote}{name}{quote}]", kind)
    return F.try_variant_get(F.variant_get("record", "$", "map<string,variant>")[F.lit(name)], "$", kind)


def _kinds(spark: SparkSession, records: DataFrame, merged: str) -> dict[str, str]:
    """Names of all members in order, each with the type that takes all its values.

    Members whose kinds do not merge are looked at once more, since an object or an array must not pass for text.
    """
    if merged == "VOID":  # no record at all
        return {}
    if not merged.startswith("OBJECT<"):
        others = records.where(~F.schema_of_variant("record").startswith("OBJECT<")).select("file").distinct().orderBy("file").limit(10)
        raise ValueError(_COMPLAINT + ", ".join(row["file"] for row in others.collect()))
    layout = T.StructType.fromDDL(f"record {_OBJECT.sub(lambda m: 'STRUCT<' if m[0] == 'OBJECT<' else m[0], merged)}")["record"].dataType
    mixed = [field.name for field in layout if isinstance(field.dataType, T.VariantType)]
    nested = {field.name for field in layout if isinstance(field.dataType, (T.StructType, T.ArrayType))}
    if mixed:
        deep = [F.bool_or(F.schema_of_variant(_member(name, "variant")).rlike("^(OBJECT|ARRAY)<")) for name in mixed]
        nested |= {name for name, found in zip(mixed, records.agg(*deep).first(), strict=True) if found}
    if nested:
        raise TypeError(f"nested column {min(nested)} cannot be staged")
    return {field.name: family(field.dataType) for field in sorted(layout, key=lambda field: field.name)}


def _read_json(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    """One pass over the documents; their records are kept in the shared scratch folder until the driver ends."""
    empty = _empty_files(spark, path)
    if empty:
        raise ValueError(_COMPLAINT + ", ".join(empty[:10]))
    records, merged = _kept_records(spark, path)
    found = _kinds(spark, records, merged)
    bound, others = _bound(spec, list(found))
    alike = sorted(name for name in found if [other.lower() for other in found].count(name.lower()) > 1)
    if alike:
        raise ValueError(f"Columns that differ only in letter case: {', '.join(alike)}")

    columns = []
    for field in spec.declared:
        cell = _member(bound[field.name], "string") if field.name in bound else F.lit(None).cast("string")
        if isinstance(field.dataType, T.DoubleType):
            cell = F.nullif(cell, F.lit("NaN"))
        columns.append(text_to(field, cell).alias(field.name))
    for name in others:
        own = _member(name, found[name])
        columns.append((nan_to_null(own) if found[name] == "double" else own).alias(name))
    return records.select(*columns)


_READERS: dict[str, Callable[[SparkSession, SourceSpec, str], DataFrame]] = {".csv": _read_csv, ".json": _read_json}


def read_source(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    """Typed DataFrame of one raw input; the reader is chosen by file extension."""
    for extension, reader in _READERS.items():
        if spec.file_name.endswith(extension):
            return reader(spark, spec, path)
    raise ValueError(f"Unsupported file format: {spec.file_name}")
