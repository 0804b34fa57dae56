"""Raw readers, landing paths and sinks on small files."""

import datetime as dt
import json
import os
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.sources import landing, readers, sinks, specs

RUN_DATE = dt.date(2024, 1, 5)
NAMES = schemas.BILLING.fieldNames()
CELLS = dict.fromkeys(NAMES, "x") | dict(net_cost="1.5", usage_amount="2", start_date="2024-01-05")


@pytest.fixture
def csv(spark, tmp_path):
    def read(text, name="billing.csv", spec=specs.BILLING_SOURCE):
        file = tmp_path / name
        file.write_text(text)
        return readers.read_source(spark, replace(spec, file_name=name), str(file))

    return read


@pytest.fixture
def cells(csv):
    """Reads one CSV record built from cell overrides, columns in the given order."""

    def read(names=NAMES, **over):
        row = CELLS | over
        return csv(",".join(names) + "\n" + ",".join(row[n] for n in names) + "\n").collect()

    return read


@pytest.fixture
def prices(spark, tmp_path):
    def read(*documents):
        folder = tmp_path / specs.PRICE_FILE
        folder.mkdir()
        for i, document in enumerate(documents):
            (folder / f"part-{i}.json").write_text(document if isinstance(document, str) else json.dumps(document))
        return readers.read_source(spark, specs.PRICE_SOURCE, str(folder))

    return read


def test_layout(csv):
    df = csv(",".join(NAMES) + "\n")
    assert df.schema == schemas.BILLING
    assert df.count() == 0


@pytest.mark.parametrize("token", ["", "NA", "None", "N/A", "null", "NULL", "#N/A", "nan", "<NA>", '"NA"', '""'])
def test_null_tokens(cells, token):
    (row,) = cells(instance_type=token, net_cost=token)
    assert (row.instance_type, row.net_cost) == (None, None)


@pytest.mark.parametrize("text", ["none", "na", " NA", "0", "-"])
def test_other_text_is_kept(cells, text):
    assert cells(instance_type=text)[0].instance_type == text


def test_columns_are_bound_by_name(cells):
    assert cells(names=NAMES[::-1], account_id="00123", region="r") == cells(account_id="00123", region="r")


def test_leading_zeros_survive(cells):
    assert cells(account_id="00123")[0].account_id == "00123"


def test_doubled_quotes_and_commas(cells):
    assert cells(product_name='"x ""q"" y, z"')[0].product_name == 'x "q" y, z'


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2024-01-05", dt.date(2024, 1, 5)), ("2024-1-5", dt.date(2024, 1, 5)), ("2024-02-30", None),
        ("05/01/2024", None), ("2024-01-05 10:00:00", None), (" 2024-01-05", None), ("2024-001-05", None),
        ("20240105", None), ("9999-12-31", None), ("1677-09-21", None), ("1677-09-22", dt.date(1677, 9, 22)),
        ("2262-04-11", dt.date(2262, 4, 11)), ("2262-04-12", None), ("junk", None),
    ],
)
def test_dates(cells, text, day):
    assert cells(start_date=text)[0].start_date == day


@pytest.mark.parametrize(
    ("text", "value"),
    [("1e3", 1000.0), (" 1.5", 1.5), ("-.5", -0.5), ("5.", 5.0), ("inf", float("inf")), ("-Infinity", float("-inf")), ("NaN", None)],
)
def test_numbers(cells, text, value):
    assert cells(net_cost=text)[0].net_cost == value


@pytest.mark.parametrize("text", ["abc", "1.5d", "2f", "0x1p3", "1 2", "1_000", "NAN"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_junk_number_fails_the_job(spark, cells, text, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="net_cost is not a number"):
            cells(net_cost=text)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_short_record_ends_in_nulls(csv):
    (row,) = csv("account_id,region,usage_type\na,b\n").select("account_id", "region", "usage_type").collect()
    assert tuple(row) == ("a", "b", None)


def test_long_record_fails_the_job(csv):
    df = csv("account_id,region\na,b\na,b,c\n")
    with pytest.raises(PySparkException, match="more than 2 fields"):
        df.collect()
    with pytest.raises(PySparkException, match="more than 2 fields"):
        df.select("region").collect()
    with pytest.raises(PySparkException, match="more than 2 fields"):
        df.count()


def test_absent_column_is_null_and_unknown_columns_are_kept_by_family(csv):
    df = csv("account_id,other,n,x,flag,none\na,b,1,1.5,true,\nc,,-2,3,False,\n")
    assert df.columns == [*NAMES, "other", "n", "x", "flag", "none"]
    assert df.first().region is None
    assert df.select("other", "n", "x", "flag", "none").dtypes == [
        ("other", "string"), ("n", "bigint"), ("x", "double"), ("flag", "boolean"), ("none", "string")]
    assert [tuple(r)[-5:] for r in df.collect()] == [("b", 1, 1.5, True, None), (None, -2, 3.0, False, None)]


def test_header_names_are_bound_without_regard_to_case(csv):
    assert csv("Account_ID,REGION\n007,r\n").select("account_id", "region").first() == ("007", "r")


def test_repeated_header_names_are_named(csv):
    with pytest.raises(ValueError, match="more than once.*Region, region"):
        csv("region,account_id,Region\na,b,c\n")


@pytest.mark.parametrize("tail", ["", '8,"x\ny"\n', '8,x\n9,"\n'])
def test_unclosed_quote_fails_instead_of_swallowing_the_file(csv, tail):
    lines = "".join(f"{i},r{i}\n" for i in range(1000))
    with pytest.raises(ValueError, match="Unclosed quote at the end of .*billing.csv"):
        csv("account_id,region\n" + tail + (lines if tail else "") + ('9,"abc\n' if tail != '8,x\n9,"\n' else "") + lines)


@pytest.mark.parametrize(
    "cell", ['"a\nb"', '"a ""q""\nb"', '"\n"', '"a\n""\nb"', '"a\n,\n\n""x"",\nb"', '"x"\n1,"y\nz"']
)
def test_closed_fields_over_several_lines(csv, cell):
    rows = csv(f"account_id,product_name\n1,{cell}\n2,d\n").select("account_id", "product_name").orderBy("account_id").collect()
    assert tuple(rows[-1]) == ("2", "d")
    assert rows[0].product_name.strip('"') or cell == '"\n"'


def small_splits(spark, size="2KB"):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_a_quote_inside_a_field_does_not_unsplit_the_read(spark, csv):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    small_splits(spark)
    try:
        lines = "".join(f'{i},5" disk {i}\n' for i in range(3000))
        df = csv("account_id,region\n" + lines).select("account_id", "region")
        assert df.rdd.getNumPartitions() > 4
        assert {tuple(r) for r in df.collect()} == {(str(i), f'5" disk {i}') for i in range(3000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def multi_line_text(seed, records, end="\n"):
    """CSV text with quotes and line breaks in fields, and its records."""
    rng = random.Random(seed)
    parts = ["a", "bc", '""', ",", "\n", "\n\n", "é", " ", "\r\n", "1"]
    rows, text = [], "account_id,product_name,region" + end
    for i in range(records):
        quoted = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        plain = "".join(rng.choices(["x", "y", "z", '"', " "], k=rng.randint(1, 5)))
        plain = "p" + plain
        if rng.random() < 0.1:
            quoted += "long " * 300
        rows.append((f"k{i}", quoted.replace('""', '"') or None, plain))
        text += f'k{i},"{quoted}",{plain}{end}' + end * (rng.random() < 0.1)
    return text, rows


@pytest.mark.parametrize(("seed", "size", "end"), [(1, "1KB", "\n"), (2, "3KB", "\n"), (3, "2KB", "\r\n"), (4, "128MB", "\n"), (5, "300B", "\n")])
def test_files_with_fields_over_several_lines_are_read_split(spark, tmp_path, seed, size, end):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    folder = tmp_path / "multi.csv"
    folder.mkdir()
    expected = []
    for part in range(3):
        text, rows = multi_line_text(10 * seed + part, 200, end)
        (folder / f"part {part}.csv").write_bytes(("\ufeff" * (part == 1) + text).encode())
        expected += rows
    small_splits(spark, size)
    try:
        df = readers.read_csv_text(spark, str(folder))
        found = sorted(map(tuple, df.collect()), key=str)
        assert found == sorted(expected, key=str)
        whole = spark.read.csv(str(folder), header=True, multiLine=True, escape='"').select("account_id", "region").collect()
        assert sorted(r[:2] for r in map(tuple, whole)) == sorted((r[0], r[2]) for r in found)
        assert "FileScan csv" not in df._jdf.queryExecution().executedPlan().toString()
        splits = readers._split_states(readers._lines(spark, [str(f) for f in folder.iterdir()], "\n"))
        n = splits.count()
        assert n > 10 if size != "128MB" else n == 3
        if size == "1KB":
            assert splits.where("inside").count() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_record_over_many_splits(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cell = "\n".join(f"line {i}" for i in range(5000))
    (tmp_path / "x.csv").write_text(f'account_id,region\n1,a\n2,"{cell}"\n3,"b\nc"\n')
    small_splits(spark)
    try:
        rows = sorted(map(tuple, readers.read_csv_text(spark, str(tmp_path / "x.csv")).collect()))
        assert rows == [("1", "a"), ("2", cell), ("3", "b\nc")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bare_carriage_returns_are_read_whole(csv):
    rows = csv('account_id,region\r1,"a\rb"\r2,c\r').select("account_id", "region").orderBy("account_id").collect()
    assert [tuple(r) for r in rows][-1] == ("2", "c") and len(rows) == 2


@pytest.mark.parametrize("record", ['1,"a\nb",c', '1,"a\nb","c"'])
def test_long_record_over_lines_fails_the_job(csv, record):
    df = csv(f"account_id,region\n{record}\n2,d\n")
    for use in (df, df.select("region")):
        with pytest.raises(PySparkException, match="more than 2 fields"):
            use.collect()


def test_short_record_over_lines_ends_in_nulls(csv):
    rows = csv('account_id,region,usage_type\n1,"a\nb"\n2,c,d\n').select("account_id", "region", "usage_type").orderBy("account_id").collect()
    assert [tuple(r) for r in rows] == [("1", "a\nb", None), ("2", "c", "d")]


def test_another_header_in_a_file_with_line_breaks_is_rejected(spark, tmp_path):
    (tmp_path / "a.csv").write_text("account_id,region\na,b\n")
    (tmp_path / "b.csv").write_text('region,account_id\nb,"a\nc"\n')
    with pytest.raises(ValueError, match="CSV header does not conform"):
        readers.read_source(spark, specs.BILLING_SOURCE, str(tmp_path))


def test_files_with_and_without_line_breaks_in_fields(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    folder = tmp_path / "a b.csv"
    folder.mkdir()
    for part in range(3):
        (folder / f"part {part}.csv").write_text("account_id,region\n" + "".join(f"{part}-{i},r\n" for i in range(2000)))
    (folder / "part 3.csv").write_text('account_id,region\n3-0,"a\nb"\n')
    small_splits(spark)
    try:
        df = readers.read_source(spark, specs.BILLING_SOURCE, str(folder)).select("account_id", "region")
        assert df.rdd.getNumPartitions() > 6
        rows = df.collect()
        assert len(rows) == 6001 and ("3-0", "a\nb") in {tuple(r) for r in rows}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_line_breaks(csv):
    rows = csv('account_id,product_name\n1,"a\nb, c"\n2,d\n').select("account_id", "product_name").orderBy("account_id").collect()
    assert [tuple(r) for r in rows] == [("1", "a\nb, c"), ("2", "d")]


def test_part_files_with_another_header_are_rejected(spark, tmp_path):
    (tmp_path / "a.csv").write_text("account_id,region\na,b\n")
    (tmp_path / "b.csv").write_text("region,account_id\nb,a\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        readers.read_source(spark, specs.BILLING_SOURCE, str(tmp_path)).collect()


def test_file_without_header(csv):
    with pytest.raises(ValueError, match="No header"):
        csv("\n")


def test_quoted_header_and_blank_lines(csv):
    rows = csv('\n"account_id","region"\n\na,b\n\n').select("account_id", "region").collect()
    assert [tuple(r) for r in rows] == [("a", "b")]


def test_windows_line_ends_and_byte_order_mark(csv):
    rows = csv("\ufeffaccount_id,region\r\na,b\r\n").select("account_id", "region").collect()
    assert [tuple(r) for r in rows] == [("a", "b")]


def test_header_is_found_in_many_splits(spark, tmp_path, csv):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2KB")
    try:
        lines = "".join(f"{i},r{i}\n" for i in range(3000))
        df = csv("account_id,region\n" + lines).select("account_id", "region")
        assert df.rdd.getNumPartitions() > 4
        assert {tuple(r) for r in df.collect()} == {(str(i), f"r{i}") for i in range(3000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_unknown_extension(csv):
    with pytest.raises(ValueError, match="x.xml"):
        csv("", name="x.xml")


def test_numeric_text_prices_and_text_keys(prices):
    (row,) = prices([{"product_code": "007", "product_name": 5, "precio_lista": "0.096"}]).collect()
    assert (row.product_code, row.product_name, row.precio_lista, row.instance_type) == ("007", "5", 0.096, None)


def test_price_layout_keeps_other_columns_by_family(prices):
    df = prices([{"precio_lista": 1, "extra_int": 1, "extra_num": 0.5, "extra_flag": True, "extra_text": "t"}])
    assert df.columns[: len(schemas.PRICES)] == schemas.PRICES.fieldNames()
    assert dict(df.dtypes) | dict(extra_int="bigint", extra_num="double", extra_flag="boolean", extra_text="string") == dict(df.dtypes)
    assert df.first().precio_lista == 1.0


def test_several_documents(prices):
    df = prices([{"product_code": "a"}, {"product_code": "b"}], "\n \n[\n{\"product_code\": \"c\"}\n]\n", "[]")
    assert sorted(r.product_code for r in df.collect()) == ["a", "b", "c"]


@pytest.mark.parametrize("nested", [{"a": 1}, [1]])
def test_nested_price_is_rejected(prices, nested):
    with pytest.raises(TypeError, match="nested column product_code"):
        prices([{"product_code": "x"}, {"product_code": nested}, {"product_code": "y"}])


@pytest.mark.parametrize(
    "document",
    [
        '{"product_code": "a"}\n{"product_code": "b"}\n', "", " \n", '[{"product_code": "a"}]\n[{"product_code": "b"}]',
        '[{"product_code": "a"}], [{"product_code": "b"}]', '[{"product_code": "a"}] trailing', '[{"product_code": "a"}',
        '[{"product_code": "a"}, 5]', '[{"product_code": "a"}, null]', '[1, 2]', '{"product_code": "a"}', "null",
        '[{"product_code": "a"}]]', '[[{"product_code": "a"}]]',
    ],
)
def test_other_than_one_array_of_records_is_rejected(prices, document):
    with pytest.raises((PySparkException, ValueError), match="Not exactly one JSON array of records: .*part-1"):
        prices([{"product_code": "a"}], document)


def test_not_a_number_is_null(prices):
    rows = prices('[{"precio_lista": NaN, "extra": NaN}, {"precio_lista": "NaN", "extra": 1.5}]').collect()
    assert [(r.precio_lista, r.extra) for r in rows] == [(None, None), (None, 1.5)]


def test_kinds_of_one_column_are_widened_over_all_documents(prices):
    df = prices([{"n": 1, "x": 1, "t": 1}], [{"n": None, "x": 0.5, "t": "a"}])
    assert df.select("n", "x", "t").dtypes == [("n", "bigint"), ("x", "double"), ("t", "string")]
    assert sorted(map(tuple, df.select("n", "x", "t").collect()), key=str) == [(1, 1.0, "1"), (None, 0.5, "a")]


def test_names_with_any_characters(prices):
    names = ["a b", "x.y", "it's", 'say "x"', "both ' and \"", "back`tick", "OBJECT<", "[0]", "", "ä"]
    df = prices([{name: i for i, name in enumerate(names)} | {"product_code": "p"}, {"product_code": "q"}])
    rows = {row.product_code: row for row in df.collect()}
    assert {name: rows["p"][name] for name in names} == {name: i for i, name in enumerate(names)}
    assert all(rows["q"][name] is None for name in names)
    assert {dict(df.dtypes)[name] for name in names} == {"bigint"}


@pytest.mark.parametrize("values", [[1, True], [1, "a"], ["a", None, 0.5], [None], [True, "x"], [None, None]])
def test_kinds_that_do_not_merge_are_text(prices, values):
    df = prices([{"product_code": str(i), "mixed": value} for i, value in enumerate(values)])
    assert dict(df.dtypes)["mixed"] == "string"
    shown = {None: None, True: "true"}
    assert [r.mixed for r in df.orderBy("product_code").collect()] == [shown.get(v, str(v)) if v != 1 or v is True else "1" for v in values]


def test_large_and_small_numbers_are_doubles(prices):
    df = prices('[{"n": 123456789012345678901234567890}, {"n": 1}, {"n": 0.1}, {"n": 1e300}]')
    assert dict(df.dtypes)["n"] == "double"
    assert sorted(r.n for r in df.collect()) == [0.1, 1.0, 1.2345678901234568e29, 1e300]


def test_a_name_twice_in_a_record_is_rejected(prices):
    with pytest.raises(PySparkException, match="Not exactly one JSON array of records: .*part-1"):
        prices([{"product_code": "a"}], '[{"product_code": "a", "product_code": "b"}]')


def test_documents_are_parsed_once(prices):
    df = prices([{"product_code": str(i)} for i in range(100)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan text" not in plan and "from_json" not in plan


def test_price_names_are_bound_without_regard_to_case(prices):
    assert prices([{"Product_Code": "a"}]).first().product_code == "a"


def test_price_names_that_differ_in_case_are_named(prices):
    with pytest.raises(ValueError, match="letter case: .*roduct_code"):
        prices([{"Product_Code": "a", "product_code": "b"}])


def test_junk_price_fails_the_job(prices):
    df = prices([{"precio_lista": "cheap"}])
    with pytest.raises(PySparkException, match="precio_lista is not a number"):
        df.collect()


def test_paths():
    spec = replace(specs.PRICE_SOURCE, file_name="a.b.json")
    assert landing.raw_path("root/", spec, RUN_DATE) == "root/a.b/2024/01/05/a.b.json"
    assert landing.stage_path("root", spec, RUN_DATE) == "root/a.b/2024/01/05/a.b.parquet"


def land(root, spec, as_folder=False, run_date=RUN_DATE):
    path = Path(landing.raw_path(str(root), spec, run_date))
    path.parent.mkdir(parents=True)
    if as_folder:
        path.mkdir()
        path = path / "part-0"
    path.write_text("x")


def test_missing_inputs_are_all_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError) as error:
        landing.require_complete(spark, str(tmp_path), RUN_DATE, specs.SOURCES)
    assert str(error.value) == (
        f"Inputs of 2024-01-05 that have not landed under {tmp_path}: "
        "aws_data_desafio/2024/01/05/aws_data_desafio.csv, lista_precios/2024/01/05/lista_precios.json"
    )
    land(tmp_path, specs.PRICE_SOURCE)
    land(tmp_path, specs.BILLING_SOURCE, run_date=dt.date(2024, 1, 6))
    with pytest.raises(FileNotFoundError, match=": aws_data_desafio/2024/01/05/aws_data_desafio.csv$"):
        landing.require_complete(spark, str(tmp_path), RUN_DATE, specs.SOURCES)


@pytest.mark.parametrize("as_folder", [True, False])
@pytest.mark.parametrize("below", ["", "x/2023/01/01/raw", "a b/2024/01/05"])
def test_complete_inputs_pass(spark, tmp_path, as_folder, below):
    root = tmp_path / below
    for spec in specs.SOURCES:
        land(root, spec, as_folder)
    for shown in (str(root), f"{root}/", f"file://{root}", f"file:{root}"):
        landing.require_complete(spark, shown, RUN_DATE, specs.SOURCES)


@pytest.fixture
def database(spark, tmp_path):
    name = "db_" + tmp_path.name.replace("-", "_")
    sinks.create_database(spark, name, str(tmp_path / "tables"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_null_day_and_column_order_survive_a_partitioned_load(spark, database):
    df = spark.createDataFrame([(None, "a"), (RUN_DATE, "b")], "start_date date, other string")
    sinks.replace_table(df, f"{database}.t", partition_by="start_date")
    back = sinks.read_table(spark, f"{database}.t", df.schema)
    assert back.schema == df.schema
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_day_filter_prunes_partitions(spark, database):
    df = spark.range(20).select(F.date_add(F.lit(RUN_DATE), F.col("id").cast("int")).alias("start_date"), "id")
    sinks.replace_table(df, f"{database}.t", partition_by="start_date")
    one_day = spark.table(f"{database}.t").where(F.col("start_date") == F.lit(RUN_DATE))
    assert "PartitionFilters: [isnotnull(start_date" in one_day._jdf.queryExecution().executedPlan().toString()
    assert one_day.count() == 1


def test_second_load_replaces_days_and_schema(spark, database):
    first = spark.createDataFrame([(RUN_DATE, "a", 1)], "start_date date, other string, old int")
    second = spark.createDataFrame([(dt.date(2024, 1, 6), 2.0)], "start_date date, other double")
    sinks.replace_table(first, f"{database}.t", partition_by="start_date")
    sinks.replace_table(second, f"{database}.t", partition_by="start_date")
    back = sinks.read_table(spark, f"{database}.t", second.schema)
    assert back.collect() == second.collect()
    sinks.replace_table(second.select("other"), f"{database}.t")
    assert spark.table(f"{database}.t").columns == ["other"]


def test_a_failed_load_leaves_the_old_table(spark, database):
    sinks.replace_table(spark.range(3), f"{database}.t")
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("boom")).cast("bigint")).otherwise(F.col("id")).alias("id"), F.lit(1).alias("n"))
    for partition_by in (None, "id"):
        with pytest.raises(PySparkException, match="boom"):
            sinks.replace_table(broken, f"{database}.t", partition_by)
        assert spark.table(f"{database}.t").count() == 3
    # What the failed and killed writes left does not count and does not block the next load.
    home = Path(spark.catalog.getDatabase(database).locationUri.removeprefix("file:")) / "t"
    (home / "v00000009").mkdir()
    (home / "v00000009" / "part-0.parquet").write_text("half a file")
    spark.sql(f"DROP TABLE {database}.t")
    sinks.create_database(spark, database, str(home.parent))
    assert spark.table(f"{database}.t").count() == 3
    sinks.replace_table(spark.range(5), f"{database}.t")
    assert spark.table(f"{database}.t").count() == 5
    # A version that is not finished may be the work of another writer, unless it is old.
    assert versions(home) == ["v00000001", "v00000009", "v00000010"]
    os.utime(home / "v00000009", (1, 1))
    (home / "v00000004.claim").touch()
    os.utime(home / "v00000004.claim", (1, 1))
    sinks.replace_table(spark.range(6), f"{database}.t")
    assert versions(home) == ["v00000010", "v00000011"]


def versions(home):
    return sorted(p.name for p in home.iterdir())


def home_of(spark, database, table="t"):
    return Path(spark.catalog.getDatabase(database).locationUri.removeprefix("file:")) / table


def test_interleaved_writers_keep_apart(spark, database, monkeypatch):
    """The second writer starts and ends while the first one writes; then the other way round."""
    table, write = f"{database}.t", sinks.write_parquet
    sinks.replace_table(spark.range(1), table)

    def writes_after_another(df, path):
        monkeypatch.setattr(sinks, "write_parquet", write)
        sinks.replace_table(spark.range(20), table)
        assert sinks.read_table(spark, table).count() == 20
        write(df, path)

    monkeypatch.setattr(sinks, "write_parquet", writes_after_another)
    sinks.replace_table(spark.range(10), table)
    # The first had claimed the lower number, as if it had been replaced by the second right away.
    assert sinks.read_table(spark, table).count() == 20
    home = home_of(spark, database)
    assert versions(home) == ["v00000002", "v00000003"]
    assert spark.read.parquet(str(home / "v00000002")).count() == 10
    sinks.replace_table(spark.range(30), table)
    assert sinks.read_table(spark, table).count() == 30
    assert versions(home) == ["v00000003", "v00000004"]


def test_writers_in_threads_all_finish(spark, database):
    table = f"{database}.t"
    sinks.replace_table(spark.range(1), table)
    home = str(home_of(spark, database))
    claims = ThreadPoolExecutor(4).map(lambda _: sinks._claim(spark, home), range(8))
    assert len(claimed := set(claims)) == 8 and min(claimed) == 2
    sinks.replace_table(spark.range(2), table)
    assert sinks.read_table(spark, table).count() == 2
    assert "v00000010" in versions(Path(home))


@pytest.mark.parametrize("partition_by", [None, "day"])
def test_an_open_reader_reads_on_after_a_replace(spark, database, partition_by):
    table = f"{database}.t"
    rows = spark.range(30).select("id", (F.col("id") % 3).cast("int").alias("day"))
    sinks.replace_table(rows, table, partition_by)
    opened, files = sinks.read_table(spark, table), spark.read.parquet(str(home_of(spark, database) / "v00000001"))
    assert opened.count() == 30
    sinks.replace_table(rows.where("id < 10"), table, partition_by)
    assert opened.count() in (30, 10)  # partitions are looked up in the catalog, files of a folder are not
    assert files.count() == 30
    if partition_by is None:
        assert opened.count() == 30
    assert sinks.read_table(spark, table).count() == 10


def test_a_session_sees_what_another_has_replaced(spark, database):
    """Two catalogs on one location, as two processes have them."""
    location = spark.catalog.getDatabase(database).locationUri
    other = f"{database}_other"
    sinks.replace_table(spark.range(3), f"{database}.t")
    sinks.create_database(spark, other, location)
    try:
        assert sinks.read_table(spark, f"{other}.t").count() == 3
        for n in (4, 5, 6):
            sinks.replace_table(spark.range(n).selectExpr("id", "id AS more"), f"{other}.t")
        assert sinks.read_table(spark, f"{database}.t").columns == ["id", "more"]
        assert sinks.read_table(spark, f"{database}.t").count() == 6
        sinks.replace_table(spark.range(7).selectExpr("id", "1 AS day"), f"{other}.t", partition_by="day")
        sinks.create_database(spark, database, location)
        assert spark.table(f"{database}.t").count() == 7
        assert spark.table(f"{database}.t").where("day = 1").count() == 7
    finally:
        spark.sql(f"DROP DATABASE {other} CASCADE")


def test_a_partitioned_load_reads_its_input_once(spark, database, tmp_path):
    """Every row that is read is counted, in any job of the load."""
    spark.range(5000).select(F.date_add(F.lit(RUN_DATE), (F.col("id") % 20).cast("int")).alias("start_date"), "id").write.parquet(str(tmp_path / "in"))
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(str(tmp_path / "in"))
    sinks.replace_table(df.mapInArrow(count, df.schema), f"{database}.t", partition_by="start_date")
    assert spark.table(f"{database}.t").count() == 5000
    assert read.value == 5000


def test_partitions_of_a_load_follow_the_files(spark, tmp_path):
    df = spark.range(200_000).select((F.col("id") % 7).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    path = tmp_path / "a b%20c"
    df.write.partitionBy("day").parquet(str(path))
    files = [file for file in path.rglob("*.parquet")]
    stored = spark.read.parquet(str(path))
    size = sum(file.stat().st_size for file in files)
    assert sinks._file_bytes(spark, stored.inputFiles()) == size
    plan = sinks._balanced(stored, "day")._jdf.queryExecution().analyzed().toString()
    wanted = -(-16 * size // (64 * 1024))  # the tests' advised size
    assert f"RebalancePartitions [day#" in plan and f", {wanted}" in plan.splitlines()[0]
    plain = sinks._balanced(spark.createDataFrame([(1,)], "day int"), "day")._jdf.queryExecution().analyzed().toString()
    assert f", {spark.conf.get('spark.sql.shuffle.partitions')}" in plain.splitlines()[0]


def test_a_table_may_be_replaced_from_itself(spark, database):
    sinks.replace_table(spark.range(10), f"{database}.t")
    sinks.replace_table(spark.table(f"{database}.t").where("id > 6"), f"{database}.t")
    assert spark.table(f"{database}.t").count() == 3


def test_tables_are_found_by_their_files(spark, database):
    df = spark.createDataFrame([(None, "a"), (RUN_DATE, "b")], "start_date date, other string")
    sinks.replace_table(df, f"{database}.t", partition_by="start_date")
    location = spark.catalog.getDatabase(database).locationUri
    spark.sql(f"DROP TABLE {database}.t")
    sinks.create_database(spark, database, location)
    assert sorted(map(tuple, sinks.read_table(spark, f"{database}.t", df.schema).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert sinks.stored(spark, location, "t") and not sinks.stored(spark, location, "other")


def test_small_days_share_tasks_and_have_one_file_each(spark, database):
    df = spark.range(4000).select(F.date_add(F.lit(RUN_DATE), (F.col("id") % 400).cast("int")).alias("start_date"), "id")
    sinks.replace_table(df.repartition(8), f"{database}.t", partition_by="start_date")
    assert len(spark.table(f"{database}.t").inputFiles()) <= 500


def test_parquet_is_snappy(spark, tmp_path):
    sinks.write_parquet(spark.range(3), str(tmp_path / "x.parquet"))
    assert list((tmp_path / "x.parquet").glob("*.snappy.parquet"))
