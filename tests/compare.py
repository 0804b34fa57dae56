"""Row-by-row comparison of a Spark result with the SQL of the same query on DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in row) for row in df.select(*names).collect())


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], Counter]:
    with duckdb.connect() as connection:
        for file in Path(sf_dir).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
        result = connection.execute(sql)
        names = [column[0] for column in result.description]
        order = sorted(range(len(names)), key=names.__getitem__)
        rows = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    return [names[i] for i in order], rows
