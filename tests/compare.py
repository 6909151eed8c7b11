"""Compare a Spark result with the DuckDB result of the matching SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return _rows(df.columns, df.collect())


def sql_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def difference(df, con, sql):
    """None if the results are the same, else a short description."""
    (left_names, left), (right_names, right) = spark_rows(df), sql_rows(con, sql)
    if left_names != right_names:
        return f"columns {left_names} vs {right_names}"
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    differing = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(differing)} of {len(left)} rows differ, e.g. {differing[0]}" if differing else None
