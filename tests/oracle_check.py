"""Compare a Spark result with the answer DuckDB gives on the same tables."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if hasattr(value, "as_tuple"):
        return round(float(value), 9)
    return value


def normalised(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(shaped, key=repr)


def spark_answer(df) -> tuple[list[str], list[tuple]]:
    return normalised(df.columns, [tuple(r) for r in df.collect()])


def duck_answer(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return normalised(columns, result.fetchall())


def difference(got, wanted) -> str | None:
    if got[0] != wanted[0]:
        return f"columns {got[0]} != {wanted[0]}"
    if len(got[1]) != len(wanted[1]):
        return f"rows {len(got[1])} != {len(wanted[1])}; first {got[1][:1]} / {wanted[1][:1]}"
    for a, b in zip(got[1], wanted[1]):
        if a != b:
            return f"row {a} != {b}"
    return None
