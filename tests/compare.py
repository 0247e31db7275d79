"""Compare a registered query with its SQL, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


SPARK_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def spark_result(df) -> tuple[dict[str, str], list[tuple]]:
    kinds = {name: SPARK_TYPES.get(kind, kind) for name, kind in df.dtypes}
    names = sorted(kinds)
    rows = [tuple(_norm(v) for v in row) for row in df.select(*names).collect()]
    return {n: kinds[n] for n in names}, sorted(rows, key=repr)


def duck_result(con, sql: str) -> tuple[dict[str, str], list[tuple]]:
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    kinds = {row[0]: row[1] for row in described}
    names = sorted(kinds)
    quoted = ", ".join(f'"{n}"' for n in names)
    rows = con.execute(f"SELECT {quoted} FROM ({sql})").fetchall()
    rows = [tuple(_norm(v) for v in row) for row in rows]
    return {n: kinds[n] for n in names}, sorted(rows, key=repr)


def _norm(value):
    if isinstance(value, decimal.Decimal):
        raise AssertionError("decimals differ between engines; cast them")
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value
