"""Compare a Spark result with a DuckDB result, whatever the row order."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    by_name = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in by_name) for r in rows)


_FAMILY = {
    "bigint": "bigint", "int": "integer", "string": "varchar", "timestamp_ntz": "timestamp",
    "boolean": "boolean", "double": "double",
}


def assert_same(df, con, sql: str) -> int:
    found = df.collect()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]).lower() for d in result.description}
    wanted = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    for name, kind in df.dtypes:
        if name in types and kind in _FAMILY and types[name] != '"null"':
            assert types[name] == _FAMILY[kind], (name, kind, types[name])
    left, right = rows_of(df.columns, found), rows_of(columns, wanted)
    assert len(found) == len(wanted)
    assert left == right, (list((left - right).items())[:3], list((right - left).items())[:3])
    return len(found)
