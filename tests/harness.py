"""Comparison of a Spark result with its SQL text run by DuckDB."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_KIND = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
    "FLOAT": "float",
}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return repr(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, con, sql: str) -> list[str]:
    """Empty when names, types and all values agree."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    found = []
    spark_types = dict(df.dtypes)
    if set(spark_types) != set(expected_types):
        return [f"columns {sorted(spark_types)} against {sorted(expected_types)}"]
    for name, kind in spark_types.items():
        if _KIND.get(expected_types[name], expected_types[name]) != kind:
            found.append(f"type of {name}: {kind} against {expected_types[name]}")
    expected = rows_of(relation.columns, relation.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(expected) != len(got):
        found.append(f"{len(got)} rows against {len(expected)}")
    if expected != got:
        only_got = sorted(set(got) - set(expected))[:3]
        only_expected = sorted(set(expected) - set(got))[:3]
        found.append(f"columns {sorted(df.columns)}; only in Spark {only_got}; only in SQL {only_expected}")
    return found
