"""Rows of a Spark frame and of a DuckDB relation in a form that can be compared."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Spark's simple type names and what DuckDB calls them.
TYPES = {
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "array<float>": "FLOAT[]",
}


def duck_type(simple: str) -> str:
    return simple.upper() if simple.startswith("decimal") else TYPES[simple]


def plain(value):
    if isinstance(value, Decimal):
        return value.normalize()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def spark_result(df):
    names = sorted(df.columns)
    types = [df.schema[n].dataType.simpleString() for n in names]
    rows = Counter(tuple(plain(row[n]) for n in names) for row in df.collect())
    return names, [duck_type(t) for t in types], rows


def duck_result(folder, sql):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    relation = connection.sql(sql)
    order = sorted(range(len(relation.columns)), key=lambda i: relation.columns[i])
    names = [relation.columns[i] for i in order]
    types = [str(relation.types[i]).replace(" ", "") for i in order]
    rows = Counter(tuple(plain(row[i]) for i in order) for row in relation.fetchall())
    connection.close()
    return names, types, rows
