"""Compare a Spark result with its SQL counterpart, row for row."""

from __future__ import annotations

import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(cell):
    if isinstance(cell, decimal.Decimal):
        cell = float(cell)
    if isinstance(cell, float):
        return None if math.isnan(cell) else float(f"{cell:.12g}")
    if hasattr(cell, "isoformat"):
        return cell.isoformat()
    return cell


def kind(type_name: str) -> str:
    names = {
        "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE",
    }
    return names.get(type_name, type_name)


def rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((c is not None, str(type(c)), c) for c in row)
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=key)


def compare(df, sql: str, connection) -> list[str]:
    """Differences in columns, types, row counts and values; empty when equal."""
    relation = connection.sql(sql)
    names = relation.columns
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    found = []
    theirs = dict(zip(names, map(str, relation.types)))
    for name, type_name in df.dtypes:
        if kind(type_name) != theirs[name]:
            found.append(f"type of {name}: {type_name} != {theirs[name]}")
    a = rows(df.collect(), df.columns)
    b = rows(relation.fetchall(), names)
    if len(a) != len(b):
        found.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        only_a, only_b = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
        found.append(f"values: spark {only_a} sql {only_b}")
    return found
