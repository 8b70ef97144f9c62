"""Compare a Spark result with the result of its SQL twin."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

from ferrytab.plans.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    """A value that is equal for equal results of both engines."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.10g}"
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return (type(value).__name__, str(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


# Spark types and the types of the other engine that hold the same values.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def differences(df, connection, sql: str) -> list[str]:
    """What differs between a frame and a query: columns, row counts or rows."""
    relation = connection.sql(sql)
    order, theirs = sorted(df.columns), sorted(relation.columns)
    if order != theirs:
        return [f"columns {order} and {theirs}"]
    ours = {name: TYPES.get(kind, kind.upper()) for name, kind in df.dtypes}
    kinds = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    problems = [f"type of {c}: {ours[c]} and {kinds[c]}" for c in order if ours[c] != kinds[c]]
    rows = Counter(tuple(plain(v) for v in row) for row in df.select(*order).collect())
    expected = Counter(
        tuple(plain(v) for v in row)
        for row in connection.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in order)} FROM ({sql})").fetchall()
    )
    if rows.total() != expected.total():
        problems.append(f"{rows.total()} rows and {expected.total()}")
    for label, extra in (("only here", rows - expected), ("only there", expected - rows)):
        problems += [f"{label}: {row}" for row, _ in list(extra.items())[:3]]
    return problems
