"""Compare one registered query with its DuckDB twin, values included."""

from __future__ import annotations

import datetime as dt
import glob
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short description of what differs."""
    got_rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    want_columns = [c[0] for c in cursor.description]
    want_types = [str(c[1]) for c in cursor.description]
    want_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    got, want = rows_of(df.columns, got_rows), rows_of(want_columns, want_rows)
    if got != want:
        return (
            f"rows {len(got_rows)} vs {len(want_rows)} columns {sorted(df.columns)}\n"
            f"only spark {list((got - want).items())[:3]}\n"
            f"only duckdb {list((want - got).items())[:3]}"
        )
    names = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
             "DATE": "date", "BOOLEAN": "boolean", "NUMBER": None, "STRING": "string"}
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    for name, kind in zip(want_columns, want_types):
        expected = names.get(kind, kind.lower())
        if expected is not None and kinds[name] != expected:
            return f"type of {name}: {kinds[name]} vs {kind}"
    return None
