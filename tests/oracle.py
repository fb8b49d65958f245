"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.9g}"
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _norm(v)) for k, v in value.items()))
    return value


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN", "date": "DATE", "float": "FLOAT",
}


def compare(df, con, sql: str) -> list[str]:
    """Problems found; an empty list means equal."""
    rel = con.sql(sql)
    names, kinds = list(rel.columns), [str(k) for k in rel.types]
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    order = sorted(names)
    for name in order:
        mine = _KINDS.get(df.schema[name].dataType.simpleString(), df.schema[name].dataType.simpleString())
        theirs = kinds[names.index(name)]
        if mine != theirs:
            problems.append(f"type of {name}: {mine} != {theirs}")
    at = [names.index(n) for n in order]
    expected = sorted((tuple(_norm(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    got = sorted((tuple(_norm(r[n]) for n in order) for r in df.collect()), key=repr)
    if not expected:
        problems.append("the SQL gives no rows")
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} != {len(expected)}")
    if got != expected:
        only = [r for r in got if r not in set(expected)][:2] if len(got) < 5000 else []
        miss = [r for r in expected if r not in set(got)][:2] if len(got) < 5000 else []
        pair = next(((a, b) for a, b in zip(got, expected) if a != b), None)
        problems.append(f"values differ {order}: ours {only} theirs {miss} first {pair}"[:900])
    return problems
