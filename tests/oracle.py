"""Side-by-side run of a registered query and its SQL, compared as sorted rows."""

from __future__ import annotations

import glob
import os
from decimal import Decimal

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return ("float", repr(v))
    if hasattr(v, "asDict"):
        return ("struct", str(v.asDict()))
    return (type(v).__name__, str(v))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {
    "TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int", "BIGINT": "bigint",
    "HUGEINT": "hugeint", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def compare(con, df, sql):
    """(problem or None, number of rows)"""
    got = df.collect()
    rel = con.sql(sql)
    names, types = rel.columns, [str(t) for t in rel.types]
    want = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    theirs = {n: KINDS.get(t, t.lower().replace(" ", "")) for n, t in zip(names, types)}
    if ours != theirs:
        diff = {n: (ours[n], theirs[n]) for n in ours if ours[n] != theirs[n]}
        return f"types (ours, sql) {diff}", len(got)
    a, b = _rows(df.columns, got), _rows(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}", len(got)
    for x, y in zip(a, b):
        if x != y:
            return f"values\n  ours {x}\n  sql  {y}", len(got)
    return None, len(got)
