"""Compare a query's rows with those of its SQL."""

import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def normalize(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(canonical(r[i]) for i in order) for r in rows)


KINDS = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def differences(df, con, sql):
    """Empty if the same columns, types and rows; else a short description."""
    result = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in result.description}
    want = normalize([d[0] for d in result.description], result.fetchall())
    got = normalize(df.columns, [tuple(r) for r in df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    types = {n: (KINDS.get(t, t), sql_types[n]) for n, t in df.dtypes if KINDS.get(t, t) != sql_types[n]}
    if got[1] != want[1]:
        odd = [r for r in got[1] if r not in set(want[1])][:2]
        lost = [r for r in want[1] if r not in set(got[1])][:2]
        return f"{len(got[1])} rows vs {len(want[1])}; only here {odd}; only there {lost}"[:1500]
    return f"types {types}" if types else ""
