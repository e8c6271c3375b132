"""Side-by-side comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in sorted(os.listdir(sf_dir)):
        if f.endswith(".parquet"):
            p = os.path.join(sf_dir, f)
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{p if os.path.isfile(p) else p + '/*.parquet'}')")
    return c


def plain(v):
    """A value both engines agree on."""
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "asDict"):
        return tuple((k, plain(x)) for k, x in sorted(v.asDict().items()))
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if type(v).__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    return v


def compare(df, con, sql: str) -> str:
    """Empty if the results agree, else what differs."""
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} and {sorted(names)}"
    at = [names.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    if got == want:
        return ""
    a, b = set(map(repr, got)), set(map(repr, want))
    return f"{len(got)} and {len(want)} rows; only here {sorted(a - b)[:3]}; only there {sorted(b - a)[:3]}"
