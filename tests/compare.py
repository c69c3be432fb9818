"""Runs a query and its SQL on the same tables and compares them as sorted rows."""

from __future__ import annotations

import math
import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if hasattr(v, "tolist"):
        return plain(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if isinstance(v, int):
        return float(v)
    try:
        return float(v) if type(v).__name__ == "Decimal" else v
    except (TypeError, ValueError):
        return v


def mismatch(df, con, sql: str, tolerance: float = 0.0) -> str | None:
    """What differs, or nothing."""
    order = sorted(df.columns)
    rel = con.sql(sql)
    if sorted(rel.columns) != order:
        return f"columns {order} against {sorted(rel.columns)}"
    mine = [tuple(plain(row[c]) for c in order) for row in df.collect()]
    at = [rel.columns.index(c) for c in order]
    theirs = [tuple(plain(row[i]) for i in at) for row in rel.fetchall()]
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    key = lambda row: tuple((x is None, str(type(x)), str(round(x, 3)) if isinstance(x, float) else str(x)) for x in row)
    for a, b in zip(sorted(mine, key=key), sorted(theirs, key=key), strict=True):
        for x, y in zip(a, b, strict=True):
            if x != y and not (tolerance and isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=tolerance, abs_tol=tolerance)):
                return f"{dict(zip(order, a, strict=True))} against {dict(zip(order, b, strict=True))}"
    return None
