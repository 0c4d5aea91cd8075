"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connection(folder: str):
    con = duckdb.connect()
    for p in sorted(Path(folder).glob("*.parquet")):
        source = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{source}')")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return None if isinstance(v, float) and math.isnan(v) else round(float(v), 4)
    return str(v)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(_plain(r[k]) for k in order) for r in data), key=repr)


def differences(spark, folder: str, query, sql: str) -> str:
    df = query(spark, folder)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    got = connection(folder).execute(sql)
    names = [c[0] for c in got.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    theirs = rows(names, got.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows and {len(theirs)}: {[r for r in mine if r not in set(theirs)][:2]} {[r for r in theirs if r not in set(mine)][:2]}"
    return next((f"{a} and {b}" for a, b in zip(mine, theirs) if a != b), "")
